"""Near duplicates, line dedup, quality rules and decontamination on small awkward inputs."""

import hashlib
import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import components as C
from pricepanel.llm import decontaminate, line_dedup, quality, superminhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, label string, h1 string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], DOCS)


def near_group(seed, base_id, n, edits, words=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"v{rng.randrange(400)}"
        out.append((base_id + k, " ".join(w)))
    return out


AWKWARD = [(900, None), (901, ""), (902, "  \t\n "), (903, "One"), (904, "one"), (905, "one two"), (906, "One  Two"), (906, "One  Two"),
           (None, "one two"), (None, "lonely words without an id at all here"), (907, "a " * 5000)]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    rows = AWKWARD + near_group(1, 0, 40, 2) + near_group(2, 100, 40, 4) + near_group(3, 200, 60, 6)
    got = superminhash.groups(documents(spark, rows), shingle=size).select("doc_id", "n_shingles", "component_id").collect()
    want = brute.near_duplicates(rows, size)
    # a null id stands apart from the known ids of its group
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_row_of_each_group_stays(spark):
    rows = AWKWARD + near_group(1, 0, 30, 1)
    kept = superminhash.remove_near_duplicates(documents(spark, rows), shingle=2)
    assert kept.columns == documents(spark, rows).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    sets = {i: c for i, _, c in brute.near_duplicates([r for r in rows if r[0] is not None], 2)}
    assert ids == sorted([*{c for c in sets.values()}, None], key=str)


def test_empty_tables(spark):
    empty = documents(spark, [(1, "x")]).limit(0)
    assert superminhash.groups(empty).count() == 0
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    assert quality.keep_documents(empty).count() == 0
    assert decontaminate.contamination_spans(empty, spark.createDataFrame([], "item_id string, text string")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("hub", f"leaf{i}") for i in range(50)] + [("hub", "hub")]
    got = {r.node: r.label for r in C.components(spark.createDataFrame(chain + star, "a string, b string").repartition(7)).collect()}
    assert {got[f"c{i:03d}"] for i in range(61)} == {"c000"} and {got[f"leaf{i}"] for i in range(50)} == {"hub"}


def test_signatures_estimate_similarity():
    import numpy as np
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
    b = np.concatenate((a[:800], rng.integers(0, 2**63, 100).astype(np.uint64)))
    s = superminhash.signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), 512)
    assert np.isfinite(s).all() and abs((s[0] == s[1]).mean() - 800 / 1000) < 0.06


LINE = "This line is long enough to count as a repeated line of text"


def brute_lines(rows):
    keys = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = x.strip(" \t\n\x0b\f\r").translate(brute.UPPER)
            if len(k) >= 40:
                keys.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        kept = [x for x in (t or "").split("\n")
                if not (len(h := keys.get(x.strip(" \t\n\x0b\f\r").translate(brute.UPPER), ())) >= 5 and i != max(h))]
        out.append((i, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_line_dedup(spark):
    rows = [(i, f"own {i}\n  {LINE.upper() if i % 2 else LINE}\t\n\n{LINE}\nÉÀ {LINE}") for i in range(9)]
    rows += [(20, LINE), (21, None), (22, ""), (23, "\n\n"), (24, "short\n" * 30), (25, "ÄÖ" * 30), (26, f"{LINE}x\n" * 5000), (20, LINE)]
    docs = documents(spark, rows)
    mapped = line_dedup.with_bitmaps(docs)
    got = mapped.select("doc_id", F.sha2(line_dedup.kept_lines(F.col("text"), F.col("_keep_bitmap")), 256)).collect()
    assert sorted(map(tuple, got)) == brute_lines(rows)
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


def brute_repeats(text):
    w = brute.WORD.findall(text or "")
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    return len({p + k for at in seen.values() if len(at) > 1 for p in at for k in range(3)})


def test_quality_counts(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab cd ef gh é# $$".split()) for _ in range(rng.randrange(90)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a"), (103, "a b a b a b\n\na b a b"), (104, "x\nx\n\nx y\n \nx"), (105, "q w e " * 4000)]
    got = {r.doc_id: r for r in quality.verdicts(documents(spark, rows)).collect()}
    for i, t in rows:
        w, lines = brute.WORD.findall(t or ""), [x for x in (t or "").split("\n") if brute.WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols) == (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")))
        assert (got[i].n_dup_lines, got[i].n_repeat_words) == (len(lines) - len(set(lines)), brute_repeats(t))
        assert got[i].base_failed == (len(w) < 50 or 2 * brute_repeats(t) > len(w)) and not (got[i].base_failed and got[i].kept)


def test_quality_outliers_go_and_ordinary_texts_stay(spark):
    rng = random.Random(4)
    clean = [(i, " ".join(f"word{rng.randrange(9999)}" for _ in range(80))) for i in range(150)]
    junk = [(500 + i, " ".join(f"word{rng.randrange(9999)}%%%" for _ in range(80))) for i in range(5)]
    kept = quality.keep_documents(documents(spark, clean + junk).withColumn("lang", F.lit(None).cast("string")))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(150))


def brute_hits(text, items, window=13):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    words = word.findall((text or "").translate(brute.UPPER))
    held = {}
    for name, t in items:
        w = word.findall((t or "").translate(brute.UPPER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            held.setdefault(tuple(w[k:k + n]), set()).add(name)
    hit, found = set(), set()
    for n in {len(x) for x in held}:
        for i in range(len(words) - n + 1):
            if names := held.get(tuple(words[i:i + n])):
                hit |= set(range(i, i + n))
                found |= names
    return len(words), len(hit), sorted(x for x in found if x is not None)


@pytest.mark.parametrize("chunk", [3, 500_000])
def test_decontamination_equals_brute_force(spark, chunk):
    rng = random.Random(7)
    words = [f"t{i}" for i in range(6)] + ["é", "ß9"]
    items = [(str(i), " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate([0, 1, 2, 5, 13, 14, 20, 20])]
    items += [("null", None), (None, "zz yy"), ("again", items[4][1]), ("again", items[4][1])]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(30)]
    rows += [(40, f"Head, {items[5][1].upper()}! tail"), (41, None), (42, ""), (43, "ZZ--yy"), (43, "ZZ--yy"), (None, items[6][1]),
             (44, f"{items[7][1]} " * 3), (45, "filler " * 3000 + items[6][1])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    spans = decontaminate.contamination_spans(documents(spark, rows), bench, max_patterns=chunk)
    got = decontaminate.judge(spans).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    want = [(i, *brute_hits(t, items)) for i, t in rows]
    want = [(i, w, h, x, h > 0 and 20 * h >= w) for i, w, h, x in want]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = decontaminate.remove_contaminated(documents(spark, rows), bench, max_patterns=chunk)
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(w[0]) for w in want if not w[-1])


CLASHING = ["n_words", "kept", "_id", "_n_words", "n_tokens", "_words", "_text_id", "_keep_bitmap", "_spans", "_row", "base_failed", "limit_word_length", "a name, with. signs"]


def test_extra_columns_may_have_any_name(spark):
    """Stages carry columns that are called like their own, unchanged."""
    from pricepanel.llm import bpe
    import public_tokenizers
    rows = near_group(1, 0, 30, 1) + [(500 + i, f"line {i} alone\n" + "a line of more than forty characters that many documents share\n" + f"end {i}") for i in range(8)]
    plain = documents(spark, rows)
    extra = plain.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    benchmark = spark.createDataFrame([("b1", " ".join(rows[3][1].split()[:20]))], "item_id string, text string")
    for stage in (quality.keep_documents, line_dedup.drop_repeated_lines, superminhash.remove_near_duplicates,
                  lambda d: decontaminate.remove_contaminated(d, benchmark)):
        got, want = stage(extra), stage(plain)
        assert got.columns == extra.columns and got.schema == extra.schema
        got = {r.doc_id: r for r in got.collect()}
        assert {i: r[:7] for i, r in got.items()} == {r.doc_id: tuple(r) for r in want.collect()}
        assert all(r[c] == f"{c}-{i}" for i, r in got.items() for c in CLASHING)
    coded = bpe.encoded(extra, public_tokenizers.path("word_bpe_49k.json"))
    assert coded.columns.count("n_tokens") == 1 and coded.schema["n_tokens"].dataType.simpleString() == "bigint"
    assert {r.doc_id: r.kept for r in coded.collect()} == {i: f"kept-{i}" for i, _ in rows}
