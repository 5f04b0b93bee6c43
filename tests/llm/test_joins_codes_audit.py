"""Prefix join, Orchard codes and filter audit against plain versions on small awkward inputs."""

import hashlib
import math
import random
import re
from itertools import permutations

import brute
import numpy as np
import pytest
from test_dedup import AWKWARD, documents, near_group

from pricepanel.llm import filter_audit, prefix_join, queries, vector_codes

SF = "/root/testdata/sf0.001"


# --- prefix join -------------------------------------------------------------

def joined(spark, rows, **options):
    found = prefix_join.groups(documents(spark, rows), **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, found), key=str)


@pytest.mark.parametrize("slots", [1, 1 << 12])  # one slot: all shingles count as equally frequent
def test_links_equal_brute_force(spark, slots):
    rows = AWKWARD + near_group(1, 0, 40, 2) + near_group(2, 100, 40, 3, words=100) + near_group(3, 200, 60, 4, words=150)
    assert joined(spark, rows, slots=slots) == sorted(brute.near_duplicates(rows, 3, 90), key=str)


def test_members_apart_from_the_commonest_component_meet(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k:])) for i, k in enumerate(rng.sample(range(120), 30))]
    for i in range(30):  # chains: every text differs from the one before by one word
        base[rng.randrange(120)] = f"y{i}"
        rows.append((100 + i, " ".join(base)))
    assert joined(spark, rows) == sorted(brute.near_duplicates(rows, 3, 90), key=str)


def test_classes_of_one_group(spark):
    """Sets of one size with identical prefixes are one group; its members are still compared."""
    common = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(common + [f"t{i}", f"u{i}", f"v{i}"])) for i in range(12)]
    assert joined(spark, rows, slots=1) == sorted(brute.near_duplicates(rows, 3, 90), key=str)


def test_documents_of_the_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op11_prefix_join"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_duplicates(rows, 3, 90))


# --- vector codes -------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, error string"


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ids = sorted({i for i, _, _ in kept if i is not None})[:entries]
    width = len(kept[0][1]) // parts
    firsts = [min(v for j, v, _ in kept if j == i) for i in ids]
    books = [[v[p * width:(p + 1) * width] for v in firsts] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    def assigned():
        return [[nearest(p, v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            held = {}
            for (_, v, _), f in zip(kept, found):
                held.setdefault(f[p][1], []).append(v[p * width:(p + 1) * width])
            for k, vs in held.items():
                books[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    found = assigned()
    errors = [sum(d for d, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), e, sum(x for x, (_, _, m) in zip(errors, kept) if m == l), digest)
            for (i, _, l), f, e in zip(kept, found, errors)]


def coded(spark, rows):
    table = spark.createDataFrame([(*r, "a", "b") for r in rows], VECTORS)
    return sorted(map(tuple, vector_codes.compressed(table).collect()), key=str)


@pytest.mark.parametrize("n,spread", [(9, 1.0), (60, 1.0), (300, 0.002)])  # few ids, many, ties everywhere
def test_codes_equal_plain_training(spark, n, spread):
    rng = random.Random(n)
    rows = [(i * 3, [rng.uniform(-spread, spread) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[4], (None, [0.5] * 16, None), (5000, None, 1), (5001, [None] * 16, 1),
             (5002, [float("nan")] * 16, 1), (-1, [float("inf")] * 16, 1)]
    assert coded(spark, rows) == sorted(plain_codes(rows), key=str)


def test_vectors_without_a_code_stay(spark):
    rows = [(i, [float(i)] * 8, 1) for i in range(4)] + [(10, [1.0] * 7, 1), (11, [], None), (12, [1e30] * 8, 1)]
    got = {r[0]: r[1:4] for r in coded(spark, rows)}
    assert got[10] == (None, None, 0) and got[11][:2] == (None, None) and got[12] == (None, None, 0) and got[3][:2] == ("03" * 8, 0)
    assert coded(spark, rows[:0]) == []
    assert [r[1] for r in coded(spark, [(1, [1.0] * 7, 1), (2, [], 1)])] == [None, None]


def test_orchard_equals_full_search_with_fewer_distances():
    rng = np.random.default_rng(3)
    for _ in range(20):
        entries = rng.integers(-50, 50, (16, 4))
        entries[5] = entries[2]
        points = np.concatenate((entries[rng.integers(0, 16, 400)] + rng.integers(-6, 7, (400, 4)), rng.integers(-60, 60, (100, 4))))
        every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        nearest, distance, measured = vector_codes.orchard(points, entries)
        assert (nearest == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
        assert measured < every.size


# --- filter audit -------------------------------------------------------------

DOCS = "doc_id bigint, text string, source string, part string, n bigint, good string, id string, digest string"
LABELS = "doc_id bigint, quality int, toxic int, part string"


def failed(doc_id, text, rows):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return {k for k, f in {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)}.items() if f}


def plain_audit(rows, labels):
    marks = [(s or "", failed(i, t or "", rows), any(l[0] == i and l[1] == 1 for l in labels if i is not None),
              any(l[0] == i and l[2] == 1 for l in labels if i is not None)) for i, t, s in rows]
    out = []
    for part in {m[0] for m in marks}:
        mine, shapley = [m[1:] for m in marks if m[0] == part], dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            for step, k in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [m for m in mine if k in m[0] and not m[0] & before]
                shapley[k] += len(gone)
                lines.append((part, "".join(order), step, sum(not m[0] & (before | {k}) for m in mine), len(gone),
                              sum(k in m[0] and bool(m[0] & before) for m in mine), sum(m[0] == {k} for m in mine),
                              sum(m[1] for m in gone), sum(m[2] for m in gone)))
        out += [(*x, shapley[x[1][x[2] - 1]]) for x in lines]
    return out


def audit_inputs(seed=1):
    rng = random.Random(seed)

    def text():
        n = rng.choice([0, 5, 49, 50, 51, 80, 300])
        words = [f"w{rng.randrange(rng.choice([20, 500]))}" for _ in range(n)]
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        return rng.choice([" ", "\n", " \t"]).join(words) + rng.choice(["", "", " $", "|"])

    rows = [(i, text(), rng.choice(["s1", "s1", "s2", "", None])) for i in range(60)]
    rows += [(100 + i, rng.choice(rows)[1], "s2") for i in range(30)]
    rows += [rows[0], rows[0], (None, rows[0][1], "s1"), (None, "x", None), (200, None, "s3"), (201, "", "s1"), (3, "other words", "s1"),
             (300, "Long word " * 9000, "s2"), (301, "\x0b\x0c \t\r\n", "s2")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in range(0, 130, 2)] + [(4, 1, 1, "y"), (4, 0, 0, "z"), (None, 1, 1, "w")]
    return rows, labels


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, s, "p", 7, "g", "i", "d") for i, t, s in rows], DOCS)
    return filter_audit.audit(docs, spark.createDataFrame(labels, LABELS))


def test_audit_equals_plain_counts(spark):
    rows, labels = audit_inputs()
    got = audited(spark, rows, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_audit(rows, labels))


def test_audit_of_empty_tables(spark):
    rows, labels = audit_inputs()
    assert audited(spark, [], labels).count() == 0
    assert sorted(map(tuple, audited(spark, rows[:3], []).collect())) == sorted(plain_audit(rows[:3], []))
