"""Secrets in texts: fixed patterns, and values whose guess cost is high.

Three patterns are taken as they come (``base_spans``). The method adds values
that stand in a credential context ("password is ...", "login: ...", with or
without quotes): the least number of guesses that an attacker needs is found by
dynamic programming over the value, as the cheapest way to cut it into words,
dates, repeats, keyboard walks, alphabet runs, separators and brute-force characters. A value
that costs at least MIN_LOG10 (decimal logarithm of guesses) is a secret; a
value made of words and years is a placeholder or prose and is left alone.

Words cost their rank in a dictionary: the words and word parts of a public
vocabulary file, in its order, then the words of the texts themselves by their
counts (``corpus_words``, counted over all documents, the DICTIONARY commonest).
A letter outside all words costs what the letters of the dictionary say about
the one before it, its whole class at most.

Every rule looks at bounded pieces (words of up to MAX_WORD letters, dates) or
at maximal runs, so a value of n characters takes n steps and texts of any length are
scanned whole. Offsets are code points, ends exclusive. Null and empty texts
have no spans. Rows are judged alone: ties, repeats and further columns need no
rule; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm import arrowtext as T
from pricepanel.session import ship_package

KINDS = ("assign", "access", "hex", "guess")
MIN_LOG10 = 8.0
#: Words of the texts in the dictionary, and the longest word there.
DICTIONARY = 200_000
MAX_WORD = 24


def either_case(words: str) -> str:
    """The pattern with its letters in either case (ASCII only)."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# The three base patterns.
ASSIGN = re.compile("(" + either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f]{24,}")

#: Words before a credential (whole, or from a capital after a small letter: dbPwd), and what may stand between them and the value.
CONTEXT_WORDS = ("password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "apikey", "api_key", "api-key",
                 "credential", "credentials", "login", "auth", "private_key", "access_key")
CONTEXT = re.compile(r"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?:" + either_case("|".join(sorted(CONTEXT_WORDS, key=len, reverse=True)))
                     + r""")["']?[\x20\t]*(?::=|=>|->|[:=]|(?:is|was)[\x20\t])[\x20\t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'<>,;]+))""")
#: A context starts with one of these, in lower case; texts without any are not searched further.
SIGNS = ("pass", "pwd", "secret", "token", "api", "credential", "login", "auth", "private_key", "access_key")

# What attackers try first in this place, most likely first; the rest of the dictionary is given.
FIRST = ("password 123456 qwerty admin welcome letmein login secret token key api pass test guest user root changeme default example sample "
         "demo temp dummy none null true false your here my the value string name client id").split()
LEET = str.maketrans("013457@$!", "oleastasi")

KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                  r"|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:19|20)?\d\d"
                  r"|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d")

#: Guesses for one character of each class, and for choosing the start of a run.
CLASSES = ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10))
OTHER = 33
RUN_STARTS = 47


def _neighbours() -> set[tuple[str, str]]:
    pairs = set()
    for row in (*KEYBOARD, ALPHABET, "0123456789"):
        for a, b in zip(row, row[1:]):
            pairs |= {(a, b), (b, a)}
    for upper, lower in zip(KEYBOARD, KEYBOARD[1:]):
        for i, a in enumerate(upper):
            pairs |= {(a, b) for b in lower[max(0, i - 1):i + 1]} | {(b, a) for b in lower[max(0, i - 1):i + 1]}
    return pairs


WALK = _neighbours()


def character_cost(c: str) -> float:
    for test, size in CLASSES:
        if c.isascii() and test(c):
            return math.log10(size)
    return math.log10(OTHER if c.isascii() else 256)


def _runs(value: str) -> Iterator[tuple[int, int, float]]:
    """Maximal repeats and walks as (start, end, cost): a start, a length, and a turn or so."""
    low = value.lower()
    for same in (lambda a, b: a == b, lambda a, b: (a, b) in WALK):
        begin = 0
        for i in range(1, len(low) + 1):
            if i == len(low) or not same(low[i - 1], low[i]):
                if i - begin >= 3:
                    yield begin, i, math.log10(RUN_STARTS * 2 * (i - begin))
                begin = i
    for m in re.finditer(r"(.{2,8}?)\1+", value):
        unit = sum(map(character_cost, m[1]))
        yield m.start(), m.end(), unit + math.log10((m.end() - m.start()) // len(m[1]))


SEPARATORS = "_-. /:"


class Guesser:
    """Prices of words and letters, from a dictionary in the order in which it would be tried."""

    def __init__(self, words: Iterable[str] = ()):
        self.rank: dict[str, int] = {}
        for w in (*FIRST, *CONTEXT_WORDS, *words):
            if 2 <= len(w) <= MAX_WORD:
                self.rank.setdefault(w, len(self.rank) + 1)
        after: dict[str, Counter] = {}
        for w, r in self.rank.items():
            for a, b in zip(w, w[1:]):
                after.setdefault(a, Counter())[b] += 1 / r
        flat = math.log10(26)
        self.letter = {a + b: min(flat, -math.log10(n / sum(c.values()))) for a, c in after.items() for b, n in c.items()
                       if a in ALPHABET and b in ALPHABET}

    def pieces(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Every piece of ``value`` with a price: (start, end, log10 of guesses)."""
        low, plain = value.lower(), value.lower().translate(LEET)
        if len(low) != len(value) or len(plain) != len(value):
            low = plain = value  # letters whose small form is longer
        yield from _runs(value)
        for m in DATE.finditer(value):
            digits = sum(c.isdigit() for c in m[0])
            yield m.start(), m.end(), math.log10(200 * (365 if digits > 6 else 12 if digits > 4 else 1))
        for end in range(1, len(value) + 1):
            c = value[end - 1]
            cost = math.log10(len(SEPARATORS)) if c in SEPARATORS else character_cost(c)
            yield end - 1, end, min(cost, self.letter.get(value[max(end - 2, 0):end], cost))
            for begin in range(max(0, end - MAX_WORD), end - 1):
                rank = self.rank.get(low[begin:end])
                leet = rank is None
                if leet and (rank := self.rank.get(plain[begin:end])) is None:
                    continue
                changes = (value[begin:end] != low[begin:end]) + leet
                yield begin, end, math.log10(rank * 2 ** changes + 1)

    def cost(self, value: str) -> float:
        """log10 of the guesses of the cheapest segmentation; ``best[j]`` is that of the first j characters."""
        ends: list[list[tuple[int, float]]] = [[] for _ in range(len(value) + 1)]
        for begin, end, cost in self.pieces(value):
            ends[end].append((begin, cost))
        best = [0.0]
        for j in range(1, len(value) + 1):
            best.append(min(best[begin] + cost for begin, cost in ends[j]))
        return best[-1]


def vocabulary_words(path: str) -> list[str]:
    """Words and word parts of a public vocabulary file (of the tokenizers library), in its order."""
    with open(path, encoding="utf-8") as f:
        ranked = json.load(f)["model"]["vocab"]
    parts = (t.removesuffix("</w>") for t in sorted(ranked, key=ranked.get))
    return [w for w in dict.fromkeys(parts) if len(w) > 2 and w.isascii() and w.isalpha()]


WORDS = re.compile(r"[^\W\d_]{2,%d}" % MAX_WORD)


def corpus_words(documents: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The ``size`` commonest words of all texts, in small letters, by count (ties by the word).

    Counted in the tasks and added up by Spark; the driver holds ``size`` words.
    """
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def told() -> pa.RecordBatch:
            told = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return told

        for batch in batches:
            for part in T.slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    counts.update(WORDS.findall((text or "").lower()))
                if len(counts) > 200_000:
                    yield told()
        yield told()

    words = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n bigint")
    ranked = words.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(size)
    return [r.word for r in ranked.select("word").collect()]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return in_order(spans)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def guess_spans(text: str, guesser: Guesser, min_log10: float = MIN_LOG10) -> list[tuple[int, int, str]]:
    """(start, end, "guess") of values in credential context that are dear to guess."""
    spans = []
    for m in CONTEXT.finditer(text):
        n = next(k for k in (1, 2, 3) if m[k] is not None)
        value = m[n] if n < 3 else m[n].rstrip(".!?)")
        if value and guesser.cost(value) >= min_log10:
            spans.append((m.start(n), m.start(n) + len(value), "guess"))
    return spans


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_text(text: str, guesser: Guesser, min_log10: float = MIN_LOG10) -> tuple[list, list]:
    """(base spans, added spans) of one text."""
    low = text.lower()
    if any(s in low for s in SIGNS):
        base, added = base_spans(text), guess_spans(text, guesser, min_log10)
    else:
        spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)] if "AKIA" in text else []
        base, added = in_order(spans), []
    return base, added


SPANS = "array<struct<kind: string, start: bigint, end: bigint, added: boolean>>"


_GUESSERS: dict[int, Guesser] = {}


def _guesser(words) -> Guesser:
    """The worker's prices for a broadcast dictionary."""
    key = hash(words.value[:1000]) ^ len(words.value)
    if key not in _GUESSERS:
        _GUESSERS.clear()
        _GUESSERS[key] = Guesser(words.value)
    return _GUESSERS[key]


def secret_spans(documents: DataFrame, key: str = "doc_id", min_log10: float = MIN_LOG10, words: Iterable[str] = ()) -> DataFrame:
    """(key, spans, base_sha256, listed) per document row: a pass that counts words, and a map stage without a shuffle.

    ``words`` is a dictionary, likeliest words first, that comes before the words of the texts.
    """
    spark = documents.sparkSession
    ship_package(spark)
    dictionary = spark.sparkContext.broadcast(tuple(dict.fromkeys([*words, *corpus_words(documents)])))
    docs = documents.select(F.col(f"`{key}`").alias("_key"), F.col("text").cast("string").alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = _guesser(dictionary)
        for batch in batches:
            for part in T.slices(batch, "text"):
                spans, digests, lists = [], [], []
                for text in part.column("text").to_pylist():
                    base, added = scan_text(text or "", guesser, min_log10)
                    spans.append([{"kind": k, "start": s, "end": e, "added": k == "guess"} for s, e, k in in_order(base + added)])
                    digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                    lists.append(listed(in_order(base + added)))
                yield pa.RecordBatch.from_arrays([part.column("_key"), pa.array(spans, kind), pa.array(digests, pa.string()),
                                                  pa.array(lists, pa.string())], ["_key", "spans", "base_sha256", "listed"])

    schema = f"_key {docs.schema['_key'].dataType.simpleString()}, spans {SPANS}, base_sha256 string, listed string"
    return docs.mapInArrow(run, schema).withColumnRenamed("_key", key)
