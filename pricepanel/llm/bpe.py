"""BPE encoding and decoding with a contiguous rank array per short word.

The vocabulary file (a JSON of token ids and ordered merges, word ends marked
by a suffix) is read once on the driver and broadcast: its size is that of a
vocabulary, not of the data. Tasks split a slice of texts at white space, look each
distinct piece up once in a bounded cache, cut the missing ones into words by the
vocabulary's rule and encode the new words: the parts of a
word and the ranks of its adjacent pairs sit in two contiguous arrays; the
least rank is searched, one boundary deleted, two neighbouring ranks renewed.
Many new words of one length are the rows of two such arrays and take each step together.
Very long words use a heap over the same ranks instead of the repeated scan.

Null texts read as empty and give no ids. Any text, of any length, is encoded
whole; strings of special tokens in a text become their ids. Rows are handled
one by one, so ties, repeats and further columns need no rule.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm import arrowtext as T
from pricepanel.session import ship_package

#: Longest word (in parts) that the repeated scan handles.
SHORT_WORD = 64
#: Words in the young and the old half of a worker's cache; longer words than CACHED_WORD aren't kept.
CACHE_ENTRIES = 350_000
CACHED_WORD = 64
#: Characters of a text that are split into words at a time (cut at white space).
PIECE = 1 << 20
#: Bytes of texts whose words are looked up together, and how many new words at least are encoded together.
LOOKUP_BYTES = 4 << 20
MANY_WORDS = 4_000

# White space and the word pattern of the vocabulary file.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACE = re.compile(f"[{SPACES}]")
WORDS = regex.compile(rf"{ENDINGS}|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")


def _of_category(kind: str, below: int) -> str:
    return "".join(f"\\u{c:04x}" for c in range(below) if unicodedata.category(chr(c))[0] == kind)


#: The same pattern for text of code points below LATIN_END, for the faster ``re``.
LATIN_END = 0x250
BEYOND_LATIN = re.compile(f"[^\\x00-\\u{LATIN_END - 1:04x}]")
_L, _N = _of_category("L", LATIN_END), _of_category("N", LATIN_END)
LATIN_WORDS = re.compile(f"{ENDINGS}|[{_L}]+|[{_N}]|[^{SPACES}{_L}{_N}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte value in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    kept = set(plain)
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


#: White space of Python's ``split`` that the vocabulary takes for text.
CONTROLS = "\x1c\x1d\x1e\x1f"


def _of_latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def normal(text: str) -> tuple[str, Callable[[str], list[str]]]:
    """The vocabulary's normal form of a text without special tokens, and what cuts it into words.

    Latin-1 texts are in NFC as they are.
    """
    if text.isascii() or _of_latin_1(text):
        return text.lower(), LATIN_WORDS.findall
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    low = text.replace("\u03a3", "\u03c3").lower()  # letter by letter: str.lower() has a rule for final sigma
    return low, WORDS.findall if BEYOND_LATIN.search(low) else LATIN_WORDS.findall


def words_of(text: str) -> list[str]:
    """The words of a text without special tokens, after the vocabulary's normal form."""
    low, find = normal(text)
    return find(low)


def _find(chunk: str) -> list[str]:
    return (WORDS if BEYOND_LATIN.search(chunk) else LATIN_WORDS).findall(chunk)


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE characters, cut at white space."""
    begin = 0
    while len(text) - begin > PIECE and (cut := SPACE.search(text, begin + PIECE)):
        yield text[begin:cut.start()]
        begin = cut.end()
    yield text[begin:]


class Vocabulary:
    """Ids, pair ranks and special tokens of a vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + end] for c in letters]
        # left id -> {right id: rank}, and rank -> merged id
        self.ranks: list[dict[int, int]] = [{} for _ in self.tokens]
        self.merged: list[int] = []
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[a]].setdefault(ids[b], n)
            self.merged.append(ids[a + b])
        self.none = len(self.merged)
        # The same ranks for many words at once: sorted pairs and their ranks, with a last pair that no word has.
        pairs = sorted((a << 32 | b, r) for a, of in enumerate(self.ranks) for b, r in of.items())
        self.pairs = np.array([p for p, _ in pairs] + [2**63 - 1], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] + [self.none], np.int32)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.wide = len(self.tokens) > 1 << 16

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word given as UTF-8."""
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        return self._scan(parts) if len(parts) <= SHORT_WORD else self._heap(parts)

    def words(self, raws: list[bytes], kind: np.dtype) -> list[bytes]:
        """Packed ids of many words given as UTF-8: the scan of ``word``, a row each, for all words of a length at once."""
        out: list[bytes] = [b""] * len(raws)
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        flat, begins = np.frombuffer(b"".join(raws), np.uint8), np.cumsum(sizes) - sizes
        inner, last, merged = (np.array(x, np.int32) for x in (self.inner, self.last, self.merged))
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            if size > SHORT_WORD:
                for r in rows.tolist():
                    out[r] = np.array(self.word(raws[r]), kind).tobytes()
                continue
            raw = flat[begins[rows][:, None] + np.arange(size)]
            parts = inner[raw]
            parts[:, -1] = last[raw[:, -1]]
            ranks = self._ranks(parts[:, :-1], parts[:, 1:])
            while len(rows):
                width = ranks.shape[1]
                at = ranks.argmin(1) if width else np.zeros(len(rows), np.int64)
                least = ranks[np.arange(len(rows)), at] if width else np.full(len(rows), self.none)
                done = least == self.none
                if done.any():
                    packed, step = parts[done].astype(kind).tobytes(), (width + 1) * kind.itemsize
                    for n, r in enumerate(rows[done].tolist()):
                        out[r] = packed[n * step:(n + 1) * step]
                    rows, parts, ranks, at, least = (x[~done] for x in (rows, parts, ranks, at, least))
                    if not len(rows):
                        break
                every = np.arange(len(rows))
                parts[every, at] = merged[least]
                parts, ranks = _without(parts, at + 1), _without(ranks, at)  # the boundary between the two parts
                k = np.flatnonzero(at > 0)
                ranks[k, at[k] - 1] = self._ranks(parts[k, at[k] - 1], parts[k, at[k]])
                k = np.flatnonzero(at < width - 1)
                ranks[k, at[k]] = self._ranks(parts[k, at[k]], parts[k, at[k] + 1])
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, pairs)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], np.int32(self.none))

    def _scan(self, parts: list[int]) -> list[int]:
        of, none, merged = self.ranks, self.none, self.merged
        ranks = [of[a].get(b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            part = parts[at] = merged[least]
            del parts[at + 1], ranks[at]  # the boundary between the two parts
            if at:
                ranks[at - 1] = of[parts[at - 1]].get(part, none)
            if at < len(ranks):
                ranks[at] = of[part].get(parts[at + 1], none)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        of, size = self.ranks, len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i in range(size - 1) if (r := of[parts[i]].get(parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= size or of[parts[i]].get(parts[j]) != r:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = self.merged[r], -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < size and (new := of[parts[left]].get(parts[after[left]])) is not None:
                    heapq.heappush(heap, (new, left))
        return [p for p in parts if p >= 0]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: the vocabulary file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _without(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Every row less its value at one place."""
    kept = np.ones(rows.shape, bool)
    kept[np.arange(len(rows)), at] = False
    return rows[kept].reshape(len(rows), rows.shape[1] - 1)


class Encoder(dict):
    """Whole texts to ids; itself the young half of the cache of words (packed little-endian ids)."""

    def __init__(self, vocabulary: Vocabulary, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.vocabulary, self.entries, self.old = vocabulary, entries, {}
        self.kind = np.dtype("<u4" if vocabulary.wide else "<u2")

    def __missing__(self, word: str) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            packed = self.pack(self.vocabulary.word(word.encode()))
        self.keep(word, packed)
        return packed

    def keep(self, word: str, packed: bytes) -> None:
        if len(word) <= CACHED_WORD:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[word] = packed

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.kind.char}", *ids)

    def keep_all(self, made: dict[str, bytes]) -> None:
        """``keep`` for many words, whose long ones leave ``made``; no half grows beyond its entries."""
        for w in [w for w in made if len(w) > CACHED_WORD]:
            del made[w]
        if len(self) + len(made) > self.entries:
            self.old = dict(self)
            self.clear()
        self.update(made if len(made) <= self.entries else islice(made.items(), self.entries))

    def prepare(self, words: list[str]) -> dict[str, bytes]:
        """Called with words that are not in the young half before they are looked up; those made here, kept as well."""
        return {}

    def looked_up(self, text: str) -> list[bytes]:
        """Packed ids of a piece of text, one lookup for everything between two white spaces.

        No word reaches over white space, so what stands between is cached as a
        whole and cut into words only when it is new.
        """
        low, find = normal(text)
        if any(c in low for c in CONTROLS):
            words = find(low)
            self.prepare(words)
            return list(map(self.__getitem__, words))
        chunks = low.split()
        found = list(map(self.get, chunks))
        if None not in found:
            return found
        made = {c: self.old.get(c) for c, f in zip(chunks, found) if f is None}
        new = [c for c, e in made.items() if e is None]
        cut = {c: (c,) if c.isalpha() else find(c) for c in new}  # letters alone are one word
        self.prepare([w for words in cut.values() for w in words])
        for c, words in cut.items():
            made[c] = self[c] if len(words) == 1 else b"".join(map(self.__getitem__, words))
        for c, e in made.items():
            self.keep(c, e)
        return [made[c] if f is None else f for c, f in zip(chunks, found)]

    def chunks_packed(self, chunks: list[str], find: Callable[[str], list[str]]) -> list[bytes]:
        """Packed ids of distinct chunks of normal form; no word reaches from one chunk into another."""
        found = list(map(self.get, chunks))
        missing = [i for i, e in enumerate(found) if e is None]
        made: dict[str, bytes] = {}
        new: dict[str, None] = {}
        whole, cut = [], []
        for i, e in zip(missing, map(self.old.get, [chunks[i] for i in missing])):
            c = chunks[i]
            if e is not None:
                found[i] = made[c] = e
            elif c.isalpha():  # letters alone are one word
                new[c] = None
                whole.append(i)
            else:
                cut.append((i, find(c)))
        for w in set(chain.from_iterable(words for _, words in cut)):
            if (e := self.get(w) or self.old.get(w)) is not None:
                made[w] = e
            else:
                new[w] = None
        made.update(prepared := self.prepare(list(new)))
        words = [w for w in new if w not in prepared] if prepared else list(new)
        raws, v = [w.encode() for w in words], self.vocabulary
        made.update(zip(words, v.words(raws, self.kind) if len(raws) >= MANY_WORDS else [self.pack(v.word(r)) for r in raws]))
        for i in whole:
            found[i] = made[chunks[i]]
        for i, words in cut:
            found[i] = b"".join(map(made.__getitem__, words))
        made.update((chunks[i], found[i]) for i, _ in cut)
        self.keep_all(made)
        return found

    def packed_all(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of every text (null: empty) of a bounded slice, one lookup for each distinct chunk of them all.

        Texts with special tokens and very long ones are encoded one by one.
        """
        if not texts:
            return []
        special = self.vocabulary.special
        alone = {i: self.packed(t) for i, t in enumerate(texts) if t and (len(t) > PIECE or any(s in t for s in special))}
        lows, finds = zip(*(normal(t if t and i not in alone else "") for i, t in enumerate(texts)))
        find = LATIN_WORDS.findall if all(f == LATIN_WORDS.findall for f in finds) else _find
        chunks = pc.ascii_split_whitespace(pa.array(lows, pa.string()))
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self.chunks_packed(distinct, find), pa.binary()).take(coded.indices)
        _, places, data = ids.buffers()
        bounds = np.frombuffer(places, np.int32)[chunks.offsets.to_numpy()].tolist()
        return [alone[i] if i in alone else data[s:e].to_pybytes() if e > s else b""
                for i, (s, e) in enumerate(zip(bounds, bounds[1:]))]

    def packed(self, text: str) -> bytes:
        v, out = self.vocabulary, []
        for part in v.cut.split(text) if any(t in text for t in v.special) else (text,):
            if part in v.special:
                out.append(self.pack([v.special[part]]))
                continue
            for piece in pieces(part):
                out += self.looked_up(piece)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), self.kind).tolist()


_ENCODERS: dict[int, Encoder] = {}


def encoder(content) -> Encoder:
    """The worker's encoder for a broadcast vocabulary (kept over the tasks of a worker)."""
    key = hash(content.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Vocabulary(content.value))
    return _ENCODERS[key]


def read_vocabulary(spark, path: str):
    """The vocabulary file, read on the driver and broadcast (a few MB at most)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(documents: DataFrame, vocabulary_path: str, with_ids: bool = True, with_digests: bool = True) -> DataFrame:
    """``documents`` without ``text``, with ``n_tokens``, the ids, and digests of ids and decoded text.

    A column of ``documents`` with the name of a result gives way to the result.

    One map stage over the scan: no shuffle. ``token_ids`` is an array of int;
    ``ids_sha256`` and ``decoded_sha256`` digest the decimal ids joined by a
    space and the text decoded from those ids.
    """
    spark = documents.sparkSession
    ship_package(spark)
    content = read_vocabulary(spark, vocabulary_path)
    made = ["n_tokens", *["token_ids"] * with_ids, *["ids_sha256", "decoded_sha256"] * with_digests]
    rest = [f for f in documents.schema.fields if f.name not in ["text", *made]]
    fields = T.fields_of(rest)
    fields += ", n_tokens bigint" + ", token_ids array<int>" * with_ids
    fields += ", ids_sha256 string, decoded_sha256 string" * with_digests
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(content)
        v = enc.vocabulary
        decimal = [str(i) for i in range(len(v.tokens))]
        for batch in batches:
            for part in T.slices(batch, "text", LOOKUP_BYTES):
                counts, arrays, ids_sha, text_sha = [], [], [], []
                for packed in enc.packed_all(part.column("text").to_pylist()):
                    ids = np.frombuffer(packed, enc.kind)
                    counts.append(len(ids))
                    if with_ids:
                        arrays.append(ids.astype(np.int32))
                    if with_digests:
                        listed = ids.tolist()
                        ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, listed)).encode()).hexdigest())
                        text_sha.append(hashlib.sha256(v.decode(listed).encode()).hexdigest())
                columns = [part.column(f"c{i}") for i in range(len(names))] + [pa.array(counts, pa.int64())]
                columns += [pa.array(arrays, pa.list_(pa.int32()))] * with_ids
                columns += [pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())] if with_digests else []
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_tokens", *["token_ids"] * with_ids,
                                                           *["ids_sha256", "decoded_sha256"] * with_digests])

    text = F.col("text").cast("string").alias("text")
    return documents.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)], text).mapInArrow(run, fields)
