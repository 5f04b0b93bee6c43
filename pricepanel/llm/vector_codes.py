"""Product codes of integer vectors, assigned by Orchard's search.

Vectors become integers and are cut into equal parts; every part position has a
codebook, trained by rounds of exact integer averages. Parts meet their nearest
entry by Orchard's method: every entry keeps the other entries sorted by their
distance from it. The search holds a current entry, walks its list, measures
entries not visited before, jumps to the list of an entry that is nearer, and
stops at the first entry beyond twice the current distance: by the triangle
inequality no later one can be nearer (an entry at exactly twice the distance
may tie, so it is still measured). Ties go to the lower index.

A round is one pass over the stored parts: tasks return one partial sum per
part position and entry, which are added up by Spark; the driver holds only the
codebooks (16 entries of one vector's length). All rows are used in every round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.tables import stored
from pricepanel.session import ship_package

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Largest integer component coded; squared distances of such vectors fit 64 bits up to 1024 components.
LARGEST = 1 << 25
#: Vectors handled at a time in a task.
BATCH = 4096

Codebook = np.ndarray  # entries x length of a part


def neighbour_lists(entries: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """For every entry: all entries by distance from it (ties by index), and the squared distances in that order."""
    gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    order = np.argsort(gaps, axis=1, kind="stable")
    return order, np.take_along_axis(gaps, order, axis=1)


def orchard(points: np.ndarray, entries: Codebook) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry and squared distance of every point, and the number of distances measured.

    All points walk at once; each has its own current entry, place in that
    entry's list and marks of visited entries.
    """
    order, gaps = neighbour_lists(entries)
    n, k = len(points), len(entries)

    def measured(rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        return ((points[rows] - entries[which]) ** 2).sum(axis=1)

    every = np.arange(n)
    current, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    best = measured(every, current)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    active, count = every, n
    while len(active):
        at = current[active], place[active]
        candidate, gap = order[at], gaps[at]
        within = gap <= 4 * best[active]  # squares: the list goes on up to twice the current distance
        active, candidate = active[within], candidate[within]
        fresh = ~visited[active, candidate]
        rows, found = active[fresh], candidate[fresh]
        visited[rows, found] = True
        distance = measured(rows, found)
        count += len(rows)
        place[active] += 1
        nearer = (distance < best[rows]) | ((distance == best[rows]) & (found < current[rows]))
        rows, found = rows[nearer], found[nearer]
        current[rows], best[rows], place[rows] = found, distance[nearer], 0
        active = active[place[active] < k]
    return current, best, count


def as_integers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, whole): the vectors as integers floor(4096 x).

    Rows whose vector is null or holds a null or non-finite component go.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    largest = float(1 << 62)  # keeps the cast defined; such vectors get no code
    whole = F.transform(x, lambda v: F.greatest(F.least(F.floor(v.cast("double") * SCALE), F.lit(largest)), F.lit(-largest)).cast("bigint"))
    return embeddings.where(x.isNotNull() & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label"), whole.alias("whole"))


def first_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[Codebook]:
    """Per part position that part of the vectors of the smallest ids, ascending (a repeated id: its least vector)."""
    least = kept.where("vec_id is not null").groupBy("vec_id").agg(F.min("whole").alias("whole"))
    chosen = [r.whole for r in least.orderBy("vec_id").limit(entries).collect()]
    length = len(chosen[0]) if chosen else 0
    if not length:
        return []
    rows = np.array([v for v in chosen if len(v) == length], np.int64).reshape(-1, length)
    return np.split(rows, parts, axis=1) if length % parts == 0 else []


def _vectors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Bounded slices with the rows that have a code and their vectors."""
    for batch in batches:
        for begin in range(0, batch.num_rows, BATCH):
            part = batch.slice(begin, BATCH)
            lists = part.column("whole")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            fits = np.flatnonzero(sizes == length)
            flat = lists.filter(pa.array(sizes == length)).flatten().to_numpy().reshape(-1, length)
            coded = np.abs(flat).max(axis=1, initial=0) <= LARGEST
            yield part, fits[coded], flat[coded]


def _partial_sums(books: list[Codebook]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for _, _, vectors in _vectors(batches, sum(b.shape[1] for b in books)):
            for i, points in enumerate(np.split(vectors, len(books), axis=1)):
                nearest, _, _ = orchard(points, books[i])
                np.add.at(sums[i], nearest, points)
                counts[i] += np.bincount(nearest, minlength=len(books[i]))
        cells = [(i, e) for i, c in enumerate(counts) for e in np.flatnonzero(c).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
             pa.array([int(counts[i][e]) for i, e in cells], pa.int64()),
             pa.array([sums[i][e].tolist() for i, e in cells], pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])
    return run


def trained(kept: DataFrame, books: list[Codebook], rounds: int = ROUNDS) -> list[Codebook]:
    """``rounds`` of assigning all parts and replacing each used entry by floor(sum / count)."""
    for _ in range(rounds if books else 0):
        partial = kept.select("whole").mapInArrow(_partial_sums(books), "part int, entry int, n bigint, sums array<bigint>")
        added = (partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
                 .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")))
        books = [b.copy() for b in books]
        for r in added.collect():  # parts x entries x length of a part
            books[r.part][r.entry, r["at"]] = r.x // r.n
    return books


def _assigned(books: list[Codebook]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, vectors in _vectors(batches, sum(b.shape[1] for b in books)):
            found = [orchard(points, books[i]) for i, points in enumerate(np.split(vectors, len(books), axis=1))]
            indexes = np.stack([f[0] for f in found], axis=1)
            errors = sum(f[1] for f in found)
            codes, error = [None] * part.num_rows, [None] * part.num_rows
            for r, index, e in zip(rows.tolist(), indexes.tolist(), errors.tolist()):
                codes[r], error[r] = "".join(f"{i:02x}" for i in index), e
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                                             ["vec_id", "label", "code", "error"])
    return run


def codes(kept: DataFrame, books: list[Codebook]) -> DataFrame:
    """(vec_id, label, code, error): entry indexes in part order, two hex digits each, and the summed squared distance."""
    label = kept.schema["label"].dataType.simpleString()
    if not books:
        return kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return kept.mapInArrow(_assigned(books), f"vec_id bigint, label {label}, code string, error bigint")


def codebooks_digest(books: list[Codebook]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a whole, finite vector.

    Rows with a null vector or a null or non-finite component go. Repeated rows
    each count and each return a row; a null vec_id is never among the smallest
    ids; null labels stand together. A row whose vector is of another length
    than the smallest id's, or beyond 2^25 in a component, stays with a null
    code and error, and so do all rows if the length does not divide into
    ``parts`` or no row has an id; they add nothing to sums. With fewer ids than
    ``entries`` the codebooks are smaller; an empty table gives no rows. Only
    vec_id, embedding and label are read.
    """
    ship_package(embeddings.sparkSession)
    kept = stored(as_integers(embeddings), "vectors")
    books = trained(kept, first_codebooks(kept, parts, entries), rounds)
    coded = stored(codes(kept, books), "codes")
    per_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    known = per_label.withColumnRenamed("label", "_label")
    return coded.join(known, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same codes by comparing every part with every entry; one pair of tables a round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (select key, p, arg_min(e, (d, e)) e, min(d) d from (
   select x.key, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) d from x join b{r} b using (p)) group by key, p),""")
        if r < rounds:
            steps.append(f"""
s{r} as materialized (select p, e, list(m order by i) v from (
   select p, e, i, floor(sum(c)::decimal(38, 0) / count(*))::bigint m from (
     select x.p, a.e, unnest(range(1, len(x.v) + 1)) i, unnest(x.v) c from x join a{r} a using (key, p)) group by p, e, i) group by p, e),
b{r + 1} as materialized (select p, e, coalesce(s.v, b.v) v from b{r} b left join s{r} s using (p, e)),""")
    return f"""
with k as materialized (select row_number() over () key, vec_id, label, list_transform(embedding, lambda c: floor(4096 * c::double)::bigint) w from embeddings
   where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
x as materialized (select key, vec_id, p, w[p * (len(w) // {parts}) + 1:(p + 1) * (len(w) // {parts})] v from k, range({parts}) t(p)),
b0 as materialized (select p, rank() over (partition by p order by vec_id) - 1 e, v from x where vec_id in (select vec_id from k order by vec_id limit {entries})),
{''.join(steps)}
c as (select k.vec_id, k.label, string_agg(printf('%02x', a.e), '' order by a.p) code, sum(a.d)::bigint error from k join a{rounds} a using (key) group by key, vec_id, label),
h as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) codebooks_sha256 from b{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, codebooks_sha256 from c, h
"""
