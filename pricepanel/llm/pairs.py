"""Pairs of rows with the wide values of both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.tables import stored
from pricepanel.operators.joins import size_bounded

#: Pieces at most that the partners of one row are dealt to, and partners a piece.
SALTS, PARTNERS = 64, 64
#: Pairs (numbers or digests of fixed width, about 100 bytes each) that are broadcast to the wide table.
MAX_PAIRS = 1_000_000


def with_both(pairs: DataFrame, table: DataFrame, key: str, *values: str, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` with ``values`` of ``table`` for the columns ``a`` and ``b``, as <value>_<column>.

    A row that stands in many pairs as ``a`` is copied to as many pieces as its
    partners need, so a hot one is not one task. The narrow side is the first
    of each join: where it is small, the wide one stays where it is.
    """
    heads = stored(pairs.groupBy(a).agg(F.least(F.ceil(F.count(F.lit(1)) / PARTNERS), F.lit(SALTS)).cast("int").alias("pieces")), "heads")
    dealt = pairs.join(heads, a).withColumn("piece", F.pmod(F.xxhash64(b), F.col("pieces")).cast("int")).drop("pieces")
    dealt = stored(dealt, "dealt")
    if size_bounded(dealt, MAX_PAIRS):  # small ones go to the wide table, not the other way
        dealt, heads = F.broadcast(dealt), F.broadcast(heads)

    def named(side: str) -> DataFrame:
        return table.select(F.col(key).alias(side), *[F.col(v).alias(f"{v}_{side}") for v in values])

    left = dealt.join(named(b), b)
    right = named(a).join(heads, a).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    return left.join(right, [a, "piece"]).drop("piece")
