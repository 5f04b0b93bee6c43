"""Intermediate tables in the shared work folder.

Writing a step and reading it back cuts the lineage (a lost executor re-runs
only the running step), gives Catalyst the real size of the side it may
broadcast, and leaves both sides of a later join free to be re-split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.session import work_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder under ``spark.checkpoint.dir`` and read back."""
    spark: SparkSession = df.sparkSession
    path = f"{work_dir(spark, name)}/data"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def finished(*tables: DataFrame) -> None:
    """Deletes the folders of ``stored`` tables whose last reader has ended and been written."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


ROW = "_row"


def carried(documents: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` that ``documents`` has, and one struct ``_row`` of all others.

    Whatever the others are called, they meet no column that an operator adds;
    ``restored`` puts them back.
    """
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns) if c not in names]
    return documents.select(*[n for n in names if n in documents.columns], F.struct(F.lit(True).alias("here"), *rest).alias(ROW))


def restored(df: DataFrame, documents: DataFrame) -> DataFrame:
    """The columns of ``documents``, in their order, from a table made of ``carried`` rows."""
    return df.select(*[(F.col(c) if c in df.columns and not _in_row(df, i) else F.col(ROW)[f"c{i}"]).alias(c)
                       for i, c in enumerate(documents.columns)])


def _in_row(df: DataFrame, i: int) -> bool:
    return f"c{i}" in df.schema[ROW].dataType.names
