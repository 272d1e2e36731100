"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Short rows that go to one file at least, where their number is known.
FILE_ROWS = 100_000


def settle(df: DataFrame, label: str, rows: int | None = None, each: int = FILE_ROWS) -> DataFrame:
    """The frame, written to the shared folder and read back.

    It cuts the lineage: later steps see the same rows on every read, also when executors are lost
    and when a column was made by a function that depends on the partitions. ``rows`` is about how many rows are made or read for it: a small table with many
    shuffle partitions is then a few files, of ``each`` of them. Each file costs its task a call of chmod or two, and on Linux a process that calls another one counts twice meanwhile.
    """
    shared_dir(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // each)))
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
