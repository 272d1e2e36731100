"""Loads with error policies, and the first pipeline layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import ERRORS, FILE, as_schema, read_csv_checked


class LoadAborted(RuntimeError):
    """A row did not fit the schema and the policy is ABORT."""


def _checked(spark, path, fmt, schema, options) -> DataFrame:
    schema = as_schema(schema)
    if fmt == "csv":
        return read_csv_checked(spark, path, schema, **options)
    if fmt == "json":
        # Lines as text, so that the file of each record is known.
        lines = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias(FILE))
        parsed = lines.where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
        typed, bad = [], [F.when(F.col("v").isNull(), F.lit("record"))]
        for f in schema.fields:
            raw = F.try_variant_get("v", f"$.{f.name}", "string")
            value = F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString())
            typed.append(value.alias(f.name))
            bad.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f.name)))
        return parsed.select(
            *typed, F.struct("value").alias("_raw"), FILE, F.array_compact(F.array(*bad)).alias(ERRORS)
        )
    if fmt == "parquet":
        return _parquet_checked(spark, path, schema, options)
    raise ValueError(f"no load for format {fmt}")


def _parquet_checked(spark: SparkSession, path: str, schema: T.StructType, options: dict) -> DataFrame:
    """Columns by name in any case, cast to the schema; a column that the file lacks is NULL."""
    raw = spark.read.options(**options).parquet(path)
    by_name = {c.lower(): F.col(f"`{c}`") for c in raw.columns}
    typed, bad = [], []
    for f in schema.fields:
        given = by_name.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if given is None else given.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        if given is not None:
            bad.append(F.when(given.isNotNull() & value.isNull(), F.lit(f.name)))
    whole = F.struct(F.to_json(F.struct(*by_name.values())).alias("value"))
    errors = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return raw.select(*typed, whole.alias("_raw"), F.col("_metadata.file_path").alias(FILE), errors.alias(ERRORS))


def load(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    on_error: str = "ABORT",
    n: int | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows in error, by policy.

    CONTINUE keeps the good rows of every file; SKIP_FILE drops files with any error;
    SKIP_FILE_n drops files with n errors or more; ABORT runs a job and raises on the first error.
    """
    rows = _checked(spark, path, fmt, schema, options)
    names = as_schema(schema).fieldNames()
    in_error = F.size(ERRORS) > 0
    rejected = rows.where(in_error).select(FILE, ERRORS, "_raw")
    good = rows.where(~in_error)
    if on_error == "ABORT":
        if not rejected.isEmpty():
            raise LoadAborted(f"rows under {path} do not fit the schema")
    elif on_error in ("SKIP_FILE", "SKIP_FILE_n"):
        limit = 1 if on_error == "SKIP_FILE" else n
        if limit is None:
            raise ValueError("SKIP_FILE_n needs n")
        skip = rejected.groupBy(FILE).count().where(F.col("count") >= limit).select(FILE)
        good = good.join(skip, FILE, "left_anti")
    elif on_error != "CONTINUE":
        raise ValueError(f"unknown policy {on_error}")
    return good.select(*names), rejected


def validate_load(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, mode: str = "RETURN_ERRORS", **options
) -> DataFrame:
    """Dry run: every row in error, or the first rows as they would load (``RETURN_5_ROWS``). Writes nothing."""
    rows = _checked(spark, path, fmt, schema, options)
    if mode == "RETURN_ERRORS":
        return rows.where(F.size(ERRORS) > 0).select(FILE, ERRORS, "_raw")
    word, count, unit = mode.split("_")
    if word != "RETURN" or unit != "ROWS":
        raise ValueError(f"unknown mode {mode}")
    return rows.select(*as_schema(schema).fieldNames()).limit(int(count))


def bronze_load(staged: DataFrame, id: str, load_date: str, source_system: str) -> DataFrame:
    """Staged rows that have an id, with load date and source system added.

    The file name comes with the staged rows, as ``_metadata.file_name`` or ``_metadata.file_path`` of the read.
    """
    return (
        staged.where(F.col(id).isNotNull())
        .withColumn("_load_date", F.lit(load_date).cast("date"))
        .withColumn("_source_system", F.lit(source_system))
    )


def append_bronze(df: DataFrame, path: str) -> None:
    """Append a load, one folder per load date."""
    df.write.mode("append").partitionBy("_load_date").parquet(path)


def older_than(df: DataFrame, date: str, as_of: str, days: int = 30) -> DataFrame:
    """Rows dated more than ``days`` before ``as_of``."""
    edge = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where(F.col(date) < edge.cast(df.schema[date].dataType))


def archive(df: DataFrame, path: str, date: str, as_of: str, days: int = 30) -> None:
    """Append old rows to the archive, one folder per day, so that readers prune by date."""
    old = older_than(df, date, as_of, days).withColumn("_day", F.col(date).cast("date"))
    # Rebalance gathers a day into few files and still splits a day that holds most of the rows.
    old.hint("rebalance", "_day").write.mode("append").partitionBy("_day").parquet(path)

