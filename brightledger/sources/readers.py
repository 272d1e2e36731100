"""Typed reads of Parquet, CSV and JSON files."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKENS = ("", "NULL", "null")
FILE, ERRORS = "_file", "_errors"


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def match_columns(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Columns of ``schema`` picked by name without regard to case, cast, NULL where absent."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in as_schema(schema).fields:
        source = have.get(f.name.lower())
        col = F.lit(None) if source is None else F.col(f"`{source}`")
        out.append(col.cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str, merge: bool = False) -> DataFrame:
    """Parquet mapped by name into a target schema; ``merge`` unites files of different schemas."""
    return match_columns(spark.read.option("mergeSchema", str(merge).lower()).parquet(path), schema)


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Parquet under a path, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def _raw_csv(spark: SparkSession, path: str, names: list[str], header: bool, trim: bool) -> DataFrame:
    """Every field as text, so that short and long rows and bad values survive the read."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(text).option("header", str(header).lower()).option("quote", '"').option("escape", '"')
    flag = str(trim).lower()
    reader = reader.option("ignoreLeadingWhiteSpace", flag).option("ignoreTrailingWhiteSpace", flag)
    return reader.option("mode", "PERMISSIVE").csv(path).withColumn(FILE, F.col("_metadata.file_path"))


def _clean(name: str, null_tokens, trim: bool) -> Column:
    raw = F.trim(F.col(f"`{name}`")) if trim else F.col(f"`{name}`")
    return F.when(raw.isin(*null_tokens), F.lit(None)).otherwise(raw)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, null_tokens=NULL_TOKENS, header=True, trim=True
) -> DataFrame:
    """Typed columns beside the raw text (as ``_raw``), the file, and the names of columns that did not cast."""
    schema = as_schema(schema)
    names = schema.fieldNames()
    raw = _raw_csv(spark, path, names, header, trim)
    clean = raw.select(FILE, *[_clean(n, null_tokens, trim).alias(n) for n in names])
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    bad = [
        F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
    ]
    return clean.select(
        *typed,
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("_raw"),
        FILE,
        F.array_compact(F.array(*bad)).alias(ERRORS),
    )


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType | str, null_tokens=NULL_TOKENS, header=True, trim=True
) -> DataFrame:
    """CSV with optional quotes, several NULL tokens and tolerance for short and long rows; bad values are NULL."""
    return read_csv_checked(spark, path, schema, null_tokens, header, trim).select(*as_schema(schema).fieldNames())


def read_json_variant(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One row per record as VARIANT column ``record``; arrays around the records are stripped.

    Files with one document or array per line split across tasks. ``whole_files`` is for a
    document that spans lines, which JSON cannot split.
    """
    if whole_files:
        docs = spark.read.option("multiLine", "true").option("singleVariantColumn", "doc").json(path)
    else:
        docs = spark.read.text(path).where(F.trim("value") != "").select(F.parse_json("value").alias("doc"))
    is_array = F.startswith(F.schema_of_variant("doc"), F.lit("ARRAY"))
    records = F.when(is_array, F.col("doc").cast("array<variant>")).otherwise(F.array("doc"))
    return docs.select(F.explode(records).alias("record"))


def query_files(spark: SparkSession, fmt: str, path: str, columns: str, where: str = "true") -> DataFrame:
    """SQL straight on files, without a table; CSV columns are ``_c0``, ``_c1`` and so on."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path}` WHERE {where}")


# Candidate types from narrow to wide, each with the text form that counts as that type.
CANDIDATES: list[tuple[str, str | None]] = [
    ("BIGINT", r"^[+-]?\d+$"),
    ("DOUBLE", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"),
    ("BOOLEAN", r"^(?i:true|false)$"),
    ("DATE", r"^\d{4}-\d{2}-\d{2}$"),
    ("TIMESTAMP_NTZ", r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"),
]


def infer_schema(spark: SparkSession, path: str, fmt: str, header: bool = True, null_tokens=NULL_TOKENS) -> DataFrame:
    """Columns of staged files: name, type, nullable, rows and NULLs.

    Parquet carries its types. For CSV one aggregate over all rows counts, per column and candidate,
    the values of that type; the narrowest type that fits every value wins.
    """
    if fmt != "csv":
        df = spark.read.format(fmt).load(path)
        types = {f.name: f.dataType.simpleString().upper() for f in df.schema.fields}
    else:
        names = spark.read.option("header", str(header).lower()).csv(path).columns
        raw = _raw_csv(spark, path, names, header, True)
        df = raw.select(*[_clean(n, null_tokens, True).alias(n) for n in names])
        types = {}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        aggs.append(F.count(c).alias(f"_n{i}"))
        if not types:
            for j, (t, pattern) in enumerate(CANDIDATES):
                fits = c.rlike(pattern) & c.try_cast(t).isNotNull()
                aggs.append(F.count_if(fits).alias(f"_t{i}_{j}"))
    one = df.agg(*aggs)
    rows = []
    for i, name in enumerate(df.columns):
        n = F.col(f"_n{i}")
        if types:
            kind = F.lit(types[name])
        else:
            kind = reduce(
                lambda wider, j: F.when((n > 0) & (F.col(f"_t{i}_{j}") == n), F.lit(CANDIDATES[j][0])).otherwise(wider),
                reversed(range(len(CANDIDATES))),
                F.lit("STRING"),
            )
        rows.append(
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column_name"), kind.alias("type"),
                (n < F.col("_rows")).alias("nullable"), F.col("_rows").alias("rows"),
                (F.col("_rows") - n).alias("nulls"),
            )
        )
    return one.select(F.inline(F.array(*rows)))
