"""The same scalar rules as native expressions and as Python functions.

Use the native form: it stays in generated code. The Python forms exist so that user code
written as functions keeps working. They take and give whole Arrow batches; only the table function that is joined laterally is
called once for each row, as Spark joins no other kind that way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import ColumnOrName, as_col, dbl, min_max_scale, round_half_up, tier

# Tiers of a day by its revenue as a multiple of the mean day.
TIERS = [(1.25, "HIGH"), (1.0, "MEDIUM"), (0.75, "LOW")]


def classify_revenue(c: ColumnOrName) -> Column:
    return tier(c, TIERS, "VERY LOW")


@F.pandas_udf(T.StringType())
def classify_revenue_udf(revenue: pd.Series) -> pd.Series:
    import numpy as np

    found = np.select([revenue >= bound for bound, _ in TIERS], [label for _, label in TIERS], "VERY LOW")
    return pd.Series(found, index=revenue.index, dtype=object).where(revenue.notna(), None)


def margin(revenue: ColumnOrName, cost_pct: ColumnOrName) -> Column:
    """revenue * (1 - cost share) to 2 decimals; NULL in, NULL out."""
    return round_half_up(dbl(revenue) * (F.lit(1.0) - as_col(cost_pct)), 2)


@F.pandas_udf(T.DoubleType())
def margin_udf(revenue: pd.Series, cost_pct: pd.Series) -> pd.Series:
    import numpy as np

    return pd.Series(np.floor(revenue * (1.0 - cost_pct) * 100.0 + 0.5) / 100.0)


@F.pandas_udf(T.DoubleType())
def identity_udf(values: pd.Series) -> pd.Series:
    """A vectorised function that returns its input: the call form only."""
    return values.astype("float64")


def global_zscore(df: DataFrame, value: str, name: str = "zscore") -> DataFrame:
    """(x - mean) / sample deviation of the whole frame, NULL where the deviation is 0."""
    x = dbl(value)
    mean = df.select(F.sum(value).cast("double") / F.count(value)).scalar()
    std = df.select(F.stddev(x)).scalar()
    return df.withColumn(name, (x - mean) / F.nullif(std, F.lit(0.0)))


def normalized(df: DataFrame, value: str, name: str = "normalized") -> DataFrame:
    """Min-max scale by the bounds of the whole frame."""
    span = df.select(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    out = df.withColumn("_span", span).withColumn(name, min_max_scale(value, F.col("_span.low"), F.col("_span.high")))
    return out.drop("_span")


def split_rows(df: DataFrame, text: str, sep: str) -> DataFrame:
    """One row per piece of ``text``: (item, position), trimmed; NULL text gives no rows."""
    pieces = F.split(as_col(text), f"\\Q{sep}\\E")
    return df.select("*", F.posexplode(pieces).alias("position", "_piece")).select(
        *df.columns, F.trim("_piece").alias("item"), "position"
    )


@F.udtf(returnType="item string, position int", useArrow=True)
class SplitToRows:
    """Table function form of ``split_rows``, for a lateral join."""

    def eval(self, text: str, sep: str):
        if text is not None:
            for position, piece in enumerate(text.split(sep or ",")):
                yield piece.strip(), position


@F.arrow_udtf(returnType="id bigint, item string, position int")
class SplitTable:
    """Table function form of ``split_rows`` over a table (id, text) and a separator: record batches in, tables out, no loop over rows."""

    def eval(self, table: pa.RecordBatch, sep: pa.Array) -> Iterator[pa.Table]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if table.num_rows:
            pieces = pc.split_pattern(table.column(1).cast(pa.string()), sep[0].as_py() or ",")
            owner = pc.list_parent_indices(pieces)
            sizes = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.table({
                "id": pc.take(table.column(0), owner), "item": pc.utf8_trim(pc.list_flatten(pieces), " "), "position": pa.array(place, pa.int32()),
            })


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL."""
    spark.udtf.register("split_to_rows", SplitToRows)
    spark.udtf.register("split_table", SplitTable)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION revenue_tier(revenue DOUBLE) RETURNS STRING RETURN CASE "
        + " ".join(f"WHEN revenue >= {bound} THEN '{label}'" for bound, label in TIERS)
        + " ELSE 'VERY LOW' END"
    )
