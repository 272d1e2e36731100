"""Classification, and the search for what moved a metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import dbl, ratio, round_half_up


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, seed: int = 7):
    """Random forest over numeric features with a text label. Runs jobs; returns the fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler

    indexer = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(df)
    vector = VectorAssembler(inputCols=list(features), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", predictionCol="_prediction", probabilityCol="_probability",
        rawPredictionCol="_raw", numTrees=20, maxDepth=6, seed=seed,
    )
    names = IndexToString(inputCol="_prediction", outputCol="predicted_class", labels=indexer.labels)
    return Pipeline(stages=[vector, forest, names]).fit(indexer.transform(df))


def predict(df: DataFrame, model) -> DataFrame:
    """Rows, seen or new, with the predicted class and a probability per class. The model may have been saved and loaded."""
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("_probability")
    columns = [p[i].alias(f"p_{name.lower()}") for i, name in enumerate(model.stages[-1].getLabels())]
    return model.transform(df).select(*df.columns, "predicted_class", *columns)


def top_insights(
    df: DataFrame, dims: Sequence[str], metric: str, label: str, before, after, n: int | None = None
) -> DataFrame:
    """Segments that explain the change of a summed metric between two labels.

    Rows are summed to the finest segments before the cube, so the cube multiplies segments, not facts.
    Dimensions outside a segment read ALL. ``n`` keeps the segments with the largest change.
    """
    fine = df.where(F.col(label).isin(before, after)).groupBy(*dims, label).agg(F.sum(metric).alias("_m"))
    side = lambda v: F.coalesce(F.sum(F.when(F.col(label) == F.lit(v), F.col("_m"))), F.lit(0))
    cube = fine.cube(*dims).agg(
        side(before).alias("_before"), side(after).alias("_after"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims],
    )
    base = fine.select(
        (side(after) - side(before)).alias("delta")
    ).scalar()
    names = [F.when(F.col(f"_g_{d}") == 1, F.lit("ALL")).otherwise(F.col(d)).alias(d) for d in dims]
    delta = F.col("_after") - F.col("_before")
    out = cube.select(
        *names, dbl("_before").alias("before_value"), dbl("_after").alias("after_value"), dbl(delta).alias("delta"),
        round_half_up(ratio(delta, base) * 100, 4).alias("share_pct"),
    )
    if n is not None:
        out = out.orderBy(F.desc(F.abs("delta")), *dims).limit(n)
    return out
