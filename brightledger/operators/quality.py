"""Data quality checks, rules, validators and reports.

Rules over one table share a single scan. Validators return a bool and run one job each;
everything else returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import dbl, mean_of, r2, ratio
from .windows import zscore_window

# The status texts of the checks.
GAPS_PASS, GAPS_FAIL = "PASS: No gaps in data", "FAIL: Data gaps detected"
POSITIVE_PASS, POSITIVE_FAIL = "PASS: All revenue positive", "FAIL: Negative or zero revenue found"
STALE, FRESH = "ALERT: No data loaded today", "OK"
MONTHS_CHECK = "Monthly aggregates completeness"


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count"), F.col("_rows").alias("total_rows"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def gaps(df: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct days, rows, expected days and PASS/FAIL, overall or per key."""
    out = df.groupBy(*keys).agg(
        F.count_distinct(F.col(date)).alias("distinct_dates"),
        F.count(F.lit(1)).alias("total_rows"),
        (F.datediff(F.max(date), F.min(date)) + 1).alias("expected_days"),
    )
    ok = F.col("total_rows") == F.col("expected_days")
    return out.withColumn(
        "gap_check", F.when(ok, F.lit(GAPS_PASS)).otherwise(F.lit(GAPS_FAIL))
    )


def positive(df: DataFrame, value: str) -> DataFrame:
    out = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(value) > 0).alias("positive_revenue"),
        F.count_if(F.col(value) <= 0).alias("non_positive_revenue"),
    )
    ok = F.col("positive_revenue") == F.col("total_rows")
    return out.withColumn(
        "revenue_check",
        F.when(ok, F.lit(POSITIVE_PASS)).otherwise(F.lit(POSITIVE_FAIL)),
    )


def silver_status(customers: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """NULL ids and names, invalid mails below a share, over current rows."""
    out = customers.where(F.col("is_current")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("customer_id").isNull()).alias("null_ids"),
        F.count_if(F.col("customer_name").isNull()).alias("null_names"),
        F.count_if(~F.col("is_valid_email")).alias("invalid_emails"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    few = F.col("invalid_emails").cast("double") < F.col("total_records").cast("double") * F.lit(tolerance)
    ok = (F.col("null_ids") == 0) & (F.col("null_names") == 0) & few
    return out.withColumn("quality_status", F.when(ok, F.lit("PASSED")).otherwise(F.lit("FAILED")))


def outliers(daily: DataFrame, limit: float = 3.0) -> DataFrame:
    """Days, range, mean, deviation, and the count and share of days beyond a z-score."""
    scored = zscore_window(daily, "daily_revenue", "sale_date")
    over = F.count_if(F.col("revenue_zscore") > limit)
    return scored.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("sale_date").alias("distinct_dates"),
        F.min("sale_date").alias("earliest_date"),
        F.max("sale_date").alias("latest_date"),
        r2(mean_of("daily_revenue")).alias("avg_revenue"),
        r2(F.stddev(dbl("daily_revenue"))).alias("stddev_revenue"),
        over.alias("outlier_count"),
        r2(ratio(over * 100, F.count(F.lit(1)))).alias("outlier_pct"),
    )


def missing_references(facts: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Fact rows without a dimension row: {issue: (fact, fact key, dimension, dimension key)}.

    Facts are counted per key before the anti join, so a key with a third of the rows is one row.
    """
    parts = []
    for issue, (fact, key, dim, dim_key) in facts.items():
        per_key = fact.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        lost = per_key.join(dim.select(F.col(dim_key).alias("_d")), F.col("_k") == F.col("_d"), "left_anti")
        parts.append(
            lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("count")).select(F.lit(issue).alias("issue"), "count")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def measure_errors(fact: DataFrame) -> DataFrame:
    """Rows whose net or total does not follow from the other measures, in exact decimals."""
    net = F.col("total_amount") - F.col("discount_amount") + F.col("tax_amount")
    return fact.agg(
        F.count_if(F.col("net_amount") != net).alias("amount_calc_errors"),
        F.count_if(F.col("total_amount") != F.col("quantity") * F.col("unit_price")).alias("total_calc_errors"),
    )


def key_consistency(fact: DataFrame, key: str, date: str, name: str) -> DataFrame:
    out = fact.agg(
        F.count_distinct(key).alias("distinct_date_keys"), F.count_distinct(date).alias("distinct_dates")
    )
    ok = F.col("distinct_date_keys") == F.col("distinct_dates")
    return out.select(F.lit(name).alias("check_name"), "*", F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


def months_complete(agg: DataFrame, month: str, fact: DataFrame, date: str) -> DataFrame:
    """Months in a summary against months in its fact."""
    expected = fact.select(F.count_distinct(F.trunc(date, "MM"))).scalar()
    out = agg.agg(F.count_distinct(month).alias("aggregated_months")).withColumn("expected_months", expected)
    ok = F.col("aggregated_months") == F.col("expected_months")
    return out.select(
        F.lit(MONTHS_CHECK).alias("check_name"), "*",
        F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
    )


def profile(df: DataFrame, table: str, keys: list[str], previous_rows: Column | int | None) -> DataFrame:
    """Health of one load: rows, growth against the load before, NULL share of all cells, duplicate share."""
    empty = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(empty).alias("_e"))
    cells = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_repeats"),
        F.coalesce(F.sum("_e"), F.lit(0)).alias("_nulls"),
    )
    nulls, repeats = F.col("_nulls"), F.col("_repeats")
    previous = F.lit(None).cast("bigint") if previous_rows is None else (
        F.lit(previous_rows) if isinstance(previous_rows, int) else previous_rows
    )
    return cells.select(
        F.lit(table).alias("table_name"),
        "row_count",
        r2(ratio((F.col("row_count") - previous) * 100, previous)).alias("growth_pct"),
        r2(ratio(nulls * 100, F.col("row_count") * len(df.columns))).alias("null_pct"),
        r2(ratio(repeats * 100, F.col("row_count"))).alias("duplicate_pct"),
    )


def row_hash(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """SHA-256 of all columns with their names: equal rows and only equal rows agree."""
    cols = list(cols or df.columns)
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def repeated_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows in total, distinct rows, and repeats, by row hash."""
    groups = df.groupBy(row_hash(df, cols).alias("_h")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def freshness(df: DataFrame, load_date: str, as_of: str) -> DataFrame:
    last = F.max(load_date).cast("date")
    return df.agg(last.alias("last_load")).withColumn(
        "status",
        F.when(F.col("last_load") < F.lit(as_of).cast("date"), F.lit(STALE)).otherwise(F.lit(FRESH)),
    )


def run_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check, passed, failed_rows) per rule, all rules in one scan. A row fails where its rule is not true."""
    one = df.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(f"_{i}") for i, r in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(n).alias("check"), (F.col(f"_{i}") == 0).alias("passed"), F.col(f"_{i}").alias("failed_rows"))
        for i, n in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*rows)))


def unique_rule(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """The rule that keys are unique; failed rows are the repeats after the first."""
    n = duplicates(df, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed_rows"))
    return n.select(F.lit(name).alias("check"), (F.col("failed_rows") == 0).alias("passed"), "failed_rows")


def keyed_rules(df: DataFrame, name: str, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """``unique_rule`` and ``run_rules`` together, from one aggregate on the keys: the rows are read once."""
    fails = [F.count_if(~F.coalesce(r, F.lit(False))).alias(f"_{i}") for i, r in enumerate(rules.values(), 1)]
    per_key = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("_0"), *fails)
    names = [name, *rules]
    one = per_key.agg(*[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(names))])
    rows = [
        F.struct(F.lit(n).alias("check"), (F.col(f"_{i}") == 0).alias("passed"), F.col(f"_{i}").alias("failed_rows")) for i, n in enumerate(names)
    ]
    return one.select(F.inline(F.array(*rows)))


RAW_STATUSES = ("P", "F", "O")


def raw_rules(id: str, amount: str, status: str, allowed: Sequence[str] = RAW_STATUSES) -> dict[str, Column]:
    return {
        "id present": F.col(id).isNotNull(),
        "amount positive": F.col(amount) > 0,
        "status allowed": F.col(status).isin(*allowed),
    }


def order_rules(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Rules of the order line table: unique id, signs, final amount, and not both returned and cancelled."""
    rules = {
        "quantity not negative": F.col("quantity") >= 0,
        "unit price not negative": F.col("unit_price") >= 0,
        "final amount follows": F.col("final_amount")
        == F.round(F.col("line_amount") * (1 - F.col("discount_percent") / 100), 2),
        "not returned and cancelled": ~(F.col("is_return") & F.col("is_cancelled")),
    }
    return keyed_rules(lines, "unique line id", keys, rules)


def scd_rules(dim: DataFrame, key: str) -> DataFrame:
    """Unique (key, effective date), no overlap, current exactly where the end is open."""
    after = F.lead("effective_date").over(W.partitionBy(key).orderBy("effective_date", "end_date"))
    lined = dim.withColumn("_next", after)
    rules = {
        "no overlap": F.col("_next").isNull() | (F.col("end_date").isNotNull() & (F.col("end_date") < F.col("_next"))),
        "current means open": F.col("is_current") == F.col("end_date").isNull(),
    }
    return keyed_rules(lined, "unique version", [key, "effective_date"], rules)


# --- validators -----------------------------------------------------------------------------


def failed_casts(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Per text column, the rows that do not cast to the expected type; all columns in one pass."""
    rules = {c: F.col(c).isNull() | F.col(c).try_cast(t).isNotNull() for c, t in expected.items()}
    return run_rules(df, rules)


def validate_not_null(df: DataFrame, columns: list[str]) -> bool:
    """No NULL in the columns; names the table does not have are ignored."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return True
    return df.where(" OR ".join(f"`{c}` IS NULL" for c in cols)).isEmpty()


def validate_data_types(df: DataFrame, expected_types: dict[str, str]) -> bool:
    """Every expected column is there and its type name starts with the expected text. Runs no job."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return all(c in have and have[c].startswith(t) for c, t in expected_types.items())


def validate_row_count(df: DataFrame, min_rows: int = 0, max_rows: int | None = None) -> bool:
    """Row count within limits; a maximum of None or 0 is no limit."""
    n = df.count()
    return n >= min_rows and not (max_rows and n > max_rows)


def row_count_rule(df: DataFrame, name: str, min_rows: int = 0, max_rows: int | None = None) -> DataFrame:
    """The number of rows and whether it is within limits, as one row, also for an empty table. Nothing runs before the result is read."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("rows")).select(
        F.lit(name).alias("table"), "rows", (F.col("rows") >= min_rows).alias("above_minimum"),
        (F.col("rows") <= max_rows if max_rows else F.lit(True)).alias("below_maximum"),
    )


def validate_duplicates(df: DataFrame, subset: list[str]) -> bool:
    """No key occurs twice; NULLs count as equal."""
    return duplicates(df, subset).isEmpty()


def validate_column_values(df: DataFrame, col: str, allowed_values: list) -> bool:
    """Every value is in the list; NULL is invalid unless None is listed."""
    return invalid_values(df, col, allowed_values).isEmpty()


def invalid_values(df: DataFrame, col: str, allowed_values: list) -> DataFrame:
    """Rows whose value is not in the list."""
    listed = [v for v in allowed_values if v is not None]
    ok = F.col(col).isin(*listed) if listed else F.lit(False)
    if None in allowed_values:
        ok = ok | F.col(col).isNull()
    return df.where(~F.coalesce(ok, F.lit(False)))


def report(checks: DataFrame, table: str) -> DataFrame:
    """Totals of a (check, passed, ...) frame: checks, passed, failed, success in percent (0 if there are none)."""
    out = checks.agg(F.count(F.lit(1)).alias("total_checks"), F.count_if("passed").alias("passed_checks"))
    rate = F.coalesce(ratio(F.col("passed_checks") * 100, "total_checks"), F.lit(0.0))
    return out.select(
        F.lit(table).alias("table"), "total_checks", "passed_checks",
        (F.col("total_checks") - F.col("passed_checks")).alias("failed_checks"),
        r2(rate).alias("success_rate"),
    )


class QualityReport:
    """Collects check results by hand and sums them up."""

    def __init__(self, spark: SparkSession, table_name: str):
        self.spark = spark
        self.table_name = table_name
        self.checks: list[tuple[str, bool, str]] = []

    def add_check(self, check_name: str, passed: bool, details: str = "") -> None:
        self.checks.append((check_name, passed, details))

    def details(self) -> DataFrame:
        return self.spark.createDataFrame(self.checks, "check string, passed boolean, details string")

    def generate_report(self) -> DataFrame:
        return report(self.details(), self.table_name)

    def summary(self) -> dict:
        """The report as a dictionary, with the checks as ``details``."""
        details = [dict(zip(("check", "passed", "details"), c)) for c in self.checks]
        return {**self.generate_report().first().asDict(), "details": details}


class DataValidator:
    """The validators under one name."""

    validate_not_null = staticmethod(validate_not_null)
    validate_data_types = staticmethod(validate_data_types)
    validate_row_count = staticmethod(validate_row_count)
    validate_duplicates = staticmethod(validate_duplicates)
    validate_column_values = staticmethod(validate_column_values)
