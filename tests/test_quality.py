"""Validators and reports on frames with known answers."""

import pytest
from pyspark.sql import functions as F

from brightledger.operators import quality as Q


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(
        [("t-07", 12.5, "tram", 3), ("t-08", None, "bus", 3), ("t-09", 4.0, None, 1), ("t-09", 4.0, "bus", None)],
        "trip string, km double, mode string, zone int",
    )


@pytest.mark.parametrize("columns, good", [(["trip"], True), (["km"], False), (["trip", "zone"], False), (["speed"], True), (["speed", "mode"], False), ([], True)])
def test_not_null(trips, columns, good):
    assert Q.validate_not_null(trips, columns) is good


@pytest.mark.parametrize("limits, good", [({}, True), ({"min_rows": 4, "max_rows": 4}, True), ({"min_rows": 5}, False), ({"max_rows": 3}, False), ({"max_rows": 0}, True), ({"max_rows": None}, True)])
def test_row_count(trips, limits, good):
    assert Q.validate_row_count(trips, **limits) is good
    assert Q.validate_row_count(trips.where("zone = 8"))


def test_row_count_of_an_empty_table_is_a_row(spark, tmp_path):
    from brightledger.plans.catalog import REGISTRY

    spark.createDataFrame([], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = REGISTRY["dq_row_count"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("orders", False, True)]


def test_duplicates(trips):
    assert Q.validate_duplicates(trips, ["trip", "mode"])
    assert not Q.validate_duplicates(trips, ["trip"])
    assert not Q.validate_duplicates(trips.select("km").where("km IS NULL").union(trips.select("km").where("km IS NULL")), ["km"])


def test_types(trips):
    assert Q.validate_data_types(trips, {"km": "double", "zone": "int", "trip": "str"})
    assert not Q.validate_data_types(trips, {"km": "int"})
    assert not Q.validate_data_types(trips, {"trip": "string", "speed": "double"})


def test_allowed_values(trips):
    assert Q.validate_column_values(trips, "trip", ["t-07", "t-08", "t-09", "t-10"])
    assert not Q.validate_column_values(trips, "zone", [1, 3])  # NULL is listed nowhere
    assert Q.validate_column_values(trips, "zone", [1, 3, None])
    assert not Q.validate_column_values(trips, "mode", ["bus", None])


@pytest.mark.parametrize("outcome, rate", [([True, False, True], 66.67), ([True, True], 100.0), ([False, False], 0.0), ([], 0.0)])
def test_report(spark, outcome, rate):
    report = Q.QualityReport(spark, "t")
    for i, passed in enumerate(outcome):
        report.add_check(f"check {i}", passed)
    row = report.generate_report().first()
    assert (row.total_checks, row.passed_checks, row.failed_checks) == (len(outcome), sum(outcome), len(outcome) - sum(outcome))
    assert row.success_rate == rate
    summary = report.summary()
    assert (summary["table"], summary["failed_checks"], len(summary["details"])) == ("t", len(outcome) - sum(outcome), len(outcome))


def test_rules_count_null_as_failure(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, None)], "id int, amount double")
    got = {r.check: r.failed_rows for r in Q.run_rules(df, {"id": F.col("id").isNotNull(), "amount": F.col("amount") > 0}).collect()}
    assert got == {"id": 1, "amount": 2}


def test_row_hash_sees_nulls_and_names(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    row = Q.repeated_rows(df).first()
    assert (row.total_rows, row.distinct_rows, row.duplicate_rows) == (3, 2, 1)


def test_scd_rules_find_planted_faults(spark):
    dim = spark.createDataFrame(
        [("a", "2024-01-01", "2024-03-31", False), ("a", "2024-03-01", None, True), ("b", "2024-01-01", None, False)],
        "key string, effective_date string, end_date string, is_current boolean",
    ).selectExpr("key", "date(effective_date) effective_date", "date(end_date) end_date", "is_current")
    got = {r.check: r.failed_rows for r in Q.scd_rules(dim, "key").collect()}
    assert got == {"unique version": 0, "no overlap": 1, "current means open": 1}


def test_checks_on_empty_input(spark):
    empty = spark.createDataFrame([], "sale_date date, daily_revenue decimal(20,2), num_orders bigint")
    assert Q.null_counts(empty).count() == 3
    assert Q.repeated_rows(empty).first().duplicate_rows == 0
    assert Q.outliers(empty).first().total_records == 0
    assert Q.validate_not_null(empty, ["sale_date"]) and Q.validate_duplicates(empty, ["sale_date"])
