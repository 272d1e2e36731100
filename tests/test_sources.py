"""Readers, load policies, writers, versions, keys and generators."""

import pytest
from pyspark.sql import functions as F

from brightledger.operators.keys import dense_numbers
from brightledger.sources import loading, readers, writers
from brightledger.sources.generators import MONTH_EFFECT, daily_sales
from brightledger.sources.versions import VersionedTable

DDL = "id bigint, name string, amount double, day date"


@pytest.fixture
def staged(tmp_path):
    """Four files: clean, one error, three errors, and odd rows that are no errors."""
    head = "id,name,amount,day\n"
    files = {
        "clean.csv": head + '1,"Ann, A.",1.5,2024-01-01\n2,Bob,2.5,2024-01-02\n',
        "one.csv": head + "3,Cy,oops,2024-01-03\n4,Di,4.5,2024-01-04\n",
        "three.csv": head + "x,Ed,1,2024-01-05\n6,Flo,1,not a day\n7,Gus,nan?,2024-01-07\n8,Hal,8,2024-01-08\n",
        "odd.csv": head + "9, Ida ,NULL,null\n10,Jo\n11,Kay,11,2024-01-11,surplus\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_csv_typed_tolerates_odd_rows(spark, staged):
    got = {r.id: r for r in readers.read_csv_typed(spark, f"{staged}/odd.csv", DDL).collect()}
    assert got[9].name == "Ida" and got[9].amount is None and got[9].day is None
    assert got[10].name == "Jo" and got[10].amount is None
    assert got[11].amount == 11.0 and str(got[11].day) == "2024-01-11"


def test_csv_quotes(spark, staged):
    assert {r.name for r in readers.read_csv_typed(spark, f"{staged}/clean.csv", DDL).collect()} == {"Ann, A.", "Bob"}


@pytest.mark.parametrize(
    "policy, n, want",
    [
        ("CONTINUE", None, [1, 2, 4, 8, 9, 10, 11]),
        ("SKIP_FILE", None, [1, 2, 9, 10, 11]),
        ("SKIP_FILE_n", 2, [1, 2, 4, 9, 10, 11]),
        ("SKIP_FILE_n", 4, [1, 2, 4, 8, 9, 10, 11]),
    ],
)
def test_load_policies(spark, staged, policy, n, want):
    good, rejected = loading.load(spark, staged, "csv", DDL, policy, n)
    assert ids(good) == want
    assert rejected.count() == 4


def test_load_abort(spark, staged):
    with pytest.raises(loading.LoadAborted):
        loading.load(spark, staged, "csv", DDL)
    assert ids(loading.load(spark, f"{staged}/clean.csv", "csv", DDL)[0]) == [1, 2]


def test_load_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":1,"amount":2.5}\n{"id":"x","amount":1}\nnot json\n{"id":3}\n')
    good, rejected = loading.load(spark, str(tmp_path), "json", "id bigint, amount double", "CONTINUE")
    assert sorted((r.id, r.amount) for r in good.collect())[:1] == [(1, 2.5)]
    assert ids(good) == [1, 3]
    assert sorted(r["_errors"][0] for r in rejected.collect()) == ["id", "record"]


def test_validate_load(spark, staged):
    errors = loading.validate_load(spark, staged, "csv", DDL)
    assert sorted(r["_errors"][0] for r in errors.collect()) == ["amount", "amount", "day", "id"]
    assert loading.validate_load(spark, staged, "csv", DDL, "RETURN_2_ROWS").count() == 2
    with pytest.raises(ValueError):
        loading.validate_load(spark, staged, "csv", DDL, "RETURN_ALL")


def test_json_outer_array(spark, tmp_path):
    (tmp_path / "whole.json").write_text('[{"a":1},\n {"a":2,"b":[true]}]')
    (tmp_path / "lines.json").write_text('{"a":3}\n[{"a":4},{"a":5}]\n\n')
    whole = readers.read_json_variant(spark, str(tmp_path / "whole.json"), whole_files=True)
    lines = readers.read_json_variant(spark, str(tmp_path / "lines.json"))
    value = F.variant_get("record", "$.a", "int").alias("a")
    assert sorted(r.a for r in whole.unionByName(lines).select(value).collect()) == [1, 2, 3, 4, 5]


def test_infer_schema_takes_the_narrowest_type(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        "i,d,b,day,ts,s,gap,none\n1,1,true,2024-01-01,2024-01-01 10:00:00,F,5,\n-2,2.5,FALSE,2024-02-30,2024-01-02T11:30:00.5,T,NULL,\n"
    )
    got = {r.column_name: (r.type, r.nullable) for r in readers.infer_schema(spark, str(tmp_path), "csv").collect()}
    assert got == {
        "i": ("BIGINT", False), "d": ("DOUBLE", False), "b": ("BOOLEAN", False),
        "day": ("STRING", False),  # the 30th of February is no date
        "ts": ("TIMESTAMP_NTZ", False), "s": ("STRING", False), "gap": ("BIGINT", True), "none": ("STRING", True),
    }


def test_infer_schema_of_parquet(spark, tmp_path):
    spark.createDataFrame([(1, None)], "a int, b string").write.parquet(str(tmp_path / "p"))
    got = {r.column_name: (r.type, r.nulls) for r in readers.infer_schema(spark, str(tmp_path / "p"), "parquet").collect()}
    assert got == {"a": ("INT", 0), "b": ("STRING", 1)}


def test_parquet_schemas_merge(spark, tmp_path):
    spark.createDataFrame([(1,)], "A int").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([(2, "x")], "A int, extra string").write.mode("append").parquet(str(tmp_path / "p"))
    df = readers.read_parquet(spark, str(tmp_path / "p"), "a bigint, EXTRA string, other date", merge=True)
    assert sorted(map(tuple, df.collect())) == [(1, None, None), (2, "x", None)]


def test_unload_caps_file_size(spark, tmp_path):
    out = tmp_path / "out"
    df = spark.range(20_000).select("id", F.repeat(F.lit("x"), 50).alias("t")).coalesce(1)
    writers.unload_csv(df, str(out), max_file_bytes=200_000)
    sizes = [f.stat().st_size for f in out.glob("*.csv")]
    assert len(sizes) > 4 and max(sizes) < 260_000
    assert readers.read_csv_typed(spark, str(out), "id bigint, t string").count() == 20_000


def test_versions_may_read_themselves(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(spark.range(3))
    table.write(table.read().unionByName(spark.range(3, 5)), "APPEND")
    assert (table.version(), table.read().count(), table.read(1).count()) == (2, 5, 3)
    table.truncate()
    assert table.read().count() == 0 and table.read().columns == ["id"]
    assert [r.action for r in table.history().orderBy("version").collect()] == ["WRITE", "APPEND", "TRUNCATE"]


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_dense_numbers(spark, partitions):
    keys = [k * k % 10_007 for k in range(1, 3000)]
    df = spark.createDataFrame([(k,) for k in sorted(set(keys), reverse=True)], "k bigint").repartition(partitions)
    got = [(r.k, r.n) for r in dense_numbers(df, ["k"], "n").collect()]
    assert sorted(got) == [(k, i + 1) for i, k in enumerate(sorted(set(keys)))]


def test_dense_numbers_of_nothing(spark):
    assert dense_numbers(spark.createDataFrame([], "k bigint"), ["k"], "n").count() == 0


def test_generator_is_the_same_on_any_layout(spark, rows):
    keys = spark.createDataFrame([(i,) for i in range(7)], "k int")
    one = rows(daily_sales(spark, n=40, keys=keys.coalesce(1)))
    assert one == rows(daily_sales(spark, n=40, keys=keys.repartition(5)))
    assert len(one) == 280


def test_generator_shape(spark):
    df = daily_sales(spark, noise=0.0)
    got = {str(r.sale_date): r.daily_revenue for r in df.collect()}
    assert len(got) == 730 and max(got) == "2024-12-30" and min(got) == "2023-01-01"
    assert got["2023-01-01"] == 100 + MONTH_EFFECT[0] - 20  # a Sunday in January
    assert got["2023-12-25"] == pytest.approx(100 + 358 * 0.15 + 45 + 10)  # a Monday in December


def test_parquet_is_loaded_by_name_in_any_case(spark, tmp_path, rows):
    """Columns in another order and case, one missing, one too many; a value that does not fit is an error of its row."""
    path = str(tmp_path / "p")
    spark.createDataFrame([("12", "7.5", "x"), ("no", "1.0", "y"), (None, None, "z")], "ID string, Amount string, spare string").write.parquet(path)
    schema = "amount double, id bigint, day date"
    good, bad = loading.load(spark, path, "parquet", schema, on_error="CONTINUE")
    assert rows(good) == [(None, None, None), (7.5, 12, None)]
    assert [r._errors for r in bad.collect()] == [["id"]] if "_errors" in bad.columns else bad.count() == 1
    with pytest.raises(loading.LoadAborted):
        loading.load(spark, path, "parquet", schema)
    assert loading.load(spark, path, "parquet", schema, on_error="SKIP_FILE")[0].count() < 3
    assert loading.validate_load(spark, path, "parquet", schema).count() == 1
