"""Change data, versions, type 2 dimensions and streams."""

import pytest
from pyspark.sql import functions as F

from brightledger.operators import changes as C
from brightledger.operators import quality as Q
from brightledger.operators import scd
from brightledger.streaming import jobs


SEATS = "seat string, deck int, fare double"


@pytest.fixture
def versions(spark):
    """Two states of a seat plan: one fare set, one deck moved, two seats gone, one new, one untouched."""
    old = [("A1", 1, None), ("A2", 1, 80.0), ("B1", 2, 55.5), ("B2", 2, 55.5), ("C9", 3, 20.0)]
    new = [("A1", 1, 95.0), ("A2", 4, 80.0), ("B2", 2, 55.5), ("D4", 4, None)]
    return spark.createDataFrame(old, SEATS), spark.createDataFrame(new, SEATS)


def test_apply_changes(versions, rows):
    old, _ = versions
    got = C.apply_changes(old, {"fare": F.col("fare") + F.col("deck")}, F.col("deck") == 2, F.col("seat").startswith("C"))
    assert rows(got, "seat", "fare") == [("A1", None), ("A2", 80.0), ("B1", 57.5), ("B2", 57.5)]


def test_null_condition_changes_nothing(versions, rows):
    old, _ = versions
    assert rows(C.apply_changes(old, delete_where=F.col("fare") < 60), "seat") == [("A1",), ("A2",)]  # a NULL fare is not below 60


def test_upsert(versions, rows):
    old, new = versions
    got = C.upsert(old, new.where("deck = 4"), old.where("deck = 2"), ["seat"])
    assert rows(got, "seat", "deck") == [("A1", 1), ("A2", 4), ("C9", 3), ("D4", 4)]


def test_net_changes(versions, rows):
    old, new = versions
    net = C.net_changes(old, new, ["seat"])
    assert rows(net, "seat", "action", "is_update") == [
        ("A1", "DELETE", True), ("A1", "INSERT", True), ("A2", "DELETE", True), ("A2", "INSERT", True),
        ("B1", "DELETE", False), ("C9", "DELETE", False), ("D4", "INSERT", False),
    ]
    assert rows(C.labelled(net), "seat", "change_type") == [("A1", "UPDATE"), ("A2", "UPDATE"), ("B1", "DELETE"), ("C9", "DELETE"), ("D4", "INSERT")]
    assert C.labelled(net, keep_before=True).count() == 7
    assert C.net_changes(new, new, ["seat"]).count() == 0


def test_row_id_links_both_images(versions):
    ids = C.net_changes(*versions, ["seat"]).where("is_update").groupBy("row_id").count()
    assert sorted(r["count"] for r in ids.collect()) == [2, 2]


def test_time_travel(versions, rows):
    old, new = versions
    log = C.log_rows(old, "I", "2031-05-06 07:00:00", 1).unionByName(C.log_changes(C.net_changes(old, new, ["seat"]), "2031-05-06 09:30:00", 2))
    for moment, back, state in (("09:29:59", 0, old), ("09:30:00", 0, new), ("09:31:00", -61, old), ("07:00:00", 0, old), ("23:00:00", 0, new)):
        assert rows(C.as_of(log, ["seat"], f"2031-05-06 {moment}", back)) == rows(state), moment
    assert rows(C.before_change(log, ["seat"], 2)) == rows(old)
    assert C.as_of(log, ["seat"], "2031-05-06 06:59:59").count() == 0
    assert rows(C.restore(new, log, ["seat"], "2031-05-06 08:00:00"), "seat") == [("A1",), ("A2",), ("B1",), ("B2",), ("C9",), ("D4",)]


def test_scd2_over_three_loads(spark):
    load = lambda data: spark.createDataFrame(data, "key string, city string, tier string")
    dim = load([("a", "Rome", "x"), ("b", "Oslo", None), ("c", "Bern", "z")]).selectExpr(
        "*", "date'2024-01-01' effective_date", "CAST(NULL AS date) end_date", "true is_current"
    )
    loads = {
        "2024-02-01": [("a", "Rome", "x"), ("b", "Oslo", "y")],  # b changes from NULL, c is absent
        "2024-03-01": [("a", "Paris", "x"), ("b", "Oslo", "y"), ("d", "Lima", None)],  # a changes, d is new
        "2024-04-01": [("a", "Paris", "x"), ("d", "Lima", None)],  # nothing changes
    }
    for day, data in loads.items():
        dim = scd.scd2_merge(dim, load(data), ["key"], ["city", "tier"], day)
    got = [(r.key, r.city, r.tier, str(r.effective_date), str(r.end_date), r.is_current) for r in dim.collect()]
    assert len(got) == 6 and set(got) == {
        ("a", "Rome", "x", "2024-01-01", "2024-02-29", False),
        ("a", "Paris", "x", "2024-03-01", "None", True),
        ("b", "Oslo", None, "2024-01-01", "2024-01-31", False),
        ("b", "Oslo", "y", "2024-02-01", "None", True),
        ("c", "Bern", "z", "2024-01-01", "None", True),
        ("d", "Lima", None, "2024-03-01", "None", True),
    }
    assert all(r.passed for r in Q.scd_rules(dim, "key").collect())
    assert scd.scd2_current(dim).count() == 4
    assert [str(r.effective_date) for r in scd.scd2_history(dim, "key", "a").collect()] == ["2024-03-01", "2024-01-01"]


def test_silver_customer_keeps_the_latest_load(spark):
    raw = spark.createDataFrame(
        [(" a1 ", " Ann ", " ANN@X.COM", "2024-01-02"), ("A1", "Ann Old", "bad", "2024-01-01"), ("b2", "Bo", None, "2024-01-01"),
         (None, "No one", "a@b.c", "2024-01-01")],
        "id string, name string, email string, _load_date string",
    )
    got = {r.customer_id: r for r in scd.silver_customer(raw, "2024-01-03").collect()}
    assert set(got) == {"A1", "B2"}
    assert (got["A1"].customer_name, got["A1"].email, got["A1"].is_valid_email) == ("Ann", "ann@x.com", True)
    assert got["B2"].is_valid_email is False


def _changes_folder(spark, tmp_path, versions):
    path = str(tmp_path / "changes")
    changes = C.net_changes(*versions, ["seat"])
    changes.write.parquet(path)
    return path, changes


def test_consume_once(spark, tmp_path, versions):
    path, changes = _changes_folder(spark, tmp_path, versions)
    stream = jobs.follow(spark, path, changes.schema)
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    assert jobs.consume(stream, log, checkpoint) == 7
    assert jobs.consume(stream, log, checkpoint) == 0
    assert spark.read.parquet(log).count() == 5
    changes.where("seat = 'D4'").write.mode("append").parquet(path)
    assert jobs.consume(stream, log, checkpoint) == 1
    assert spark.read.parquet(log).count() == 6


def test_rows_of_many_batches_count_once(spark, tmp_path):
    """More batches than a query keeps reports of; the job reads each twice, or not at all."""
    path = str(tmp_path / "in")
    spark.range(110 * 3).repartition(110, "id").sortWithinPartitions("id").write.parquet(path)
    files = len(list((tmp_path / "in").glob("part-*")))
    assert files > 100
    stream = lambda: jobs.follow(spark, path, spark.range(1).schema, max_files=1)
    assert jobs.run_available(stream(), str(tmp_path / "twice"), lambda batch, _: (batch.count(), batch.count())) == 330
    assert jobs.run_if_data(stream(), str(tmp_path / "never"), lambda batch, _: None) is True
    assert jobs.run_if_data(stream(), str(tmp_path / "never"), lambda batch, _: None) is False


def test_rollup_counts_late_rows_and_survives_a_lost_commit(spark, tmp_path, rows):
    events = spark.sql(
        "SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id * 7 % 600 AS INT)) AS ts FROM range(900)"
    )
    path, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    want = rows(events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).count())
    for lo, hi in ((600, 900), (0, 300), (300, 600)):  # late rows come last
        events.where(f"id >= {lo} AND id < {hi}").coalesce(1).write.mode("append").parquet(path)
        jobs.hourly_rollup(jobs.follow(spark, path, events.schema), "ts", out, cp)
    assert rows(jobs.read_rollup(spark, out)) == want
    # Without its commit the last batch runs again; its folder is replaced, not added to.
    commits = sorted(p for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit())
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)
    jobs.hourly_rollup(jobs.follow(spark, path, events.schema), "ts", out, cp)
    assert rows(jobs.read_rollup(spark, out)) == want


def test_summaries_equal_a_full_recompute_in_any_number_of_loads(spark, tmp_path, rows):
    orders = spark.sql(
        "SELECT id, CAST(timestamp'2023-11-20' + make_dt_interval(CAST(id * 13 % 120 AS INT)) AS timestamp_ntz) AS d, "
        "CAST(id % 97 AS DOUBLE) + 0.25 AS price FROM range(2000)"
    )
    results = []
    for loads in (1, 4):
        source = str(tmp_path / f"in{loads}")
        kept = jobs.RevenueSummaries(spark, str(tmp_path / f"kept{loads}"))
        for i in range(loads):
            orders.where(F.col("id") % loads == i).write.mode("append").parquet(source)
            kept.refresh(jobs.follow(spark, source, orders.schema), "d", "price")
        results.append((rows(kept.monthly()), rows(kept.quarterly()), rows(kept.yearly())))
    assert results[0] == results[1]
    total = orders.agg(F.sum("price")).first()[0]
    assert sum(r[1] for r in results[0][2]) == pytest.approx(total)
    assert len(results[0][0]) == 5 and len(results[0][1]) == 2 and len(results[0][2]) == 2


def test_counting_reads_a_batch_once(spark, tmp_path):
    """A job that writes its batch is one scan of it, and its rows are known; one that reads nothing is counted on its own."""
    path = str(tmp_path / "in")
    spark.range(500).repartition(3).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    def job(batch, batch_id):
        batch.mapInArrow(seen, "id long").groupBy((F.col("id") % 7).alias("k")).count().write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={batch_id}")

    stream = jobs.follow(spark, path, spark.range(1).schema)
    # The rows pass through the counter below the job's own plan.
    watched = stream.mapInArrow(seen, "id long")
    assert jobs.run_available(watched, str(tmp_path / "cp"), lambda b, i: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={i}")) == 500
    assert reads.value == 500
    assert jobs.run_available(stream, str(tmp_path / "cp2"), lambda b, i: None) == 500


def test_an_empty_file_does_not_run_the_job(spark, tmp_path):
    path, ran = str(tmp_path / "in"), []
    schema = spark.range(1).schema
    spark.range(0).write.parquet(path)
    run = lambda: jobs.run_if_data(jobs.follow(spark, path, schema), str(tmp_path / "cp"), lambda b, i: ran.append(b.count()))
    assert run() is False and ran == []
    spark.range(4).write.mode("append").parquet(path)
    assert run() is True and ran == [4]
    assert run() is False and ran == [4]


def test_windows_count_late_rows_up_to_the_watermark(spark, tmp_path, rows):
    """Rows within an hour of the newest time count in their own window, also after a restart; later ones are left out."""
    path, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    event = "ts timestamp_ntz"

    def send(*times):
        spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts")).coalesce(1).write.mode("append").parquet(path)
        jobs.windowed_rollup(jobs.follow(spark, path, spark.createDataFrame([], event).schema), "ts", out, cp)
        return {str(r.hour)[11:16]: r.new_rows for r in jobs.read_windows(spark, out).collect()}

    assert send("2024-05-01 09:10:00", "2024-05-01 09:20:00", "2024-05-01 10:30:00") == {"09:00": 2, "10:00": 1}
    # The watermark stands at 09:30, so the window of nine o'clock is still open.
    assert send("2024-05-01 09:05:00", "2024-05-01 12:45:00") == {"09:00": 3, "10:00": 1, "12:00": 1}
    # It stands at 11:45 now: ten o'clock has ended, eleven o'clock has not.
    assert send("2024-05-01 10:59:00", "2024-05-01 11:01:00") == {"09:00": 3, "10:00": 1, "11:00": 1, "12:00": 1}
    # Without its commit the last batch runs again, from the state before it, and nothing counts twice.
    commits = sorted((p for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)
    assert send("2024-05-01 12:50:00") == {"09:00": 3, "10:00": 1, "11:00": 1, "12:00": 2}


def test_windows_equal_the_batch_result(spark, tmp_path, rows):
    events = spark.sql("SELECT timestamp_ntz'2024-03-30 20:00:00' + make_dt_interval(0, 0, CAST(id * 7 AS INT)) AS ts FROM range(400)")
    path, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    events.repartition(5).write.parquet(path)
    jobs.windowed_rollup(jobs.follow(spark, path, events.schema, max_files=1), "ts", out, cp, late="30 days")
    assert rows(jobs.read_windows(spark, out)) == rows(events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).count())


def test_a_refresh_touches_only_its_periods(spark, tmp_path):
    """Neither the files that are kept nor those that a refresh opens grow with the number of batches, and a lost batch runs again."""
    source = str(tmp_path / "in")
    kept = jobs.RevenueSummaries(spark, str(tmp_path / "kept"))
    load = lambda day, n: spark.sql(f"SELECT CAST(timestamp'{day}' AS timestamp_ntz) AS d, CAST(10 AS DOUBLE) AS price FROM range({n})")
    sizes, opened = [], []
    held = kept.days.read

    def watched(parts=None, before=None):
        df = held(parts, before)
        if parts is not None:
            opened.append(len(df.inputFiles()))
        return df

    kept.days.read = watched
    days = ["2023-01-05", "2023-02-05", "2023-06-05", "2024-01-05"] + ["2024-01-06", "2024-01-07"] * 3
    for day in days:
        load(day, 3).coalesce(1).write.mode("append").parquet(source)
        kept.refresh(jobs.follow(spark, source, load(day, 1).schema), "d", "price")
        sizes.append(len(list((tmp_path / "kept" / "days" / "data").rglob("part-*.parquet"))))
    assert sizes[-1] == sizes[-2] == sizes[-3] <= 5 and max(opened) == 1
    plan = kept.days.read(["2024-01-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "quarter" in plan.split("PartitionFilters: [")[1].split("]")[0]
    want = {(2023, 9 * 10.0, 9), (2024, 21 * 10.0, 21)}
    assert {tuple(r) for r in kept.yearly().collect()} == want
    # The last batch failed after its levels were written: it runs again and replaces them.
    commits = sorted((p for p in (tmp_path / "kept" / "checkpoint" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)
    kept.refresh(jobs.follow(spark, source, load("2024-01-05", 1).schema), "d", "price")
    assert {tuple(r) for r in kept.yearly().collect()} == want
    assert kept.monthly().count() == 4 and kept.quarterly().count() == 3


def test_parts(spark, tmp_path, rows):
    """Changed parts are rewritten, others keep their files; a commit is seen whole, may run again, and an emptied part goes."""
    from brightledger.sources.parts import PartTable

    table = PartTable(spark, str(tmp_path / "t"), "k int, v string, part string", "part")
    assert table.read().count() == 0 and table.parts() == {}
    make = lambda *r: spark.createDataFrame(list(r), "k int, v string, part string")
    table.replace(make((1, "a", "x"), (2, "b", "y/z"), (3, "c", "w 1")), ["x", "y/z", "w 1"])
    files = lambda: {str(p.relative_to(tmp_path)) for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    first = files()
    table.change(["x"], lambda old: old.withColumn("v", F.lit("new")))
    assert rows(table.read(), "k", "v") == [(1, "new"), (2, "b"), (3, "c")] and first < files()
    assert rows(table.read(["y/z", "none"]), "k") == [(2,)] and len(table.read(["y/z"]).inputFiles()) == 1
    assert rows(table.read(before=1), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    table.replace(make((9, "again", "x"), (8, "stray", "other")), ["x"], commit=1)
    assert rows(table.read(), "k", "v") == [(2, "b"), (3, "c"), (9, "again")]
    table.replace(make(), ["w 1"])
    assert rows(table.read(), "k") == [(2,), (9,)]
    # An unfinished commit is not seen.
    table.files.delete("commits/2.json")
    assert rows(table.read(), "k") == [(2,), (3,), (9,)]
    table.replace(make((5, "e", "v")), ["v"])
    table.change(["v"], lambda old: old.withColumn("k", F.col("k") + 1))
    table.clean(1)
    assert rows(table.read(), "k") == [(2,), (3,), (6,), (9,)] and len(files()) == 4 and table.commits() == [3]


def test_a_kept_table_equals_a_full_replay(spark, tmp_path, rows):
    """Random histories: at every moment the rows are those of the whole log, and a read opens one snapshot and the days after it."""
    import random

    from brightledger.sources.kept import KeptTable

    rng = random.Random(4)
    kept = KeptTable(spark, str(tmp_path / "kept"), "k int, v string", ["k"], every=3)
    log, state, moments = [], {None: "nobody"}, []
    kept.append(spark.createDataFrame([(None, "nobody", "I")], "k int, v string, op string"), "2031-01-01 00:00:00")
    log.append((None, "nobody", "I", "2031-01-01 00:00:00", 1))
    for n in range(2, 12):
        ts = f"2031-01-{n // 2 + 1:02d} {n % 2 * 12:02d}:30:00"
        entries = []
        for k in rng.sample(range(8), 3):
            op = rng.choice("UD") if k in state else "I"
            entries.append((k, f"{k}-{n}", op))
            state.pop(k, None) if op == "D" else state.update({k: f"{k}-{n}"})
        assert kept.append(spark.createDataFrame(entries, "k int, v string, op string"), ts) == n
        log += [(*e, ts, n) for e in entries]
        moments.append(ts)
    whole = spark.createDataFrame(log, "k int, v string, op string, commit_ts string, change_id int").withColumn("commit_ts", F.col("commit_ts").cast("timestamp_ntz"))
    assert rows(kept.current()) == sorted(state.items(), key=lambda r: (r[0] is not None, str(r[0])))
    for n, ts in enumerate(moments, 2):
        assert rows(kept.as_of(ts)) == rows(C.as_of(whole, ["k"], ts)), ts
        assert rows(kept.as_of(ts, -1)) == rows(C.as_of(whole, ["k"], ts, -1)), ts
        assert rows(kept.before_change(n)) == rows(C.before_change(whole, ["k"], n))
    assert kept.as_of("2030-12-31 00:00:00").count() == 0
    assert rows(kept.restore(moments[0]), "k") == sorted({(k,) for k, *_ in rows(kept.as_of(moments[0]))} | {(k,) for k in state}, key=lambda r: (r[0] is not None, str(r[0])))
    files = kept.as_of(moments[6]).inputFiles()
    assert sum("/snapshots/" in f for f in files) > 0 and {f.split("/snapshots/")[1].split("/")[0] for f in files if "/snapshots/" in f} == {"change_id=6"}
    assert {f.split("/log/")[1].rsplit("/", 1)[0] for f in files if "/log/" in f} == {"commit_day=2031-01-04/change_id=7", "commit_day=2031-01-05/change_id=8"}
    with pytest.raises(ValueError):
        kept.append(spark.createDataFrame([], "k int, v string, op string"), "2030-01-01 00:00:00")


def test_changes_rewrite_only_their_buckets(spark, tmp_path, rows):
    from brightledger.sources.parts import BucketTable

    data = spark.range(200).selectExpr("id AS k", "CAST(id % 10 AS INT) AS v", "CASE WHEN id % 3 > 0 THEN 'x' END AS s")
    table = BucketTable(spark, str(tmp_path / "t"), "k bigint, v int, s string", ["k"], buckets=16)
    table.load(data)
    files = lambda: {str(p) for p in (tmp_path / "t" / "data").rglob("part-*.parquet")}
    first = files()
    touched = table.update({"v": F.col("v") + 100}, where=F.col("k") == 7)
    assert len(touched) == 1 and first < files() and len(files() - first) == 1
    assert rows(table.read()) == rows(C.apply_changes(data, {"v": F.col("v") + 100}, F.col("k") == 7))
    # Rows that go are known after the update; a NULL condition hits nothing.
    gone = (F.col("v") == 200) | (F.col("s") == "none")
    want = C.apply_changes(table.read(), {"v": F.lit(200)}, F.col("k").isin(3, 5), gone)
    want = rows(want)
    assert len(table.update({"v": F.lit(200)}, F.col("k").isin(3, 5), gone)) <= 2 and rows(table.read()) == want and table.read().count() == 198
    assert table.update(delete_where=F.col("k") == -1) == [] and table.update({"v": F.lit(1)}, F.col("k") < 0) == []
    news = spark.createDataFrame([(9, 1, "new"), (1000, 2, "new")], "k bigint, v int, s string")
    want = rows(C.upsert(table.read(), news, data.where("k = 11"), ["k"]))
    assert len(table.upsert(news, data.where("k = 11"))) <= 3 and rows(table.read()) == want


LOADS = {
    "2024-01-01": [("a", "Rome", "x"), ("b", "Oslo", None), ("c", "Bern", "z")],
    "2024-02-01": [("a", "Rome", "x"), ("b", "Oslo", "y")],
    "2024-03-01": [("a", "Paris", "x"), ("b", "Oslo", "y"), ("d", "Lima", None)],
    "2024-04-01": [("a", "Paris", "x"), ("d", "Lima", None)],
}
DIM = "key string, city string, tier string"


def test_two_merges_on_one_day(spark):
    """The second one replaces what the first one opened; of two rows of a key the greater counts."""
    load = lambda data: spark.createDataFrame(data, DIM)
    dim = spark.createDataFrame([], f"{DIM}, effective_date date, end_date date, is_current boolean")
    for day, data in (("2024-01-01", [("a", "Rome", "x")]), ("2024-06-01", [("a", "Bonn", "x")]), ("2024-06-01", [("a", "Kiel", "x"), ("a", "Kiel", "a"), (None, "Nice", "n")])):
        dim = scd.scd2_merge(dim, load(data), ["key"], ["city", "tier"], day)
    dim = scd.scd2_merge(dim, load([(None, "Nice", "n")]), ["key"], ["city", "tier"], "2024-07-01")
    assert {(r.key, r.city, r.tier, str(r.effective_date), str(r.end_date), r.is_current) for r in dim.collect()} == {
        ("a", "Rome", "x", "2024-01-01", "2024-05-31", False), ("a", "Kiel", "x", "2024-06-01", "None", True), (None, "Nice", "n", "2024-06-01", "None", True),
    }


def test_a_stored_dimension_rewrites_only_what_changes(spark, tmp_path, rows):
    load = lambda data: spark.createDataFrame(data, DIM)
    table = scd.Scd2Table(spark, str(tmp_path / "dim"), DIM, ["key"], ["city", "tier"], buckets=8)
    dim = spark.createDataFrame([], f"{DIM}, effective_date date, end_date date, is_current boolean")
    files = lambda: {p.name for p in (tmp_path / "dim" / "data").rglob("part-*.parquet")}
    merges = [*LOADS.items(), ("2024-04-01", [("a", "Metz", "x")]), ("2024-05-01", [("a", "Metz", "y"), ("a", "Metz", "x")])]
    for day, data in merges:
        before = files()
        touched = table.merge(load(data), day)
        dim = scd.scd2_merge(dim, load(data), ["key"], ["city", "tier"], day)
        assert rows(table.read()) == rows(dim), day
        assert len(files() - before) <= len(touched) + 1 and before <= files()
    assert rows(table.current(), "key") == [("a",), ("b",), ("c",), ("d",)]
    assert table.merge(load([("c", "Bern", "z")]), "2024-06-01") == []
    assert all("closed" not in f for f in table.current().inputFiles())
