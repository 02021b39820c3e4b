"""The month layout: what is read, what is rewritten."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tablewright.sources.months import latest_per, read_months, upsert_months, write_months
from test_plans import plan_of

NOW = dt.datetime(2024, 6, 1)


def day(text):
    return None if text is None else dt.datetime.fromisoformat(text)


@pytest.fixture
def facts(spark, tmp_path):
    rows = [(i, day(f"2023-{1 + i % 12:02d}-{1 + i % 28:02d}"), i * 1.0, day("2023-01-01")) for i in range(240)]
    rows.append((1000, None, 5.0, None))
    df = spark.createDataFrame(rows, "id long, fecha timestamp, monto double, updated_at timestamp")
    path = str(tmp_path / "facts")
    write_months(df, path, "fecha", ["id"])
    return path


def files(path):
    return {
        d: sorted((f, os.stat(os.path.join(path, d, f)).st_mtime_ns) for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet"))
        for d in os.listdir(path)
        if d.startswith("month=")
    }


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_files_of_other_months_stay(spark, facts):
    before = files(facts)
    assert len(before) == 13
    updates = spark.createDataFrame(
        [(2, day("2023-03-03"), 99.0), (14, day("2023-03-15"), 14.0), (5000, day("2023-03-09"), 1.0)], "id long, fecha timestamp, monto double"
    )
    assert upsert_months(spark, facts, updates, ["id"], "fecha", NOW) == [202303]
    after = files(facts)
    assert {d for d in after if after[d] != before.get(d)} == {"month=202303"}
    rows = by_id(read_months(spark, facts, "fecha"))
    assert len(rows) == 242
    assert rows[2]["monto"] == 99.0 and rows[2]["updated_at"] == NOW
    assert rows[14]["updated_at"] == day("2023-01-01")  # nothing changed
    assert rows[5000]["updated_at"] is None and rows[26]["monto"] == 26.0


def test_rows_move_between_months(spark, facts):
    updates = spark.createDataFrame([(0, day("2024-02-01"), 0.0), (1000, day("2023-05-05"), 5.0), (1, None, 1.0)], "id long, fecha timestamp, monto double")
    before = files(facts)
    done = upsert_months(spark, facts, updates, ["id"], "fecha", NOW, moved=True)
    assert done == [202301, 202302, 202305, 202402, None]
    after = files(facts)
    assert {d for d in before if after.get(d) != before[d]} == {"month=202301", "month=202302", "month=202305", "month=__HIVE_DEFAULT_PARTITION__"}
    rows = by_id(read_months(spark, facts, "fecha"))
    assert len(rows) == 241 and rows[0]["month"] == 202402 and rows[1]["month"] is None and rows[1000]["month"] == 202305


def test_a_month_that_all_rows_leave_is_gone(spark, tmp_path):
    path = str(tmp_path / "few")
    write_months(spark.createDataFrame([(1, day("2023-01-05"), None), (2, day("2023-02-05"), None)], "id long, fecha timestamp, updated_at timestamp"), path, "fecha")
    upsert_months(spark, path, spark.createDataFrame([(1, day("2023-02-07"))], "id long, fecha timestamp"), ["id"], "fecha", NOW, moved=True)
    assert set(files(path)) == {"month=202302"}
    assert {i: r["fecha"] for i, r in by_id(read_months(spark, path, "fecha")).items()} == {1: day("2023-02-07"), 2: day("2023-02-05")}


def test_updates_must_tell_the_month(spark, facts):
    with pytest.raises(ValueError, match="fecha"):
        upsert_months(spark, facts, spark.createDataFrame([(1, 2.0)], "id long, monto double"), ["id"], "fecha", NOW)


def test_only_partitions_in_range_are_read(spark, facts):
    df = read_months(spark, facts, "fecha", since=dt.date(2023, 3, 10), until=dt.date(2023, 5, 1))
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(month" in plan and ">= 202303" in plan and "<= 202305" in plan
    assert "PushedFilters: [IsNotNull(fecha), GreaterThanOrEqual(fecha" in plan
    want = {i for i in range(240) if dt.datetime(2023, 3, 10) <= dt.datetime(2023, 1 + i % 12, 1 + i % 28) < dt.datetime(2023, 5, 1)}
    assert set(by_id(df)) == want


def test_files_follow_the_date_inside_a_hot_month(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(5000).select("id", (F.timestamp_seconds(F.lit(1700000000) + F.pmod(F.hash("id"), F.lit(86400)))).alias("fecha"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_months(rows, path, "fecha", ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder = f"{path}/month=202311"
    parts = [spark.read.parquet(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(parts) > 1
    spans = sorted(tuple(p.agg(F.min("fecha"), F.max("fecha")).first()) for p in parts)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_latest_row_of_each_entity(spark, facts):
    rows = [
        (1, "a", day("2023-01-01"), "x"), (2, "a", day("2023-01-03"), "y"), (3, "a", day("2023-01-03"), "z"), (4, "b", day("2023-01-01"), None),
        (5, None, day("2022-01-01"), "n"), (6, None, day("2021-01-01"), "o"), (7, "c", None, "p"),
    ]
    df = spark.createDataFrame(rows, "id long, entity string, event_at timestamp, note string")
    assert set(by_id(latest_per(df, ["entity"], "event_at", "id"))) == {3, 4, 5}
    assert latest_per(df.where("false"), ["entity"], "event_at", "id").count() == 0


def test_latest_rows_need_no_sort(spark, facts):
    df = read_months(spark, facts, "fecha", since=dt.date(2023, 6, 1)).withColumn("entity", F.col("id") % 7)
    plan = plan_of(latest_per(df, ["entity"], "fecha", "id"))
    assert "Sort" not in plan and "PartitionFilters: [isnotnull(month" in plan
    assert sorted(by_id(latest_per(df, ["entity"], "fecha", "id"))) == sorted(
        max((r for r in df.collect() if r["entity"] == e), key=lambda r: (r["fecha"], r["id"]))["id"] for e in range(7)
    )
