"""Streams against the same work done in one batch."""

import os
import pathlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.sources import tables
from tidemark.sources.ticks import build_candles, candle_parts, candles_of, combine_parts
from tidemark.streaming import landing

SHAPE = "event_id bigint, ts timestamp_ntz, event_type string, value double"
START = datetime(2024, 3, 1)


@pytest.fixture
def ticks(spark):
    rows = [
        (i, START + timedelta(minutes=13 * (i * 37 % 200)), "ab"[i % 2], float(i * 7 % 23))
        for i in range(200)
    ]
    return spark.createDataFrame(rows, SHAPE)


def content(df):
    cols = sorted(df.columns)
    return sorted(map(str, df.select(*cols).collect()))


class Folders:
    """A table, the folders around it and a stream of files into it."""

    def __init__(self, spark, base, schema):
        self.spark, self.schema = spark, schema
        self.source, self.table, self.staging, self.checkpoint = (
            str(base / x) for x in ("in", "table", "staging", "checkpoint")
        )

    def add(self, rows, files=1):
        rows.coalesce(files).write.mode("append").parquet(self.source)

    def stream(self, per_trigger=1):
        return landing.read_files(self.spark, self.source, self.schema, per_trigger=per_trigger)

    def fold(self):
        landing.candle_stream(self.stream(), self.table, self.staging, self.checkpoint).awaitTermination()
        return landing.read_candles(self.spark, self.table)

    def land(self, keys=("event_id", "ts"), **options):
        landing.land_stream(
            self.stream(), self.table, self.staging, self.checkpoint, list(keys), "ts", **options
        ).awaitTermination()
        return self.spark.read.parquet(self.table).drop("date")

    def replay(self):
        """Forget that the last batch was committed."""
        commits = sorted((p for p in os.listdir(f"{self.checkpoint}/commits") if p.isdigit()), key=int)
        for name in (commits[-1], f".{commits[-1]}.crc"):
            if os.path.exists(f"{self.checkpoint}/commits/{name}"):
                os.remove(f"{self.checkpoint}/commits/{name}")


@pytest.fixture
def folders(spark, ticks, tmp_path):
    return Folders(spark, tmp_path, ticks.schema)


def test_candles_arriving_in_two_runs(ticks, folders):
    folders.add(ticks.where("event_id < 120"))
    assert content(folders.fold()) == content(build_candles(ticks.where("event_id < 120")))
    folders.add(ticks.where("event_id >= 120"))
    assert content(folders.fold()) == content(build_candles(ticks))
    # nothing new: nothing changes
    assert content(folders.fold()) == content(build_candles(ticks))


def test_a_tick_sixty_days_late_changes_its_candle_alone(spark, ticks, folders):
    late = START + timedelta(days=60)
    newer = spark.createDataFrame([(1000, late, "a", 4.0), (1001, late, "b", 6.0)], SHAPE)
    folders.add(newer.unionByName(ticks.where("event_id % 5 <> 0")))
    before = {(r.symbol, r.timestamp): r for r in folders.fold().collect()}
    old = spark.createDataFrame([(-7, START, "a", 99.0)], SHAPE)
    folders.add(old)
    after = {(r.symbol, r.timestamp): r for r in folders.fold().collect()}
    changed = {k for k in after if before.get(k) != after[k]}
    assert changed == {("a", START)} and before.keys() <= after.keys()
    assert after["a", START].open == after["a", START].high == 99.0
    want = build_candles(newer.unionByName(ticks.where("event_id % 5 <> 0")).unionByName(old))
    assert content(folders.fold()) == content(want)


def test_a_replayed_batch_is_not_counted_again(ticks, folders):
    folders.add(ticks.where("event_id < 120"))
    folders.fold()
    folders.replay()
    assert content(folders.fold()) == content(build_candles(ticks.where("event_id < 120")))
    folders.add(ticks.where("event_id >= 120"))
    assert content(folders.fold()) == content(build_candles(ticks))


def test_a_failed_merge_is_finished_when_its_batch_comes_again(spark, ticks, folders, monkeypatch):
    """The fault comes after the batch is recorded and before the table changes."""
    folders.add(ticks.where("event_id < 120"))
    folders.fold()
    folders.add(ticks.where("event_id >= 120"))
    with monkeypatch.context() as fault:
        fault.setattr(tables, "_replace_dates", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision"):
            folders.fold()
    assert content(folders.fold()) == content(build_candles(ticks))


def test_records_land_once(ticks, folders):
    folders.add(ticks.unionByName(ticks).repartition(3), 3)
    assert content(folders.land()) == content(ticks)


def test_a_key_repeated_after_any_delay_lands_once(spark, ticks, folders):
    folders.add(ticks)
    folders.land()
    newer = spark.createDataFrame([(1000, START + timedelta(days=400), "a", 4.0)], SHAPE)
    folders.add(newer)
    folders.land()
    folders.add(ticks.withColumn("value", F.col("value") + 1))
    assert content(folders.land()) == content(ticks.unionByName(newer))
    folders.replay()
    assert content(folders.land()) == content(ticks.unionByName(newer))


def test_another_stream_may_reuse_batch_numbers(spark, ticks, folders):
    folders.add(ticks.where("event_id < 50"))
    folders.land()
    other = Folders(spark, pathlib.Path(folders.source).parent / "other", ticks.schema)
    other.table, other.staging = folders.table, folders.staging
    other.add(ticks.where("event_id >= 30"))
    assert content(other.land()) == content(ticks)


def test_landing_keeps_the_newest_of_a_batch(spark, folders):
    rows = [(1, START, "a", 1.0), (1, START, "b", 3.0), (1, START, "a", 2.0), (None, START, "a", 5.0)]
    folders.add(spark.createDataFrame(rows, SHAPE))
    got = folders.land(newest_by=["value"])
    assert sorted(r.value for r in got.collect()) == [3.0, 5.0]


def test_parts_combine_in_any_order(ticks):
    whole = candle_parts(ticks)
    for n in (2, 5):
        split = [candle_parts(ticks.where(f"event_id % {n} = {i}")) for i in range(n)]
        while len(split) > 1:
            split = [*split[2:], combine_parts(split[1].unionByName(split[0]))]
        assert content(split[0]) == content(whole)
    assert content(candles_of(whole)) == content(build_candles(ticks))


def test_repeated_keys_in_a_batch_keep_the_newest(spark, tmp_path):
    shape = "symbol string, timestamp timestamp_ntz, v int, seq int"
    rows = [("a", START, 1, 1), ("a", START, 2, 2), ("b", START, 3, 1)]
    source = str(tmp_path / "in")
    df = spark.createDataFrame(rows, shape)
    df.write.parquet(source)
    landing.upsert_stream(
        landing.read_files(spark, source, df.schema), str(tmp_path / "t"), str(tmp_path / "s"),
        str(tmp_path / "c"), newest_by=["seq"], mode="append",
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "t"))
    assert sorted((r.symbol, r.v) for r in got.collect()) == [("a", 2), ("b", 3)]


def test_ties_in_time_are_broken_by_id(spark):
    rows = [(2, START, "a", 5.0), (1, START, "a", 7.0), (-3, START, "a", 9.0)]
    bar = build_candles(spark.createDataFrame(rows, SHAPE)).first()
    assert (bar.open, bar.close, bar.trades) == (9.0, 5.0, 3)
    named = spark.createDataFrame(rows, SHAPE).withColumn("event_id", F.col("event_id").cast("string"))
    assert build_candles(named).first().open == 9.0
