"""What the physical plans of the headline queries must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import bench
from catalog import queries
from catalog import tables as t
from tidemark.operators.quality import null_count, validate
from tidemark.operators.series import chunk_series
from tidemark.operators.skew import spread_join
from tidemark.plans import monitor
from tidemark.plans.features import feature_summary
from tidemark.plans.inference import latest_features
from tidemark.plans.retrain import drift
from tidemark.sources import tables
from tidemark.sources.scans import scan_candles
from tidemark.sources.tables import append

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", bench.HEADLINE)
def test_no_cross_joins_or_global_windows(spark, name):
    plan = plan_of(getattr(queries, name)(spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # the first part of every window is a key, not an order
    for first in re.findall(r"windowspecdefinition\(([^,)]*)", plan):
        assert " ASC" not in first and " DESC" not in first and "frame" not in first


def test_candles_hash_ticks_and_read_four_columns(spark):
    plan = plan_of(queries.candles_hourly(spark, SF))
    assert "SortAggregate" not in plan
    assert "partial_min_by" in plan
    columns = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in columns.split(",")) == [
        "event_id", "event_type", "ts", "value",
    ]


def test_time_bounds_reach_the_scan(spark):
    plan = plan_of(scan_candles(t.candles(spark, SF), "2024-01-30", 20))
    assert "GreaterThanOrEqual(timestamp" in plan
    assert "trades" not in re.search(r"ReadSchema: [^\n]*", plan).group(0)


def test_tables_by_date_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    append(t.candles(spark, SF), path)
    plan = plan_of(scan_candles(spark.read.parquet(path), "2024-01-30", 3))
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan)


def test_counting_buckets_reads_only_the_key(spark):
    plan = plan_of(chunk_series(t.candles(spark, SF), 7).select("symbol", "close"))
    reads = [m.split("<")[1] for m in re.findall(r"ReadSchema: struct<[^>]*", plan)]
    assert any("close" not in r for r in reads)


def test_no_window_spans_a_whole_symbol(spark):
    plan = plan_of(queries.feature_table(spark, SF))
    for clause in re.findall(r"windowspecdefinition\(([^)]*)", plan):
        # by chunk, or over the one-row-per-day and one-row-per-chunk tables
        assert "_chunk" in clause or "_bucket" in clause


def test_outcomes_read_a_bounded_time(spark):
    found = monitor.outcomes(t.predictions(spark, SF), t.features(spark, SF), "2024-01-31")
    plan = plan_of(found)
    assert "GreaterThanOrEqual(prediction_timestamp" in plan
    assert "GreaterThanOrEqual(timestamp" in plan
    assert "_salt" not in plan


def test_filters_pass_below_a_spread_join(spark):
    joined = spread_join(t.candles(spark, SF), spark.createDataFrame([("x",)], "symbol string"), ["symbol"])
    assert "GreaterThan(close,10.0)" in plan_of(joined.where("close > 10"))


def test_trailing_windows_prune_tables_by_date(spark, tmp_path):
    path = str(tmp_path / "t")
    append(t.features(spark, SF).drop("date"), path)
    table = spark.read.parquet(path)
    for df in (
        drift(table, "2024-01-31"),
        feature_summary(table, "2024-01-31"),
        null_count(table, "close", "2024-01-31"),
        latest_features(table, start="2024-01-29"),
    ):
        assert re.search(r"PartitionFilters: \[[^\]]*date", plan_of(df))


def test_merge_reads_only_its_dates(spark, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    candles = t.candles(spark, SF)
    append(candles, path)
    seen = []
    real = tables.upsert
    monkeypatch.setattr(tables, "upsert", lambda old, *a: seen.append(plan_of(old)) or real(old, *a))
    new = candles.where("timestamp >= '2024-01-30'").withColumn("close", F.lit(1.0))
    tables.merge_into(new, path, staging, ["symbol", "timestamp"])
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ (IN|=)", seen[0])
    stored = spark.read.parquet(path)
    assert stored.count() == candles.count()
    assert stored.where("close = 1.0").count() == new.count()


def test_merge_refuses_repeated_keys(spark, tmp_path):
    rows = t.candles(spark, SF).limit(3)
    with pytest.raises(ValueError, match="repeat"):
        tables.merge_into(
            rows.unionByName(rows), str(tmp_path / "t"), str(tmp_path / "s"), ["symbol", "timestamp"]
        )


def test_metrics_cover_old_predictions(spark):
    """Reports on models cover every prediction, checks for retraining ten days."""
    oldest = F.min("prediction_timestamp")
    every = queries._all_judged(spark, SF)
    recent = queries._judged(spark, SF)
    assert every.agg(oldest).first()[0] < recent.agg(oldest).first()[0]
    found = queries.classification_metrics(spark, SF)
    want = queries.metrics.clf_metrics(every, ["symbol"], "actual_direction", "predicted_direction")
    assert sorted(found.collect()) == sorted(queries.tidy(want).collect())


def test_validation_scans_once(spark, tmp_path):
    """Stale series, missing values and jumps, the last ones also between days."""
    rows = [
        ("a", "2024-01-01 22:00:00", 10.0), ("a", "2024-01-01 23:00:00", 30.0), ("a", "2024-01-02 00:30:00", 70.0),
        ("a", "2024-01-02 01:00:00", None), ("a", "2024-01-02 01:10:00", 9.0), ("a", "2024-01-02 01:20:00", 9.5),
        ("b", "2023-12-30 00:00:00", 1.0), ("b", "2024-01-01 10:00:00", 5.0), ("b", "2024-01-01 12:30:00", 0.0),
        ("b", "2024-01-01 13:00:00", 4.0), ("c", "2023-01-01 00:00:00", None),
    ]
    df = spark.createDataFrame(rows, "symbol string, t string, price_usd double").selectExpr(
        "symbol", "CAST(t AS TIMESTAMP_NTZ) AS timestamp", "price_usd"
    )
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = validate(stored, "2024-01-02 01:30:00", null_window="1 day", jump_window="15 hours")
    row = found.first()
    # a: 10 to 30, 30 to 70; b: 5 comes before the window's 0, and nothing grows from 0
    assert (row.stale_data_count, row.null_price_count, row.outlier_count) == (2, 1, 2)
    wider = validate(stored, "2024-01-02 01:30:00", jump_window="10 days").first()
    # b also: 1 to 5, 5 to 0
    assert wider.outlier_count == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
