"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import queries, tables  # noqa: E402

HEADLINE = """
    candles_hourly features_from_ticks sma ema rsi macd bollinger rolling_stats targets
    sentiment_attached series_tail feature_table upsert_full upsert_partial price_jumps
    validation_row medians time_split scaler_params cross_products ridge_model logistic_model merged_table
    outcome_by_feature outcome_among_many ab_metrics accuracy_vs_baseline feature_drift
    accuracy_rollup accuracy_by_confidence retrain_decision key_figures latest_features
    ensemble_signals recent_accuracy metric_pivot
""".split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    times = {}
    # stored tables that the other queries read; the first one bears the warm-up
    for build in (
        tables.candles, tables.sentiment, tables.features, tables.predictions,
        tables.fine_candles, tables.ab_results, tables.model_metrics, queries._prepared,
    ):
        start = time.perf_counter()
        build(spark, sf)
        name = f"stored_{build.__name__.strip('_')}"
        times[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        query = getattr(queries, name)
        start = time.perf_counter()
        run(query(spark, sf))
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
