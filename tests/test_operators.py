"""Joins, merges, quality checks, metrics and models against hand-made results."""

import json
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema
from tidemark.operators import linear, merge, metrics, prepare, quality
from tidemark.operators.asof import nearest_outcome
from tidemark.operators.skew import spread_join
from tidemark.plans import abtest, inference, monitor, retrain
from tidemark.sources import payloads, tables

T0 = datetime(2024, 1, 1, 12)
AS_OF = "2024-01-31 00:00:00"


def minutes(n):
    return T0 + timedelta(minutes=n)


def prices_at(spark, *points):
    return spark.createDataFrame(
        [("a", minutes(m), float(c)) for m, c in points],
        "symbol string, timestamp timestamp_ntz, close double",
    )


PREDICTION = (
    "symbol string, prediction_timestamp timestamp_ntz, current_price double, "
    "predicted_direction int"
)


def asked(spark, *points):
    return spark.createDataFrame([("a", minutes(m), float(p), 1) for m, p in points], PREDICTION)


# --- nearest outcome ---------------------------------------------------------


def test_equally_near_outcomes_take_the_earlier(spark):
    found = nearest_outcome(asked(spark, (0, 10)), prices_at(spark, (55, 11), (65, 9)))
    assert found.first().actual_price == 11.0


def test_outcomes_outside_the_interval_do_not_count(spark):
    assert nearest_outcome(asked(spark, (0, 10)), prices_at(spark, (49, 1), (71, 2))).count() == 0
    edge = nearest_outcome(asked(spark, (0, 10)), prices_at(spark, (50, 3), (70.01, 2)))
    assert edge.first().actual_price == 3.0


def test_equal_price_is_down(spark):
    row = nearest_outcome(asked(spark, (0, 10)), prices_at(spark, (60, 10))).first()
    assert (row.actual_direction, row.actual_return, row.correct) == (0, 0.0, 0)


def test_feature_base_needs_an_exact_row(spark):
    prices = prices_at(spark, (0, 8), (60, 9))
    found = nearest_outcome(asked(spark, (0, 10), (1, 10)), prices, base="feature")
    assert [(r.base_price, r.actual_price, r.correct) for r in found.collect()] == [(8.0, 9.0, 1)]


@pytest.mark.parametrize("base", ["recorded", "feature"])
def test_nearest_outcome_equals_brute_force(spark, base):
    rng = random.Random(3)
    points = sorted(rng.sample(range(0, 3000), 400))
    prices = {(s, p): round(rng.uniform(1, 9), 2) for s in "ab" for p in points}
    asks = [(rng.choice("ab"), rng.choice(range(3000)), 5.0, rng.randint(0, 1)) for _ in range(500)]
    # copies of one prediction make a hot key
    asks += [("a", points[7], 5.0, 1)] * 300
    df = spark.createDataFrame([(s, minutes(m), p, d) for s, m, p, d in asks], PREDICTION)
    rows = [(s, minutes(m), c) for (s, m), c in prices.items()]
    price_df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")
    want = []
    for s, m, p, d in asks:
        near = [(abs(t - m - 60), t) for t in points if 50 <= t - m <= 70]
        start = p if base == "recorded" else prices.get((s, m))
        if near and start is not None:
            actual = prices[s, min(near)[1]]
            want.append((s, minutes(m), start, actual, int((actual > start) == bool(d))))
    got = nearest_outcome(df, price_df, base=base).collect()
    key = ("symbol", "prediction_timestamp", "base_price", "actual_price", "correct")
    assert sorted(tuple(r[k] for k in key) for r in got) == sorted(want)


def test_spread_join_keeps_every_row(spark):
    large = spark.range(2000, numPartitions=7).select(
        F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    small = large.select("k").distinct().withColumn("v", F.length("k"))
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert spread_join(large, small, ["k"]).select("id").distinct().count() == 2000
        assert spread_join(large, small.where("k = 'hot'"), ["k"], "left").count() == 2000
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- merges ------------------------------------------------------------------


def table(spark, rows):
    return spark.createDataFrame(
        [("s", minutes(m), a, b) for m, a, b in rows],
        "symbol string, timestamp timestamp_ntz, a int, b int",
    )


KEYS = ["symbol", "timestamp"]


def content(df):
    return sorted((r.timestamp, r.a, r.b) for r in df.collect())


def at(rows):
    return [(minutes(m), a, b) for m, a, b in rows]


def test_upserts(spark):
    old, new = table(spark, [(0, 1, 1), (1, 2, 2)]), table(spark, [(1, 9, None), (2, 3, 3)])
    assert content(merge.upsert(old, new, KEYS)) == at([(0, 1, 1), (1, 9, None), (2, 3, 3)])
    assert content(merge.upsert(old, new, KEYS, ["a"])) == at([(0, 1, 1), (1, 9, 2), (2, 3, 3)])
    # an update to NULL is an update
    changed = merge.upsert(old, new, KEYS, ["b"])
    assert [(r.a, r.b) for r in changed.where("a = 2").collect()] == [(2, None)]
    assert content(merge.insert_new(old, new, KEYS)) == at([(0, 1, 1), (1, 2, 2), (2, 3, 3)])
    twice = merge.upsert(merge.upsert(old, new, KEYS), new, KEYS)
    assert content(twice) == content(merge.upsert(old, new, KEYS))


def test_dedupe_keeps_the_last(spark):
    df = table(spark, [(0, 1, 5), (0, 2, 4), (1, 3, 3)])
    assert content(merge.dedupe_last(df, KEYS, ["a"])) == at([(0, 2, 4), (1, 3, 3)])


def test_merge_into_rewrites_only_touched_dates(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    tables.merge_into(table(spark, [(0, 1, 1), (3000, 2, 2)]), path, staging, KEYS)
    before = {p.name for p in (tmp_path / "t" / "date=2024-01-01").glob("*.parquet")}
    for _ in range(2):
        tables.merge_into(table(spark, [(3000, 7, 7), (3001, 8, 8)]), path, staging, KEYS)
    after = {p.name for p in (tmp_path / "t" / "date=2024-01-01").glob("*.parquet")}
    assert before == after
    want = at([(0, 1, 1), (3000, 7, 7), (3001, 8, 8)])
    assert content(tables.read_table(spark, path)) == want
    tables.merge_into(
        table(spark, [(0, 5, 5), (1, 6, 6)]), path, staging, KEYS, insert_only=True
    )
    assert content(tables.read_table(spark, path)) == sorted(want + at([(1, 6, 6)]))


def test_a_pending_merge_is_finished_first(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    tables.merge_into(table(spark, [(0, 1, 1)]), path, staging, KEYS)
    # as left by a run that failed while it replaced the second date
    lost = table(spark, [(3000, 2, 2)]).withColumn("date", F.to_date("timestamp"))
    lost.write.mode("overwrite").partitionBy("date").parquet(f"{staging}/merged")
    tables._mark(spark, staging, True)
    tables.merge_into(table(spark, [(1, 3, 3)]), path, staging, KEYS)
    want = at([(0, 1, 1), (1, 3, 3), (3000, 2, 2)])
    assert content(tables.read_table(spark, path)) == want


def test_split_valid(spark):
    shape = T.StructType(
        [
            T.StructField("symbol", T.StringType(), False),
            T.StructField("v", T.DecimalType(5, 4)),
            T.StructField("n", T.IntegerType()),
        ]
    )
    df = spark.createDataFrame(
        [("a", "0.5", "1"), (None, "0.5", "1"), ("b", "12.5", "x"), ("c", None, None)],
        "symbol string, v string, n string",
    )
    good, bad = merge.split_valid(df, shape)
    assert good.schema["v"].dataType == T.DecimalType(5, 4)
    assert sorted(r.symbol for r in good.collect()) == ["a", "c"]
    assert sorted((r.symbol or "", r.rejected_columns) for r in bad.collect()) == [
        ("", ["symbol"]), ("b", ["v", "n"]),
    ]
    assert merge.conform(df, shape).count() == 4
    assert len(schema.FEATURES) == 51 and len(schema.MODEL_INPUTS) == 22


def test_check_rows(spark):
    shape = T.StructType(
        [
            T.StructField("symbol", T.StringType(), False),
            T.StructField("v", T.DecimalType(5, 4)),
            T.StructField("n", T.IntegerType(), False),
        ]
    )
    rows = [
        ("a", "0.5", "1", 2), ("a", "0.7", "1", 1), ("a", None, "2", 1), (None, "0.5", "1", 1),
        (None, "0.5", "1", 2), ("b", "12.5", "x", 1), ("c", None, None, 1), ("a", "0.9", "1", 3),
    ]
    df = spark.createDataFrame(rows, "symbol string, v string, n string, seq int")
    checked = merge.check_rows(df, shape, ["symbol", "n"], ["seq"])
    assert checked.columns == ["symbol", "v", "n", "violations"] and checked.count() == len(rows)
    good = merge.good_rows(checked)
    assert sorted((r.symbol, float(r.v or 0), r.n) for r in good.collect()) == [("a", 0.0, 2), ("a", 0.7, 1)]
    broken = sorted((r.symbol or "", r.rule) for r in merge.violations(checked, ["symbol"]).collect())
    assert broken == [
        ("", "required(symbol)"), ("", "required(symbol)"), ("a", "unique(symbol,n)"), ("a", "unique(symbol,n)"),
        ("b", "type(n)"), ("b", "type(v)"), ("c", "required(n)"),
    ]
    assert merge.check_rows(df.where("seq > 9"), shape, ["symbol"]).count() == 0


def test_duplicate_keys(spark):
    df = table(spark, [(0, 1, 1), (0, 2, 2), (1, 1, 1)])
    assert [r.copies for r in merge.duplicate_keys(df, KEYS).collect()] == [2]


# --- payloads and reports ----------------------------------------------------


def read_json(spark, tmp_path, name, lines, payload, extra="symbol STRING, fetched_at TIMESTAMP_NTZ"):
    path = tmp_path / name
    path.write_text("\n".join(json.dumps(line) for line in lines))
    return spark.read.schema(f"{extra}, payload STRUCT<{payload_fields(payload)}>").json(str(path))


def payload_fields(ddl):
    shape = T.StructType.fromDDL(ddl)
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in shape)


def test_ticker_payloads(spark, tmp_path):
    usd = {"price": 10.5, "market_cap": 1000.7, "ath_price": 99.0}
    lines = [
        {"symbol": "a", "fetched_at": "2024-01-01T00:00:00", "payload": {"quotes": {"USD": usd}}},
        {"symbol": "b", "fetched_at": "2024-01-01T00:00:00", "payload": {"quotes": {}}},
    ]
    raw = read_json(spark, tmp_path, "t.json", lines, payloads.TICKER_PAYLOAD)
    (row,) = payloads.normalize_tickers(raw).collect()
    assert (row.symbol, row.price_usd, row.market_cap, row.high_24h) == ("a", 10.5, 1000, 99.0)
    assert row.low_24h is None and row.total_volume is None
    assert len(row) == 12


def test_candle_payloads(spark, tmp_path):
    entry = {"time": 3600, "open": 1, "high": "2.5", "low": 0.5, "close": 2, "volumeto": 7}
    lines = [
        {"symbol": "a", "payload": {"Response": "Success", "Data": {"Data": [entry]}}},
        {"symbol": "b", "payload": {"Response": "Error", "Message": "limit", "Data": {}}},
        {"symbol": "c", "payload": {"Response": "Success", "Data": {"Data": []}}},
    ]
    raw = read_json(spark, tmp_path, "c.json", lines, payloads.CANDLE_PAYLOAD)
    (row,) = payloads.normalize_candles(raw).collect()
    assert row.timestamp == datetime(1970, 1, 1, 1) and row.high == 2.5 and row.volume == 7.0
    assert [tuple(r) for r in payloads.failed_payloads(raw).collect()] == [("b", "limit")]


def test_sentiment_payloads(spark, tmp_path):
    entries = [{"timestamp": "86400", "value": "40", "value_classification": "Fear"}]
    raw = read_json(
        spark, tmp_path, "s.json", [{"payload": {"data": entries}}], payloads.SENTIMENT_PAYLOAD
    )
    (row,) = payloads.normalize_sentiment(raw).collect()
    assert tuple(row) == (datetime(1970, 1, 2), 40, "Fear")


# --- quality -----------------------------------------------------------------


def test_completeness_counts_nan_and_null(spark):
    df = spark.createDataFrame(
        [("a", T0, float("nan"), 1), ("a", T0, None, None), ("a", T0, 1.0, 2)],
        "symbol string, timestamp timestamp_ntz, x double, y int",
    )
    row = quality.completeness(df, {"null_x": "x", "null_y": "y"}, "2024-01-02").first()
    assert (row.total_records, row.null_x, row.null_y) == (3, 2, 1)
    assert row.completeness_pct == pytest.approx(50.0)


def test_gates(spark):
    df = table(spark, [(i, 1, 1) for i in range(5)])
    quality.assert_enough(quality.require_rows(df, 5, "symbol"))
    for gate in (quality.require_rows(df, 6), quality.require_rows(df.limit(0), 1, "symbol")):
        with pytest.raises(quality.NotEnoughRows):
            quality.assert_enough(gate)


def test_validation_of_an_empty_table(spark):
    df = spark.createDataFrame([], "symbol string, timestamp timestamp_ntz, price_usd double")
    row = quality.validate(df, AS_OF).first()
    assert (row.stale_data_count, row.null_price_count, row.outlier_count) == (0, 0, 0)


def test_status_bands(spark):
    df = spark.createDataFrame([(0.56,), (0.55,), (0.5,), (None,)], "v double")
    got = [r.s for r in df.select(quality.status(F.col("v"), 0.55, 0.5).alias("s")).collect()]
    assert got == ["success", "warning", "danger", "danger"]


# --- preparation and models --------------------------------------------------


def test_medians_equal_pandas(spark):
    rng = np.random.default_rng(5)
    frames = []
    for symbol, n in (("hot", 6000), ("even", 2), ("odd", 3), ("one", 1)):
        frames.append(
            pd.DataFrame(
                {"symbol": symbol, "x": rng.normal(size=n), "y": rng.integers(0, 4, n).astype(float)}
            )
        )
    pdf = pd.concat(frames)
    pdf.loc[pdf.index % 5 == 1, "x"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = prepare.group_medians(df, ["x", "y"]).toPandas().set_index("symbol").sort_index()
    want = pdf.groupby("symbol")[["x", "y"]].median()
    pd.testing.assert_frame_equal(got.astype(float), want, check_exact=True)


def test_imputation_leaves_all_missing_columns_missing(spark):
    df = spark.createDataFrame(
        [("a", None, 1.0), ("a", None, None), ("b", 4.0, None)], "symbol string, x double, y double"
    )
    got = sorted(map(tuple, prepare.impute_median(df, ["x", "y"]).collect()), key=str)
    assert got == [("a", None, 1.0), ("a", None, 1.0), ("b", 4.0, None)]


def test_split_sizes(spark):
    df = table(spark, [(i, 1, 1) for i in range(101)])
    sizes = {r.split: r["count"] for r in prepare.time_split(df).groupBy("split").count().collect()}
    assert sizes == {"train": int(101 * 0.7), "validation": int(101 * 0.85) - int(101 * 0.7),
                     "test": 101 - int(101 * 0.85)}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0)], "symbol string, x double")
    params = prepare.fit_scaler(df, ["x"])
    assert params.first()["x__std"] == 1.0
    assert [r.x for r in prepare.apply_scaler(df, params, ["x"]).collect()] == [0.0, 0.0]


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(1)
    frames = []
    for symbol, n in (("a", 400), ("b", 60)):
        x = rng.normal(size=(n, 3))
        z = x @ [1.0, -2.0, 0.5] + 0.3 + rng.normal(size=n)
        frame = pd.DataFrame(x, columns=["x", "y", "z"]).assign(
            symbol=symbol, change=z, up=(z > 0).astype(int)
        )
        frames.append(frame)
    pdf = pd.concat(frames)
    return spark.createDataFrame(pdf).repartition(5), pdf


def test_ridge_equals_normal_equations(regression):
    df, pdf = regression
    got = {r.symbol: r for r in linear.fit_ridge(df, ["x", "y", "z"], "change").collect()}
    for symbol, part in pdf.groupby("symbol"):
        x, y = part[["x", "y", "z"]].to_numpy(), part.change.to_numpy()
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
        assert np.allclose(got[symbol].coefficients, w, atol=1e-10)
        assert got[symbol].intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-10)


def test_logistic_keys_settle_apart(spark):
    """A key of one class and a separable one beside a good one."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 2))
    frame = pd.DataFrame(x, columns=["x", "y"])
    frame["symbol"] = np.repeat(["good", "one class", "separable"], 200)
    up = x @ [1.0, -2.0] + rng.logistic(size=600) > 0.3
    frame["up"] = np.where(frame.symbol == "good", up, np.where(frame.symbol == "one class", 1, x[:, 0] > 0)).astype(int)
    broken = pd.DataFrame({"x": [1.0, float("nan")], "y": [0.0, 1.0], "symbol": "broken", "up": [0, 1]})
    df = spark.createDataFrame(pd.concat([frame, broken]))
    got = {r.symbol: r for r in linear.fit_logistic(df, ["x", "y"], "up").collect()}
    assert got["good"].converged and got["good"].passes <= 15
    assert got["separable"].converged and got["separable"].coefficients[0] > 3
    assert (got["one class"].converged, got["one class"].passes) == (False, 0)
    assert got["one class"].coefficients == [0.0, 0.0]
    assert got["one class"].intercept == pytest.approx(np.log(200.5 / 0.5))
    assert (got["broken"].converged, got["broken"].passes, got["broken"].coefficients) == (False, 1, [0.0, 0.0])
    alone = linear.fit_logistic(df.where("symbol = 'good'"), ["x", "y"], "up").first()
    assert alone.coefficients == pytest.approx(got["good"].coefficients, abs=1e-9)
    stopped = linear.fit_logistic(df.where("symbol = 'good'"), ["x", "y"], "up", max_iter=2).first()
    assert (stopped.converged, stopped.passes) == (False, 2)


def test_logistic_is_at_the_optimum(regression):
    df, pdf = regression
    model = linear.fit_logistic(df, ["x", "y", "z"], "up")
    got = {r.symbol: r for r in model.collect()}
    for symbol, part in pdf.groupby("symbol"):
        x = part[["x", "y", "z"]].to_numpy()
        w, b = np.array(got[symbol].coefficients), got[symbol].intercept
        residual = 1 / (1 + np.exp(-(x @ w + b))) - part.up.to_numpy()
        assert np.abs(x.T @ residual + w).max() < 1e-6
        assert abs(residual.sum()) < 1e-6
    scored = linear.predict_logistic(df, model, ["x", "y", "z"])
    rows = metrics.clf_metrics(scored, ["symbol"], "up").collect()
    assert all(r.accuracy > 0.8 for r in rows)


def test_metrics_with_zero_denominators(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 0, 0)], "g string, label int, prediction int")
    row = metrics.clf_metrics(df, ["g"]).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.0, 0.0, 0.0)
    flat = spark.createDataFrame([("a", 1.0, 1.0)], "g string, label double, prediction double")
    assert metrics.reg_metrics(flat, ["g"]).first().r2 == 1.0


# --- decisions ---------------------------------------------------------------


def test_ensemble_ties_and_missing_models(spark):
    df = spark.createDataFrame(
        [(0, 1, 0.7, 0.7), (1, 1, 0.7, 0.5), (1, None, 0.8, None), (1, None, 0.6, None)],
        "a int, b int, ca double, cb double",
    )
    got = inference.signal(inference.ensemble(df, ["a", "b"], ["ca", "cb"])).collect()
    assert [r.ensemble_prediction for r in got] == [0, 1, 1, 1]
    assert [round(r.ensemble_confidence, 6) for r in got] == [0.7, 0.6, 0.65, 0.55]
    # exactly 0.6 is not above the threshold
    assert [r.signal for r in got] == ["SELL", "HOLD", "BUY", "HOLD"]


def test_confidence_bucket_edges(spark):
    df = spark.createDataFrame([(0.55,), (0.6,), (0.65,), (1.0,), (0.0,), (1.01,)], "c double")
    got = [r.b for r in df.select(monitor.confidence_bucket(F.col("c")).alias("b")).collect()]
    assert got == ["50-55%", "55-60%", "60-65%", "65%+", None, None]


@pytest.mark.parametrize(
    "a,b,want",
    [(0.6, 0.2, ("A", "high")), (0.519, 0.5, ("tie", "low")), (0.5, 0.5201, ("B", "medium")),
     (0.551, 0.5, ("A", "high")), (0.2, None, ("A", "high"))],
)
def test_winner_rule(spark, a, b, want):
    rows = [(v, acc) for v, acc in (("A", a), ("B", b)) if acc is not None]
    df = spark.createDataFrame(rows, "model_version string, accuracy double")
    row = abtest.ab_winner(df).first()
    assert (row.winner, row.confidence) == want


def test_no_outcomes_no_winner(spark):
    df = spark.createDataFrame([], "model_version string, accuracy double")
    assert abtest.ab_winner(df).first().winner is None


def golden_outcomes(spark):
    """12 of 20 right for A and 3 of 15 for B, over five symbols."""
    rows = []
    for version, total, right, sure in (("A", 20, 12, 0.558655), ("B", 15, 3, 0.7226)):
        for i in range(total):
            rows.append(("pqrst"[i % 5], version, int(i < right), sure))
    return spark.createDataFrame(
        rows, "symbol string, model_version string, correct int, confidence double"
    )


def test_report_of_the_published_example(spark, tmp_path):
    config = spark.createDataFrame(
        [], "test_name string, model_a_name string, model_b_name string, traffic_split double, "
        "status string, created_at timestamp_ntz",
    )
    found = golden_outcomes(spark)
    report = abtest.ab_report(abtest.active_test(config), found, AS_OF)
    path = str(tmp_path / "report")
    tables.write_report(report, path)
    row = tables.read_report(spark, path).first()
    assert (row.test_name, row.model_a, row.model_b) == (
        "rf_vs_gb_v1", "random_forest", "gradient_boosting",
    )
    assert (row.winner, row.confidence) == ("A", "high")
    a, b = row.model_a_metrics, row.model_b_metrics
    assert (a.accuracy, a.predictions, a.correct) == (0.6, 20, 12)
    assert (b.accuracy, b.predictions, b.correct) == (0.2, 15, 3)
    assert round(a.avg_confidence, 6) == 0.558655 and round(b.avg_confidence, 4) == 0.7226
    assert len(row.per_symbol) == 10
    assert sum(s.predictions for s in row.per_symbol) == 35
    panel = {r.model_version: r.metric_value for r in monitor.ab_panel(
        tables.read_report(spark, path)).collect()}
    assert panel == {"A": 0.6, "B": 0.2}


def test_rollup_of_the_published_example(spark):
    right = {"bitcoin": 6, "cardano": 8, "ethereum": 8, "polkadot": 4, "solana": 6}
    rows = [(s, "HOLD", int(i < k)) for s, k in right.items() for i in range(12)]
    df = spark.createDataFrame(rows, "symbol string, signal string, correct int")
    got = {(r.level, r.name): r for r in monitor.accuracy_rollup(df).collect()}
    assert round(got["overall", "all"].accuracy, 3) == 0.533
    assert got["overall", "all"].predictions == 60
    assert round(got["symbol", "cardano"].accuracy, 3) == 0.667
    assert got["signal", "HOLD"].predictions == 60


def test_accuracy_triggers(spark):
    df = spark.createDataFrame(
        [("few", 49, 0.1, 0.9), ("low", 50, 0.47, 0.9), ("worse", 50, 0.5, 0.61),
         ("fine", 50, 0.5, 0.59), ("new", 50, 0.5, None), ("edge", 50, 0.48, None)],
        "symbol string, total_predictions long, accuracy double, baseline_accuracy double",
    )
    got = {r.symbol: r.reason for r in retrain.accuracy_triggers(df).collect()}
    assert got == {"low": "low_accuracy", "worse": "accuracy_degradation"}


def test_drift_triggers_are_strict(spark):
    df = spark.createDataFrame(
        [("edge", 0.30, None, None), ("over", None, 0.31, 0.1), ("none", None, None, None)],
        "symbol string, rsi_drift double, volatility_drift double, volume_drift double",
    )
    assert [r.symbol for r in retrain.drift_triggers(df).collect()] == ["over"]


def test_staleness(spark):
    shape = "training_timestamp timestamp_ntz"
    week = spark.createDataFrame([(datetime(2024, 1, 24),)], shape)
    row = retrain.staleness(week, AS_OF).first()
    assert (row.days_since_training, row.should_retrain) == (7.0, True)
    fresh = spark.createDataFrame([(datetime(2024, 1, 24, 1),)], shape)
    assert retrain.staleness(fresh, AS_OF).first().should_retrain is False
    assert retrain.staleness(week.limit(0), AS_OF).first().should_retrain is True


def test_decision_document(spark):
    accuracy = spark.createDataFrame(
        [("b", 50, 0.4, 0.9), ("a", 50, 0.3, None)],
        "symbol string, total_predictions long, accuracy double, baseline_accuracy double",
    )
    drifts = spark.createDataFrame(
        [("c", 0.5, None, 0.1)],
        "symbol string, rsi_drift double, volatility_drift double, volume_drift double",
    )
    trained = spark.createDataFrame([(datetime(2024, 1, 21),)], "training_timestamp timestamp_ntz")

    def decision(acc, dr):
        return retrain.decide(
            retrain.accuracy_triggers(acc), retrain.drift_triggers(dr),
            retrain.staleness(trained, AS_OF), AS_OF,
        )

    row = monitor.decision_summary(decision(accuracy, drifts)).first()
    assert row.reasons == ["accuracy_degradation", "data_drift", "training_staleness"]
    assert row.summary == "Data Drift: c; Accuracy Degradation: a, b; Staleness: 10.0 days"
    details = json.loads(row.details)
    assert [t["symbol"] for t in details["accuracy_check"]["triggers"]] == ["a", "b"]
    assert details["drift_check"]["triggers"][0]["max_drift"] == 0.5
    only_age = decision(accuracy.limit(0), drifts.limit(0)).first()
    assert only_age.reasons == ["training_staleness"]
    broken = spark.createDataFrame([("{oops",)], "details string")
    assert monitor.decision_summary(broken).first().summary == "Invalid details format"


def test_variant_is_replayable_and_close_to_the_split(spark):
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("symbol"), F.lit(T0).cast("timestamp_ntz").alias("t")
    )
    test = spark.createDataFrame(
        [("x", "m1", "m2", 0.3)],
        "test_name string, model_a_name string, model_b_name string, traffic_split double",
    )
    first = abtest.assign_variant(df, test, "t").where("model_version = 'A'")
    again = abtest.assign_variant(df.repartition(3), test, "t").where("model_version = 'A'")
    assert first.select("symbol").exceptAll(again.select("symbol")).count() == 0
    assert 0.27 < first.count() / 4000 < 0.33
    assert {r.model_name for r in first.collect()} == {"m1"}


def test_best_model_breaks_ties_by_name(spark):
    rows = [("b", "m", "accuracy", 0.5), ("a", "n", "accuracy", 0.5), ("a", "m", "r2", None)]
    df = spark.createDataFrame(
        rows, "symbol string, model_name string, metric_name string, metric_value double"
    )
    assert [tuple(r) for r in metrics.best_model(df).collect()] == [("accuracy", "a", "n", 0.5)]
