"""Join each prediction with the price nearest to a later target time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import moment
from tidemark.sources.scans import since

HOUR = 3600


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def nearest_outcome(
    predictions: DataFrame,
    prices: DataFrame,
    target: int = HOUR,
    low: int = 50 * 60,
    high: int = 70 * 60,
    base: str = "recorded",
    time: str = "prediction_timestamp",
    recorded: str = "current_price",
    start=None,
) -> DataFrame:
    """Predictions that have an outcome, with what happened.

    The outcome is the price row of the symbol between ``low`` and ``high``
    seconds after the prediction that lies nearest to ``target``; of two equally
    near rows the earlier counts. The base price is the recorded one, or with
    ``base="feature"`` the price row at exactly the prediction time.

    Adds ``base_price``, ``actual_price``, ``actual_direction``,
    ``actual_return`` and ``correct``.

    With ``start`` only predictions from then on count, and no older price is
    read; both bounds reach the scans and prune tables stored by date.

    Time is cut into slots as wide as the interval. A price row goes to the two
    or three prediction slots it can serve, where rows are gathered into one
    array per symbol and slot: prices are unique per symbol and time, so an
    array is bounded by the slot, not by the data. Each prediction then meets
    one row instead of all prices of its symbol. Symbol and slot together are
    fine-grained, so both sides are shuffled by them as they are.
    """
    if base not in ("recorded", "feature"):
        raise ValueError("base is 'recorded' or 'feature'")
    second = 1_000_000
    width = (high - low) * second

    def slot(micros: Column) -> Column:
        return F.floor(micros / F.lit(width)).cast("long")

    if start is not None:
        predictions = since(predictions, moment(start), time=time)
        prices = since(prices, moment(start))
    at = F.col("_at")
    priced = prices.select("symbol", _micros(F.col("timestamp")).alias("_at"), "close")
    serves = F.transform(
        F.sequence(slot(at - high * second), slot(at - low * second)),
        lambda s: F.struct(s.alias("slot"), F.lit(True).alias("later")),
    )
    if base == "feature":
        own = F.array(F.struct(slot(at).alias("slot"), F.lit(False).alias("later")))
        serves = F.concat(serves, own)
    row = F.struct(at.alias("at"), F.col("close").alias("close"))
    gathered = [F.collect_list(F.when(F.col("_s.later"), row)).alias("_later")]
    if base == "feature":
        gathered.append(F.collect_list(F.when(~F.col("_s.later"), row)).alias("_same"))
    slots = (
        priced.withColumn("_s", F.explode(serves))
        .groupBy("symbol", F.col("_s.slot").alias("_slot"))
        .agg(*gathered)
    )

    asked = predictions.withColumn("_asked", _micros(F.col(time)))
    asked = asked.withColumn("_slot", slot(F.col("_asked")))
    met = asked.join(slots, ["symbol", "_slot"])

    gap = "(r.at - _asked)"
    inside = f"{gap} BETWEEN {low * second} AND {high * second}"
    ranked = F.expr(
        f"transform(_later, r -> CASE WHEN {inside} THEN "
        f"struct(abs({gap} - {target * second}) AS off, r.at AS at, r.close AS close) END)"
    )
    met = met.withColumn("actual_price", F.array_min(ranked)["close"])
    if base == "feature":
        exact = F.filter("_same", lambda r: r["at"] == F.col("_asked"))
        met = met.withColumn("base_price", F.array_min(exact)["close"])
    else:
        met = met.withColumn("base_price", F.col(recorded))
    known = met.where(F.col("actual_price").isNotNull() & F.col("base_price").isNotNull())
    return judged(known.drop("_later", "_same", "_slot", "_asked"))


def judged(df: DataFrame) -> DataFrame:
    """Direction, return and correctness from base and actual price.

    An unchanged price counts as down.
    """
    return df.withColumns(
        {
            "actual_direction": F.when(F.col("actual_price") > F.col("base_price"), 1).otherwise(0),
            "actual_return": F.try_divide(
                F.col("actual_price") - F.col("base_price"), F.col("base_price")
            ),
        }
    ).withColumn(
        "correct",
        F.when(F.col("predicted_direction") == F.col("actual_direction"), 1).otherwise(0),
    )
