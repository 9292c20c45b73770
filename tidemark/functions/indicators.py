"""SQL expressions over an ordered series window ``w``.

``w`` is a window clause without its frame, such as ``PARTITION BY symbol ORDER
BY timestamp``. Every expression counts rows, not hours, and accepts partial
frames at the start of a series. Division by zero gives NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def add(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add columns given as SQL expressions, all in one projection."""
    return df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in columns.items()])


def _trailing(fn: str, col: str, n: int, w: str) -> str:
    return f"{fn}({col}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rolling_mean(col: str, n: int, w: str) -> str:
    return _trailing("avg", col, n, w)


def rolling_std(col: str, n: int, w: str) -> str:
    """Sample deviation; NULL for a one-row frame."""
    return _trailing("stddev_samp", col, n, w)


def rolling_max(col: str, n: int, w: str) -> str:
    return _trailing("max", col, n, w)


def rolling_min(col: str, n: int, w: str) -> str:
    return _trailing("min", col, n, w)


def lagged(col: str, n: int, w: str) -> str:
    return f"lag({col}, {n}) OVER ({w})"


def step(col: str, w: str) -> str:
    """Change from the previous row."""
    return f"{col} - {lagged(col, 1, w)}"


def rise(delta: str) -> str:
    """Upward part of a change; a missing change counts as none."""
    return f"CASE WHEN {delta} > 0 THEN {delta} ELSE 0D END"


def fall(delta: str) -> str:
    """Downward part of a change, as a positive number."""
    return f"CASE WHEN {delta} < 0 THEN -{delta} ELSE 0D END"


def rsi(mean_rise: str, mean_fall: str) -> str:
    """Relative strength from simple means; NULL where nothing fell."""
    return f"100D - 100D / (1D + ({mean_rise}) / nullif({mean_fall}, 0D))"


def carried(col: str, w: str, carry: str | None = None) -> str:
    """Last known value up to the row; ``carry`` holds one from earlier chunks."""
    known = f"last({col}, true) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"coalesce({known}, {carry})" if carry else known


def change_since(filled: str, n: int, w: str) -> str:
    """Relative change against the value ``n`` rows earlier."""
    return f"try_divide({filled}, {lagged(filled, n, w)}) - 1D"


def change_until(filled: str, n: int, w: str) -> str:
    """Relative change to the value ``n`` rows later."""
    return f"try_divide(lead({filled}, {n}) OVER ({w}), {filled}) - 1D"


def ratio(top: str, bottom: str) -> str:
    return f"{top} / nullif({bottom}, 0D)"


def distance_from(col: str, extreme: str) -> str:
    return f"try_divide({col} - {extreme}, {extreme})"


def direction(change: str, strict: bool = False) -> str:
    """1 for a rise, else 0; unknown stays unknown unless ``strict``."""
    known = "true" if strict else f"{change} IS NOT NULL"
    return f"CASE WHEN {change} > 0 THEN 1 WHEN {known} THEN 0 END"


# Right-closed cut points of the return categories.
CATEGORY_CUTS = ((-0.02, "strong_down"), (-0.005, "down"), (0.005, "neutral"), (0.02, "up"))
CATEGORY_TOP = "strong_up"


def category(change: str) -> str:
    cuts = " ".join(f"WHEN {change} <= {cut}D THEN '{name}'" for cut, name in CATEGORY_CUTS)
    return f"CASE {cuts} WHEN {change} IS NOT NULL THEN '{CATEGORY_TOP}' END"


def calendar(time: str) -> dict[str, str]:
    """Clock and calendar parts; weeks start on Monday as 0."""
    return {
        "hour": f"hour({time})",
        "day_of_week": f"weekday({time})",
        "day_of_month": f"dayofmonth({time})",
        "month": f"month({time})",
        "quarter": f"quarter({time})",
    }
