"""Exponential moving averages and MACD as chunked affine scans.

``y[i] = a*x[i] + r*y[i-1]`` with ``r = 1 - a`` is linear in the value carried
into a stretch of rows, so a stretch is a pair (decay, offset), and pairs compose
associatively. A chunk of whole buckets may hold any number of rows; it is cut by
place into stretches short enough for their powers of ``r`` to stay within double
precision. Inside a stretch a windowed sum gives the part that does not depend on
the carry; the pairs, one row per stretch, then give every carry; a join brings
the carries back. The MACD signal is an average of a difference of averages, so
its dependence on the carries also has a closed form and needs no second pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.indicators import add
from tidemark.operators.series import BUCKET, CHUNK_ROWS, chunk_series, chunk_window

SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
MACD_COLUMNS = ("macd", "macd_signal", "macd_histogram")


def _weights(span: int) -> tuple[float, float]:
    a = 2.0 / (span + 1.0)
    return a, 1.0 - a


def _power(span: int, n: str) -> str:
    return f"pow({_weights(span)[1]!r}D, {n})"


def _taken(span: int, n: str) -> str:
    """The power of a row's own place, from the column that holds it."""
    return f"(1D / _up_{span})"


def _response(
    span: int, signal: int, n: str, power: Callable[[int, str], str] = _power
) -> str:
    """What a unit carry of one average adds to the signal after ``n`` rows."""
    a, r = _weights(signal)
    _, q = _weights(span)
    if math.isclose(q, r):
        return f"({a!r}D * ({n}) * {power(span, n)})"
    return f"({a * q / (q - r)!r}D * ({power(span, n)} - {power(signal, n)}))"


def _reach(spans: Iterable[int]) -> int:
    """Known values after which every carry's weight is zero in double precision."""
    slowest = _weights(max(spans))[1]
    return math.ceil(745.0 / -math.log(slowest)) + 1


def _carries(
    ends: DataFrame, ended: Mapping[int, str], reach: int, key: str, out: Mapping[int, str]
) -> DataFrame:
    """What the stretches before each stretch hand on to it, per span.

    ``ended`` names the column with the part each one adds by itself. They are
    reached by the number of known values since, however thin these are;
    ``reach`` also allows for the longest stretch.
    """
    fields = ", ".join(f"{col} AS v{span}" for span, col in ended.items())
    earlier = (
        f"collect_list(struct(_chunk_seen AS n, {fields})) "
        f"OVER (PARTITION BY `{key}` ORDER BY _chunk_seen "
        f"RANGE BETWEEN {reach} PRECEDING AND CURRENT ROW)"
    )
    totals = {
        out[span]: "aggregate(filter(_earlier, e -> e.n <= _prior), 0D, (acc, e) -> "
        f"acc + e.v{span} * {_power(span, '_prior - e.n')})"
        for span in ended
    }
    return add(add(ends, {"_earlier": earlier}), totals).drop("_earlier")


class Averages:
    """The window passes and the final join for a set of averages.

    ``count`` counts values over the chunk window, so that a caller can evaluate
    its own windows in the same pass. ``passes`` are columns for the projections
    that follow; their windows run over stretches, so the caller's own chunk
    windows come before them. Rows outside the chunk's core do not count.
    ``finish`` takes the core rows.
    """

    def __init__(
        self,
        col: str,
        spans: Mapping[str, int],
        macd: tuple[int, int, int] | None = None,
        key: str = "symbol",
        time: str = "timestamp",
        rows: int = CHUNK_ROWS,
    ):
        self.col, self.spans, self.macd = col, spans, macd
        self.key, self.time, self.rows = key, time, rows
        self.wanted = sorted(set(spans.values()) | set(macd[:2] if macd else ()))
        every = self.wanted + ([macd[2]] if macd else [])
        if min(every) < 2:
            raise ValueError("spans start at 2")
        # up to this many rows the weights inside one stretch stay below e^350, so
        # that values up to 1e150 may be multiplied by them
        self.limit = int(350 / -math.log(_weights(min(every))[1]))
        self.powers = sorted(set(every))
        self.parts = [f"_local_{s}" for s in self.wanted] + (["_local_signal"] if macd else [])

    def _so_far(self, fn: str, value: str, w: str) -> str:
        counted = f"CASE WHEN _core AND {self.col} IS NOT NULL THEN {value} END"
        return f"{fn}({counted}) OVER ({w} {SO_FAR})"

    @property
    def count(self) -> dict[str, str]:
        return {"_known": self._so_far("count", "1", chunk_window(self.key, self.time))}

    @property
    def passes(self) -> list[dict[str, str]]:
        w = f"PARTITION BY `{self.key}`, _chunk, _stretch ORDER BY `{self.time}`"

        def weighted_sum(span: int, value: str) -> str:
            """Average of the values inside the stretch, from a start of zero."""
            a, _ = _weights(span)
            total = self._so_far("sum", f"{a!r}D * {value} * _up_{span}", w)
            return f"coalesce({total}, 0D) / _up_{span}"

        # powers are slow: each is taken once per row and used in all later steps
        out = [
            {"_stretch": f"greatest(_known - 1, 0) div {self.limit}"},
            {"_pos": f"_known - _stretch * {self.limit}"},
            {f"_up_{s}": _power(s, "-_pos") for s in self.powers},
            {f"_local_{s}": weighted_sum(s, self.col) for s in self.wanted},
        ]
        if self.macd:
            fast, slow, signal = self.macd
            line = f"(_local_{fast} - _local_{slow})"
            out.append({"_local_signal": weighted_sum(signal, line)})
        return out

    def _ends(self, local: DataFrame) -> DataFrame:
        """One row per stretch with every carry handed to it."""
        key, wanted = self.key, self.wanted
        first = f"min_by({self.col}, CASE WHEN {self.col} IS NOT NULL THEN `{self.time}` END)"
        ends = local.groupBy(key, "_chunk", "_stretch").agg(
            F.expr(first).alias("_first"),
            F.max("_pos").alias("_n"),
            *[F.max_by(c, "_pos").alias(f"_end{c}") for c in self.parts],
        )
        wk = f"PARTITION BY `{key}` ORDER BY _chunk, _stretch"
        ends = add(
            ends,
            {
                "_chunk_seen": f"sum(_n) OVER ({wk} {SO_FAR})",
                "_seed": f"first(_first, true) OVER ({wk} ROWS BETWEEN UNBOUNDED PRECEDING "
                "AND UNBOUNDED FOLLOWING)",
            },
        )
        ends = add(ends, {"_prior": "_chunk_seen - _n"})
        own = {s: f"_end_local_{s}" for s in wanted}
        handed = {s: f"_from_{s}" for s in wanted}
        ends = _carries(ends, own, _reach(wanted) + self.limit, key, handed)
        seeded = {f"_in_{s}": f"_from_{s} + _seed * {_power(s, '_prior')}" for s in wanted}
        ends = add(ends, seeded)
        if self.macd:
            fast, slow, signal = self.macd
            driven = (
                f"_end_local_signal + _in_{fast} * {_response(fast, signal, '_n')} "
                f"- _in_{slow} * {_response(slow, signal, '_n')}"
            )
            ends = add(ends, {"_driven": driven})
            reach = _reach([signal]) + self.limit
            ends = _carries(ends, {signal: "_driven"}, reach, key, {signal: "_in_signal"})
        return ends.select(key, "_chunk", "_stretch", "_prior", *self._carried())

    def _carried(self) -> list[str]:
        return [f"_in_{s}" for s in self.wanted] + (["_in_signal"] if self.macd else [])

    def finish(self, local: DataFrame) -> DataFrame:
        """Bring the carries back and put the averages together."""

        def value(span: int) -> str:
            return f"(_local_{span} + _in_{span} / _up_{span})"

        def known(sql: str) -> str:
            return f"CASE WHEN _prior + _pos > 0 THEN {sql} END"

        results = {name: known(value(s)) for name, s in self.spans.items()}
        if self.macd:
            fast, slow, signal = self.macd
            gap = f"({value(fast)} - {value(slow)})"
            smooth = (
                f"(_local_signal + _in_signal / _up_{signal} "
                f"+ _in_{fast} * {_response(fast, signal, '_pos', _taken)} "
                f"- _in_{slow} * {_response(slow, signal, '_pos', _taken)})"
            )
            lines = (gap, smooth, f"{gap} - {smooth}")
            results |= {n: known(sql) for n, sql in zip(MACD_COLUMNS, lines, strict=True)}
        joined = local.join(self._ends(local), [self.key, "_chunk", "_stretch"])
        helpers = [*self.parts, *[f"_up_{s}" for s in self.powers], *self._carried()]
        return add(joined, results).drop("_known", "_stretch", "_pos", "_prior", *helpers)


def _averaged(df: DataFrame, averages: Averages, bucket: str) -> DataFrame:
    local = chunk_series(df, 0, 0, averages.key, averages.time, averages.rows, bucket)
    for columns in (averages.count, *averages.passes):
        local = add(local, columns)
    return averages.finish(local)


def ema(
    df: DataFrame,
    col: str,
    spans: Mapping[str, int],
    key: str = "symbol",
    time: str = "timestamp",
    rows: int = CHUNK_ROWS,
    bucket: str = BUCKET,
) -> DataFrame:
    """Exponential moving averages seeded with the first value of each series."""
    out = _averaged(df, Averages(col, spans, None, key, time, rows), bucket)
    return out.select(*df.columns, *spans)


def macd(
    df: DataFrame,
    col: str = "close",
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    key: str = "symbol",
    time: str = "timestamp",
    rows: int = CHUNK_ROWS,
    bucket: str = BUCKET,
) -> DataFrame:
    """Difference of two averages, its own average, and the gap between them."""
    out = _averaged(df, Averages(col, {}, (fast, slow, signal), key, time, rows), bucket)
    return out.select(*df.columns, *MACD_COLUMNS)
