"""Exact values at wanted ranks, by narrowing: counted ranges, then ranges inside those that hold a rank.

Each pass counts the values of every open interval in equally wide ranges, with the least and greatest
value of each; the range that holds a wanted rank is the next interval, bounded by values that stand in
the data. Counting is map-side, so what is shuffled and what reaches the driver is at most one row for
each range of each open interval, however many rows there are; nothing is sorted, and no value is moved.

Values are compared in their own type. Only the number of a range is computed in double precision, by
operations that keep order, so values past 2^53 are told apart: an interval that double precision cannot
split starts from its own least value, from which differences are exact.

An interval that holds few rows is not narrowed further: its distinct values are counted and put in
order by one window of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGES = 1024  # counted ranges of an interval in one pass
SMALL = 50_000  # rows of an interval that one window puts in order
_GREATEST = 1.7e308
_LEAST = 5e-324


@dataclass
class Interval:
    """Rows with values from ``low`` to ``high``, of which ``before`` in the column are smaller."""

    low: object
    high: object
    before: int
    rows: int
    ranks: list[int] = field(default_factory=list)

    @property
    def one_value(self) -> bool:
        return self.low == self.high or self.low != self.low  # only NaN differs from itself, and is the greatest


def _literal(value, kind: T.DataType) -> Column:
    return F.lit(str(value) if isinstance(value, Decimal) else value).cast(kind)


def _scaled(value: Column, low: float, high: float, ranges: int) -> Column:
    at = (value - F.lit(low)) / F.lit(max(high - low, _LEAST)) * ranges
    return F.least(F.greatest(F.floor(at), F.lit(0)), F.lit(ranges - 1)).cast("int")


def _range_of(value: Column, kind: T.DataType, low, high, ranges: int) -> Column:
    """The range that a value of an interval lies in; greater values never lie in lower ranges."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = value.cast("double")
        low, high = (min(max(x, -_GREATEST), _GREATEST) if x == x else _GREATEST for x in (low, high))
        bent = number
        if low <= 0 <= high or abs(math.log2(high / low)) > 4:
            # Over many magnitudes ranges follow the exponent; Java's logarithm keeps order.
            bent = F.signum(number) * (F.log2(F.greatest(F.abs(number), F.lit(_LEAST))) + 1100.0)
            low, high = (math.copysign(math.log2(max(abs(x), _LEAST)) + 1100.0, x) if x else 0.0 for x in (low, high))
        # What has no place among finite numbers has a range of its own at either end.
        odd = F.when(F.isnan(number), ranges + 1).when(number == float("inf"), ranges).when(number == -float("inf"), -1)
        return odd.otherwise(_scaled(bent, low, high, ranges))
    width = high - low
    if isinstance(kind, T.DecimalType):
        exact = kind.precision < 38
        ahead = value - _literal(low, kind)
    else:
        exact = width < 1 << 62
        ahead = value.cast("long") - F.lit(low)
    if exact:
        return _scaled(ahead.cast("double"), 0.0, float(width), ranges)
    return _scaled(value.cast("double"), float(low), float(high), ranges)


def _inside(value: Column, interval: Interval, kind: T.DataType) -> Column:
    return (value >= _literal(interval.low, kind)) & (value <= _literal(interval.high, kind))


def _by_interval(intervals: Sequence[Interval], test, result) -> Column:
    chain = F.when(test(intervals[0], 0), result(intervals[0], 0))
    for at, interval in enumerate(intervals[1:], 1):
        chain = chain.when(test(interval, at), result(interval, at))
    return chain


class _Ranks:
    """The open intervals of one column, and the values that were found at wanted ranks."""

    def __init__(self, df: DataFrame, column: str, at: int, whole: Interval):
        self.at, self.kind = at, df.schema[column].dataType
        self.values = df.select(F.col(f"`{column}`").alias("value"))
        self.found: dict[int, object] = {}
        self.open: list[Interval] = []
        self.take(whole)

    def take(self, interval: Interval) -> None:
        if interval.one_value:
            self.found.update(dict.fromkeys(interval.ranks, interval.low))
        elif interval.ranks:
            self.open.append(interval)

    def _shown(self, value: Column) -> Column:
        return value.cast("double" if isinstance(self.kind, (T.FloatType, T.DoubleType)) else self.kind).cast("string")

    def _read(self, text: str):
        if isinstance(self.kind, (T.FloatType, T.DoubleType)):
            return float(text.replace("Infinity", "inf"))
        return Decimal(text) if isinstance(self.kind, T.DecimalType) else int(text)

    def _rows(self) -> DataFrame:
        """Rows of open intervals with their interval; the filter reaches the scan."""
        value = F.col("value")
        inside = reduce(lambda a, b: a | b, [_inside(value, i, self.kind) for i in self.open])
        which = _by_interval(self.open, lambda i, _: _inside(value, i, self.kind), lambda _, at: F.lit(at))
        return self.values.where(inside).withColumn("interval", which)

    def count_ranges(self) -> DataFrame:
        ranges = max(RANGES // len(self.open), 16)
        place = _by_interval(
            self.open,
            lambda _, at: F.col("interval") == at,
            lambda i, _: _range_of(F.col("value"), self.kind, i.low, i.high, ranges),
        )
        counted = self._rows().groupBy("interval", place.alias("range")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        return counted.select(F.lit(self.at).alias("at"), "interval", "range", "n", self._shown(F.col("low")).alias("low"), self._shown(F.col("high")).alias("high"))

    def narrow(self, counted: Sequence) -> None:
        """Go on with the ranges that hold wanted ranks."""
        old, self.open = self.open, []
        for at, interval in enumerate(old):
            before = interval.before
            for r in sorted((r for r in counted if r["interval"] == at), key=lambda r: r["range"]):
                ranks = [k for k in interval.ranks if before <= k < before + r["n"]]
                if ranks:
                    self.take(Interval(self._read(r["low"]), self._read(r["high"]), before, r["n"], ranks))
                before += r["n"]

    def look_up(self) -> DataFrame:
        """The values at wanted ranks of intervals that are small by now."""
        counts = self._rows().groupBy("interval", "value").agg(F.count(F.lit(1)).alias("n"))
        upto = W.partitionBy("interval").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
        start = _by_interval(self.open, lambda _, at: F.col("interval") == at, lambda i, _: F.lit(i.before))
        ranks = _by_interval(
            self.open, lambda _, at: F.col("interval") == at, lambda i, _: F.array(*[F.lit(k).cast("long") for k in i.ranks])
        )
        placed = counts.withColumn("end", start + F.sum("n").over(upto)).withColumn("rank", F.explode(ranks))
        hit = (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))
        return placed.where(hit).select(F.lit(self.at).alias("at"), "rank", self._shown(F.col("value")).alias("value"))


def exact_ranks(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> list[tuple[str, float, object, object, float]]:
    """``(column, prob, below, above, part)``: the values around each quantile, and how far it lies between them.

    Values are those of the column, in its type. Columns without values are left out. What is held
    here is one row for each column and quantile, and in a pass one for each counted range.
    """
    shown = lambda c: F.col(f"`{c}`").cast("double") if isinstance(df.schema[c].dataType, T.FloatType) else F.col(f"`{c}`")
    ends = df.agg(
        *[agg for at, c in enumerate(columns) for agg in (F.count(f"`{c}`").alias(f"n{at}"), F.min(shown(c)).alias(f"low{at}"), F.max(shown(c)).alias(f"high{at}"))]
    ).first()
    positions = {at: [p * (ends[f"n{at}"] - 1) for p in probs] for at, _ in enumerate(columns) if ends[f"n{at}"]}
    states = {}
    for at, places in positions.items():
        ranks = sorted({int(f(p)) for p in places for f in (math.floor, math.ceil)})
        states[at] = _Ranks(df, columns[at], at, Interval(ends[f"low{at}"], ends[f"high{at}"], 0, ends[f"n{at}"], ranks))
    while True:
        large = [s for s in states.values() if any(i.rows > SMALL for i in s.open)]
        if not large:
            break
        rows = reduce(DataFrame.unionByName, [s.count_ranges() for s in large]).collect()
        for s in large:
            s.narrow([r for r in rows if r["at"] == s.at])
    rest = [s for s in states.values() if s.open]
    if rest:
        for r in reduce(DataFrame.unionByName, [s.look_up() for s in rest]).collect():
            states[r["at"]].found[r["rank"]] = states[r["at"]]._read(r["value"])
    return [
        (columns[at], float(p), states[at].found[math.floor(place)], states[at].found[math.ceil(place)], place - math.floor(place))
        for at, places in positions.items()
        for p, place in zip(probs, places)
    ]


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: ``column_name, prob, quantile``."""
    rows = [
        (column, p, float(below) if below == above else float(below) + float(above - below) * part)
        for column, p, below, above, part in exact_ranks(df, columns, probs)
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, prob double, quantile double")


def rank_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The values of the columns, as text in their own type, between which each quantile lies: ``column_name, prob, below, above``."""
    rows = [(column, p, str(below), str(above)) for column, p, below, above, _ in exact_ranks(df, columns, probs)]
    return df.sparkSession.createDataFrame(rows, "column_name string, prob double, below string, above string")
