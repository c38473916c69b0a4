"""Joins of closed day intervals that overlap, without meeting all of a patient's intervals on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a bucket by level; an interval has the first level on which it lies in at most 17 buckets.
WIDTHS = (64, 1024, 16384, 1 << 18)
_MOST = 16


def _bucket(day, width) -> Column:
    return F.floor(F.unix_date(day) / width).cast("int")


def _level(start, end) -> Column:
    days = F.datediff(end, start)
    out = F.when(days < _MOST * WIDTHS[0], 0)
    for k, width in enumerate(WIDTHS[1:-1], 1):
        out = out.when(days < _MOST * width, k)
    return out.otherwise(len(WIDTHS) - 1)


def _places(start: str, end: str, level: int) -> Column:
    width = WIDTHS[level]
    return F.transform(F.sequence(_bucket(start, width), _bucket(end, width)), lambda b: F.struct(F.lit(level).alias("_on"), b.alias("_bucket")))


def _levelled(df: DataFrame, start: str, end: str, level: str) -> DataFrame:
    return df.where(F.col(start) <= F.col(end)).withColumn(level, _level(start, end))


def _spread(own: DataFrame, start: str, end: str, level: str, met: DataFrame | None = None) -> DataFrame:
    """Rows once for each bucket of their interval on their own level and on those above; of those above, only the ones in met (one row, ``_met``)."""
    none = F.array().cast("array<struct<_on:int,_bucket:int>>")
    rows = own if met is None else own.crossJoin(F.broadcast(met))
    on = [F.col(level) <= k if met is None else (F.col(level) == k) | ((F.col(level) < k) & F.array_contains("_met", k)) for k in range(len(WIDTHS))]
    places = [F.when(on[k], _places(start, end, k)).otherwise(none) for k in range(len(WIDTHS))]
    return rows.select(*own.columns, F.inline(F.flatten(F.array(*places))))


def overlapping(a: DataFrame, b: DataFrame, of_a: tuple[str, str], of_b: tuple[str, str], key: str = "patid") -> DataFrame:
    """Pairs of rows of a and b of the same key whose intervals (start, end) share a day; other column names differ.

    Two intervals meet in the bucket where the later one starts, on the level of the longer one, so each pair is found once and a
    patient with a long history is spread over buckets. Intervals with a null end or that end before they start meet nothing.
    A row of b goes to a level above its own only if a row of a has that level, so let b be the larger table.
    """
    x, y = _levelled(a, *of_a, "_level_a"), _levelled(b, *of_b, "_level_b")
    met = x.agg(F.collect_set("_level_a").alias("_met"))
    x, y = _spread(x, *of_a, "_level_a"), _spread(y, *of_b, "_level_b", met)
    both = x.join(y, [key, "_on", "_bucket"])
    later = F.greatest(of_a[0], of_b[0])
    width = F.element_at(F.array(*(F.lit(w) for w in WIDTHS)), F.col("_on") + 1)
    once = (F.col("_on") == F.greatest("_level_a", "_level_b")) & (F.col("_bucket") == _bucket(later, width))
    meet = (F.col(of_a[0]) <= F.col(of_b[1])) & (F.col(of_b[0]) <= F.col(of_a[1]))
    return both.where(once & meet).drop("_on", "_bucket", "_level_a", "_level_b")
