"""Order statistics of groups of any size: running sums and quantiles without a group in one task.

A window over a group sorts it in one task, and an exact percentile buffers its values there. Here rows are range
partitioned by (group, order) instead, so that a large group covers many partitions. Each partition sums up its own part, and a
window over these sums, one row a partition and group, says what came before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import cut, parts


def running(df: DataFrame, by: list[str], order: list[str], amount: Column) -> DataFrame:
    """df with ``_before``, the sum of amount (a whole number) over earlier rows of the same ``by``, and ``_total``, over all of them.

    Nulls of ``by`` are a group; nulls of order come first. Rows of equal order come in any order, so let ``order`` tell all rows of a group apart
    where that matters.
    """
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    rows = cut(df.withColumns({"_key": key, "_amount": amount}))  # the range partitioning reads it twice, once for a sample
    spread = cut(rows.repartitionByRange(parts(df.sparkSession), "_key", *order).withColumn("_part", F.spark_partition_id()))
    sums = spread.groupBy("_key", "_part").agg(F.sum("_amount").alias("_sum"))
    all_parts = W.partitionBy("_key")
    earlier = F.coalesce(F.sum("_sum").over(all_parts.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("_key", "_part", earlier.alias("_offset"), F.sum("_sum").over(all_parts).alias("_total"))
    inside = F.coalesce(F.sum("_amount").over(W.partitionBy("_key", "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    found = spread.withColumn("_inside", inside).join(offsets, ["_key", "_part"])
    return found.withColumn("_before", F.col("_inside") + F.col("_offset")).drop("_key", "_amount", "_part", "_inside", "_offset")


def counted(df: DataFrame, column: str, by: list[str], weight: str | None = None) -> DataFrame:
    """by, ``_value``, ``_n`` and, of the values that are not null, ``_before`` and ``_total``: a row a distinct value, placed in its group.

    weight: a column of whole numbers that say how often a row counts.
    """
    n = F.sum(weight) if weight else F.count("*")
    values = df.groupBy(*by, F.col(column).cast("double").alias("_value")).agg(n.alias("_n"))
    return running(values, by, ["_value"], F.when(F.col("_value").isNotNull(), F.col("_n")).otherwise(0))


def at_shares(shares: list[float]) -> Column:
    """An aggregate over rows of ``counted``: the exact quantiles at these shares, interpolated between neighbours, as an array (of nulls without values)."""
    at = [F.lit(float(p)) * (F.max("_total") - 1) for p in shares]
    place = [F.lit(float(p)) * (F.col("_total") - 1) for p in shares]
    holds = lambda x: F.col("_value").isNotNull() & (F.col("_before") <= x) & (x < F.col("_before") + F.col("_n"))
    low, high = ([F.max(F.when(holds(end(x)), F.col("_value"))) for x in place] for end in (F.floor, F.ceil))
    return F.array(*(a + (b - a) * (x - F.floor(x)) for a, b, x in zip(low, high, at)))


def quantiles(df: DataFrame, column: str, by: list[str], shares: list[float], weight: str | None = None) -> DataFrame:
    """by and ``quantiles``: the exact quantiles of column as an array of doubles, nulls where a group has no value.

    Equal values are counted before they are sorted. Null values do not count. Where by is empty there is always one row.
    """
    return counted(df, column, by, weight).groupBy(*by).agg(at_shares(shares).alias("quantiles"))
