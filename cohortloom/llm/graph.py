"""Connected components of links between integer ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kit import cut, drop


#: Links from which one id may have so many that Spark splits a join on it; its own limit is 256 MB of a partition.
SPLIT_LINKS = 1 << 22


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def _round(both: DataFrame) -> DataFrame:
    """A large and a small star of links in both directions; all links of an id are in one task."""
    least = F.min("v").over(W.partitionBy("u"))
    large = both.withColumn("m", F.least("u", least)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
    return large.withColumn("m", least).select(F.inline(small)).where("u <> v").distinct()


def _split_round(both: DataFrame, done: list[DataFrame]) -> DataFrame:
    """The same by joins that Spark splits; done: gets the tables written for it."""

    def apart(df):
        done.append(df := cut(df))
        return df

    least = apart(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lowest = apart(large.groupBy("u").agg(F.min("v").alias("m")))
    small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b); component: the smallest id reachable.

    Each round is written to the shared folder; rounds grow with the logarithm of
    the longest chain. Ids with many links are aggregated before the shuffle. From SPLIT_LINKS links on, what is joined to
    them, a row an id, is written first: Spark splits a join on a large id (spark.sql.adaptive.skewJoin)
    only if neither side is an aggregate of the same stage. Below that, a round is two windows by id, as Spark keeps a thread of the driver
    for each shuffle of the last minute.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = _state(edges)
    while True:
        done = [edges]
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = cut(_split_round(both, done) if now[0] >= SPLIT_LINKS else _round(both))
        before, now = now, _state(edges)
        drop(*done)
        if now == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
