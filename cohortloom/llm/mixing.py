"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Sizes are words. Sources in code point order, null last, weigh ``weights`` in
turn and share the size of the whole collection; a target stops at ``max_copies``
times its source's size and the excess is shared by weight among the others, until
none is above (the level of that filling has a closed form over the sources in
order of size by weight).

Inside a source documents are not alike: expected copies rise with the size class
(the binary digits of the size), in proportion to ``lean`` plus the class, and stop
at ``max_copies``; their factor is such that expected words add up to the target
(again in closed form, over the few classes of a source). The whole part of a
document's expected copies is allocated for certain; the rest is its inclusion
probability for one more copy. For that, documents are ranked by random odds divided
by inclusion odds, so the likelier come first, and taken in this order as long as the
words still due hold them. The document that stops the run may be a long one, so the
walk goes on in the same order and takes each later document that still fits: at the
end none is left that does. The sample's size is thus fixed in words, to less than
the smallest document that it leaves out.

No window or array holds a source. Ranks are cut into ``BUCKETS`` ranges, whose sums
are added up first; the range where the words run out is cut again, ``LEVELS`` times
in all, and only the last is ordered row by row. The walk beyond goes by powers of two: while
at least h = 2^k words are left and fewer than 2h, every document shorter than h fits, and at most one that is longer
can be taken, as less than h is left then. So sums of the shorter ones, again over ranges first, tell where that state
ends, and a source takes at most as many steps as what is left has binary digits, whatever its number of documents; a step
leaves one row a source. Random numbers come from a hash of the id, so that
reruns agree; rows without an id share one and come in order of size. Rows with the same id, source and size tie and are taken in any order,
with the same counts. Null or empty texts have size 0 and are never taken; very long
ones count whole. Other columns play no part, whatever their names. An empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kit import cut

#: What a word is, and the weights of sources in turn.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
LEAN = 8
BUCKETS = 1024
LEVELS = 2
#: Tables of one row a source are broadcast up to so many rows, and joined by a shuffle beyond.
FEW_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number inside (0, 1) from a hash that other engines have too."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(seed)))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(by: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row a source: source, source_size, target. by: (source, source_size).

    The windows below see one row a source.
    """
    nth = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int")).cast("long")
    by = by.withColumn("weight", weight).withColumn("most", F.col("source_size") * max_copies)
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    level = left.cast("double") / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)).cast("double")
    by = by.withColumn("level", level)
    by = by.withColumn("free", F.col("level") * F.col("weight") <= F.col("most"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("most") / F.col("weight"), F.col("level")))).over(everything)["level"]
    return by.withColumn("at", level).select("source", "source_size", F.least(F.col("most").cast("double"), F.coalesce(F.col("at") * F.col("weight"), F.col("most").cast("double"))).alias("target"))


def expected(classes: DataFrame, plan: DataFrame, max_copies: int, lean: int) -> DataFrame:
    """One row a source: s, source_size, target, due (words left for the draw), copies (a map from size class to expected copies).

    classes: (source, k, n): words by source and size class. The windows see the classes of one source.
    """
    rows = classes.where("k > 0").join(plan.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
    down = W.partitionBy("s").orderBy(F.desc("k"))
    rows = rows.withColumn("w", F.lit(lean) + F.col("k"))
    above = F.coalesce(F.sum("n").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * max_copies
    c = (F.col("target") - above.cast("double")) / F.sum(F.col("w") * F.col("n")).over(down.rowsBetween(0, W.unboundedFollowing)).cast("double")
    rows = rows.withColumn("c", c)
    factor = F.max(F.when(F.col("c") * F.col("w") <= max_copies, F.struct("k", "c"))).over(W.partitionBy("s"))["c"]
    rows = rows.withColumn("e", F.least(F.lit(float(max_copies)), F.coalesce(factor * F.col("w"), F.lit(float(max_copies)))))
    by = rows.groupBy("s").agg(F.max("target").alias("t"), F.sum(F.floor("e") * F.col("n")).alias("certain"), F.map_from_entries(F.collect_list(F.struct("k", "e"))).alias("copies"))
    by = by.select(F.col("s").alias("s2"), (F.col("t") - F.col("certain").cast("double")).alias("due"), "copies")
    return plan.withColumnRenamed("source", "s").join(by, F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2")


def _narrow(drawn: DataFrame, level: int, side) -> DataFrame:
    """Rows with the limit's range at the next finer level, and the words before it; a null limit: all rows fit.

    The window sees at most BUCKETS sums of each source.
    """
    bucket = F.floor(F.col("place") * BUCKETS**level).cast("long")
    inside = drawn.where(F.floor(bucket / BUCKETS).cast("long") == F.col("limit"))
    sums = inside.groupBy("source", bucket.alias("bucket"), "due", "before").agg(F.sum("size").alias("n"))
    upto = F.col("before") + F.sum("n").over(W.partitionBy("source").orderBy("bucket"))
    found = sums.withColumn("upto", upto).where("upto > due").groupBy(F.col("source").alias("s")).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("x"))
    limit = cut(found.select("s", F.col("x.bucket").alias("limit"), F.col("x.before").alias("before")))
    return drawn.drop("limit", "before").join(side(limit), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _front(drawn: DataFrame, side, names: list[str]) -> DataFrame:
    """The named columns and whether a row is in the longest run from the front of its source that fits the words due."""
    drawn = drawn.withColumns({"limit": F.lit(0).cast("long"), "before": F.lit(0).cast("long")})
    for level in range(1, LEVELS + 1):
        drawn = _narrow(drawn, level, side)
    run = F.sum("size").over(W.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0))
    last = F.floor(F.col("place") * BUCKETS**LEVELS).cast("long")
    below = drawn.where(F.col("limit").isNull() | (last < F.col("limit"))).withColumn("one", F.lit(True))
    at = drawn.where(last == F.col("limit")).withColumn("one", F.col("before") + run <= F.col("due"))
    above = drawn.where(last > F.col("limit")).withColumn("one", F.lit(False))
    return below.select(*names, "one").unionByName(at.select(*names, "one")).unionByName(above.select(*names, "one"))


def _walk_on(chosen: DataFrame, side) -> DataFrame:
    """chosen with each further row taken, in order, that fits the words left of its source."""
    chosen = cut(chosen.withColumn("row", F.monotonically_increasing_id()))
    key = F.struct("place", "doc_id", "size", "row")
    rows = chosen.where("not one and place is not null").select("source", "size", key.alias("key"))
    words = F.max("due") - F.coalesce(F.sum(F.when(F.col("one"), F.col("size"))), F.lit(0))
    state = _halved(chosen.groupBy(F.col("source").alias("s")).agg(F.floor(words).cast("long").alias("left")).withColumn("last", F.lit(None).cast(dict(rows.dtypes)["key"])))
    steps = []
    while not (step := cut(_step(rows, state, side))).isEmpty():
        steps.append(step)
        state = _halved(step.where("end is not null").select("s", "then", F.col("end").alias("last")).withColumnRenamed("then", "left"))
    if not steps:
        return chosen
    spans = reduce(DataFrame.unionByName, steps).groupBy("s").agg(F.collect_list(F.struct("last", "end", "half")).alias("spans"))  # at most a step a binary digit

    def covers(x):
        inside = (x["last"].isNull() | (key > x["last"])) & (x["end"].isNull() | (key < x["end"])) & (F.col("size") < x["half"])
        return inside | F.coalesce(key == x["end"], F.lit(False))

    walked = chosen.join(side(spans), F.col("source").eqNullSafe(F.col("s")), "left")
    added = F.coalesce(~F.col("one") & F.col("place").isNotNull() & F.exists("spans", covers), F.lit(False))
    return walked.withColumn("one", F.col("one") | added).drop("s", "spans")


def _halved(state: DataFrame) -> DataFrame:
    """Sources with words left, and the greatest power of two among these."""
    return state.where("left > 0").withColumn("half", F.expr("shiftleft(cast(1 as bigint), length(bin(left)) - 1)"))


def _step(rows: DataFrame, state: DataFrame, side) -> DataFrame:
    """s, last, half, end, then: the row that brings the words left below half, if one does, and what is left then.

    Windows see the sums of a source's ranges, and the rows of one range.
    """
    near = rows.join(side(state), F.col("source").eqNullSafe(F.col("s"))).where((F.col("size") <= F.col("left")) & (F.col("last").isNull() | (F.col("key") > F.col("last"))))
    near = near.withColumns({"bucket": F.floor(F.col("key.place") * BUCKETS).cast("long"), "short": F.when(F.col("size") < F.col("half"), F.col("size")).otherwise(0)})
    known = ["s", "left", "last", "half"]
    sums = near.groupBy(*known, "bucket").agg(F.sum("short").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("s").alias("s2"), F.col("bucket").alias("b2"), before.alias("before"))
    run = F.sum("short").over(W.partitionBy("s", "bucket").orderBy("key").rowsBetween(W.unboundedPreceding, 0))
    placed = near.withColumn("run", run).join(sums, F.col("s").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("b2")))
    taken = F.col("before") + F.col("run") + F.when(F.col("short") > 0, 0).otherwise(F.col("size"))  # if this row is taken
    ends = F.when(F.col("short") > 0, taken > F.col("left") - F.col("half")).otherwise(taken <= F.col("left"))
    found = placed.groupBy(*known).agg(F.min(F.when(ends, F.struct("key", (F.col("left") - taken).alias("then")))).alias("x"))
    return found.select("s", "last", "half", F.col("x.key").alias("end"), F.col("x.then").alias("then"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, max_copies: int = MAX_COPIES, lean: int = LEAN, seed: str = "mix") -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, expected (copies), copies, taken (copies * size)."""
    size = word_count(F.col(text_col))
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")).withColumn("k", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)))
    classes = cut(rows.groupBy("source", "k").agg(F.sum("size").alias("n")))
    plan = cut(expected(classes, targets(classes.groupBy("source").agg(F.sum("n").alias("source_size")), weights, max_copies), max_copies, lean))
    few = plan.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES

    def side(df):
        return F.broadcast(df) if few else df

    u, p = uniform(F.col("doc_id"), seed), F.col("p")
    odds = (u / (1 - u)) / (p / (1 - p))
    ranked = rows.join(side(plan), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ranked = ranked.withColumn("expected", F.when(F.col("k") > 0, F.element_at("copies", F.col("k"))).otherwise(0.0)).drop("copies", "k")
    ranked = ranked.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole"))
    ranked = cut(ranked.withColumn("odds", F.when(p > 0, odds)).withColumn("place", F.col("odds") / (1 + F.col("odds"))))  # odds on a scale from 0 to 1

    names = ["doc_id", "source", "size", "source_size", "target", "expected", "whole", "due", "place"]
    rest = ranked.where("place is null").withColumn("one", F.lit(False))
    chosen = _front(ranked.where("place is not null"), side, names).unionByName(rest.select(*names, "one"))
    chosen = _walk_on(chosen, side)
    copies = (F.col("whole") + F.col("one").cast("int")).cast("long")
    return chosen.select("doc_id", "source", "size", "source_size", "target", "expected", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
