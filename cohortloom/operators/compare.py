"""Comparing two cohorts: covariates, propensity, matching, weights, pooled effects, trees."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import days, matching, order
from ..functions.shared import cut, parts
from . import summaries


def covariate_matrix(index: DataFrame, records: DataFrame, groups: list[str], low: int, high: int, date: str = "adate", code: str = "code") -> DataFrame:
    """Index rows with a 0/1 column for each group: whether it was recorded low to high days from index."""
    other = records.where(F.col(code).isin(groups)).select(F.col("patid").alias("p"), F.col(date).alias("d"), F.col(code).alias("g")).distinct()
    rows = index.withColumn("_row", F.monotonically_increasing_id())  # equal rows stay apart
    joined = rows.join(other, (F.col("patid") == F.col("p")) & days.within("d", "index_date", low, high), "left")
    flags = [F.coalesce(F.max((F.col("g") == g).cast("int")), F.lit(0)).alias(g) for g in groups]
    return joined.groupBy(*index.columns, "_row").agg(*flags).drop("_row")


def propensity(df: DataFrame, treat: str, covariates: list[str], regularisation: float = 0.0, steps: int = 25) -> DataFrame:
    """df with the fitted probability of treatment (``ps``): logistic regression by Newton steps over covariate cells.

    Patients are counted once, by cell (distinct covariates): with discrete covariates the steps then run over a table as small as
    their combinations, each as one aggregate whose sums, a square of the number of covariates, go to the driver. The penalty,
    regularisation / 2 times the squared coefficients of standardised covariates, is weighed against the mean loss. Equal covariates
    give the very same score. Rows with a null covariate have a null score and, like those with a null arm, no part in the fit.
    """
    names = [f"x{k}" for k in range(len(covariates))]
    known = df.select(F.col(treat).cast("double").alias("y"), *(F.col(c).cast("double").alias(x) for c, x in zip(covariates, names))).dropna()
    cells = cut(known.groupBy(*names).agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("y")))
    n, means, spreads = _standard(cells, names)
    if not n:
        return df.withColumn("ps", F.lit(None).cast("double"))
    z = [F.lit(1.0), *((F.col(x) - F.lit(m)) / F.lit(s) for x, m, s in zip(names, means, spreads))]
    beta = newton(lambda b: _loss(cells, z, b), len(z), [0.0] + [regularisation * n] * len(names), steps)
    given = [F.lit(1.0), *((F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(covariates, means, spreads))]
    return df.withColumn("ps", 1 / (1 + F.exp(-_dot(given, beta))))


def _standard(cells: DataFrame, names: list[str]) -> tuple[float, list[float], list[float]]:
    """Patients, and means and sample standard deviations (1 where a covariate does not vary)."""
    sums = cells.agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col(x)).alias(f"s{x}") for x in names)).first()
    n = sums["n"] or 0.0
    if not n:
        return 0.0, [], []
    means = [sums[f"s{x}"] / n for x in names]
    squares = cells.agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.pow(F.col(x) - F.lit(m), 2)).alias(x) for x, m in zip(names, means))).first()
    return n, means, [float(np.sqrt(squares[x] / max(n - 1, 1.0))) or 1.0 for x in names]


def _dot(columns: list, beta) -> F.Column:
    return reduce(lambda a, b: a + b, (c * F.lit(float(w)) for c, w in zip(columns, beta)))


def _loss(cells: DataFrame, z: list, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log loss of all patients, its gradient and its second derivatives, in one aggregate over cells."""
    eta = _dot(z, beta)
    p = 1 / (1 + F.exp(-eta))
    rows = cells.select(*(c.alias(f"z{k}") for k, c in enumerate(z)), (F.col("n") * p - F.col("y")).alias("r"), (F.col("n") * p * (1 - p)).alias("w"), (F.col("n") * (F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta)))) - F.col("y") * eta).alias("loss"))
    pairs = [(j, k) for j in range(len(z)) for k in range(j + 1)]
    sums = rows.agg(F.sum("loss"), *(F.sum(F.col("r") * F.col(f"z{k}")) for k in range(len(z))), *(F.sum(F.col("w") * F.col(f"z{j}") * F.col(f"z{k}")) for j, k in pairs)).first()
    h = np.zeros((len(z), len(z)))
    for (j, k), value in zip(pairs, sums[1 + len(z) :]):
        h[j, k] = h[k, j] = value
    return sums[0], np.array(sums[1 : 1 + len(z)]), h


def newton(loss, size: int, penalty: list[float], steps: int) -> np.ndarray:
    """The least of loss(beta) + penalty / 2 * beta^2 by Newton steps, halved while they do not help. loss: value, gradient, second derivatives."""
    beta, step, weight = np.zeros(size), np.zeros(size), np.array(penalty)
    best = np.inf
    for _ in range(steps):
        value, gradient, h = loss(beta + step)
        value += float(weight @ (beta + step) ** 2) / 2
        if value > best + 1e-9 * abs(best):
            step = step / 2
            continue
        beta, best = beta + step, value
        step = -np.linalg.pinv(h + np.diag(weight)) @ (gradient + weight * beta)
        if np.abs(step).max() < 1e-10:
            break
    return beta


def ps_strata(df: DataFrame, k: int, treat: str = "treat", score: str = "ps", trim: bool = True) -> DataFrame:
    """df with the stratum (1 to k) of exact quantiles of the score; trim: only scores that both arms reach."""
    scores = cut(df.groupBy(treat, score).agg(F.count("*").alias("_n")))
    if trim:
        ends = scores.groupBy(treat).agg(F.min(score).alias("a"), F.max(score).alias("b")).agg(F.max("a").alias("_low"), F.min("b").alias("_high"))  # one row
        shared = F.col(score).between(F.col("_low"), F.col("_high"))
        df, scores = (x.join(F.broadcast(ends), shared).drop("_low", "_high") for x in (df, scores))
    cuts = order.quantiles(scores, score, [], [j / k for j in range(1, k)], "_n")
    number = F.size(F.filter("quantiles", lambda c: F.col(score) > c)) + 1
    return df.crossJoin(F.broadcast(cuts)).withColumn("stratum", number.cast("long")).drop("quantiles")  # cuts: one row


def match_in_cells(df: DataFrame, cells: list[str], ratio: int = 1, treat: str = "treat", id_col: str = "patid") -> DataFrame:
    """Matches of treated to up to ratio controls of the same cell, in order of id: cells, treated, control."""
    order = F.row_number().over(W.partitionBy(*cells, treat).orderBy(id_col))
    ranked = df.withColumn("_n", order)
    treated = ranked.where(F.col(treat) == 1).select(*cells, F.col(id_col).alias("treated"), "_n")
    controls = ranked.where(F.col(treat) == 0).select(*cells, F.col(id_col).alias("control"), F.ceil(F.col("_n") / ratio).cast("int").alias("_n"))
    return treated.join(controls, [*cells, "_n"]).drop("_n")


def match_caliper(df: DataFrame, caliper: float, treat: str = "treat", score: str = "ps", id_col: str = "patid", segments: int | None = None) -> DataFrame:
    """Greedy 1:1 matches within the caliper, the nearest first, ties by the treated id, then the control's: treated, control, distance.

    Patients of equal score match by rank of their ids, all at once, which is what the greedy order does with them. The others
    are cut by score into segments that are solved side by side (``matching.solve``): a segment makes the matches that no one
    outside it can change and hands on the rest, which go into fewer segments with other ends, at last into one. Segments
    go down by a factor of eight, so the number of jobs follows the logarithm of their number, not the matches; the rest of a segment is what
    chains of ever nearer neighbours tie to its ends. Patients without a score, or in neither arm, match no one. Ids are unique in an arm.
    """
    spark = df.sparkSession
    given = df.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(treat).isin(0, 1))
    rows = given.select(F.col(id_col).alias("id"), F.col(score).cast("double").alias("s"), F.col(treat).cast("int").alias("arm"))
    ranked = order.running(rows, ["s", "arm"], ["id"], F.lit(1))
    one, two = (ranked.where(F.col("arm") == k).select("s", F.col("_before").alias("nth"), F.col("id").alias(name)) for k, name in ((1, "treated"), (0, "control")))
    both = cut(one.join(two, ["s", "nth"], "full_outer"))
    paired = F.col("treated").isNotNull() & F.col("control").isNotNull()
    found = [both.where(paired).select("treated", "control", F.lit(0.0).alias("distance"))]
    left = both.where(~paired).select(F.coalesce("treated", "control").alias("id"), "s", F.col("treated").isNotNull().cast("int").alias("arm"))
    kind = dict(rows.dtypes)["id"]
    n = segments or parts(spark)
    while True:
        spread = cut(left.repartitionByRange(n, "s", "arm", "id").withColumn("segment", F.spark_partition_id()))
        arm = {k: F.when(F.col("arm") == k, F.col("s")) for k in (0, 1)}
        ends = spread.groupBy("segment").agg(*(f(arm[k]).alias(f"{name}{k}") for k in arm for name, f in (("least", F.min), ("most", F.max))), *(F.count(arm[k]).alias(f"n{k}") for k in arm)).orderBy("segment").collect()  # a row a segment
        outside = matching.outsides(ends)
        if not outside:
            break
        solve = matching.solver(outside, caliper, {k: sum(r[f"n{k}"] for r in ends) for k in (0, 1)})
        done = cut(spread.groupBy("segment").applyInArrow(solve, f"treated {kind}, control {kind}, distance double, id {kind}, s double, arm int"))
        found.append(done.where("treated is not null").select("treated", "control", "distance"))
        if n == 1:
            break
        left, n = done.where("id is not null").select("id", "s", "arm"), max(1, n // 8)
    return reduce(DataFrame.unionByName, found)


def ps_weights(df: DataFrame, kind: str = "ate", treat: str = "treat", score: str = "ps", stabilised: bool = False, most: float | None = None) -> DataFrame:
    """df with inverse-probability weights (``weight``): ate, att or overlap; stabilised by the arm's share; cut at most."""
    t, p = F.col(treat) == 1, F.col(score)
    kinds = {"ate": F.when(t, 1 / p).otherwise(1 / (1 - p)), "att": F.when(t, F.lit(1.0)).otherwise(p / (1 - p)), "overlap": F.when(t, 1 - p).otherwise(p)}
    weight = kinds[kind]
    if stabilised:
        share = df.agg(F.avg(F.col(treat).cast("double")).alias("_share"))
        df = df.crossJoin(F.broadcast(share))  # one row
        weight = weight * F.when(t, F.col("_share")).otherwise(1 - F.col("_share"))
    if most is not None:
        weight = F.least(weight, F.lit(float(most)))
    return df.withColumn("weight", weight).drop("_share")


def mantel_haenszel(df: DataFrame, stratum: list[str], treat: str = "treat", event: str = "event", days_col: str = "days") -> DataFrame:
    """Pooled risk ratio, risk difference and rate ratio over strata. One row."""
    arm = {1: F.col(treat) == 1, 0: F.col(treat) == 0}
    e = F.col(event).cast("long")
    cells = df.groupBy(*stratum).agg(*(f.alias(f"{name}{k}") for k, inside in arm.items() for name, f in (("e", F.coalesce(F.sum(F.when(inside, e)), F.lit(0))), ("n", F.count(F.when(inside, 1))), ("t", F.coalesce(F.sum(F.when(inside, F.col(days_col))), F.lit(0))))))
    n, t = F.col("n1") + F.col("n0"), F.nullif(F.col("t1") + F.col("t0"), F.lit(0))
    terms = cells.select(
        (F.col("e1") * F.col("n0") / n).alias("a"), (F.col("e0") * F.col("n1") / n).alias("b"), (F.col("n1") * F.col("n0") / n).alias("w"),
        (F.col("e1") * F.col("t0") / t).alias("c"), (F.col("e0") * F.col("t1") / t).alias("d"),
    )
    sums = terms.agg(*(F.sum(x).alias(x) for x in "abwcd"))
    ratio = lambda x, y: F.try_divide(F.col(x), F.col(y))
    return sums.select(ratio("a", "b").alias("risk_ratio"), F.try_divide(F.col("a") - F.col("b"), F.col("w")).alias("risk_difference"), ratio("c", "d").alias("rate_ratio"))


def risk_sets(df: DataFrame, treat: str = "treat", time: str = "days", event: str = "event") -> DataFrame:
    """One row an event time: events and patients at risk, all and treated."""
    e, t = F.col(event).cast("long"), F.col(treat).cast("long")
    rows = df.groupBy(F.col(time).alias("time")).agg(F.sum(e).alias("d"), F.sum(e * t).alias("d1"), F.count("*").alias("m"), F.sum(t).alias("m1"))
    later = W.partitionBy().orderBy(F.desc("time")).rowsBetween(W.unboundedPreceding, 0)  # rows: distinct days of follow-up
    return rows.withColumn("n", F.sum("m").over(later)).withColumn("n1", F.sum("m1").over(later)).where("d > 0").select("time", "d", "d1", "n", "n1")


def _log_rank(sets: DataFrame) -> DataFrame:
    d, n, n1 = F.col("d"), F.col("n"), F.col("n1")
    expected = d * n1 / n
    variance = F.when(n > 1, d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1)).otherwise(0.0)
    sums = sets.agg(F.sum("d1").alias("observed"), F.sum(expected).alias("expected"), F.sum(variance).alias("variance"))
    return sums.withColumn("chi_square", F.try_divide(F.pow(F.col("observed") - F.col("expected"), 2), F.col("variance")))


def log_rank(df: DataFrame, treat: str = "treat", time: str = "days", event: str = "event") -> DataFrame:
    """Observed and expected events of the treated arm, variance and chi-square. One row."""
    return _log_rank(risk_sets(df, treat, time, event))


def combine_log_rank(results: list[DataFrame]) -> DataFrame:
    """The log-rank test stratified by site, from the risk sets of each: patients are compared with those of their own site only."""
    return _log_rank(reduce(DataFrame.unionByName, results))


def tree_counts(counts: DataFrame, tree: DataFrame, sums: list[str]) -> DataFrame:
    """Counts by code (``code``) rolled up to every node above it, itself included, each code once: node, sums.

    What is above what is found by doubling: pairs that are at most k steps apart, joined to themselves, give those at most 2k
    apart. So a tree of any depth takes a logarithm of it in rounds (recursive SQL runs a job a level), a code with several parents
    counts once in each node, and the nodes of a cycle are above each other. Edges with a null end are none.
    """
    edges = tree.where("parent is not null and child is not null").select(F.col("parent").alias("node"), F.col("child").alias("leaf")).distinct()
    above, n = cut(edges), None
    while n != (n := above.count()):
        further = above.join(above.select(F.col("node").alias("leaf"), F.col("leaf").alias("_below")), "leaf").select("node", F.col("_below").alias("leaf"))
        above = cut(above.unionByName(further).distinct())
    by_code = counts.groupBy(F.col("code").alias("leaf")).agg(*(F.sum(c).alias(c) for c in sums))
    upwards = above.where("node <> leaf").join(by_code, "leaf").select("node", *sums)
    return upwards.unionByName(by_code.select(F.col("leaf").alias("node"), *sums)).groupBy("node").agg(*(F.sum(c).alias(c) for c in sums))


def effect(df: DataFrame, stratum: list[str]) -> dict[str, DataFrame]:
    """The usual comparison of two arms: pooled effects and the log-rank test."""
    return {"pooled": mantel_haenszel(df, stratum), "log_rank": log_rank(df), "survival": summaries.kaplan_meier(df, ["treat"])}
