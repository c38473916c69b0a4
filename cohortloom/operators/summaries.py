"""Result tables: counts, rates, distributions, survival."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import days, order
from . import outcomes


def counts_by(df: DataFrame, strata_sets: list[list[str]]) -> DataFrame:
    """Rows and patients for each of several sets of strata in one pass; strata not in a set are null; grouping: its grouping id.

    Rows are counted by patient and strata before the one large exchange, which brings a patient's strata together. They are few, so a
    patient says itself in which cells of each set it counts, and no row is expanded or shuffled again for a set. A null patient is none.
    """
    strata = list(dict.fromkeys(c for s in strata_sets for c in s))
    own = df.groupBy("patid", *strata).agg(F.count("*").alias("_n")).groupBy("patid").agg(F.collect_list(F.struct(*strata, "_n")).alias("_own"))
    kinds = dict(df.dtypes)
    is_patient = F.col("patid").isNotNull()

    def cells(members: list[str]) -> Column:
        grouping = sum(1 << (len(strata) - 1 - k) for k, c in enumerate(strata) if c not in members)
        cell = lambda x: F.struct(F.lit(grouping).cast("long").alias("grouping"), *((x[c] if c in members else F.lit(None).cast(kinds[c])).alias(c) for c in strata))
        found = F.transform("_own", cell)
        first = lambda x, i: is_patient & (F.array_position(found, cell(x)) == i + 1)
        return F.transform("_own", lambda x, i: F.struct(cell(x).alias("c"), x["_n"].alias("n"), first(x, i).cast("long").alias("p")))

    rows = own.select(F.inline(F.flatten(F.array(*(cells(s) for s in strata_sets))))).select("c.*", "n", "p")
    return rows.groupBy("grouping", *strata).agg(F.sum("n").alias("n_rows"), F.sum("p").alias("n_patients")).select(*strata, "grouping", "n_rows", "n_patients")


def incidence_rate(df: DataFrame, strata: list[str], events: str = "event", person_days: str = "days") -> DataFrame:
    """Events a 1,000 person-years and a log-normal 95 % interval (null without events)."""
    sums = df.groupBy(*strata).agg(F.sum(F.col(events).cast("long")).alias("n_events"), F.sum(person_days).alias("person_days"))
    rate = F.try_divide(F.col("n_events") * 365250.0, F.col("person_days"))
    wide = F.exp(1.96 / F.sqrt(F.nullif("n_events", F.lit(0))))
    return sums.withColumn("rate", rate).withColumn("low", F.col("rate") / wide).withColumn("high", F.col("rate") * wide)


def describe_by(df: DataFrame, column: str, strata: list[str]) -> DataFrame:
    """n, mean, standard deviation, least, exact quartiles, most; all but n are null in a stratum without a value.

    All of it comes from one table of distinct values and their counts.
    """
    values = order.counted(df, column, strata)
    v, n = F.col("_value"), F.when(F.col("_value").isNotNull(), F.col("_n"))
    found = values.groupBy(*strata).agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"), (F.sum(n * v) / F.sum(n)).alias("mean"), F.min(v).alias("least"), order.at_shares([0.25, 0.5, 0.75]).alias("_q"), F.max(v).alias("most"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in strata), F.lit(True))
    mean = found.select(*(F.col(c).alias(f"_{c}") for c in strata), "mean")
    squares = values.join(mean, same).groupBy(*strata).agg(F.sqrt(F.sum(n * F.pow(v - F.col("mean"), 2)) / F.nullif(F.sum(n) - 1, F.lit(0))).alias("sd"))
    squares = squares.select(*(F.col(c).alias(f"_{c}") for c in strata), "sd")
    quartiles = [F.get("_q", F.lit(k)).alias(name) for k, name in enumerate(("q1", "median", "q3"))]
    kind = dict(df.dtypes)[column]
    return found.join(squares, same).select(*strata, "n", "mean", "sd", F.col("least").cast(kind).alias("least"), *quartiles, F.col("most").cast(kind).alias("most"))


def histogram_by(df: DataFrame, column: str, cuts: list[int], strata: list[str]) -> DataFrame:
    """Rows in each band of the cuts, by stratum."""
    return df.where(F.col(column).isNotNull()).groupBy(*strata, days.band(column, cuts).alias("band")).agg(F.count("*").alias("n"))


def balance_table(df: DataFrame, treat: str, covariates: list[str], weight: str | None = None) -> DataFrame:
    """Means by arm and standardised differences: covariate, mean_1, mean_0, difference. Weighted if weight is given."""
    w = F.col(weight) if weight else F.lit(1.0)
    sums = []
    for k, c in enumerate(covariates):
        for arm in (1, 0):
            inside = F.col(treat) == arm
            sums += [F.sum(F.when(inside, w)).alias(f"w{k}_{arm}"), F.sum(F.when(inside, w * F.col(c))).alias(f"x{k}_{arm}"), F.sum(F.when(inside, w * F.col(c) * F.col(c))).alias(f"q{k}_{arm}")]
    rows = []
    for k, c in enumerate(covariates):
        mean = {arm: F.col(f"x{k}_{arm}") / F.col(f"w{k}_{arm}") for arm in (1, 0)}
        variance = {arm: F.col(f"q{k}_{arm}") / F.col(f"w{k}_{arm}") - mean[arm] * mean[arm] for arm in (1, 0)}
        spread = F.sqrt(F.nullif((F.greatest(variance[1], F.lit(0.0)) + F.greatest(variance[0], F.lit(0.0))) / 2, F.lit(0.0)))
        rows.append(F.struct(F.lit(c).alias("covariate"), mean[1].alias("mean_1"), mean[0].alias("mean_0"), ((mean[1] - mean[0]) / spread).alias("difference")))
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def comorbidity_score(index: DataFrame, records: DataFrame, weights: DataFrame, lookback: int, date: str = "adate", code: str = "code") -> DataFrame:
    """Sum of the weights (condition, weight) of conditions recorded in the lookback days before index, each once."""
    other = records.select(F.col("patid").alias("p"), F.col(date).alias("d"), F.col(code).alias("condition"))
    seen = index.select("patid", "index_date").distinct().join(other, (F.col("patid") == F.col("p")) & days.within("d", "index_date", -lookback, -1)).select("patid", "index_date", "condition").distinct()
    summed = seen.join(weights, "condition").groupBy("patid", "index_date").agg(F.sum("weight").alias("score"))
    return index.join(summed, ["patid", "index_date"], "left").withColumn("score", F.coalesce("score", F.lit(0)))


def utilisation(index: DataFrame, encounters: DataFrame, dispensing: DataFrame, low: int, high: int, settings: list[str]) -> DataFrame:
    """Visits by setting, fills and distinct codes filled low to high days from index."""
    keys = ["patid", "index_date"]
    base = index.select(*keys).distinct()
    visits = encounters.select(F.col("patid").alias("p"), F.col("adate").alias("d"), "enctype")
    seen = base.join(visits, (F.col("patid") == F.col("p")) & days.within("d", "index_date", low, high)).groupBy(*keys).agg(*(F.count(F.when(F.col("enctype") == s, 1)).alias(f"visits_{s}") for s in settings))
    fills = dispensing.select(F.col("patid").alias("p"), F.col("rxdate").alias("d"), "code")
    filled = base.join(fills, (F.col("patid") == F.col("p")) & days.within("d", "index_date", low, high)).groupBy(*keys).agg(F.count("*").alias("n_fills"), F.count_distinct("code").alias("n_codes"))
    return base.join(seen, keys, "left").join(filled, keys, "left").na.fill(0)


def suppress_small(df: DataFrame, counts: list[str], min_cell: int) -> DataFrame:
    """Counts from 1 to below min_cell become null; suppressed: whether the row has any."""
    small = {c: (F.col(c) > 0) & (F.col(c) < min_cell) for c in counts}
    flag = F.coalesce(reduce(lambda a, b: a | b, small.values()), F.lit(False))
    return df.withColumns({"suppressed": flag} | {c: F.when(~x, F.col(c)) for c, x in small.items()})


def background_rates(spans: DataFrame, records: DataFrame, washout: int, unit: str = "month", date: str = "adate") -> DataFrame:
    """By period: eligible members, member-days, prevalent patients, incident patients (none in the washout days before)."""
    time = outcomes.person_time(spans, unit).withColumnRenamed("n_patients", "members").withColumnRenamed("days", "member_days")
    covered = records.join(spans.select(F.col("patid").alias("p"), "span_start", "span_end"), (F.col("patid") == F.col("p")) & F.col(date).between(F.col("span_start"), F.col("span_end"))).select("patid", F.trunc(date, unit).alias("period"))
    prevalent = covered.groupBy("period").agg(F.count_distinct("patid").alias("prevalent"))
    new = outcomes.incident_outcome(records, washout, date).withColumnRenamed("outcome_date", date)
    fresh = new.join(spans.select(F.col("patid").alias("p"), "span_start", "span_end"), (F.col("patid") == F.col("p")) & F.col(date).between(F.col("span_start"), F.col("span_end"))).groupBy(F.trunc(date, unit).alias("period")).agg(F.count_distinct("patid").alias("incident"))
    return time.join(prevalent, "period", "left").join(fresh, "period", "left").na.fill(0, ["prevalent", "incident"])


def at_risk(df: DataFrame, strata: list[str], time: str = "days", event: str = "event") -> DataFrame:
    """One row a stratum and time: n_events, n_censored, n_risk."""
    e = F.col(event).cast("long")
    return _with_risk(df.groupBy(*strata, F.col(time).alias("time")).agg(F.sum(e).alias("n_events"), F.sum(1 - e).alias("n_censored")), strata)


def _with_risk(rows: DataFrame, strata: list[str]) -> DataFrame:
    later = W.partitionBy(*strata).orderBy(F.desc("time")).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("n_risk", F.sum(F.col("n_events") + F.col("n_censored")).over(later))


def kaplan_meier(df: DataFrame, strata: list[str], time: str = "days", event: str = "event") -> DataFrame:
    """At-risk table with the survival after each time; 0 once all at risk had the event."""
    return survival(at_risk(df, strata, time, event), strata)


def survival(table: DataFrame, strata: list[str]) -> DataFrame:
    """An at-risk table with the survival after each time."""
    upto = W.partitionBy(*strata).orderBy("time").rowsBetween(W.unboundedPreceding, 0)
    share = 1 - F.col("n_events") / F.col("n_risk")
    ended = F.max((F.col("n_events") == F.col("n_risk")).cast("int")).over(upto) == 1
    logs = F.sum(F.ln(F.when(share > 0, share))).over(upto)
    return table.withColumn("survival", F.when(ended, 0.0).otherwise(F.exp(logs)))


def latest_value(index: DataFrame, records: DataFrame, value: str, date: str = "adate") -> DataFrame:
    """Index rows with the value on the last day on or before index (the largest of that day), and that day.

    Records and index rows are sorted together by patient and day, and each index row takes the last record before it,
    so no row meets a patient's whole history. A null patient or day has no value.
    """
    found = F.when(F.col("patid").isNotNull() & F.col(date).isNotNull(), F.struct(F.col(date).alias("d"), F.col(value).alias("v")))
    other = records.select("patid", F.col(date).alias("_day"), found.alias("_found"))
    both = index.withColumns({"_day": F.col("index_date"), "_index": F.lit(True)}).unionByName(other, allowMissingColumns=True)
    upto = W.partitionBy("patid").orderBy("_day", F.col("_index").asc_nulls_first(), "_found").rowsBetween(W.unboundedPreceding, 0)
    last = both.withColumn("_last", F.last("_found", ignorenulls=True).over(upto)).where("_index")
    return last.select(*index.columns, F.col("_last.d").alias("value_date"), F.col("_last.v").alias("value"))


def combine_sites(results: list[DataFrame], by: list[str], sums: list[str]) -> DataFrame:
    """Result tables of several sites stacked and totalled."""
    stacked = reduce(lambda a, b: a.unionByName(b), (r.select(*by, *sums) for r in results))
    return stacked.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums))


def combine_survival(results: list[DataFrame], strata: list[str]) -> DataFrame:
    """At-risk tables of several sites as one with its survival: what all their patients together would give.

    Events and censored patients add up by time; who is at risk follows from them, so a site's own n_risk is not needed.
    """
    pooled = combine_sites(results, [*strata, "time"], ["n_events", "n_censored"])
    return survival(_with_risk(pooled, strata), strata)


def value_counts(df: DataFrame, column: str, strata: list[str]) -> DataFrame:
    """What a site passes on for pooled quantiles: value and n, the patients that have it, by stratum."""
    return df.where(F.col(column).isNotNull()).groupBy(*strata, F.col(column).cast("double").alias("value")).agg(F.count("*").alias("n"))


def combine_quantiles(results: list[DataFrame], strata: list[str], shares: list[float]) -> DataFrame:
    """strata, n and the exact quantiles at these shares, from the value counts of several sites."""
    placed = order.counted(combine_sites(results, [*strata, "value"], ["n"]), "value", strata, "n")
    return placed.groupBy(*strata).agg(F.sum("_n").alias("n"), order.at_shares(shares).alias("quantiles"))
