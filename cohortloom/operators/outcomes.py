"""Following index dates to outcomes, and what happens between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import days, spans
from . import cohort


def follow_up(index: DataFrame, data_end: str, cap: int | None = None) -> DataFrame:
    """End and reason of follow-up: the earliest of the date columns that index has.

    Columns ``outcome_date``, ``death_date``, ``enr_end``, ``episode_end``; the cap is
    days after index; the end of the data closes all. On a tie the first counts.
    """
    given = [(c, r) for c, r in (("outcome_date", "outcome"), ("death_date", "death"), ("enr_end", "disenrollment"), ("episode_end", "episode end")) if c in index.columns]
    ends = [(F.col(c), r) for c, r in given]
    if cap is not None:
        ends.append((F.date_add("index_date", cap), "cap"))
    ends.append((F.to_date(F.lit(data_end)), "data end"))
    out = index.withColumn("end_date", F.least(*(e for e, _ in ends)) if len(ends) > 1 else ends[0][0])
    reason = F.coalesce(*(F.when(e == F.col("end_date"), r) for e, r in ends))
    return out.withColumn("reason", reason).withColumn("days", F.datediff("end_date", "index_date").cast("long"))


def first_outcome(index: DataFrame, outcomes: DataFrame, low: int, high: int, date: str = "adate") -> DataFrame:
    """Index rows with the earliest outcome low to high days after index, inside enr_end where index has it; null: none."""
    other = outcomes.select(F.col("patid").alias("p"), F.col(date).alias("d"))
    cond = (F.col("patid") == F.col("p")) & days.within("d", "index_date", low, high)
    if "enr_end" in index.columns:
        cond = cond & (F.col("d") <= F.col("enr_end"))
    rows = index.withColumn("_row", F.monotonically_increasing_id())  # equal rows stay apart
    return rows.join(other, cond, "left").groupBy(*index.columns, "_row").agg(F.min("d").alias("outcome_date")).drop("_row")


def count_outcomes(index: DataFrame, outcomes: DataFrame, low: int, high: int, blackout: int, date: str = "adate") -> DataFrame:
    """Outcomes in the risk window, each more than blackout days after the last one counted: n_outcomes by index row."""
    other = outcomes.select(F.col("patid").alias("p"), F.col(date).alias("d")).distinct()
    cond = (F.col("patid") == F.col("p")) & days.within("d", "index_date", low, high)
    keys = ["patid", "index_date"]
    inside = index.select(*keys).distinct().join(other, cond).select("patid", F.col("index_date").alias("base"), F.col("d").alias("index_date"))
    counted = cohort.entry_nonoverlap(inside, blackout, ("patid", "base")).groupBy("patid", "base").agg(F.count("*").alias("n"))
    joined = index.join(counted.withColumnRenamed("base", "index_date"), keys, "left")
    return joined.withColumn("n_outcomes", F.coalesce("n", F.lit(0)).cast("long")).drop("n")


def incident_outcome(outcomes: DataFrame, washout: int | None, date: str = "adate") -> DataFrame:
    """Outcomes without another of the patient in the washout days before: patid, outcome_date."""
    coded = outcomes.select("patid", date, F.lit("outcome").alias("code"))
    return cohort.incident(coded, washout, date).select("patid", F.col("index_date").alias("outcome_date"))


def combine_events(a: DataFrame, b: DataFrame, within: int, date: str = "adate") -> DataFrame:
    """Events made of one of a and one of b at most within days apart, dated by the later: patid, event_date."""
    one = a.select("patid", F.col(date).alias("d1")).distinct()
    two = b.select("patid", F.col(date).alias("d2")).distinct()
    both = one.join(two, "patid").where(F.abs(F.datediff("d1", "d2")) <= within)
    return both.select("patid", F.greatest("d1", "d2").alias("event_date")).distinct()


def self_controlled(index: DataFrame, outcomes: DataFrame, risk: tuple[int, int], control: tuple[int, int], date: str = "adate") -> DataFrame:
    """Outcomes in the risk and control windows of the same index rows, their days, and the ratio of rates. One row."""
    other = outcomes.select(F.col("patid").alias("p"), F.col(date).alias("d")).distinct()
    low, high = min(risk[0], control[0]), max(risk[1], control[1])
    joined = index.select("patid", "index_date").distinct().join(other, (F.col("patid") == F.col("p")) & days.within("d", "index_date", low, high))
    n = {name: F.count(F.when(days.within("d", "index_date", *w), 1)).alias(name) for name, w in (("n_risk", risk), ("n_control", control))}
    rate = (F.col("n_risk") / (risk[1] - risk[0] + 1)) / F.nullif(F.col("n_control") / (control[1] - control[0] + 1), F.lit(0.0))
    return joined.agg(*n.values()).withColumn("rate_ratio", rate)


def pregnancy_episodes(deliveries: DataFrame, durations: DataFrame, exposures: DataFrame | None = None) -> DataFrame:
    """Episodes that end at a delivery and began the days before that its code (``kind``) stands for, by trimester.

    deliveries: patid, kind, end_date; durations: kind, duration (days). Trimesters
    are days 0-90, 91-181 and the rest. With exposures (patid, start_date, end_date):
    exposed, whether one overlaps the trimester.
    """
    found = deliveries.join(durations, "kind").withColumn("preg_start", F.expr("date_sub(end_date, cast(duration as int))")).withColumnRenamed("end_date", "preg_end")
    thirds = F.array(*(F.struct(F.lit(k).cast("long").alias("trimester"), F.date_add("preg_start", a).alias("tri_start"), (F.least(F.date_add("preg_start", b), "preg_end") if b else F.col("preg_end")).alias("tri_end")) for k, a, b in ((1, 0, 90), (2, 91, 181), (3, 182, None))))
    rows = found.select("patid", "kind", "preg_start", "preg_end", F.inline(thirds)).where("tri_start <= tri_end")
    if exposures is None:
        return rows
    other = exposures.select(F.col("patid").alias("p"), F.col("start_date").alias("s"), F.col("end_date").alias("e"))
    met = rows.join(other, (F.col("patid") == F.col("p")) & (F.col("s") <= F.col("tri_end")) & (F.col("e") >= F.col("tri_start")), "left")
    return met.groupBy(*rows.columns).agg((F.count("p") > 0).alias("exposed"))


def concomitant(a: DataFrame, b: DataFrame, min_days: int) -> DataFrame:
    """Overlapping episodes of a and b of min_days (1 or more) at least."""
    other = b.select("patid", F.col("code").alias("code_b"), F.col("start_date").alias("s"), F.col("end_date").alias("e"))
    both = spans.overlapping(a.select("patid", "code", "start_date", "end_date"), other, ("start_date", "end_date"), ("s", "e")).select("patid", "code", "code_b", F.greatest("start_date", "s").alias("start_date"), F.least("end_date", "e").alias("end_date"))
    return both.where(F.datediff("end_date", "start_date") + 1 >= min_days)


def switching(episodes: DataFrame) -> DataFrame:
    """Counts of moves from one episode's code to the next episode's, where they differ: code_from, code_to, n."""
    following = F.lead("code").over(W.partitionBy("patid").orderBy("start_date", "code", "end_date"))
    moved = episodes.withColumn("code_to", following).where(F.col("code_to") != F.col("code"))
    return moved.groupBy(F.col("code").alias("code_from"), "code_to").agg(F.count("*").alias("n"))


def top_codes(index: DataFrame, records: DataFrame, low: int, high: int, n: int, strata: list[str], date: str = "adate", code: str = "code") -> DataFrame:
    """The n codes of most records low to high days from index, by stratum; ties by code."""
    other = records.select(F.col("patid").alias("p"), F.col(date).alias("d"), F.col(code).alias("code"))
    joined = index.select("patid", "index_date", *strata).distinct().join(other, (F.col("patid") == F.col("p")) & days.within("d", "index_date", low, high))
    counted = joined.groupBy(*strata, "code").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy(*strata).orderBy(F.desc("n"), "code")).cast("long")
    return counted.withColumn("rank", rank).where(F.col("rank") <= n)


def person_time(covered: DataFrame, unit: str = "year") -> DataFrame:
    """Days of spans by calendar year or month: period (its first day), days, n_patients."""
    periods = F.sequence(F.trunc("span_start", unit), F.trunc("span_end", unit), F.expr(f"interval 1 {unit}"))
    rows = covered.select("patid", "span_start", "span_end", F.explode(periods).alias("period"))
    last = F.date_sub(F.add_months("period", 12 if unit == "year" else 1), 1)
    part = days.length(F.greatest("span_start", "period"), F.least("span_end", last))
    return rows.groupBy("period").agg(F.sum(part).alias("days"), F.count_distinct("patid").alias("n_patients"))


def adherence(fills: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """Share of the window days from index on that stockpiled fills cover: patid, index_date, covered, pdc."""
    other = fills.select(F.col("patid").alias("p"), F.col("start_date").alias("s"), F.col("end_date").alias("e"))
    last = F.date_add("index_date", window - 1)
    joined = index.select("patid", "index_date").distinct().join(other, (F.col("patid") == F.col("p")) & (F.col("s") <= last) & (F.col("e") >= F.col("index_date")), "left")
    inside = days.length(F.greatest("s", "index_date"), F.least("e", last))
    covered = F.coalesce(F.sum(F.when(F.col("p").isNotNull(), inside)), F.lit(0)).cast("long")
    return joined.groupBy("patid", "index_date").agg(covered.alias("covered")).withColumn("pdc", F.col("covered") / window)


def event_sequences(records: DataFrame, k: int, date: str = "adate", code: str = "code") -> DataFrame:
    """Counts of ordered paths of k codes over each patient's distinct (date, code): path, n."""
    by = W.partitionBy("patid").orderBy(date, code)
    steps = [F.col(code), *(F.lead(code, j).over(by) for j in range(1, k))]
    paths = records.select("patid", date, code).distinct().select(*(s.alias(f"s{j}") for j, s in enumerate(steps)))
    return paths.where(F.col(f"s{k - 1}").isNotNull()).groupBy(F.concat_ws(">", *(f"s{j}" for j in range(k))).alias("path")).agg(F.count("*").alias("n"))
