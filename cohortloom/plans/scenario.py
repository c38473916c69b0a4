"""A request: parameters and code lists in, cohort and result tables out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import cut, parts, shared_dir
from ..operators import cohort, outcomes, summaries
from ..sources.tables import save_patient_tables, stored_bytes

#: Bytes of the files behind the fills for a share of what scenarios share, if that makes more shares than there are cores.
SHARE_BYTES = 1 << 24


@dataclass(frozen=True)
class Scenario:
    """Parameters of one request; days are counts of calendar days."""

    query_start: str
    query_end: str
    index_group: str
    outcome_group: str
    washout_days: int | None = 183
    washout_groups: tuple[str, ...] = ()
    enroll_days: int = 183
    enroll_gap: int = 45
    cover: str = "MD"
    entry: str = "first"
    blackout_days: int = 0
    episode_gap: int = 30
    episode_ext: int = 0
    min_episode_days: int = 1
    max_episode_days: int | None = None
    outcome_washout: int | None = None
    risk_from: int = 1
    risk_to: int = 365
    age_bins: tuple[int, ...] = (20, 40, 60)
    strata: tuple[str, ...] = ("sex", "age_band")
    min_cell: int = 11
    incl_excl: tuple[dict, ...] = field(default=())


@dataclass(frozen=True)
class Prepared:
    """What scenarios share, each table bucketed by patient into as many shares: tagged fills (one a day, with the largest supply) and
    diagnoses (one a day), covered time by (cover, gap), and the people with their death."""

    fills: DataFrame
    diagnoses: DataFrame
    covered: dict[tuple[str, int], DataFrame]
    people: DataFrame
    shares: int


def prepare(tables: dict[str, DataFrame], scenarios: list[Scenario], codes: DataFrame) -> Prepared:
    """Each source table is read, tagged and bridged once for all scenarios, dealt by patient and written to the shared folder in buckets.

    A scenario then groups, windows and joins by patient where the buckets lie. Their number follows the input, so that a task's part does not.
    tables: ``drugs``, if it is there, has every code of ``dispensing``.
    """
    groups = sorted({g for s in scenarios for g in (s.index_group, s.outcome_group, *s.washout_groups, *(r["group"] for r in s.incl_excl))})
    codes = codes.where(F.col("grp").isin(groups))
    spark = codes.sparkSession
    shares = max(min(parts(spark), spark.sparkContext.defaultParallelism), -(-stored_bytes(tables["dispensing"]) // SHARE_BYTES))
    run = uuid.uuid4().hex
    dealt = lambda df: df.repartition(shares, "patid")

    def kept(name: str, df: DataFrame) -> DataFrame:
        save_patient_tables({name: df}, f"request_{run}_", f"{shared_dir(spark)}/request-{run}", shares, dealt=True)
        return spark.table(f"request_{run}_{name}")

    fills = cohort.match_codes(dealt(tables["dispensing"].select("patid", "rxdate", "code", "rxsup")), codes, kinds=tables.get("drugs"))
    fills = cohort.collapse_fills(fills.select("patid", F.col("grp").alias("code"), "rxdate", "rxsup"))
    dx = cohort.match_codes(tables["diagnosis"].withColumnRenamed("dx", "code"), codes)
    dx = dealt(dx.select("patid", "adate", F.col("grp").alias("code"))).distinct()

    bridged, covered = {}, {}
    for letter, flag in (("M", "medcov"), ("D", "drugcov")):
        spans = dealt(tables["enrollment"].where(flag).select("patid", "enr_start", "enr_end"))
        # spans that a smaller gap has merged are merged on by a larger one
        for gap in sorted({s.enroll_gap for s in scenarios if letter in s.cover}):
            bridged[letter, gap] = kept(f"{letter}_{gap}".lower(), cohort.bridge_spans(spans, gap))
            spans = bridged[letter, gap].withColumnsRenamed({"span_start": "enr_start", "span_end": "enr_end"})
    for cover, gap in sorted({(s.cover, s.enroll_gap) for s in scenarios}):
        found = [bridged[letter, gap] for letter in "MD" if letter in cover]
        covered[cover, gap] = found[0] if len(found) == 1 else kept(f"{cover}_{gap}".lower(), cohort.intersect_bridged(*found, shares))
    people = tables["demographic"].select("patid", "birth_date", "sex", "site", "segment").join(tables["death"].select("patid", "death_date"), "patid", "left")
    return Prepared(kept("fills", fills), kept("diagnoses", dx), covered, kept("people", dealt(people)), shares)


def follow(shared: Prepared, scenario: Scenario) -> DataFrame:
    """The cohort of a scenario: one row an index with follow-up and outcome."""
    s = scenario
    outcome = shared.diagnoses.where(F.col("code") == s.outcome_group).select("patid", "adate")
    if s.outcome_washout is not None:
        outcome = outcomes.incident_outcome(outcome, s.outcome_washout).withColumnRenamed("outcome_date", "adate")
    fills = shared.fills.where(F.col("code") == s.index_group)
    index = cohort.incident(fills, s.washout_days)
    for group in s.washout_groups:
        index = cohort.incident_vs(index, shared.fills.where(F.col("code") == group), s.washout_days)
    index = cohort.in_query_period(index, "index_date", s.query_start, s.query_end)
    index = cohort.require_enrollment(index, shared.covered[s.cover, s.enroll_gap], s.enroll_days, shared.shares)
    index = cut(cohort.apply_windows(index, shared.diagnoses, list(s.incl_excl)))  # few of the fills, and read more than once
    if s.entry == "first":
        index = cohort.entry_first(index)
    elif s.entry == "nonoverlap":
        index = index.join(cohort.entry_nonoverlap(index, s.blackout_days), ["patid", "index_date"], "left_semi")
    index = index.repartition(shared.shares, "patid")

    supply = cohort.stockpile(fills.join(index.select("patid").distinct(), "patid", "left_semi"))
    episodes = cohort.treatment_episodes(supply, s.episode_gap, s.episode_ext, s.min_episode_days, s.max_episode_days)
    on = episodes.select(F.col("patid").alias("p"), "start_date", F.col("end_date").alias("episode_end"))
    index = index.join(on, (F.col("patid") == F.col("p")) & F.col("index_date").between(F.col("start_date"), F.col("episode_end")), "left").drop("p", "start_date")
    index = outcomes.first_outcome(index, outcome, s.risk_from, s.risk_to)
    index = index.join(shared.people, "patid")
    index = outcomes.follow_up(index, s.query_end, s.risk_to)
    index = cohort.with_age(index, list(s.age_bins))
    return index.withColumn("event", (F.col("reason") == "outcome").cast("long"))


def tabulate(found: DataFrame, scenario: Scenario) -> tuple[DataFrame, DataFrame]:
    """Counts and rates of a cohort, small cells suppressed."""
    s = scenario
    sets = [list(s.strata), *([c] for c in s.strata), []]
    counts = summaries.suppress_small(summaries.counts_by(found, sets), ["n_rows", "n_patients"], s.min_cell)
    rates = summaries.suppress_small(summaries.incidence_rate(found, list(s.strata)), ["n_events"], s.min_cell)
    return counts, rates.withColumns({c: F.when(~F.col("suppressed"), F.col(c)) for c in ("rate", "low", "high")})


def run_requests(tables: dict[str, DataFrame], scenarios: dict[str, Scenario], codes: DataFrame) -> dict[str, DataFrame]:
    """``cohort``, ``counts`` and ``rates`` of several scenarios, told apart by ``scenario``; strata that one lacks are null.

    Tagging and bridging are shared (``prepare``), and each cohort is written once for both its tables. What is written lies in the shared
    folder and holds no memory, so there is nothing to release but that folder.
    tables: the patient model. codes: groups of dispensing codes and of diagnosis codes.
    """
    shared = prepare(tables, list(scenarios.values()), codes)
    results = {"cohort": [], "counts": [], "rates": []}
    for name, s in scenarios.items():
        found = cut(follow(shared, s))
        for kind, table in zip(results, (found, *tabulate(found, s))):
            results[kind].append(table.select(F.lit(name).alias("scenario"), "*"))
    return {kind: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) for kind, parts in results.items()}


def run_request(tables: dict[str, DataFrame], scenario: Scenario, codes: DataFrame) -> dict[str, DataFrame]:
    """The same for one scenario, without its name."""
    return {kind: table.drop("scenario") for kind, table in run_requests(tables, {"": scenario}, codes).items()}
