"""Building cohorts: codes, coverage spans, fills, episodes, index dates, inclusion rules.

Records have a patient (``patid``) and a date; an index is (patid, index_date) with
further columns. Intervals are closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import days, greedy, spans


def _matches(kinds: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """Distinct codes of kinds with each entry of the code list that they match."""
    kinds = kinds.select(code).distinct()
    exact = kinds.join(codes.where("match = 'exact'"), F.col(code) == F.col("pattern"))
    return exact.unionByName(kinds.join(codes.where("match = 'like'"), F.like(F.col(code), F.col("pattern"))))


def match_codes(records: DataFrame, codes: DataFrame, code: str = "code", kinds: DataFrame | None = None) -> DataFrame:
    """Records with the group (``grp``) of each code-list entry they match, once a group.

    Patterns meet the distinct codes only; records then join those by equality where they lie, as the codes that match are broadcast.
    Care setting and principal flag of an entry hold where records have them.
    kinds: a table whose column code has every code of records (others do no harm), where it costs less to read than they do.
    """
    settings = F.collect_set(F.struct(F.coalesce("enctype", F.lit("*")).alias("enctype"), F.coalesce("pdx", F.lit("*")).alias("pdx")))
    matched = _matches(records if kinds is None else kinds, codes, code).groupBy(F.col(code).alias("_code"), "grp").agg(settings.alias("_settings"))

    def allowed(setting):
        out = F.lit(True)
        for name in {"enctype", "pdx"} & set(records.columns):
            out = out & ((setting[name] == "*") | (setting[name] == F.col(name)))
        return out

    return records.join(F.broadcast(matched), F.col(code) == F.col("_code")).where(F.exists("_settings", allowed)).drop("_code", "_settings")


def listed(records: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    """Records whose code an entry of the code list matches in some setting."""
    known = _matches(records, codes, code).select(F.col(code).alias("_known")).distinct()
    return records.join(F.broadcast(known), F.col(code) == F.col("_known"), "left_semi")


def care_setting(records: DataFrame, enctype: str | None = None, pdx: str | None = None) -> DataFrame:
    """Records of a care setting and principal flag; None: any."""
    for name, value in (("enctype", enctype), ("pdx", pdx)):
        if value is not None:
            records = records.where(F.col(name) == value)
    return records


def bridge_spans(enrollment: DataFrame, gap: int) -> DataFrame:
    """(patid, span_start, span_end): overlapping spans and those at most gap days apart are merged."""
    by = W.partitionBy("patid").orderBy("enr_start", "enr_end")
    reach = F.max("enr_end").over(by.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.datediff("enr_start", reach) - 1 > gap), 1).otherwise(0)
    marked = enrollment.select("patid", "enr_start", "enr_end").withColumn("new", new)
    numbered = marked.withColumn("span", F.sum("new").over(by))
    return numbered.groupBy("patid", "span").agg(F.min("enr_start").alias("span_start"), F.max("enr_end").alias("span_end")).drop("span")


def intersect_spans(a: DataFrame, b: DataFrame) -> DataFrame:
    """Time that lies in a span of a and a span of b."""
    other = b.select("patid", F.col("span_start").alias("s"), F.col("span_end").alias("e"))
    both = spans.overlapping(a.select("patid", "span_start", "span_end"), other, ("span_start", "span_end"), ("s", "e"))
    return both.select("patid", F.greatest("span_start", "s").alias("span_start"), F.least("span_end", "e").alias("span_end"))


def intersect_bridged(a: DataFrame, b: DataFrame, shares: int | None = None) -> DataFrame:
    """``intersect_spans`` of tables whose spans are disjoint, as ``bridge_spans`` makes them, without a join.

    Of two spans that meet, the later one starts inside the other, which is then the last of its table that has started. So spans of both are
    sorted together by day. shares: how many partitions by patient the spans are dealt into.
    """
    span, none = F.struct("span_start", "span_end"), F.lit(None).cast("struct<span_start:date,span_end:date>")
    given = [t.where(F.col("patid").isNotNull() & (F.col("span_start") <= F.col("span_end"))) for t in (a, b)]
    both = given[0].select("patid", "span_start", span.alias("_a"), none.alias("_b")).unionByName(given[1].select("patid", "span_start", none.alias("_a"), span.alias("_b")))
    upto = W.partitionBy("patid").orderBy("span_start", F.col("_a").isNull()).rowsBetween(W.unboundedPreceding, 0)
    dealt = both if shares is None else both.repartition(shares, "patid")
    last = dealt.select("patid", *(F.last(c, ignorenulls=True).over(upto).alias(c) for c in ("_a", "_b"))).where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    found = last.select("patid", F.greatest("_a.span_start", "_b.span_start").alias("span_start"), F.least("_a.span_end", "_b.span_end").alias("span_end"))
    return found.where(F.col("span_start") <= F.col("span_end"))


def require_enrollment(index: DataFrame, bridged: DataFrame, days_before: int, shares: int | None = None) -> DataFrame:
    """Index rows inside one bridged span that began at least days_before days earlier; the span's end as enr_end.

    Those spans are disjoint, as ``bridge_spans`` makes them, so only the last one that began by the index date can hold it: index rows and
    spans are sorted together by day, and no row meets a patient's other spans. shares: how many partitions by patient they are dealt into.
    """
    began = bridged.where(F.col("patid").isNotNull()).select("patid", F.col("span_start").alias("_day"), F.struct("span_start", "span_end").alias("_span"))
    both = index.where(F.col("patid").isNotNull()).withColumn("_day", F.col("index_date")).unionByName(began, allowMissingColumns=True)
    both = both if shares is None else both.repartition(shares, "patid")
    upto = W.partitionBy("patid").orderBy(F.col("_day"), F.col("_span").isNull()).rowsBetween(W.unboundedPreceding, 0)
    held = both.withColumn("_last", F.last("_span", ignorenulls=True).over(upto)).where(F.col("_span").isNull())
    inside = held.where((F.col("_last.span_start") <= F.date_sub("index_date", days_before)) & (F.col("_last.span_end") >= F.col("index_date")))
    return inside.select(*index.columns, F.col("_last.span_end").alias("enr_end"))


def in_query_period(records: DataFrame, date: str, start: str, end: str) -> DataFrame:
    return records.where(F.col(date).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def clip_spans(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Spans cut to the query period; those outside it go."""
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    inside = spans.where((F.col("span_start") <= e) & (F.col("span_end") >= s))
    return inside.withColumns({"span_start": F.greatest("span_start", s), "span_end": F.least("span_end", e)})


def collapse_fills(dispensing: DataFrame) -> DataFrame:
    """One fill a patient, code and day, with the largest supply."""
    return dispensing.groupBy("patid", "code", "rxdate").agg(F.max("rxsup").alias("rxsup"))


def stockpile(fills: DataFrame) -> DataFrame:
    """Fills (one a day) with start and end; supply that is not used up shifts the next fill.

    The recursion start = max(rxdate, last end + 1) unrolls to running sums and a running maximum.
    """
    by = W.partitionBy("patid", "code").orderBy("rxdate")
    upto = F.sum("rxsup").over(by.rowsBetween(W.unboundedPreceding, 0))
    rows = fills.withColumn("upto", upto).withColumn("day", F.unix_date("rxdate"))
    lag = F.max(F.col("day") - (F.col("upto") - F.col("rxsup"))).over(by.rowsBetween(W.unboundedPreceding, 0))
    end = (F.col("upto") + lag - 1).cast("int")
    return rows.withColumn("end", end).select("patid", "code", "rxdate", "rxsup", F.date_from_unix_date(F.col("end") - F.col("rxsup") + 1).alias("start_date"), F.date_from_unix_date("end").alias("end_date"))


def treatment_episodes(fills: DataFrame, gap: int, extension: int = 0, min_days: int = 1, max_days: int | None = None) -> DataFrame:
    """Episodes of stockpiled fills at most gap days apart, extended, cut to max_days, and of min_days at least."""
    by = W.partitionBy("patid", "code").orderBy("start_date")
    before = F.lag("end_date").over(by)
    new = F.when(before.isNull() | (F.datediff("start_date", before) - 1 > gap), 1).otherwise(0)
    numbered = fills.withColumn("new", new).withColumn("episode", F.sum("new").over(by))
    found = numbered.groupBy("patid", "code", "episode").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"), F.count("*").alias("n_fills")).drop("episode")
    following = F.lead("start_date").over(by)
    end = F.date_add("end_date", extension)
    if max_days is not None:
        end = F.least(end, F.date_add("start_date", max_days - 1))
    end = F.least(end, F.coalesce(F.date_sub(following, 1), end))
    return found.withColumn("end_date", end).where(days.length("start_date", "end_date") >= min_days)


def incident(records: DataFrame, washout: int | None, date: str = "rxdate") -> DataFrame:
    """Records without another of their patient and code in the washout days before; None: ever before. Once a day."""
    once = records.select("patid", "code", date).distinct()
    before = F.lag(date).over(W.partitionBy("patid", "code").orderBy(date))
    clean = F.col("before").isNull()
    if washout is not None:
        clean = clean | (F.datediff(date, "before") > washout)
    return once.withColumn("before", before).where(clean).select("patid", "code", F.col(date).alias("index_date"))


def incident_vs(index: DataFrame, other: DataFrame, washout: int | None, date: str = "rxdate") -> DataFrame:
    """Index rows without a record of other in the washout days before; None: ever before."""
    past = other.select(F.col("patid").alias("p"), F.col(date).alias("d")).distinct()
    cond = (F.col("patid") == F.col("p")) & days.within("d", "index_date", None if washout is None else -washout, -1)
    return index.join(past, cond, "left_anti")


def apply_windows(index: DataFrame, records: DataFrame, rules: list[dict], date: str = "adate", code: str = "code") -> DataFrame:
    """Index rows that meet every rule: dict(group, low, high, n, include).

    include: at least n distinct days of the group low to high days from index;
    else fewer than n. None as low or high: no limit.
    """
    for rule in rules:
        other = records.where(F.col(code) == rule["group"]).select(F.col("patid").alias("p"), F.col(date).alias("d")).distinct()
        cond = (F.col("patid") == F.col("p")) & days.within("d", "index_date", rule["low"], rule["high"])
        n, include = rule.get("n", 1), rule.get("include", True)
        if n == 1:
            index = index.join(other, cond, "left_semi" if include else "left_anti")
        else:
            counted = index.select("patid", "index_date").distinct().join(other, cond).groupBy("patid", "index_date").agg(F.count("*").alias("n_days")).where(F.col("n_days") >= n)
            index = index.join(counted.drop("n_days"), ["patid", "index_date"], "left_semi" if include else "left_anti")
    return index


def age_at(index: DataFrame, demographic: DataFrame, cuts: list[int]) -> DataFrame:
    """Index rows with age and age band."""
    return with_age(index.join(demographic.select("patid", "birth_date"), "patid"), cuts)


def with_age(index: DataFrame, cuts: list[int]) -> DataFrame:
    """The same of index rows that have birth_date, which goes."""
    return index.withColumn("age", days.age("birth_date", "index_date")).withColumn("age_band", days.band("age", cuts)).drop("birth_date")


def entry_first(index: DataFrame) -> DataFrame:
    """The first index of each patient; ties by all other columns."""
    others = sorted(c for c in index.columns if c not in ("patid", "index_date"))
    rank = F.row_number().over(W.partitionBy("patid").orderBy("index_date", *others))
    return index.withColumn("rank", rank).where("rank = 1").drop("rank")


def entry_all(index: DataFrame) -> DataFrame:
    return index


def entry_nonoverlap(index: DataFrame, blackout: int, by: tuple[str, ...] = ("patid",)) -> DataFrame:
    """Index dates greedily: each is more than blackout days after the last one taken.

    Each date points to the first one beyond its blackout, and doubling these pointers finds what the first date
    reaches, in a time near the number of dates. Null dates are none; dates of a null patient are those of one patient.
    """
    dates = index.select(*by, "index_date").where(F.col("index_date").isNotNull()).distinct()
    rows = dates.repartition(*by).sortWithinPartitions(*by, "index_date")
    return rows.mapInArrow(greedy.apart_by(list(by), "index_date", max(blackout, 0) + 1), rows.schema)


def attrition(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows and patients left after each step and all before it, in one pass: step, name, n_rows, n_patients.

    Rows are counted by patient first, so that one exchange of a row a patient serves all steps. A null patient is none.
    """
    named = [("all", F.lit(True)), *steps]
    passed, counts = F.lit(True), []
    for k, (_, condition) in enumerate(named):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count(F.when(passed, 1)).alias(f"r{k}"))
    left = [F.col(f"r{k}") for k in range(len(named))]
    patients = [F.count(F.when((r > 0) & F.col("patid").isNotNull(), 1)).alias(f"p{k}") for k, r in enumerate(left)]
    totals = df.groupBy("patid").agg(*counts).agg(*patients, *(F.coalesce(F.sum(r), F.lit(0)).alias(f"r{k}") for k, r in enumerate(left)))
    rows = [F.struct(F.lit(k).cast("long").alias("step"), F.lit(name).alias("name"), F.col(f"r{k}").alias("n_rows"), F.col(f"p{k}").alias("n_patients")) for k, (name, _) in enumerate(named)]
    return totals.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def truncate_at(episodes: DataFrame, other: DataFrame) -> DataFrame:
    """Episodes end the day before the first other one that starts after their own start, if that is earlier."""
    starts = other.select(F.col("patid").alias("p"), F.col("start_date").alias("s")).distinct()
    cond = (F.col("patid") == F.col("p")) & (F.col("s") > F.col("start_date")) & (F.col("s") <= F.col("end_date"))
    rows = episodes.withColumn("_row", F.monotonically_increasing_id())  # equal rows stay apart
    joined = rows.join(starts, cond, "left").groupBy(*episodes.columns, "_row").agg(F.min("s").alias("cut")).drop("_row")
    return joined.withColumn("truncated", F.col("cut").isNotNull()).withColumn("end_date", F.coalesce(F.date_sub("cut", 1), "end_date")).drop("cut")
