"""All named queries of the library and their SQL.

Each query reads its tables, applies one operator (or a request) and casts what
it returns to types that SQL engines agree on: dates as text, whole numbers as
longs, doubles rounded to six places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import shared_dir
from ..operators import cohort, compare, outcomes, summaries
from ..sources import tables as sources
from .scenario import Scenario, run_requests

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}

PATIENTS = """
demographic AS (SELECT c_custkey AS patid, DATE '1930-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS birth_date, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex, r_name AS site, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
enrollment AS (SELECT o_custkey AS patid, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 179 AS e, o_orderstatus <> 'P' AS drugcov FROM orders),
dispensing AS (SELECT o_custkey AS patid, CAST(l_shipdate AS DATE) AS rxdate, p_brand AS code, CAST(l_quantity AS INTEGER) AS rxsup FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
types AS (SELECT o_custkey AS patid, CAST(l_shipdate AS DATE) AS rxdate, p_type AS code, CAST(l_quantity AS INTEGER) AS rxsup FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
diagnosis AS (SELECT o_custkey AS patid, o_orderkey AS encounterid, CAST(o_orderdate AS DATE) AS adate, o_orderstatus AS enctype, o_orderpriority AS dx, CASE WHEN o_orderstatus = 'F' THEN 'P' ELSE 'S' END AS pdx FROM orders),
death AS (SELECT c_custkey AS patid, max(CAST(o_orderdate AS DATE)) AS death_date FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal < 0 GROUP BY 1),
records AS (SELECT user_id AS patid, CAST(ts AS DATE) AS adate, event_type AS code FROM events)"""

#: Spans are told by their ends: a start that nothing within the gap reaches, an end that nothing within the gap follows.
SPANS = """
cover AS (SELECT DISTINCT patid, s, e FROM enrollment {where}),
opens AS (SELECT DISTINCT patid, s FROM cover a WHERE NOT EXISTS (SELECT 1 FROM cover b WHERE b.patid = a.patid AND b.s < a.s AND b.e >= a.s - {gap} - 1)),
closes AS (SELECT DISTINCT patid, e FROM cover a WHERE NOT EXISTS (SELECT 1 FROM cover b WHERE b.patid = a.patid AND b.e > a.e AND b.s <= a.e + {gap} + 1)),
spans AS (SELECT o.patid, o.s AS span_start, min(c.e) AS span_end FROM opens o JOIN closes c ON o.patid = c.patid AND c.e >= o.s GROUP BY 1, 2)"""

#: A clean fill has none of its code in the 183 days before.
INDEX = """
fills AS (SELECT DISTINCT patid, code, rxdate FROM dispensing),
starts AS (SELECT patid, code, rxdate AS index_date FROM fills a WHERE NOT EXISTS (SELECT 1 FROM fills b WHERE b.patid = a.patid AND b.code = a.code AND b.rxdate < a.rxdate AND b.rxdate >= a.rxdate - 183))"""

SUPPLY = """
once AS (SELECT patid, code, rxdate, max(rxsup) AS rxsup FROM dispensing GROUP BY 1, 2, 3),
numbered AS (SELECT *, row_number() OVER (PARTITION BY patid, code ORDER BY rxdate) AS k FROM once),
chained AS (SELECT patid, code, k, rxdate, rxsup, rxdate AS start_date, rxdate + rxsup - 1 AS end_date FROM numbered WHERE k = 1
  UNION ALL SELECT n.patid, n.code, n.k, n.rxdate, n.rxsup, greatest(n.rxdate, c.end_date + 1), greatest(n.rxdate, c.end_date + 1) + n.rxsup - 1 FROM chained c JOIN numbered n ON n.patid = c.patid AND n.code = c.code AND n.k = c.k + 1),
ranked AS (SELECT *, lag(end_date) OVER (PARTITION BY patid, code ORDER BY start_date) AS before FROM chained),
marked AS (SELECT *, sum(CASE WHEN before IS NULL OR start_date - before - 1 > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY patid, code ORDER BY start_date) AS episode FROM ranked),
episodes AS (SELECT patid, code, min(start_date) AS start_date, max(end_date) AS end_date, count(*) AS n_fills FROM marked GROUP BY patid, code, episode)"""

URGENT = "urgent AS (SELECT DISTINCT patid, adate FROM diagnosis WHERE dx = '1-URGENT')"
FIRST = "firsts AS (SELECT patid, min(index_date) AS index_date FROM starts GROUP BY patid)"
#: One row a patient: first start, arm, event and days of follow-up of at most a year.
ARMS = f"""{INDEX}, {FIRST}, {URGENT},
arms AS (SELECT f.patid, f.index_date, sex, site, segment, CASE WHEN segment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS treat,
  (SELECT min(adate) FROM urgent u WHERE u.patid = f.patid AND u.adate - f.index_date BETWEEN 1 AND 365) AS outcome_date
  FROM firsts f JOIN demographic d ON f.patid = d.patid),
followed AS (SELECT *, CASE WHEN outcome_date IS NULL THEN 0 ELSE 1 END AS event, coalesce(outcome_date - index_date, 365) AS days FROM arms)"""


def plain(df: DataFrame) -> DataFrame:
    kinds = {"date": lambda c: F.col(c).cast("string"), "double": lambda c: F.round(c, 6), "int": lambda c: F.col(c).cast("long"), "bigint": F.col, "string": F.col, "boolean": F.col}
    return df.select(*((kinds[t] if t in kinds else kinds["double"])(c).alias(c) for c, t in df.dtypes))


def query(sql: str | None = None, prelude: str = "", dates: str = "", longs: str = "", doubles: str = "", recursive: bool = False):
    """Registers a query and its SQL under the function's name."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql:
            casts = [*(f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()), *(f"CAST({c} AS BIGINT) AS {c}" for c in longs.split()), *(f"round({c}, 6) AS {c}" for c in doubles.split())]
            replace = f" REPLACE ({', '.join(casts)})" if casts else ""
            ORACLE_SQL[f.__name__] = f"WITH{' RECURSIVE' * recursive} {PATIENTS}{', ' * bool(prelude)}{prelude} SELECT *{replace} FROM ({sql})"
        return f

    return register


def patients(spark, sf_dir, code="p_brand"):
    return sources.to_patient_tables(sources.read_tables(spark, sf_dir), code)


def listed_patients(spark, sf_dir, codes):
    """The patient model of requests with this code list: fills of other codes go before they are joined and dealt."""
    raw = sources.read_tables(spark, sf_dir)
    return sources.to_patient_tables(raw | {"part": cohort.listed(raw["part"], codes, "p_brand")})


def _urgent(t):
    return t["diagnosis"].where("dx = '1-URGENT'").select("patid", "adate")


def _starts(t):
    return cohort.incident(t["dispensing"], 183)


def _arms(t):
    index = cohort.entry_first(_starts(t).drop("code").distinct())
    found = index.join(t["demographic"], "patid").withColumn("treat", F.col("segment").isin("BUILDING", "MACHINERY").cast("int"))
    found = outcomes.first_outcome(found, _urgent(t), 1, 365)
    return found.withColumn("event", F.col("outcome_date").isNotNull().cast("int")).withColumn("days", F.coalesce(F.datediff("outcome_date", "index_date"), F.lit(365)).cast("long"))


def _episodes(t):
    return cohort.treatment_episodes(cohort.stockpile(cohort.collapse_fills(t["dispensing"])), 30)


# Sources


@query("SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'region', count(*) FROM region", longs="n")
def read_tables(spark, sf_dir):
    parts = [t.groupBy(F.lit(name).alias("name")).agg(F.count("*").alias("n")) for name, t in sorted(sources.read_tables(spark, sf_dir).items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT patid, birth_date, sex, site, segment, count(*) AS n_orders, sum(CASE WHEN drugcov THEN 1 ELSE 0 END) AS n_drugcov FROM demographic JOIN enrollment USING (patid) GROUP BY ALL", dates="birth_date", longs="n_orders n_drugcov")
def to_patient_tables(spark, sf_dir):
    t = patients(spark, sf_dir)
    return t["demographic"].join(t["enrollment"], "patid").groupBy("patid", "birth_date", "sex", "site", "segment").agg(F.count("*").alias("n_orders"), F.sum(F.col("drugcov").cast("long")).alias("n_drugcov"))


@query("SELECT code AS pattern, count(*) AS n FROM dispensing WHERE code IN ('Brand#1', 'Brand#12') GROUP BY 1", longs="n")
def code_list(spark, sf_dir):
    codes = sources.code_list(spark, [("a", "Brand#1", "exact"), ("b", "Brand#12", "exact")])
    return codes.join(patients(spark, sf_dir)["dispensing"], F.col("code") == F.col("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))


# Cohorts


FLAGSHIP = """SELECT s.patid, s.code, s.index_date, min(u.adate) AS outcome_date FROM starts s JOIN spans p ON s.patid = p.patid AND p.span_start <= s.index_date - 183 AND p.span_end >= s.index_date
  LEFT JOIN urgent u ON u.patid = s.patid AND u.adate BETWEEN s.index_date + 1 AND s.index_date + 365 AND u.adate <= p.span_end GROUP BY 1, 2, 3"""


@query(FLAGSHIP, f"{SPANS.format(where='', gap=45)}, {INDEX}, {URGENT}", dates="index_date outcome_date")
def cohort_first_outcome(spark, sf_dir):
    """The flagship: clean starts of a brand with 183 days of coverage, and the first urgent order within a year."""
    return first_outcomes(patients(spark, sf_dir))


def first_outcomes(t):
    index = cohort.require_enrollment(_starts(t), cohort.bridge_spans(t["enrollment"], 45), 183)
    return outcomes.first_outcome(index, _urgent(t), 1, 365).drop("enr_end")


@query("""SELECT grp, count(*) AS n, count(DISTINCT patid) AS n_patients FROM (
  SELECT patid, CASE WHEN code LIKE 'Brand#1%' THEN 'ones' END AS grp FROM dispensing UNION ALL SELECT patid, CASE WHEN code = 'Brand#23' THEN 'single' END FROM dispensing UNION ALL SELECT patid, CASE WHEN code LIKE 'Brand#_5' OR code = 'Brand#5' THEN 'fives' END FROM dispensing) WHERE grp IS NOT NULL GROUP BY 1""", longs="n n_patients")
def match_codes(spark, sf_dir):
    codes = sources.code_list(spark, [("ones", "Brand#1%", "like"), ("single", "Brand#23", "exact"), ("fives", "Brand#_5", "like"), ("fives", "Brand#5", "exact")])
    t = listed_patients(spark, sf_dir, codes)
    return cohort.match_codes(t["dispensing"], codes, kinds=t["drugs"]).groupBy("grp").agg(F.count("*").alias("n"), F.count_distinct("patid").alias("n_patients"))


@query("SELECT dx, count(*) AS n FROM diagnosis WHERE enctype = 'F' AND pdx = 'P' GROUP BY 1", longs="n")
def care_setting(spark, sf_dir):
    return cohort.care_setting(patients(spark, sf_dir)["diagnosis"], "F", "P").groupBy("dx").agg(F.count("*").alias("n"))


@query("SELECT patid, span_start, span_end FROM spans", SPANS.format(where="", gap=45), dates="span_start span_end")
def bridge_spans(spark, sf_dir):
    return cohort.bridge_spans(patients(spark, sf_dir)["enrollment"], 45)


def _renamed(prefix, where, gap):
    text = SPANS.format(where=where, gap=gap)
    for name in ("cover", "opens", "closes", "spans"):
        text = text.replace(f"{name} ", f"{prefix}{name} ")
    return text


BOTH = f"{_renamed('m', '', 45)}, {_renamed('d', 'WHERE drugcov', 45)}"


@query("SELECT a.patid, greatest(a.span_start, b.span_start) AS span_start, least(a.span_end, b.span_end) AS span_end FROM mspans a JOIN dspans b ON a.patid = b.patid WHERE greatest(a.span_start, b.span_start) <= least(a.span_end, b.span_end)", BOTH, dates="span_start span_end")
def intersect_spans(spark, sf_dir):
    e = patients(spark, sf_dir)["enrollment"]
    return cohort.intersect_spans(cohort.bridge_spans(e, 45), cohort.bridge_spans(e.where("drugcov"), 45))


@query("SELECT s.patid, code, index_date, span_end AS enr_end FROM starts s JOIN spans p ON s.patid = p.patid AND index_date BETWEEN span_start + 183 AND span_end", f"{SPANS.format(where='', gap=45)}, {INDEX}", dates="index_date enr_end")
def require_enrollment(spark, sf_dir):
    t = patients(spark, sf_dir)
    return cohort.require_enrollment(_starts(t), cohort.bridge_spans(t["enrollment"], 45), 183)


@query("SELECT patid, code, index_date FROM starts WHERE index_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'", INDEX, dates="index_date")
def in_query_period(spark, sf_dir):
    return cohort.in_query_period(_starts(patients(spark, sf_dir)), "index_date", "1997-01-01", "1997-12-31")


@query("SELECT patid, greatest(span_start, DATE '1997-01-01') AS span_start, least(span_end, DATE '1997-12-31') AS span_end FROM spans WHERE span_end >= DATE '1997-01-01' AND span_start <= DATE '1997-12-31'", SPANS.format(where="", gap=45), dates="span_start span_end")
def clip_spans(spark, sf_dir):
    return cohort.clip_spans(cohort.bridge_spans(patients(spark, sf_dir)["enrollment"], 45), "1997-01-01", "1997-12-31")


@query("SELECT patid, code, rxdate, max(rxsup) AS rxsup FROM types GROUP BY 1, 2, 3", dates="rxdate", longs="rxsup")
def collapse_fills(spark, sf_dir):
    return cohort.collapse_fills(patients(spark, sf_dir, "p_type")["dispensing"])


@query("SELECT patid, code, rxdate, rxsup, start_date, end_date FROM chained", SUPPLY, dates="rxdate start_date end_date", longs="rxsup", recursive=True)
def stockpile(spark, sf_dir):
    return cohort.stockpile(cohort.collapse_fills(patients(spark, sf_dir)["dispensing"]))


@query("""SELECT patid, code, start_date, least(end_date + 10, start_date + 119, coalesce(following - 1, end_date + 10)) AS end_date, n_fills FROM (SELECT *, lead(start_date) OVER (PARTITION BY patid, code ORDER BY start_date) AS following FROM episodes)
  WHERE least(end_date + 10, start_date + 119, coalesce(following - 1, end_date + 10)) - start_date + 1 >= 15""", SUPPLY, dates="start_date end_date", longs="n_fills", recursive=True)
def treatment_episodes(spark, sf_dir):
    return cohort.treatment_episodes(cohort.stockpile(cohort.collapse_fills(patients(spark, sf_dir)["dispensing"])), 30, 10, 15, 120)


@query("SELECT patid, code, index_date FROM starts", INDEX, dates="index_date")
def incident(spark, sf_dir):
    return _starts(patients(spark, sf_dir))


@query("SELECT patid, code, index_date FROM starts s WHERE code = 'Brand#1' AND (SELECT count(*) FROM fills f WHERE f.patid = s.patid AND f.code = 'Brand#12' AND f.rxdate < s.index_date AND f.rxdate >= s.index_date - 365) = 0", INDEX, dates="index_date")
def incident_vs(spark, sf_dir):
    t = patients(spark, sf_dir)
    return cohort.incident_vs(_starts(t).where("code = 'Brand#1'"), t["dispensing"].where("code = 'Brand#12'"), 365)


@query("""SELECT patid, index_date FROM firsts f WHERE (SELECT count(DISTINCT adate) FROM diagnosis d WHERE d.patid = f.patid AND dx = '2-HIGH' AND adate - index_date BETWEEN -365 AND 365) < 2
  AND (SELECT count(*) FROM diagnosis d WHERE d.patid = f.patid AND dx = '5-LOW' AND adate - index_date BETWEEN 0 AND 730) >= 1""", f"{INDEX}, {FIRST}", dates="index_date")
def apply_windows(spark, sf_dir):
    t = patients(spark, sf_dir)
    index = cohort.entry_first(_starts(t).drop("code").distinct())
    rules = [{"group": "2-HIGH", "low": -365, "high": 365, "n": 2, "include": False}, {"group": "5-LOW", "low": 0, "high": 730}]
    return cohort.apply_windows(index, t["diagnosis"], rules, code="dx")


@query("""SELECT patid, index_date, age, CASE WHEN age < 20 THEN '<20' WHEN age < 40 THEN '20-39' WHEN age < 60 THEN '40-59' ELSE '>=60' END AS age_band FROM (
  SELECT f.patid, index_date, year(index_date) - year(birth_date) - CASE WHEN strftime(index_date, '%m%d') < strftime(birth_date, '%m%d') THEN 1 ELSE 0 END AS age FROM firsts f JOIN demographic d ON f.patid = d.patid)""", f"{INDEX}, {FIRST}", dates="index_date", longs="age")
def age_at(spark, sf_dir):
    t = patients(spark, sf_dir)
    return cohort.age_at(cohort.entry_first(_starts(t).drop("code").distinct()), t["demographic"], [20, 40, 60])


@query("SELECT DISTINCT ON (patid) patid, code, index_date FROM starts ORDER BY patid, index_date, code", INDEX, dates="index_date")
def entry_first(spark, sf_dir):
    return cohort.entry_first(_starts(patients(spark, sf_dir)))


@query("SELECT code, count(*) AS n, min(index_date) AS first_date FROM starts GROUP BY 1", INDEX, dates="first_date", longs="n")
def entry_all(spark, sf_dir):
    return cohort.entry_all(_starts(patients(spark, sf_dir))).groupBy("code").agg(F.count("*").alias("n"), F.min("index_date").alias("first_date"))


@query("SELECT patid, index_date FROM taken", """dates AS (SELECT DISTINCT patid, rxdate FROM dispensing),
taken AS (SELECT patid, min(rxdate) AS index_date FROM dates GROUP BY 1 UNION ALL SELECT patid, index_date FROM (
  SELECT t.patid, (SELECT min(d.rxdate) FROM dates d WHERE d.patid = t.patid AND d.rxdate > t.index_date + 60) AS index_date FROM taken t) WHERE index_date IS NOT NULL)""", dates="index_date", recursive=True)
def entry_nonoverlap(spark, sf_dir):
    return cohort.entry_nonoverlap(patients(spark, sf_dir)["dispensing"].select("patid", F.col("rxdate").alias("index_date")), 60)


@query("""SELECT 0 AS step, 'all' AS name, count(*) AS n_rows, count(DISTINCT patid) AS n_patients FROM dispensing
  UNION ALL SELECT 1, 'long supply', count(*), count(DISTINCT patid) FROM dispensing WHERE rxsup >= 25
  UNION ALL SELECT 2, 'from 1998', count(*), count(DISTINCT patid) FROM dispensing WHERE rxsup >= 25 AND rxdate >= DATE '1998-01-01'
  UNION ALL SELECT 3, 'one brand', count(*), count(DISTINCT patid) FROM dispensing WHERE rxsup >= 25 AND rxdate >= DATE '1998-01-01' AND code = 'Brand#1'""", longs="step n_rows n_patients")
def attrition(spark, sf_dir):
    steps = [("long supply", F.col("rxsup") >= 25), ("from 1998", F.col("rxdate") >= F.lit("1998-01-01").cast("date")), ("one brand", F.col("code") == "Brand#1")]
    return cohort.attrition(patients(spark, sf_dir)["dispensing"], steps)


@query("""SELECT patid, code, start_date, coalesce(cut - 1, end_date) AS end_date, n_fills, cut IS NOT NULL AS truncated FROM (
  SELECT *, (SELECT min(o.start_date) FROM episodes o WHERE o.patid = e.patid AND o.code = 'Brand#12' AND o.start_date > e.start_date AND o.start_date <= e.end_date) AS cut FROM episodes e WHERE code <> 'Brand#12')""", SUPPLY, dates="start_date end_date", longs="n_fills", recursive=True)
def truncate_at(spark, sf_dir):
    e = _episodes(patients(spark, sf_dir))
    return cohort.truncate_at(e.where("code <> 'Brand#12'"), e.where("code = 'Brand#12'"))


# Outcomes


@query("""SELECT patid, index_date, outcome_date, death_date, end_date, CASE WHEN end_date = outcome_date THEN 'outcome' WHEN end_date = death_date THEN 'death' WHEN end_date = index_date + 365 THEN 'cap' ELSE 'data end' END AS reason, end_date - index_date AS days FROM (
  SELECT a.patid, index_date, outcome_date, death_date, least(coalesce(outcome_date, DATE '9999-01-01'), coalesce(death_date, DATE '9999-01-01'), index_date + 365, DATE '2001-06-30') AS end_date FROM arms a LEFT JOIN death d ON a.patid = d.patid)""", ARMS, dates="index_date outcome_date death_date end_date", longs="days")
def follow_up(spark, sf_dir):
    t = patients(spark, sf_dir)
    index = _arms(t).select("patid", "index_date", "outcome_date").join(t["death"], "patid", "left")
    return outcomes.follow_up(index, "2001-06-30", 365)


@query("SELECT s.patid, s.code, s.index_date, (SELECT min(adate) FROM urgent u WHERE u.patid = s.patid AND adate - index_date BETWEEN 1 AND 90) AS outcome_date FROM starts s", f"{INDEX}, {URGENT}", dates="index_date outcome_date")
def first_outcome(spark, sf_dir):
    t = patients(spark, sf_dir)
    return outcomes.first_outcome(_starts(t), _urgent(t), 1, 90)


@query("SELECT f.patid, f.index_date, count(c.adate) AS n_outcomes FROM firsts f LEFT JOIN counted c ON f.patid = c.patid GROUP BY 1, 2", f"""{INDEX}, {FIRST}, {URGENT},
inside AS (SELECT u.patid, u.adate FROM urgent u JOIN firsts f ON u.patid = f.patid WHERE adate - index_date BETWEEN 1 AND 1500),
counted AS (SELECT patid, min(adate) AS adate FROM inside GROUP BY 1 UNION ALL SELECT patid, adate FROM (SELECT c.patid, (SELECT min(i.adate) FROM inside i WHERE i.patid = c.patid AND i.adate > c.adate + 120) AS adate FROM counted c) WHERE adate IS NOT NULL)""", dates="index_date", longs="n_outcomes", recursive=True)
def count_outcomes(spark, sf_dir):
    t = patients(spark, sf_dir)
    return outcomes.count_outcomes(cohort.entry_first(_starts(t).drop("code").distinct()), _urgent(t), 1, 1500, 120)


@query("SELECT patid, adate AS outcome_date FROM urgent a WHERE NOT EXISTS (SELECT 1 FROM urgent b WHERE b.patid = a.patid AND b.adate < a.adate AND b.adate >= a.adate - 365)", URGENT, dates="outcome_date")
def incident_outcome(spark, sf_dir):
    return outcomes.incident_outcome(_urgent(patients(spark, sf_dir)), 365)


@query("SELECT DISTINCT a.patid, greatest(a.adate, b.adate) AS event_date FROM diagnosis a JOIN diagnosis b ON a.patid = b.patid AND a.dx = '1-URGENT' AND b.dx = '2-HIGH' AND abs(a.adate - b.adate) <= 14", dates="event_date")
def combine_events(spark, sf_dir):
    d = patients(spark, sf_dir)["diagnosis"]
    return outcomes.combine_events(d.where("dx = '1-URGENT'"), d.where("dx = '2-HIGH'"), 14)


@query("""SELECT n_risk, n_control, (n_risk / 60.0) / nullif(n_control / 90.0, 0) AS rate_ratio FROM (SELECT count(*) FILTER (adate - index_date BETWEEN 1 AND 60) AS n_risk, count(*) FILTER (adate - index_date BETWEEN 91 AND 180) AS n_control
  FROM (SELECT DISTINCT patid, index_date FROM starts) s JOIN urgent u ON s.patid = u.patid)""", f"{INDEX}, {URGENT}", longs="n_risk n_control", doubles="rate_ratio")
def self_controlled(spark, sf_dir):
    t = patients(spark, sf_dir)
    return outcomes.self_controlled(_starts(t), _urgent(t), (1, 60), (91, 180))


@query("""SELECT patid, kind, preg_start, preg_end, trimester, tri_start, tri_end, EXISTS (SELECT 1 FROM episodes e WHERE e.patid = x.patid AND e.code = 'Brand#1' AND e.start_date <= tri_end AND e.end_date >= tri_start) AS exposed FROM (
  SELECT *, 1 AS trimester, preg_start AS tri_start, least(preg_start + 90, preg_end) AS tri_end FROM born UNION ALL SELECT *, 2, preg_start + 91, least(preg_start + 181, preg_end) FROM born WHERE preg_start + 91 <= preg_end UNION ALL SELECT *, 3, preg_start + 182, preg_end FROM born WHERE preg_start + 182 <= preg_end) x""",
       f"{SUPPLY}, born AS (SELECT DISTINCT patid, enctype AS kind, adate - CASE enctype WHEN 'F' THEN 273 WHEN 'O' THEN 160 ELSE 70 END AS preg_start, adate AS preg_end FROM diagnosis WHERE dx = '3-MEDIUM')", dates="preg_start preg_end tri_start tri_end", longs="trimester", recursive=True)
def pregnancy_episodes(spark, sf_dir):
    t = patients(spark, sf_dir)
    ends = t["diagnosis"].where("dx = '3-MEDIUM'").select("patid", F.col("enctype").alias("kind"), F.col("adate").alias("end_date")).distinct()
    durations = spark.createDataFrame([("F", 273), ("O", 160), ("P", 70)], "kind string, duration int")
    return outcomes.pregnancy_episodes(ends, durations, _episodes(t).where("code = 'Brand#1'"))


@query("SELECT a.patid, a.code, b.code AS code_b, greatest(a.start_date, b.start_date) AS start_date, least(a.end_date, b.end_date) AS end_date FROM episodes a JOIN episodes b ON a.patid = b.patid AND a.code = 'Brand#1' AND b.code <> 'Brand#1' WHERE least(a.end_date, b.end_date) - greatest(a.start_date, b.start_date) + 1 >= 7", SUPPLY, dates="start_date end_date", recursive=True)
def concomitant(spark, sf_dir):
    e = _episodes(patients(spark, sf_dir))
    return outcomes.concomitant(e.where("code = 'Brand#1'"), e.where("code <> 'Brand#1'"), 7)


@query("SELECT code AS code_from, next_code AS code_to, count(*) AS n FROM (SELECT code, lead(code) OVER (PARTITION BY patid ORDER BY start_date, code, end_date) AS next_code FROM episodes) WHERE next_code <> code GROUP BY 1, 2", SUPPLY, longs="n", recursive=True)
def switching(spark, sf_dir):
    return outcomes.switching(_episodes(patients(spark, sf_dir)))


@query("""SELECT sex, code, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY sex ORDER BY n DESC, code) AS rank FROM (
  SELECT sex, x.code, count(*) AS n FROM firsts f JOIN demographic d ON f.patid = d.patid JOIN dispensing x ON x.patid = f.patid AND rxdate - index_date BETWEEN 0 AND 180 GROUP BY 1, 2)) WHERE rank <= 10""", f"{INDEX}, {FIRST}", longs="n rank")
def top_codes(spark, sf_dir):
    t = patients(spark, sf_dir)
    index = cohort.entry_first(_starts(t).drop("code").distinct()).join(t["demographic"], "patid")
    return outcomes.top_codes(index, t["dispensing"], 0, 180, 10, ["sex"], date="rxdate")


@query("""SELECT make_date(y, 1, 1) AS period, sum(least(span_end, make_date(y, 12, 31)) - greatest(span_start, make_date(y, 1, 1)) + 1) AS days, count(DISTINCT patid) AS n_patients FROM spans, (SELECT unnest(range(1990, 2011)) AS y)
  WHERE span_start <= make_date(y, 12, 31) AND span_end >= make_date(y, 1, 1) GROUP BY 1""", SPANS.format(where="", gap=45), dates="period", longs="days n_patients")
def person_time(spark, sf_dir):
    return outcomes.person_time(cohort.bridge_spans(patients(spark, sf_dir)["enrollment"], 45))


@query("""SELECT patid, index_date, covered, covered / 365.0 AS pdc FROM (SELECT f.patid, f.index_date, coalesce(sum(least(c.end_date, f.index_date + 364) - greatest(c.start_date, f.index_date) + 1) FILTER (c.patid IS NOT NULL), 0) AS covered
  FROM firsts f LEFT JOIN chained c ON c.patid = f.patid AND c.code = 'Brand#1' AND c.start_date <= f.index_date + 364 AND c.end_date >= f.index_date GROUP BY 1, 2)""", f"{SUPPLY}, {INDEX}, {FIRST}", dates="index_date", longs="covered", doubles="pdc", recursive=True)
def adherence(spark, sf_dir):
    t = patients(spark, sf_dir)
    fills = cohort.stockpile(cohort.collapse_fills(t["dispensing"].where("code = 'Brand#1'")))
    return outcomes.adherence(fills, cohort.entry_first(_starts(t).drop("code").distinct()), 365)


@query("""SELECT a.code || '>' || b.code || '>' || c.code AS path, count(*) AS n FROM r a JOIN r b ON a.patid = b.patid AND b.k = a.k + 1 JOIN r c ON c.patid = b.patid AND c.k = b.k + 1 GROUP BY 1""",
       "r AS (SELECT *, row_number() OVER (PARTITION BY patid ORDER BY adate, code) AS k FROM (SELECT DISTINCT patid, adate, code FROM records))", longs="n")
def event_sequences(spark, sf_dir):
    return outcomes.event_sequences(patients(spark, sf_dir)["records"], 3)


# Summaries


@query("""SELECT site, sex, grouping, n_rows, n_patients FROM (SELECT site, sex, 0 AS grouping, count(*) AS n_rows, count(DISTINCT patid) AS n_patients FROM p GROUP BY 1, 2 UNION ALL SELECT site, NULL, 1, count(*), count(DISTINCT patid) FROM p GROUP BY 1
  UNION ALL SELECT NULL, sex, 2, count(*), count(DISTINCT patid) FROM p GROUP BY sex UNION ALL SELECT NULL, NULL, 3, count(*), count(DISTINCT patid) FROM p)""", f"{INDEX}, p AS (SELECT s.patid, site, sex FROM starts s JOIN demographic d ON s.patid = d.patid)", longs="grouping n_rows n_patients")
def counts_by(spark, sf_dir):
    t = patients(spark, sf_dir)
    return summaries.counts_by(_starts(t).join(t["demographic"], "patid"), [["site", "sex"], ["site"], ["sex"], []])


@query("""SELECT segment, n_events, person_days, rate, rate / exp(1.96 / sqrt(nullif(n_events, 0))) AS low, rate * exp(1.96 / sqrt(nullif(n_events, 0))) AS high FROM (
  SELECT segment, sum(event) AS n_events, sum(days) AS person_days, sum(event) * 365250.0 / nullif(sum(days), 0) AS rate FROM followed GROUP BY 1)""", ARMS, longs="n_events person_days", doubles="rate low high")
def incidence_rate(spark, sf_dir):
    return summaries.incidence_rate(_arms(patients(spark, sf_dir)), ["segment"])


@query("SELECT sex, count(days) AS n, avg(days) AS mean, stddev_samp(days) AS sd, min(days) AS least, quantile_cont(days, 0.25) AS q1, quantile_cont(days, 0.5) AS median, quantile_cont(days, 0.75) AS q3, max(days) AS most FROM followed GROUP BY 1", ARMS, longs="n least most", doubles="mean sd q1 median q3")
def describe_by(spark, sf_dir):
    return summaries.describe_by(_arms(patients(spark, sf_dir)), "days", ["sex"])


@query("SELECT sex, CASE WHEN days < 30 THEN '<30' WHEN days < 90 THEN '30-89' WHEN days < 365 THEN '90-364' ELSE '>=365' END AS band, count(*) AS n FROM followed GROUP BY 1, 2", ARMS, longs="n")
def histogram_by(spark, sf_dir):
    return summaries.histogram_by(_arms(patients(spark, sf_dir)), "days", [30, 90, 365], ["sex"])


@query("""SELECT name AS covariate, m1 AS mean_1, m0 AS mean_0, (m1 - m0) / nullif(sqrt((v1 + v0) / 2), 0) AS difference FROM (
  SELECT name, avg(x) FILTER (treat = 1) AS m1, avg(x) FILTER (treat = 0) AS m0, var_pop(x) FILTER (treat = 1) AS v1, var_pop(x) FILTER (treat = 0) AS v0 FROM (
  SELECT treat, 'days' AS name, CAST(days AS DOUBLE) AS x FROM followed UNION ALL SELECT treat, 'female', CASE WHEN sex = 'F' THEN 1.0 ELSE 0.0 END FROM followed) GROUP BY 1)""", ARMS, doubles="mean_1 mean_0 difference")
def balance_table(spark, sf_dir):
    arms = _arms(patients(spark, sf_dir)).withColumn("female", (F.col("sex") == "F").cast("double"))
    return summaries.balance_table(arms, "treat", ["days", "female"])


@query("""SELECT f.patid, f.index_date, coalesce((SELECT sum(w) FROM (SELECT DISTINCT d.dx, CASE d.dx WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 3 ELSE 1 END AS w FROM diagnosis d WHERE d.patid = f.patid AND d.dx IN ('1-URGENT', '2-HIGH', '5-LOW') AND d.adate - f.index_date BETWEEN -730 AND -1)), 0) AS score FROM lasts f""",
       f"{INDEX}, lasts AS (SELECT patid, max(index_date) AS index_date FROM starts GROUP BY 1)", dates="index_date", longs="score")
def comorbidity_score(spark, sf_dir):
    t = patients(spark, sf_dir)
    index = _starts(t).groupBy("patid").agg(F.max("index_date").alias("index_date"))
    weights = spark.createDataFrame([("1-URGENT", 5), ("2-HIGH", 3), ("5-LOW", 1)], "condition string, weight long")
    return summaries.comorbidity_score(index, t["diagnosis"], weights, 730, code="dx")


@query("""SELECT f.patid, f.index_date, (SELECT count(*) FROM diagnosis d WHERE d.patid = f.patid AND enctype = 'F' AND adate - index_date BETWEEN -365 AND -1) AS visits_F, (SELECT count(*) FROM diagnosis d WHERE d.patid = f.patid AND enctype = 'O' AND adate - index_date BETWEEN -365 AND -1) AS visits_O,
  (SELECT count(*) FROM dispensing d WHERE d.patid = f.patid AND rxdate - index_date BETWEEN -365 AND -1) AS n_fills, (SELECT count(DISTINCT code) FROM dispensing d WHERE d.patid = f.patid AND rxdate - index_date BETWEEN -365 AND -1) AS n_codes FROM lasts f""",
       f"{INDEX}, lasts AS (SELECT patid, max(index_date) AS index_date FROM starts GROUP BY 1)", dates="index_date", longs="visits_F visits_O n_fills n_codes")
def utilisation(spark, sf_dir):
    t = patients(spark, sf_dir)
    index = _starts(t).groupBy("patid").agg(F.max("index_date").alias("index_date"))
    return summaries.utilisation(index, t["encounter"], t["dispensing"], -365, -1, ["F", "O"])


@query("SELECT patid % 40 AS cell, code, CASE WHEN count(*) >= 11 THEN count(*) END AS n, count(*) < 11 AS suppressed FROM records GROUP BY 1, 2", longs="cell n")
def suppress_small(spark, sf_dir):
    counted = patients(spark, sf_dir)["records"].groupBy((F.col("patid") % 40).alias("cell"), "code").agg(F.count("*").alias("n"))
    return summaries.suppress_small(counted, ["n"], 11)


@query("""SELECT p AS period, sum(least(span_end, last_day(p)) - greatest(span_start, p) + 1) AS member_days, count(DISTINCT s.patid) AS members,
  (SELECT count(DISTINCT u.patid) FROM urgent u JOIN spans c ON u.patid = c.patid AND u.adate BETWEEN c.span_start AND c.span_end WHERE date_trunc('month', u.adate) = p) AS prevalent,
  (SELECT count(DISTINCT u.patid) FROM fresh u JOIN spans c ON u.patid = c.patid AND u.adate BETWEEN c.span_start AND c.span_end WHERE date_trunc('month', u.adate) = p) AS incident
  FROM spans s, (SELECT CAST(unnest(range(DATE '1994-01-01', DATE '2003-01-01', INTERVAL 1 MONTH)) AS DATE) AS p) WHERE span_start <= last_day(p) AND span_end >= p GROUP BY 1""",
       f"{SPANS.format(where='', gap=45)}, {URGENT}, fresh AS (SELECT patid, adate FROM urgent a WHERE NOT EXISTS (SELECT 1 FROM urgent b WHERE b.patid = a.patid AND b.adate < a.adate AND b.adate >= a.adate - 365))", dates="period", longs="member_days members prevalent incident")
def background_rates(spark, sf_dir):
    t = patients(spark, sf_dir)
    return summaries.background_rates(cohort.bridge_spans(t["enrollment"], 45), _urgent(t), 365)


@query("""SELECT sex, time, n_events, n_censored, n_risk, CASE WHEN bool_or(n_events = n_risk) OVER w THEN 0.0 ELSE product(1 - n_events * 1.0 / n_risk) OVER w END AS survival FROM (
  SELECT a.sex, a.days AS time, sum(a.event) AS n_events, sum(1 - a.event) AS n_censored, (SELECT count(*) FROM followed b WHERE b.sex = a.sex AND b.days >= a.days) AS n_risk FROM followed a GROUP BY a.sex, a.days) WINDOW w AS (PARTITION BY sex ORDER BY time)""", ARMS, longs="time n_events n_censored n_risk", doubles="survival")
def kaplan_meier(spark, sf_dir):
    return summaries.kaplan_meier(_arms(patients(spark, sf_dir)), ["sex"])


@query("""SELECT s.patid, s.code, s.index_date, x.adate AS value_date, x.dx AS value FROM starts s LEFT JOIN LATERAL (SELECT adate, dx FROM diagnosis d WHERE d.patid = s.patid AND d.adate <= s.index_date ORDER BY adate DESC, dx DESC LIMIT 1) x ON true""", INDEX, dates="index_date value_date")
def latest_value(spark, sf_dir):
    t = patients(spark, sf_dir)
    return summaries.latest_value(_starts(t), t["diagnosis"], "dx")


@query("SELECT sex, count(*) AS n_rows, sum(event) AS n_events FROM followed GROUP BY 1", ARMS, longs="n_rows n_events")
def combine_sites(spark, sf_dir):
    by_site = _by_site(spark, sf_dir)
    return summaries.combine_sites([arms.groupBy("sex").agg(F.count("*").alias("n_rows"), F.sum("event").alias("n_events")) for arms in by_site], ["sex"], ["n_rows", "n_events"])


def _by_site(spark, sf_dir):
    """The patients of each site that there is, as the site itself would hold them."""
    sites = [r.r_name for r in sources.read_tables(spark, sf_dir, ("region",))["region"].select("r_name").distinct().orderBy("r_name").collect()]  # a site a region
    arms = _arms(patients(spark, sf_dir))
    return [arms.where(F.col("site") == s) for s in sites]


@query("""SELECT sex, time, n_events, n_censored, n_risk, CASE WHEN bool_or(n_events = n_risk) OVER w THEN 0.0 ELSE product(1 - n_events * 1.0 / n_risk) OVER w END AS survival FROM (
  SELECT a.sex, a.days AS time, sum(a.event) AS n_events, sum(1 - a.event) AS n_censored, (SELECT count(*) FROM followed b WHERE b.sex = a.sex AND b.days >= a.days) AS n_risk FROM followed a GROUP BY a.sex, a.days) WINDOW w AS (PARTITION BY sex ORDER BY time)""", ARMS, longs="time n_events n_censored n_risk", doubles="survival")
def combine_survival(spark, sf_dir):
    """Pooled survival from each site's table of times, against that of all patients."""
    return summaries.combine_survival([summaries.at_risk(arms, ["sex"]) for arms in _by_site(spark, sf_dir)], ["sex"])


@query("SELECT sex, count(days) AS n, quantile_cont(days, 0.25) AS q1, quantile_cont(days, 0.5) AS median, quantile_cont(days, 0.75) AS q3 FROM followed GROUP BY 1", ARMS, longs="n", doubles="q1 median q3")
def combine_quantiles(spark, sf_dir):
    """Pooled quartiles from each site's counts of values, against those of all patients."""
    found = summaries.combine_quantiles([summaries.value_counts(arms, "days", ["sex"]) for arms in _by_site(spark, sf_dir)], ["sex"], [0.25, 0.5, 0.75])
    return found.select("sex", "n", *(F.get("quantiles", F.lit(k)).alias(name) for k, name in enumerate(("q1", "median", "q3"))))


@query("""SELECT observed, expected, variance, (observed - expected) ** 2 / variance AS chi_square FROM (SELECT sum(d1) AS observed, sum(d * n1 * 1.0 / n) AS expected, sum(CASE WHEN n > 1 THEN d * (n1 * 1.0 / n) * (1 - n1 * 1.0 / n) * (n - d) / (n - 1) ELSE 0 END) AS variance FROM (
  SELECT site, days, sum(event) AS d, sum(event * treat) AS d1, (SELECT count(*) FROM followed b WHERE b.site = a.site AND b.days >= a.days) AS n, (SELECT sum(treat) FROM followed b WHERE b.site = a.site AND b.days >= a.days) AS n1 FROM followed a GROUP BY site, days HAVING sum(event) > 0))""", ARMS, longs="observed", doubles="expected variance chi_square")
def combine_log_rank(spark, sf_dir):
    """The log-rank test stratified by site, from each site's risk sets."""
    return compare.combine_log_rank([compare.risk_sets(arms) for arms in _by_site(spark, sf_dir)])


# Comparisons


def _covariates(t):
    return compare.covariate_matrix(_arms(t).select("patid", "index_date", "treat", "sex", "site", "event", "days"), t["diagnosis"], ["1-URGENT", "2-HIGH", "5-LOW"], -365, 365, code="dx")


@query("SELECT patid, index_date, treat, " + ", ".join(f"""CASE WHEN EXISTS (SELECT 1 FROM diagnosis d WHERE d.patid = f.patid AND d.dx = '{g}' AND d.adate - f.index_date BETWEEN -365 AND 365) THEN 1 ELSE 0 END AS "{g}" """ for g in ("1-URGENT", "2-HIGH", "5-LOW")) + "FROM followed f", ARMS, dates="index_date", longs='treat "1-URGENT" "2-HIGH" "5-LOW"')
def covariate_matrix(spark, sf_dir):
    return _covariates(patients(spark, sf_dir)).drop("sex", "site", "event", "days")


def _scored(t):
    found = _covariates(t).withColumn("female", (F.col("sex") == "F").cast("int"))
    return compare.propensity(found, "treat", ["1-URGENT", "2-HIGH", "5-LOW", "female"])


#: Covariates of the score, and its fit in another shape: one coefficient at a time goes to where its slope is 0, by Newton steps, round and round.
FIT = f"""{ARMS}, covs AS (SELECT patid, treat, [1.0::DOUBLE, {", ".join(f"CAST(EXISTS (SELECT 1 FROM diagnosis d WHERE d.patid = f.patid AND d.dx = '{g}' AND d.adate - f.index_date BETWEEN -365 AND 365) AS INT)::DOUBLE" for g in ("1-URGENT", "2-HIGH", "5-LOW"))}, CASE WHEN sex = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END] AS x FROM followed f),
cells AS (SELECT list({{'x': x, 'n': n, 'y': y}} ORDER BY x) AS cells FROM (SELECT x, count(*)::DOUBLE AS n, sum(treat)::DOUBLE AS y FROM covs GROUP BY 1)),
fit(k, b) AS (SELECT 0, [0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[] UNION ALL SELECT k + 1, [CASE WHEN i = j THEN b[i] - list_sum([(c.n * c.p - c.y) * c.x[j] FOR c IN filled]) / list_sum([c.n * c.p * (1 - c.p) * c.x[j] FOR c IN filled]) ELSE b[i] END FOR i IN range(1, 6)]
  FROM (SELECT k, k % 5 + 1 AS j, b, [{{'x': c.x, 'n': c.n, 'y': c.y, 'p': 1 / (1 + exp(-list_dot_product(b, c.x)))}} FOR c IN cells] AS filled FROM fit, cells WHERE k < 500))"""


@query("SELECT patid, treat, round(1 / (1 + exp(-list_dot_product((SELECT arg_max(b, k) FROM fit), x))), 4) AS ps FROM covs", FIT, longs="treat", recursive=True)
def propensity(spark, sf_dir):
    return _scored(patients(spark, sf_dir)).select("patid", "treat", F.round("ps", 4).alias("ps"))


SCORE = "scored AS (SELECT *, ((patid * 7919) % 10007) / 10007.0 AS ps FROM followed)"


def _made_score(t):
    """A score that both engines compute alike, for what follows the fit."""
    return _arms(t).withColumn("ps", (F.col("patid") * 7919 % 10007) / 10007.0)


@query("""SELECT patid, treat, 1 + CAST(ps > c[1] AS INT) + CAST(ps > c[2] AS INT) + CAST(ps > c[3] AS INT) + CAST(ps > c[4] AS INT) AS stratum FROM kept, (SELECT quantile_cont(ps, [0.2, 0.4, 0.6, 0.8]) AS c FROM kept)""",
       f"{ARMS}, {SCORE}, kept AS (SELECT * FROM scored WHERE ps BETWEEN (SELECT max(a) FROM (SELECT min(ps) AS a FROM scored GROUP BY treat)) AND (SELECT min(a) FROM (SELECT max(ps) AS a FROM scored GROUP BY treat)))", longs="treat stratum")
def ps_strata(spark, sf_dir):
    return compare.ps_strata(_made_score(patients(spark, sf_dir)), 5).select("patid", "treat", "stratum")


@query("""SELECT a.site, a.sex, a.patid AS treated, b.patid AS control FROM r a JOIN r b ON a.site = b.site AND a.sex = b.sex AND a.treat = 1 AND b.treat = 0 AND b.k IN (2 * a.k - 1, 2 * a.k)""",
       f"{ARMS}, r AS (SELECT *, row_number() OVER (PARTITION BY site, sex, treat ORDER BY patid) AS k FROM followed)")
def match_in_cells(spark, sf_dir):
    return compare.match_in_cells(_arms(patients(spark, sf_dir)), ["site", "sex"], 2)


@query()
def match_caliper(spark, sf_dir):
    """Matches by the fitted score, which many patients share."""
    return compare.match_caliper(_scored(patients(spark, sf_dir)), 0.02)


@query("SELECT patid, treat, least(CASE WHEN treat = 1 THEN s / p ELSE (1 - s) / (1 - p) END, 10.0) AS weight FROM (SELECT patid, treat, ps + 0.00005 AS p, (SELECT avg(treat) FROM scored) AS s FROM scored)", f"{ARMS}, {SCORE}", longs="treat", doubles="weight")
def ps_weights(spark, sf_dir):
    scored = _made_score(patients(spark, sf_dir)).withColumn("ps", F.col("ps") + 0.00005)
    return compare.ps_weights(scored, "ate", stabilised=True, most=10.0).select("patid", "treat", "weight")


CELLS = "SELECT site, sum(event * treat) AS e1, sum(event * (1 - treat)) AS e0, sum(treat) * 1.0 AS n1, sum(1 - treat) * 1.0 AS n0, sum(days * treat) * 1.0 AS t1, sum(days * (1 - treat)) * 1.0 AS t0 FROM followed GROUP BY 1"


@query(f"SELECT sum(e1 * n0 / (n1 + n0)) / sum(e0 * n1 / (n1 + n0)) AS risk_ratio, (sum(e1 * n0 / (n1 + n0)) - sum(e0 * n1 / (n1 + n0))) / sum(n1 * n0 / (n1 + n0)) AS risk_difference, sum(e1 * t0 / (t1 + t0)) / sum(e0 * t1 / (t1 + t0)) AS rate_ratio FROM ({CELLS})", ARMS, doubles="risk_ratio risk_difference rate_ratio")
def mantel_haenszel(spark, sf_dir):
    return compare.mantel_haenszel(_arms(patients(spark, sf_dir)), ["site"])


SETS = "sets AS (SELECT days AS time, sum(event) AS d, sum(event * treat) AS d1, (SELECT count(*) FROM followed b WHERE b.days >= a.days) AS n, (SELECT sum(treat) FROM followed b WHERE b.days >= a.days) AS n1 FROM followed a GROUP BY days HAVING sum(event) > 0)"


@query("SELECT observed, expected, variance, (observed - expected) ** 2 / variance AS chi_square FROM (SELECT sum(d1) AS observed, sum(d * n1 * 1.0 / n) AS expected, sum(CASE WHEN n > 1 THEN d * (n1 * 1.0 / n) * (1 - n1 * 1.0 / n) * (n - d) / (n - 1) ELSE 0 END) AS variance FROM sets)", f"{ARMS}, {SETS}", longs="observed", doubles="expected variance chi_square")
def log_rank(spark, sf_dir):
    return compare.log_rank(_arms(patients(spark, sf_dir)))


@query("SELECT * FROM sets", f"{ARMS}, {SETS}", longs="time d d1 n n1")
def risk_sets(spark, sf_dir):
    return compare.risk_sets(_arms(patients(spark, sf_dir)))


@query("""SELECT n_name AS node, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 UNION ALL SELECT r_name, count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
  UNION ALL SELECT 'WORLD', count(*) FROM customer""", longs="n")
def tree_counts(spark, sf_dir):
    raw = sources.read_tables(spark, sf_dir)
    counts = raw["customer"].join(raw["nation"], F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("code")).agg(F.count("*").alias("n"))
    tree = sources.to_patient_tables(raw)["tree"]
    return compare.tree_counts(counts, tree.unionByName(tree.select(F.lit("WORLD").alias("parent"), F.col("parent").alias("child"))), ["n"])


@query("SELECT site, sex, count(*) AS n_rows, sum(event) AS n_events FROM followed GROUP BY 1, 2", ARMS, longs="n_rows n_events")
def write_result(spark, sf_dir):
    """A result table written by site and read again."""
    path = f"{shared_dir(spark)}/result-{uuid.uuid4().hex}"
    sources.write_result(_arms(patients(spark, sf_dir)).groupBy("site", "sex").agg(F.count("*").alias("n_rows"), F.sum("event").alias("n_events")), path, ["site"])
    return spark.read.parquet(path)


@query(FLAGSHIP, f"{SPANS.format(where='', gap=45)}, {INDEX}, {URGENT}", dates="index_date outcome_date")
def bucketed_tables(spark, sf_dir):
    """The flagship on patient tables that were saved by patient."""
    name = uuid.uuid4().hex
    kept = {k: v for k, v in patients(spark, sf_dir).items() if k in ("dispensing", "enrollment", "diagnosis")}
    sources.save_patient_tables(kept, f"patients_{name}_", f"{shared_dir(spark)}/patients-{name}")
    return first_outcomes(sources.load_patient_tables(spark, f"patients_{name}_"))


# Requests


SCENARIOS = {
    "first starts": Scenario("1996-01-01", "2000-12-31", "ones", "urgent", strata=("sex",), min_cell=5),
    "all starts": Scenario("1995-06-01", "2001-03-31", "twos", "urgent", washout_days=90, enroll_days=60, enroll_gap=20, cover="M", entry="all", episode_gap=10, episode_ext=14, risk_from=0, risk_to=180, strata=("sex",), min_cell=8),
    "apart": Scenario("1996-01-01", "2001-06-30", "twos", "urgent", washout_days=30, enroll_days=90, cover="M", entry="nonoverlap", blackout_days=200, strata=("sex",), min_cell=5),
}
CODES = [("ones", "Brand#1%", "like"), ("twos", "Brand#2_", "like"), ("urgent", "1-URGENT", "exact")]


def _request_sql(name: str, s: Scenario) -> str:
    """A whole scenario in SQL. Its supply and its starts far enough apart are recursions, its spans are told by their ends."""
    like = next(pattern for group, pattern, _ in CODES if group == s.index_group)
    start, end = f"DATE '{s.query_start}'", f"DATE '{s.query_end}'"
    covered = "SELECT a.patid, greatest(a.span_start, b.span_start) AS span_start, least(a.span_end, b.span_end) AS span_end FROM mspans a JOIN dspans b ON a.patid = b.patid WHERE greatest(a.span_start, b.span_start) <= least(a.span_end, b.span_end)" if s.cover == "MD" else "SELECT * FROM mspans"
    entered = {
        "first": "SELECT patid, min(index_date) AS index_date FROM able GROUP BY 1",
        "all": "SELECT patid, index_date FROM able",
        "nonoverlap": "SELECT patid, index_date FROM taken",
    }[s.entry]
    days = "date_diff('day', index_date, ended)"
    return f"""SELECT '{name}' AS scenario, sex, CASE WHEN NOT hidden THEN n_events END AS n_events, person_days, hidden AS suppressed, CASE WHEN NOT hidden THEN rate END AS rate, CASE WHEN NOT hidden THEN rate / exp(1.96 / sqrt(nullif(n_events, 0))) END AS low, CASE WHEN NOT hidden THEN rate * exp(1.96 / sqrt(nullif(n_events, 0))) END AS high FROM (
WITH RECURSIVE {_renamed("m", "", s.enroll_gap)}, {_renamed("d", "WHERE drugcov", s.enroll_gap)}, covered AS ({covered}),
once AS (SELECT patid, rxdate, max(rxsup) AS rxsup FROM dispensing WHERE code LIKE '{like}' GROUP BY 1, 2),
clean AS (SELECT patid, rxdate AS index_date FROM once a WHERE rxdate BETWEEN {start} AND {end} AND NOT EXISTS (SELECT 1 FROM once b WHERE b.patid = a.patid AND b.rxdate < a.rxdate AND b.rxdate >= a.rxdate - {s.washout_days})),
able AS (SELECT c.patid, index_date, span_end AS enr_end FROM clean c JOIN covered v ON c.patid = v.patid AND index_date BETWEEN span_start + {s.enroll_days} AND span_end),
taken AS (SELECT patid, min(index_date) AS index_date FROM able GROUP BY 1 UNION ALL SELECT patid, index_date FROM (SELECT t.patid, (SELECT min(a.index_date) FROM able a WHERE a.patid = t.patid AND a.index_date > t.index_date + {s.blackout_days}) AS index_date FROM taken t) WHERE index_date IS NOT NULL),
entered AS (SELECT a.* FROM able a JOIN ({entered}) e ON a.patid = e.patid AND a.index_date = e.index_date),
numbered AS (SELECT *, row_number() OVER (PARTITION BY patid ORDER BY rxdate) AS k FROM once),
chained AS (SELECT patid, k, rxdate AS s, rxdate + rxsup - 1 AS e FROM numbered WHERE k = 1 UNION ALL SELECT n.patid, n.k, greatest(n.rxdate, c.e + 1), greatest(n.rxdate, c.e + 1) + n.rxsup - 1 FROM chained c JOIN numbered n ON n.patid = c.patid AND n.k = c.k + 1),
marked AS (SELECT *, sum(CASE WHEN before IS NULL OR s - before - 1 > {s.episode_gap} THEN 1 ELSE 0 END) OVER (PARTITION BY patid ORDER BY s) AS episode FROM (SELECT *, lag(e) OVER (PARTITION BY patid ORDER BY s) AS before FROM chained)),
episodes AS (SELECT patid, s, least(e + {s.episode_ext}, coalesce(lead(s) OVER (PARTITION BY patid ORDER BY s) - 1, e + {s.episode_ext})) AS e FROM (SELECT patid, min(s) AS s, max(e) AS e FROM marked GROUP BY patid, episode)),
ends AS (SELECT x.patid, index_date, (SELECT min(adate) FROM diagnosis d WHERE d.patid = x.patid AND dx = '1-URGENT' AND adate BETWEEN index_date + {s.risk_from} AND index_date + {s.risk_to} AND adate <= enr_end) AS outcome_date, death_date, enr_end, p.e AS episode_end
  FROM entered x LEFT JOIN episodes p ON p.patid = x.patid AND index_date BETWEEN p.s AND p.e LEFT JOIN death t ON t.patid = x.patid),
followed AS (SELECT *, least(coalesce(outcome_date, {end}), coalesce(death_date, {end}), enr_end, coalesce(episode_end, {end}), index_date + {s.risk_to}, {end}) AS ended FROM ends)
SELECT sex, sum(CASE WHEN ended = outcome_date THEN 1 ELSE 0 END) AS n_events, sum({days}) AS person_days, sum(CASE WHEN ended = outcome_date THEN 1 ELSE 0 END) * 365250.0 / nullif(sum({days}), 0) AS rate, sum(CASE WHEN ended = outcome_date THEN 1 ELSE 0 END) BETWEEN 1 AND {s.min_cell - 1} AS hidden FROM followed f JOIN demographic d ON f.patid = d.patid GROUP BY sex)"""


@query(" UNION ALL ".join(f"({_request_sql(name, s)})" for name, s in SCENARIOS.items()), longs="n_events person_days", doubles="rate low high")
def request_rates(spark, sf_dir):
    """Whole requests: starters of two groups of brands under three scenarios, urgent orders as outcome."""
    codes = sources.code_list(spark, CODES)
    return run_requests(listed_patients(spark, sf_dir, codes), SCENARIOS, codes)["rates"]
