"""Registered queries against their SQL in DuckDB, where the driver's tables are at hand."""

import os

import duckdb
import pytest

import __spark_entry__
from cohortloom.plans import registry, scenario
from cohortloom.sources import tables

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect())))
    if name in registry.ORACLE_SQL:
        listed = ", ".join(f'"{c}"' for c in columns)
        assert got == sorted(map(repr, duck.sql(f"SELECT {listed} FROM ({registry.ORACLE_SQL[name]})").fetchall()))
    else:
        assert name == "match_caliper"


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 1330 and len({r.patid for r in rows}) == 139 and sum(r.outcome_date is not None for r in rows) == 192


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_schema_is_checked(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "region.parquet"))
    with pytest.raises(ValueError, match="region"):
        tables.read_tables(spark, str(tmp_path), ("region",))


def test_write_result(spark, tmp_path):
    tables.write_result(spark.createDataFrame([(1, "a"), (2, "b")], "n int, g string"), str(tmp_path / "out"), ["g"])
    assert spark.read.parquet(str(tmp_path / "out")).where("g = 'b'").first().n == 2


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    """Grouping, windows and joins by patient read the buckets where they lie; only the union in the enrolment test deals its rows again."""
    kept = {k: v for k, v in registry.patients(spark, SF).items() if k in ("dispensing", "enrollment", "diagnosis", "tree")}
    tables.save_patient_tables(kept, "test_layout_", str(tmp_path))
    t = tables.load_patient_tables(spark, "test_layout_")
    assert set(t) == set(kept) and t["tree"].count() == kept["tree"].count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        episodes = registry.cohort.treatment_episodes(registry.cohort.stockpile(registry.cohort.collapse_fills(t["dispensing"])), 30)
        assert exchanges(episodes) == 0 and exchanges(registry.cohort.bridge_spans(t["enrollment"], 45)) == 0
        assert exchanges(registry.outcomes.first_outcome(registry.cohort.incident(t["dispensing"], 183), t["diagnosis"], 1, 365)) == 0
        assert exchanges(registry.first_outcomes(t)) == 1 < exchanges(registry.first_outcomes(kept))
        assert registry.first_outcomes(t).count() == 1330
        assert len(list((tmp_path / "dispensing").glob("*.parquet"))) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in kept:
            spark.sql(f"DROP TABLE test_layout_{name}")


def test_fills_are_dealt_into_shares_of_the_input(spark, duck, monkeypatch):
    """A task's part of a patient's fills follows PART_BYTES and not the input; results are the same."""
    lineitem = tables.read_tables(spark, SF, ("lineitem",))["lineitem"]
    assert tables.stored_bytes(lineitem) == os.path.getsize(f"{SF}/lineitem.parquet") and tables.stored_bytes(spark.range(3)) == 0
    monkeypatch.setattr(tables, "WHOLE_BYTES", 0)
    monkeypatch.setattr(tables, "PART_BYTES", tables.stored_bytes(lineitem) // 9)
    for name, found in (("treatment_episodes", registry._episodes), ("switching", registry._episodes), ("first_outcome", registry._starts)):
        assert found(registry.patients(spark, SF)).rdd.getNumPartitions() >= 9
        test_query_equals_sql(spark, duck, name)
    for name in ("truncate_at", "concomitant", "pregnancy_episodes", "request_rates"):
        test_query_equals_sql(spark, duck, name)


def test_scenarios_work_where_the_buckets_of_a_request_lie(spark, monkeypatch):
    """A scenario deals its index rows by patient and nothing else, and the shares of a request follow the input."""
    monkeypatch.setattr(scenario, "SHARE_BYTES", 1 << 14)
    codes = tables.code_list(spark, registry.CODES)
    t = registry.listed_patients(spark, SF, codes)
    assert {r.code[:7] for r in t["dispensing"].select("code").distinct().collect()} == {"Brand#1", "Brand#2"}
    shared = scenario.prepare(t, list(registry.SCENARIOS.values()), codes)
    assert shared.shares == -(-tables.stored_bytes(t["dispensing"]) // (1 << 14)) > 4
    assert not shared.fills.groupBy("patid", "code", "rxdate").count().where("count > 1").count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scenario.follow(shared, registry.SCENARIOS["all starts"])._jdf.queryExecution().executedPlan().toString()
        assert "ENSURE_REQUIREMENTS" not in plan and "hashpartitioning(patid#" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bridged_spans_meet_as_joined_ones(spark):
    enrolled = registry.patients(spark, SF)["enrollment"]
    a, b = (registry.cohort.bridge_spans(enrolled.where(f"day(enr_start) % 3 = {k}"), 20 * k) for k in (0, 1))
    rows = lambda df: sorted(map(tuple, df.select("patid", "span_start", "span_end").collect()))
    assert rows(registry.cohort.intersect_bridged(a, b, 3)) == rows(registry.cohort.intersect_spans(a, b)) != []
    assert rows(registry.cohort.intersect_bridged(a, a)) == rows(a)
    again = registry.cohort.bridge_spans(a.withColumnsRenamed({"span_start": "enr_start", "span_end": "enr_end"}), 90)
    assert rows(again) == rows(registry.cohort.bridge_spans(enrolled.where("day(enr_start) % 3 = 0"), 90))
