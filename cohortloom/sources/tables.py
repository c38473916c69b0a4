"""Reading source tables, mapping them to the patient model, code lists, and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shared import parts

#: The declared columns of the tables that the cohort queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

#: Bytes of lineitem's files from which fills are dealt into shares, and those of a share (some 300,000 fills).
WHOLE_BYTES, PART_BYTES = 1 << 26, 1 << 22


def read_tables(spark: SparkSession, directory: str, names=tuple(SCHEMAS)) -> dict[str, DataFrame]:
    """Tables by name; a column that is missing or has another type than declared is an error. Further columns are dropped."""
    found = {}
    for name in names:
        table = spark.read.parquet(f"{directory}/{name}.parquet")
        have = {f.name: f.dataType for f in table.schema}
        wanted = T.StructType.fromDDL(SCHEMAS[name])
        wrong = [f.name for f in wanted if have.get(f.name) != f.dataType]
        if wrong:
            raise ValueError(f"{name}: missing or of another type: {', '.join(wrong)}")
        found[name] = table.select(*wanted.names)
    return found


def stored_bytes(table: DataFrame) -> int:
    """Bytes of the files that table is read from; 0 if it is read from none."""
    jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in table.inputFiles()]
    return sum(f.getFileSystem(conf).getFileStatus(f).getLen() for f in files)


def to_patient_tables(tables: dict[str, DataFrame], code: str = "p_brand") -> dict[str, DataFrame]:
    """The patient model from order data; code: the part column that a fill's code is.

    From WHOLE_BYTES of lineitem on, fills are dealt by patient into shares of PART_BYTES of it, and before that by order. Left to itself,
    Spark merges its shuffle partitions until there is about one a core, so that a task's sorts and tables grow with the input.
    Whatever groups or windows fills by patient runs in these shares without another exchange.
    """
    orders = tables["orders"].withColumn("day", F.to_date("o_orderdate"))
    held = stored_bytes(tables["lineitem"])
    shares = max(parts(orders.sparkSession), -(-held // PART_BYTES))

    def dealt(rows, key):
        return rows.repartition(shares, key) if held >= WHOLE_BYTES else rows

    placed = orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = tables["lineitem"].join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    coded = tables["lineitem"].join(tables["part"].select("p_partkey", code), F.col("l_partkey") == F.col("p_partkey"))
    fills = dealt(coded, "l_orderkey").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    places = tables["nation"].join(tables["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    people = tables["customer"].join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    patid = F.col("o_custkey").alias("patid")
    seen = [patid, F.col("o_orderkey").alias("encounterid"), F.col("day").alias("adate"), F.col("o_orderstatus").alias("enctype")]
    last_order = orders.groupBy("o_custkey").agg(F.max("day").alias("death_date"))
    return {
        "demographic": people.select(F.col("c_custkey").alias("patid"), F.expr("date_add(date'1930-01-01', cast(c_custkey * 37 % 18000 as int))").alias("birth_date"), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("sex"), F.col("r_name").alias("site"), F.col("c_mktsegment").alias("segment")),
        "enrollment": orders.select(patid, F.col("day").alias("enr_start"), F.date_add("day", 179).alias("enr_end"), F.lit(True).alias("medcov"), (F.col("o_orderstatus") != "P").alias("drugcov")),
        "dispensing": dealt(fills.select(patid, F.to_date("l_shipdate").alias("rxdate"), F.col(code).alias("code"), F.col("l_quantity").cast("int").alias("rxsup")), "patid"),
        "drugs": tables["part"].select(F.col(code).alias("code")),
        "encounter": orders.select(*seen),
        "diagnosis": orders.select(*seen, F.col("o_orderpriority").alias("dx"), F.when(F.col("o_orderstatus") == "F", "P").otherwise("S").alias("pdx")),
        "procedure": lines.select(patid, F.to_date("l_shipdate").alias("adate"), F.col("l_orderkey").alias("encounterid"), F.col("o_orderstatus").alias("enctype"), F.col("l_returnflag").alias("px")),
        "death": tables["customer"].where("c_acctbal < 0").join(last_order, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_custkey").alias("patid"), "death_date"),
        "tree": places.select(F.col("r_name").alias("parent"), F.col("n_name").alias("child")),
    } | ({"records": tables["events"].select(F.col("user_id").alias("patid"), F.to_date("ts").alias("adate"), F.col("event_type").alias("code"))} if "events" in tables else {})


def code_list(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The code list of a request: (grp, pattern, match) or with enctype and pdx; match: exact or like."""
    full = [(*r, None, None)[:5] for r in rows]
    if wrong := [r for r in full if r[2] not in ("exact", "like")]:
        raise ValueError(f"match must be exact or like: {wrong}")
    return spark.createDataFrame(full, "grp string, pattern string, match string, enctype string, pdx string")


def write_result(result: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Write a result table as Parquet, partitioned by the given columns."""
    writer = result.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def save_patient_tables(tables: dict[str, DataFrame], prefix: str, directory: str, buckets: int | None = None, dealt: bool = False) -> None:
    """Tables of the patient model as Parquet tables ``<prefix><name>`` under directory, bucketed by patient where they have one.

    dealt: tables lie by patient in that many partitions already and are not dealt again.

    Rows are dealt to buckets once, a task a bucket, so a bucket is one sorted file. Whatever groups, joins or
    windows by patient afterwards reads its buckets where they lie, without an exchange, if all tables have as many.
    """
    for name, table in tables.items():
        n = buckets or parts(table.sparkSession)
        rows = table.repartition(n, "patid") if "patid" in table.columns and not dealt else table
        writer = rows.write.mode("overwrite").format("parquet").option("path", f"{directory}/{name}")
        if "patid" in table.columns:
            writer = writer.bucketBy(n, "patid").sortBy("patid")
        writer.saveAsTable(f"{prefix}{name}")


def load_patient_tables(spark: SparkSession, prefix: str) -> dict[str, DataFrame]:
    """What ``save_patient_tables`` saved under this prefix, by name."""
    return {t.name.removeprefix(prefix): spark.table(t.name) for t in spark.catalog.listTables() if t.name.startswith(prefix)}
