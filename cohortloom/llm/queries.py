"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, langid, licenses, linededup, mixing, neardup, quality, repetition, secrets, substrings, toxicity, vectorcodes
from .sql import ORACLE_SQL  # noqa: F401  what the entry point reads


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(parts: int):
    """A document's fold; a null id has none, so it is neither learned from nor held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


def _held_out(parts: int, fold: int):
    return F.coalesce(_fold(parts) == fold, F.lit(False))


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(_fold(5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic, n = labels.agg(F.count_if(F.col("toxic") == 1), F.count("*")).first()
    model = toxicity.fit(docs.where(_fold(5) != 0), labels.where("toxic = 1"), (toxic + 1) / (n + 2))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op2_secrets(spark, sf_dir):
    # a document stands for a repository and its source for the owner: the table has no nearer columns
    spans = F.coalesce("spans", F.array().cast("array<struct<start:long,kind:int,end:long,wider:boolean,h:long,n_owners:long,n_repos:long,live:boolean>>"))
    found = secrets.scan(table(spark, sf_dir, "documents"), repo_col="doc_id", owner_col="source").select("doc_id", spans.alias("spans"))
    base = F.filter("spans", lambda x: ~x["wider"])
    named = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", secrets.kind_name(x["kind"]), x["start"], x["end"])), ",")
    ownership = lambda x: F.concat_ws(":", x["n_owners"], x["n_repos"], F.when(x["live"], "live").otherwise("copied"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(("assign", "access", "hex"))), F.sha2(named(base), 256).alias("base_sha256"), named("spans").alias("spans"), F.array_join(F.transform("spans", ownership), ",").alias("ownership"), F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_repetition(spark, sf_dir):
    found = repetition.rules(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~F.col("repetitive")).drop("repetitive", "longest_repeat")


def op6_substrings(spark, sf_dir):
    return substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


def op7_licenses(spark, sf_dir):
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(_fold(4) != 2))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op9_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2)


def op10_lines(spark, sf_dir):
    return linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op11_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where((_fold(4) != 2) & (F.col("quality") == 1))
    scored = quality.score(docs, quality.fit(docs, trusted))
    return scored.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op12_vector_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    books = vectorcodes.train(vectors)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = vectorcodes.with_label_error(vectorcodes.encode(vectors, books))
    code = F.array_join(F.transform("codes", lambda k: F.lower(F.lpad(F.hex(k), 2, "0"))), "")
    return coded.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_conversations(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    found = conversations.repair(conversations.damage(given))
    hashes = conversations.digests(found.messages)
    out = given.select("conv_id").distinct()
    for other in (found.conversations, hashes):
        other = other.withColumnRenamed("conv_id", "_conv_id")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = F.sha2(F.lit(""), 256)
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_decontaminate": op3_decontaminate,
    "op4_mixing": op4_mixing,
    "op5_repetition": op5_repetition,
    "op6_substrings": op6_substrings,
    "op7_licenses": op7_licenses,
    "op8_language": op8_language,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_lines": op10_lines,
    "op11_quality": op11_quality,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversations": op13_conversations,
}

