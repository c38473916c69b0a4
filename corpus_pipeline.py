"""Corpus cleaning in stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``; ``n_chars`` follows the text where a stage changes it.

All stages take empty tables, repeated rows, null or repeated ids, very long texts and
further columns of any name; what each does with them its docstring says. Null and empty
texts are rejected by the first stage; a stage called alone keeps them, but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.llm import decontaminate, langid, linededup, mixing, neardup
from cohortloom.llm.kit import shared_dir

#: No SQL: the stages hold a trained model, sketches and alignments. Tests compare with brute force.
ORACLE_SQL = None

#: A document goes if no language is at least this likely, or if it fits the likeliest less than this.
MIN_LANGUAGE_SCORE = 0.5
MIN_LANGUAGE_FIT = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter, a language that is likely enough, and words that this language has.

    The probability of a long text is near 1 in whatever language is nearest, so the share of its words that the
    model knows (with a margin for short texts) must reach MIN_LANGUAGE_FIT too: at sf0.1 all held-out texts of the
    four languages do, and 99 of 100 French texts do not if French is not learned. Rows are judged alone,
    so ids may be null or repeated. Null, empty and letterless texts go; without any labelled text all go.
    """
    found = langid.identify(docs, langid.fit(docs), names=("_language", "_likely", "_fit"))
    likely = (F.col("_likely") >= MIN_LANGUAGE_SCORE) & (F.col("_fit") >= MIN_LANGUAGE_FIT)
    return found.where((F.col("_language") != langid.UNKNOWN) & likely).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three of them share, but in the last one.

    All rows stay. Rows that share an id count as a document each; those with the largest id, null being the smallest,
    keep a shared line. Null and empty texts are one empty line and become empty texts.
    """
    found = linededup.dedup(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the one with the smallest id.

    Rows that share that id all stay; null counts as the smallest. Null and empty texts are near nothing and stay.
    """
    return neardup.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``.

    Rows are judged alone, so ids may be null or repeated. Null and empty texts hold nothing and stay, as all rows do if
    there are no items.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, copies and taken; those columns replace any of the same names.

    Rows of the same id, source and size, null or not, differ only in their copies: the more go to the lesser text (and n_chars),
    so each row comes out once and reruns agree. Null and empty texts have size 0 and go.
    """
    given = ["size", "source_size", "target", "copies", "taken"]
    key = ["doc_id", "source", "size"]
    kept = docs.drop(*given)
    texts = kept.select(*kept.columns, mixing.word_count(F.col("text")).alias("size"))
    texts = texts.withColumn("_nth", F.row_number().over(W.partitionBy(*key).orderBy("text", "n_chars")))
    mixed = mixing.mix(docs).where("copies > 0")
    mixed = mixed.withColumn("_nth", F.row_number().over(W.partitionBy(*key).orderBy(F.desc("copies"))))
    mixed = mixed.select(*(F.col(c).alias(f"_{c}") for c in key), F.col("_nth").alias("_which"), *given[1:])
    same = (F.col("_nth") == F.col("_which")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    return texts.join(mixed, same).select(*kept.columns, *given)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", remove_benchmark),
    ("source_mixing", mix_sources),
]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's table is deleted once the next is written; the last one's stays, as the result reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            _delete(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
