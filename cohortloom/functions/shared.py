"""The folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where that is unset and all runs on one machine.

    On a cluster without the setting this is an error, as executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there: it is computed once and a lost executor costs little."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
