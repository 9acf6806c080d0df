"""Cutting a plan's lineage through the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> None:
    """Sets the checkpoint folder to spark.checkpoint.dir; where that is unset and the session runs on one machine, to a folder of our own."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="kinspan-"))


def cut(df: DataFrame) -> DataFrame:
    """df, computed and written to the checkpoint folder."""
    prepare(df.sparkSession)
    return df.checkpoint()
