"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; with a local master a local folder may take its place."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = shared_dir.own = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="tidepanel-")
    return found.rstrip("/")


def keep(df: DataFrame, what: str) -> DataFrame:
    """Write a table that several passes read, and read it back: scans prune its columns, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidepanel-{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
