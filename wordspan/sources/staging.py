"""Tables written once and read back, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder in local mode only, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="wordspan-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The rows, written once: what is costly is not worked out again, and a lost executor costs nothing."""
    path = new_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
