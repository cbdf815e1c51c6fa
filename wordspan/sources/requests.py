"""Request logs: one JSON object a file, with the texts that a validator sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.functions.text import word_count

SCHEMA = "timestamp string, validator_uid long, validator_hotkey string, version string, texts array<string>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """validator_uid, file, i, text and wc, a row for each text."""
    logs = spark.read.schema(SCHEMA).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_name"))
    return logs.select("validator_uid", "file", F.posexplode("texts").alias("i", "text")).withColumn("wc", word_count(F.col("text")))
