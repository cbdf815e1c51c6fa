"""Registered queries over files of JSON that a run has written, and the heads of a training set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordspan.operators import dataset, profile
from wordspan.plans.queries import SPLIT_SEED, chosen_models, merged, parts_as_models, table
from wordspan.sources import catalog, requests
from wordspan.sources.staging import new_path, staged

#: Conversations of a request log, and entries of a catalogue file.
A_LOG, A_FILE = 20, 500


def write_objects(rows, place: Column, path: str) -> None:
    """A file for each place, with the row's JSON object `value`."""
    rows.select("value", place.alias("place")).repartition("place").write.partitionBy("place").text(path)


def request_log_profile(spark, sf_dir):
    """Conversations as request logs, an object a file, and what each validator has sent, by validator."""
    said = table(spark, sf_dir, "conversations").select(F.floor(F.col("conv_id") / A_LOG).alias("log"), F.coalesce("text", F.lit("")).alias("text"))
    logs = said.groupBy("log").agg(F.collect_list("text").alias("texts"))
    stated = F.struct(F.lit("20260101").alias("timestamp"), (F.col("log") % 3).alias("validator_uid"), F.lit("key").alias("validator_hotkey"), F.lit("1").alias("version"), "texts")
    path = new_path(spark, "logs")
    write_objects(logs.select(F.to_json(stated).alias("value"), "log"), F.col("log"), path)
    rows = staged(requests.read(spark, f"{path}/*"))
    files = rows.groupBy("validator_uid").agg(F.count_if(F.col("i") == 0).alias("files"))
    return profile.stats(rows, "validator_uid").join(files, "validator_uid").orderBy("validator_uid")


def catalog_from_files(spark, sf_dir):
    """Models that may be used, of a catalogue read from its files."""
    made = parts_as_models(spark, sf_dir)
    entry = F.struct("id", "pricing", "supported_parameters", "architecture", "expiration_date")
    files = made.groupBy(F.floor(F.col("p_partkey") / A_FILE).alias("file")).agg(F.to_json(F.struct(F.collect_list(entry).alias("data"))).alias("value"))
    path = new_path(spark, "catalog")
    write_objects(files, F.col("file"), path)
    return chosen_models(catalog.read(spark, f"{path}/*"))


#: Rows of each split that a short training takes.
HEADS = {"train": 120, "validation": 10, "test": 25}


def training_heads(spark, sf_dir):
    """The first rows of every split of the shuffled windows."""
    placed = staged(dataset.split(dataset.shuffled(staged(merged(spark, sf_dir)), SPLIT_SEED, ["kind", "id", "copy"])))
    firsts = {r["split"]: r["first"] for r in placed.groupBy("split").agg(F.min("pos").alias("first")).collect()}
    parts = [dataset.head(placed.where(F.col("split") == name), firsts.get(name, 0) + n) for name, n in HEADS.items()]
    return dataset.merge(*parts).select("split", "pos", "kind", "id", "copy")


ALL = [request_log_profile, catalog_from_files, training_heads]
