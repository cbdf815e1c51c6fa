"""Splits by source, rejects, observed counters, and the stream of folders that stops."""

import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from wordspan.functions.labels import as_ints, parsed_ints
from wordspan.operators import align, dataset, observed, score, windows
from wordspan.sources import rejects
from wordspan.sources.staging import new_path


def test_split_by_source_leaks_nothing(spark):
    random.seed(5)
    rows = [(random.choice((None, "", *map(str, range(60)))), k % 2, i) for k in range(2) for i in range(500)] + [("hot", 0, i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc string, weight int, i int")
    placed = dataset.split_groups(df, 42, ["doc", "weight"])
    assert placed.columns == [*df.columns, "split"] and placed.count() == len(rows)
    assert placed.groupBy("doc", "weight").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    sizes = {r["split"]: r["count"] for r in placed.groupBy("split").count().collect()}
    largest = max(r["count"] for r in placed.groupBy("doc", "weight").count().collect())
    assert abs(sizes["train"] - 0.8 * len(rows)) <= largest and abs(sizes.get("validation", 0) - 0.05 * len(rows)) <= largest
    again = dataset.split_groups(df.repartition(5), 42, ["doc", "weight"])
    assert sorted(map(str, again.collect())) == sorted(map(str, placed.collect()))
    assert sorted(map(str, dataset.split_groups(df, 43, ["doc", "weight"]).collect())) != sorted(map(str, placed.collect()))
    assert dataset.split_groups(df.limit(0), 42, ["doc"]).count() == 0
    with pytest.raises(ValueError, match="sum"):
        dataset.split_groups(df, 42, ["doc"], 0.5, 0.1, 0.1)


def test_rejects_have_reasons(spark):
    rows = [(1, "a b", [0, 1], "m"), (None, "a b", [0, 1], "m"), (3, None, [0], "m"), (4, " \n", [0], "m"), (5, "a", [0], None), (6, "a", [0], " "), (7, "a", None, "m"), (8, "a", [], "m"), (9, "a b c", [0, 1], "m"), (10, "a b", [0, 2], "m"), (11, "a b", [None, 1], "m"), (1, "a b", [0, 1], "m")]
    df = spark.createDataFrame([(*r, "w", 3) for r in rows], "idx long, text string, labels array<int>, model string, words string, bad int")
    valid, bad = rejects.parted(df, new_path(spark, "parted"))
    assert valid.columns == df.columns and sorted(r["idx"] for r in valid.collect()) == [1, 1]
    assert valid.count() + bad.count() == df.count()
    got = {r["idx"]: (r["reason"], r["message"]) for r in bad.collect()}
    assert got == {None: ("no index", "idx is null"), 3: ("no text", "text is null"), 4: ("no text", "text is blank"), 5: ("no model", "model is null or blank"), 6: ("no model", "model is null or blank"), 7: ("no labels", "no label"), 8: ("no labels", "no label"), 9: ("misaligned", "3 words, 2 labels"), 10: ("bad labels", "1 labels, the first 2"), 11: ("bad labels", "1 labels, the first null")}
    none, nothing = rejects.parted(df.limit(0), new_path(spark, "parted"))
    assert none.count() == nothing.count() == 0


def test_tokenizing_refuses_what_does_not_align(spark):
    cut = lambda words: (list(range(len(words))), list(range(len(words))))
    df = spark.createDataFrame([(1, ["a", "b"], [0, 1]), (2, ["a"], [0, 1])], "id int, words array<string>, labels array<int>")
    assert align.tokenized(df.where("id = 1"), cut, 5, "id").first()["labels"] == [0, 1]
    with pytest.raises(Exception, match="id 2: 1 words, 2 labels"):
        align.tokenized(df, cut, 5, "id").collect()


def test_counters_come_with_the_write(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            made.add(len(f))
            yield f

    df = spark.createDataFrame([(i, ("generated", "skipped", "failed", "generated")[i % 4]) for i in range(103)], "id int, status string").mapInPandas(counted, "id int, status string")
    seen = observed.written(df, new_path(spark, "results"), observed.run_counts(), "status")
    assert seen == {"generated": 51, "skipped": 26, "failed": 26, "total": 103} and made.value == 103


def test_counters_of_a_stream(spark):
    base = new_path(spark, "counted")
    for k in range(3):
        spark.createDataFrame([(i, "generated" if i % 3 else "failed") for i in range(40 * k, 40 * k + 40)], "id int, status string").coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = observed.watched(spark.readStream.schema("id int, status string").option("maxFilesPerTrigger", 1).parquet(f"{base}/in"), "run", observed.run_counts())
    totals = observed.Totals("run")
    spark.streams.addListener(totals)
    try:
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
        until = time.time() + 20
        while totals.sums().get("total", 0) < 120 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(totals)
    assert len(totals.batches) == 3 and totals.sums() == {"generated": 80, "failed": 40, "total": 120}


def test_stream_stops_at_its_target(spark):
    base = new_path(spark, "folders")
    texts = spark.range(80).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" ")), 60).alias("text"), (F.col("id") % 8).alias("part"))
    texts.write.partitionBy("part").parquet(f"{base}/texts")
    run = lambda name, target, **how: windows.stream_to_target(spark, f"{base}/texts", f"{base}/{name}", 44, "doc_id", 1, target, "doc_id long, text string", **how)
    whole = sorted(map(str, run("whole", 100).collect()))
    assert len(whole) == 100
    used = {r["part"] for r in run("used", 100).select((F.col("doc_id") % 8).alias("part")).distinct().collect()}
    assert len(used) == 2  # of 80 windows a folder
    for part in set(range(8)) - used:  # what isn't needed isn't opened
        shutil.rmtree(f"{base.removeprefix('file:')}/texts/part={part}/")
        (open(f"{base.removeprefix('file:')}/texts/part={part}", "w")).close()
    assert [r for r in used] and run("all", 10_000).count() == 80 * len(used)
    with open(f"{base.removeprefix('file:')}/texts/part={min(used)}/broken.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="[Pp]arquet"):
        run("broken", 10_000).count()


def test_labels_of_any_kind(spark):
    r = spark.range(1).select(parsed_ints(F.lit("[0, 1.0, 2]")).alias("a"), parsed_ints(F.lit("no")).alias("b"), as_ints(F.array(F.lit(0.0), F.lit(0.5), F.lit(None).cast("double"))).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == ([0, 1, 2], None, [0, None, None])


def test_predictions_of_a_text(spark):
    df = spark.createDataFrame([(1, 0, "a", 0.9), (1, 1, "b", 0.5), (1, 2, "c", None), (1, 3, "d", 0.1), (2, 0, "x", None)], "id int, word_pos int, word string, p double")
    got = {(r["id"], r["word_pos"]): (r["named"], r["doc_p"], r["n_words"], r["n_skipped"], r["ai_pct"]) for r in score.predictions(df, "id").collect()}
    assert got[(1, 1)] == ("ai", pytest.approx(0.5), 4, 1, pytest.approx(200 / 3)) and got[(1, 2)][0] == "—" and got[(1, 3)][0] == "human"
    assert got[(2, 0)] == ("—", None, 1, 1, 0.0)
