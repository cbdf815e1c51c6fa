"""Scores of word predictions (columns p, a probability or null, and y, 0 or 1), for each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordspan.functions.labels import IGNORED
from wordspan.functions.probability import hard_label
from wordspan.operators.scan import running
from wordspan.sources.corpus import key_bucket
from wordspan.sources.staging import staged


def confusion(scored: DataFrame, *by: str) -> DataFrame:
    """tn, fp, fn, tp, f1 (0 without positives) of rounded probabilities; words without one don't count."""
    h = hard_label(F.col("p"))
    cells = {n: F.count_if((F.col("y") == y) & (h == x)) for n, y, x in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))}
    out = scored.where("p is not null").groupBy(*by).agg(*(c.alias(n) for n, c in cells.items()))
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)))


def average_precision(scored: DataFrame, *by: str, segments: int | None = None) -> DataFrame:
    """ap: the sum over distinct scores, from the highest, of the gain in recall times precision; 0 without positives.

    Rows are first counted by score. The scores are run over in ranges, `segments` of them, so that a group whose scores
    all differ is the work of many tasks.
    """
    steps = staged(scored.where("p is not null").groupBy(*by, "p").agg(F.sum("y").cast("long").alias("pos"), F.count("*").alias("m")))
    width = segments or int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ran = running(steps, list(by), [F.desc("p")], -key_bucket(steps, "p", width), sums={"tp": F.col("pos"), "n": F.col("m")})
    gain = F.sum(F.try_divide(F.col("pos") * F.col("tp"), F.col("n")))
    return ran.groupBy(*by).agg(F.coalesce(F.try_divide(gain, F.sum("pos")), F.lit(0.0)).alias("ap"))


def reward(scored: DataFrame, *by: str) -> DataFrame:
    """The confusion counts, f1, ap, fp_score (1 - false positives a word) and reward, the mean of the three scores."""
    both = confusion(scored, *by).join(average_precision(scored, *by), list(by)) if by else confusion(scored).crossJoin(F.broadcast(average_precision(scored)))
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    out = both.withColumn("fp_score", F.coalesce(1 - F.try_divide(F.col("fp"), n), F.lit(0.0)))
    return out.withColumn("reward", F.when(n == 0, 0.0).otherwise((F.col("fp_score") + F.col("f1") + F.col("ap")) / 3))


def rates(scored: DataFrame, *by: str) -> DataFrame:
    """label_rate, predicted_rate (from 0.5 on), scored and skipped words, skipped_pct, accuracy of rounded labels."""
    hit = (hard_label(F.col("p")) == F.col("y")).cast("int")
    counts = [F.avg("y").alias("label_rate"), F.avg((F.col("p") >= 0.5).cast("int")).alias("predicted_rate"), F.count("p").alias("scored"), F.count_if(F.col("p").isNull()).alias("skipped"), F.avg(hit).alias("accuracy")]
    out = scored.groupBy(*by).agg(*counts)
    return out.withColumn("skipped_pct", 100.0 * F.col("skipped") / F.greatest(F.col("scored") + F.col("skipped"), F.lit(1)))


def token_metrics(tokens: DataFrame, *by: str, ignored: int = IGNORED) -> DataFrame:
    """kept, accuracy, f1, label_rate and predicted_rate of tokens (label, prediction) whose label isn't ignored.

    Without such tokens all are 0.
    """
    kept, hit = F.col("label") != ignored, F.col("label") == F.col("prediction")
    counts = {"kept": kept, "hits": kept & hit, "tp": kept & hit & (F.col("label") == 1), "positives": kept & (F.col("label") == 1), "predicted": kept & (F.col("prediction") == 1)}
    out = tokens.groupBy(*by).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return out.select(*by, "kept", share(F.col("hits"), F.col("kept")).alias("accuracy"), share(2 * F.col("tp"), F.col("positives") + F.col("predicted")).alias("f1"), share(F.col("positives"), F.col("kept")).alias("label_rate"), share(F.col("predicted"), F.col("kept")).alias("predicted_rate"))


def run_counters(results: DataFrame, *by: str) -> DataFrame:
    """generated, skipped, failed and total entries by status, and the share that is done, in percent."""
    names = ("generated", "skipped", "failed")
    out = results.groupBy(*by).agg(*(F.count_if(F.col("status") == n).alias(n) for n in names), F.count("*").alias("total"))
    return out.withColumn("done_pct", 100.0 * (F.col("generated") + F.col("skipped") + F.col("failed")) / F.col("total"))
