"""Running sums by segments, cooldowns of a hot model, average precision of distinct scores, openings that texts share."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wordspan.functions.names import free
from wordspan.operators import metrics
from wordspan.operators.scan import running
from wordspan.sources import corpus
from wordspan.sources.staging import staged
from wordspan.streaming import cooldown


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_free_names():
    assert free(["A", "_b", "b"], "a", "b", "c", "c") == ["_a", "__b", "c", "_c"]


@pytest.mark.parametrize("by", [["g"], ["g", "h"], []])
def test_running_as_one_window(spark, by):
    random.seed(6)
    rows = [(random.choice(("hot", "hot", "hot", "a", None)), random.randrange(2), i, random.randrange(50), random.choice((None, 1, 2, 5))) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, h int, id int, t int, x int").withColumns({"segment": F.lit("mine"), "value_0": F.lit(7), "of_g": F.lit(1)})
    got = running(df, by, ["t", "id"], F.floor(F.col("t") / 4).cast("int"), {"s": F.col("x")}, {"m": F.col("x"), "last": F.when(F.col("x") == 5, F.struct("t", "id"))})
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))).orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"s": F.coalesce(F.sum("x").over(w), F.lit(0)), "m": F.max("x").over(w), "last": F.max(F.when(F.col("x") == 5, F.struct("t", "id"))).over(w)})
    assert got.columns == want.columns and rows_of(got, got.columns) == rows_of(want, want.columns)
    assert running(df.limit(0), by, ["t"], F.lit(0), {"s": F.col("x")}).count() == 0


def partitions(df, order, most):
    """The largest segment that a window sorts, from the rows themselves."""
    bucket = corpus.key_bucket(df, order, most)
    return df.groupBy("model", bucket.alias("b")).count().agg(F.max("count")).first()[0]


def slow_cooldowns(events):
    out, state = {}, {}
    for at, event, model, kind, wait in sorted(events):
        s = state.setdefault(model, {"strikes": 0, "until": None, "permanent": False})
        if kind == "rate":
            s["strikes"] += 1
            often = s["strikes"] >= 3
            ends = at + (min(300.0, 30.0 * s["strikes"]) if often else wait)
            s["permanent"] = s["permanent"] and not often
        else:
            ends = at + 30 if kind == "content" else None
            s["permanent"] = s["permanent"] or kind in ("quota", "retry")
        s["until"] = ends if s["until"] is None else s["until"] if ends is None else max(s["until"], ends)
        out[event] = (s["strikes"], s["until"], s["permanent"], s["permanent"] or (s["until"] is not None and at < s["until"]))
    return out


def test_cooldowns_of_a_hot_model(spark):
    random.seed(8)
    events = [(float(random.randrange(3000)), i, random.choice((1, 1, 1, 2, None)), random.choice(("rate", "rate", "content", "quota", "retry", "other")), random.choice((5.0, 11.0))) for i in range(3000)]
    df = spark.createDataFrame([(*e, "x", 1) for e in events], "at double, event int, model int, kind string, wait double, block string, pardon int").cache()
    want = slow_cooldowns([e for e in events if e[2] is not None]) | slow_cooldowns([(a, i, 0, k, w) for a, i, m, k, w in events if m is None])
    for segments in (1, 16):
        got = cooldown.cooldowns(df, ["at", "event"], segments)
        assert got.columns[:7] == df.columns
        assert {r["event"]: (r["strikes"], r["until"], r["permanent"], r["blocked"]) for r in got.collect()} == want
    hot = sum(m == 1 for _, _, m, _, _ in events)
    assert partitions(df, "at", 16) < hot / 8
    assert cooldown.cooldowns(df.limit(0), ["at", "event"]).count() == 0


def test_average_precision_of_distinct_scores(spark):
    random.seed(3)
    rows = [(i % 3 if i % 3 < 2 else None, random.random(), int(random.random() < 0.3)) for i in range(3000)] + [(7, 0.1 * k, 0) for k in range(9)] + [(1, None, 1)]
    df = spark.createDataFrame(rows, "g int, p double, y int")
    for segments in (1, 20):
        got = {r["g"]: r["ap"] for r in metrics.average_precision(df, "g", segments=segments).collect()}
        for g in (0, 1, None, 7):
            own = sorted(((p, y) for k, p, y in rows if k == g and p is not None), reverse=True)
            positives, tp, ap = sum(y for _, y in own), 0, 0.0
            for n, (_, y) in enumerate(own, 1):
                tp += y
                ap += y * tp / n
            assert got[g] == pytest.approx(ap / positives if positives else 0.0)
    (all_one,) = metrics.average_precision(df.where("g = 0").drop("g")).collect()
    assert all_one["ap"] == pytest.approx(got[0])


def test_openings_that_texts_share(spark):
    random.seed(2)
    shared = [f"w{k}" for k in range(25)]
    texts = {i: [*shared, str(i)] if i % 2 else [random.choice("abc") for _ in range(random.randint(1, 6))] for i in range(0, 900)}
    probes = [(k, texts[min(899, max(0, hint))] if k % 3 else shared[:5], hint) for k, hint in enumerate(random.choices(range(-60, 960), k=200))] + [(500, [], 3), (501, None, 3), (502, shared, 40), (503, shared, 40), (504, ["none"], 40)]
    source = spark.createDataFrame([(i, w) for i, w in texts.items()], "idx long, words array<string>")
    given = spark.createDataFrame(probes, "probe_id int, words array<string>, hint int")
    for radius in (0, 7, 50):
        want = {}
        for k, words, hint in probes:
            first = (words or [])[:20]
            found = [i for i, w in texts.items() if first and w[: len(first)] == first and abs(i - hint) <= radius]
            if found:
                want[k] = min(found)
        assert {r["probe_id"]: r["idx"] for r in corpus.by_prefix(given, source, 20, radius).collect()} == want


def test_an_opening_of_all_texts_makes_no_pairs(spark):
    """20,000 texts and as many probes with one opening: what comes out of joins and windows follows the rows."""
    source = staged(spark.range(20_000).select(F.col("id").alias("idx"), F.split(F.lit("one opening of all texts"), " ").alias("words")))
    probes = source.select(F.col("idx").alias("probe_id"), "words", F.col("idx").alias("hint"))
    met = corpus.by_prefix(probes, source, 20, 2000)
    assert met.where(F.col("idx") != F.greatest(F.lit(0), F.col("probe_id") - 2000)).count() == 0 and met.count() == 20_000
    plan = met._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
