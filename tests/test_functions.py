"""Small cases with known answers, and folds against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wordspan.functions import labels as L
from wordspan.functions import text as T
from wordspan.functions.probability import hard_label, named_label, render
from wordspan.operators import align, dataset, generate, metrics, score, splits, windows
from wordspan.sources import catalog, chunks, corpus, requests

TEXTS = ["", "   ", "a", "a b　c d\u0085e\x1cf\x0bg", "zero​width stays", "Pi is 3.14. Ok? Yes", "one two.  three!\nfour"]


def test_words_are_those_of_split(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", T.tokens(F.col("t")).alias("w"), T.word_count(F.col("t")).alias("n"), T.is_blank(F.col("t")).alias("b")).collect()
    for r in rows:
        assert r["w"] == r["t"].split() and r["n"] == len(r["w"]) and r["b"] == (not r["w"])
    assert spark.range(1).select(T.word_count(F.lit(None).cast("string")).alias("n")).first()["n"] == 0


def test_sentences(spark):
    got = {r["t"]: r["s"] for r in spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", T.sentences(F.col("t")).alias("s")).collect()}
    for t, s in got.items():
        want = [x for x in re.findall(r"[^.!?]*[.!?]+|[^.!?]+$", t.strip(), re.S) if x.strip()]
        assert s == (want or ([t.strip()] if t.strip() else []))


@pytest.mark.parametrize(("labels", "bounds", "mode"), [([0], [], "unknown"), ([0, 0], [], "unknown"), ([0, 1], [0], "append"), ([0, 1, 0], [0, 1], "sandwich"), ([1, 0, 1], [0, 1], "append"), ([], [], "unknown")])
def test_labels(spark, labels, bounds, mode):
    words = [f"w{i}" for i in range(len(labels))]
    r = spark.createDataFrame([(words, labels)], "w array<string>, l array<int>").select(L.boundaries(F.col("l")).alias("b"), L.mode(F.col("l")).alias("m"), L.is_valid(F.col("w"), F.col("l")).alias("v"), L.segments(F.col("w"), F.col("l")).alias("s")).first()
    assert (r["b"], r["m"], r["v"]) == (bounds, mode, True)
    assert len(r["s"]["human_start"]) + len(r["s"]["generated"]) + len(r["s"]["human_end"]) == len(words)


def test_alignment_and_padding(spark):
    r = spark.createDataFrame([([0, 1, 1], [None, 0, 0, 1, 2, 2, 9, None])], "l array<int>, w array<int>").select(L.align(F.col("l"), F.col("w")).alias("a"), L.pad(F.col("l"), F.lit(5), -1).alias("p")).first()
    assert r["a"] == [-100, 0, -100, 1, 1, -100, -100, -100] and r["p"] == [0, 1, 1, -1, -1]


def two_way(lens):
    k = max(1, len(lens) // 2)
    for _ in range(10):
        head, tail = sum(lens[:k]), sum(lens[k:])
        if k <= 1 or k >= len(lens) - 1:
            break
        step = -1 if head > tail else 1 if head + lens[k] < tail - lens[k] else 0
        k += step
        if not step:
            break
    return k


def test_two_way_cut_by_brute_force(spark):
    random.seed(3)
    cases = [[random.randint(1, 40) for _ in range(random.randint(2, 25))] for _ in range(200)]
    rows = spark.createDataFrame([(c,) for c in cases], "c array<int>").select("c", splits.two_way_cut(F.col("c")).alias("k")).collect()
    assert all(r["k"] == two_way(r["c"]) for r in rows)


def test_windows_keep_their_rules(spark):
    random.seed(4)
    rows = [(i, " ".join(f"w{j}" for j in range(n)), [random.randint(0, 1) for _ in range(n)]) for i, n in enumerate([2, 34, 35, 36, 60, 351, 900])]
    rows += [(90, "a b c", [0, 1]), (91, "x " * 60, [0] * 60)]
    df = spark.createDataFrame(rows, "id long, text string, label array<int>")
    got = windows.boundary_windows(df, 1, "id", copies=5).collect()
    texts = {r[0]: r[1].split() for r in rows}
    assert {r["id"] for r in got} == {2, 3, 4, 5, 6}
    for r in got:
        assert 35 <= r["e"] - r["s"] <= 350 and r["text"].split() == texts[r["id"]][r["s"] : r["e"]] and {0, 1} == set(r["label"])
    assert len({(r["id"], r["s"], r["e"]) for r in got}) == len(got)
    audit = dataset.audit(spark.createDataFrame(got))
    dataset.check(audit)
    one = windows.one_class_windows(df, 1, "id", 0, copies=3).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in one} == {2: 3, 3: 3, 4: 3, 5: 3, 6: 3, 91: 3}


def test_metrics(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.2, 0), (None, 1)], "p double, y int")
    r = metrics.reward(df).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (2, 0, 1, 1)
    assert r["ap"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    none = metrics.reward(df.limit(0)).first()
    assert (none["f1"], none["ap"], none["reward"]) == (0.0, 0.0, 0.0)
    x = df.select(hard_label(F.col("p")).alias("h"), named_label(F.col("p")).alias("n")).collect()
    assert [tuple(v) for v in x[:2]] == [(0, "ai"), (0, "ai")] and x[4]["n"] == "—"
    assert spark.range(1).select(render(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(F.lit(0.9), F.lit(0.1), F.lit(None).cast("double"))).alias("t")).first()["t"] == "[a*] b (c?)"
    rates = metrics.rates(df).first()
    assert (rates["scored"], rates["skipped"]) == (4, 1)


def test_split_is_exact_and_reproducible(spark):
    df = spark.range(101).select(F.col("id"))
    placed = dataset.split(dataset.shuffled(df, 42, ["id"]))
    assert {r["split"]: r["count"] for r in placed.groupBy("split").count().collect()} == {"train": 80, "validation": 5, "test": 16}
    assert sorted(r["pos"] for r in placed.collect()) == list(range(101))
    assert placed.orderBy("pos").collect() == dataset.split(dataset.shuffled(df.repartition(3), 42, ["id"])).orderBy("pos").collect()
    with pytest.raises(ValueError):
        dataset.split(placed, 0.5, 0.1, 0.1)
    assert dataset.head(placed, 7).count() == 7


def test_corpus_bounds(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, "  "), (4, "d e f g")], "doc_id long, text string")
    assert [(r["doc_id"], r["idx"]) for r in corpus.indexed(df, "doc_id").orderBy("idx").collect()] == [(1, 0), (4, 1)]
    for bad in ((-1, None), (3, 3)):
        with pytest.raises(ValueError):
            corpus.index_range(df, "doc_id", *bad)
    assert corpus.indexed(df.limit(0), "doc_id").count() == 0


def test_chunks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("train", f"a{i} b", [0, 1] if i % 2 else [0], "m", i, 3, None) for i in range(25)], f"split string, {chunks.SCHEMA}")
    chunks.write(df, str(tmp_path / "c"), 10)
    back = chunks.read(spark, str(tmp_path / "c"), ["train"])
    assert back.count() == 25 and chunks.validated(back, "append").count() == 12
    man = chunks.manifest(back, "split", "chunk_id")
    assert [(r["lo"], r["hi"]) for r in chunks.overlapping(man, 12, 20).collect()] == [(10, 19)]
    assert [r["split"] for r in chunks.splits_of(back).collect()] == ["train"]
    with pytest.raises(ValueError):
        chunks.chunk_of(F.lit(1), 0)


def test_sources_from_json(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"timestamp": "x", "validator_uid": 3, "texts": ["a b", "c"]}')
    assert [(r["validator_uid"], r["file"], r["i"], r["wc"]) for r in requests.read(spark, str(tmp_path / "log")).orderBy("i").collect()] == [(3, "a.json", 0, 2), (3, "a.json", 1, 1)]
    (tmp_path / "cat.json").write_text('{"data": [{"id": "m", "pricing": {"prompt": "0", "completion": "0"}, "supported_parameters": ["max_tokens"], "architecture": {"input_modalities": ["text"], "output_modalities": ["text"]}}, {"id": "~m"}]}')
    rows = catalog.read(spark, str(tmp_path / "cat.json")).where(catalog.is_chat_model()).where(catalog.is_affordable(free_only=True)).collect()
    assert [r["id"] for r in rows] == ["m"]
    assert [r["id"] for r in catalog.listed(spark, "a, ,b").collect()] == ["a", "b"]


def test_small_helpers(spark):
    one = spark.range(1)
    r = one.select(T.chunk_range(F.lit("train_10_20.pt")).alias("a"), T.chunk_range(F.lit("train_x.pt")).alias("b"), T.number_or_infinite(F.lit("n/a")).alias("c"), T.setting(F.lit("5 # five")).alias("d"), T.preview(F.lit("a\nb"), 2).alias("e")).first()
    assert (r["a"]["lo"], r["a"]["hi"], r["b"], r["c"], r["d"], r["e"]) == (10, 20, None, float("inf"), "5", "a ...")


def test_generation_retries(spark):
    calls = []

    def generator(prompt, budget, model):
        calls.append(model)
        if len(calls) < 3:
            raise RuntimeError("busy")
        return " done "

    assert generate.attempt(generator, "p", 64, ["a", "b"]) == ("done", "a", "generated", 3)

    def never(prompt, budget, model):
        raise generate.Permanent

    assert generate.attempt(never, "p", 64, ["a"])[2] == "skipped"
    df = spark.createDataFrame([(1, "p", 64)], "id long, prompt string, max_tokens int")
    r = generate.generated(df, lambda: lambda p, b, m: p + m, ["x"]).first()
    assert (r["answer"], r["status"], r["attempts"]) == ("px", "generated", 1)


def test_injected_tokenizer_and_scorer(spark):
    df = spark.createDataFrame([(1, ["ab", "c"], [0, 1])], "id long, words array<string>, labels array<int>")
    rows = align.tokenized(df, lambda w: ([1] + [7] * 3 + [2], [None, 0, 0, 1, None]), 4, "id")
    assert rows.first()["labels"] == [-100, 0, -100, 1]
    got = score.scored_words(df, lambda: lambda batch: [[0.1] * len(w) for w in batch], "id").collect()
    assert [(r["word"], r["y"], r["p"]) for r in got] == [("ab", 0, 0.1), ("c", 1, 0.1)]


def three_way(lens):
    n = len(lens)
    a, b = n // 3, 2 * n // 3
    for _ in range(10):
        x, y, z = sum(lens[:a]), sum(lens[a:b]), sum(lens[b:])
        if a <= 1 or b <= a + 1 or b >= n - 1:
            break
        if x - y > 2 * lens[a - 1]:
            a -= 1
        elif y - z > 2 * lens[b - 1]:
            b -= 1
        elif y - x > 2 * lens[a]:
            a += 1
        elif z - y > 2 * lens[b]:
            b += 1
        else:
            break
    return a, b


def test_three_way_cut_by_brute_force(spark):
    random.seed(8)
    cases = [[random.randint(1, 40) for _ in range(random.randint(3, 25))] for _ in range(200)]
    rows = spark.createDataFrame([(c,) for c in cases], "c array<int>").select("c", splits.three_way_cut(F.col("c")).alias("k")).collect()
    assert all((r["k"]["a"], r["k"]["b"]) == three_way(r["c"]) for r in rows)


def test_sums_of_blocks(spark):
    lengths = [random.Random(2).randint(1, 9) for _ in range(200)]
    df = spark.createDataFrame([(lengths,)], "v array<int>").withColumn("s", T.block_starts(F.col("v")))
    got = df.select(F.transform(F.sequence(F.lit(0), F.lit(200)), lambda k: T.sum_before(F.col("v"), F.col("s"), k)).alias("x")).first()["x"]
    assert got == [sum(lengths[:k]) for k in range(201)]


def test_first_words(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    for n in (1, 2, 5):
        for r in df.select("t", T.first_words(F.coalesce("t", F.lit("")), n).alias("w"), T.has_words(F.col("t"), n).alias("h")).collect():
            words = (r["t"] or "").split()
            assert (r["w"], r["h"]) == (words[:n], len(words) >= n)


def test_buckets_of_far_ids_and_own_columns(spark):
    df = spark.createDataFrame([(i, "a b c", 1, 2) for i in [*range(50), 1 << 60]], "doc_id long, text string, _bucket int, _n int")
    got = corpus.indexed(df, "doc_id", buckets=5)
    assert {"_bucket", "_n"} <= set(got.columns) and [r["idx"] for r in got.orderBy("doc_id").collect()] == list(range(51))
    sizes = df.groupBy(corpus.key_bucket(df, "doc_id", 5).alias("b")).count().collect()
    assert max(r["count"] for r in sizes) <= 15
