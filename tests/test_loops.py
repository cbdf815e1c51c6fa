"""Generation under cooldowns, chunks committed by a stream, and planned reads, with failures in between."""

import itertools
import json
import random
import shutil
import uuid
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from wordspan.functions import errors
from wordspan.functions.failures import Failed, backoff, verdict
from wordspan.operators import generate
from wordspan.operators.entries import Entry, Lane, Model
from wordspan.plans import loops
from wordspan.plans.loops import MODELS, rolling
from wordspan.plans.loops_sql import SQL
from wordspan.sources import chunks, commits, planned
from wordspan.sources.staging import new_path
from wordspan.streaming import generation

NOW = 1_700_000_000.0


def cases():
    kinds = ("rate", "status", "value", "json", "timeout", "runtime", "server", "not_found", "connection", "other")
    texts = (None, "", "model x Returned Empty content", "maximum context", "All models unavailable", "7 words; need at least 30", "provider returned error", "Daily limit", "please RETRY SHORTLY")
    bodies = [None, "no json", "[]", "{}", '{"error": null}', '{"error": "text"}', '{"error": {"message": ""}}', '{"error": {"message": "daily LIMIT reached"}}', '{"error": {"message": "Temporarily rate-limited"}}']
    for value in ("7", '"2.5"', '"soon"', "120", "null", "1e1"):
        bodies.append('{"error": {"metadata": {"retry_after_seconds": %s}}}' % value)
    bodies.append('{"error": {"metadata": {"retry_after_seconds_raw": 3, "retry_after_seconds": null}}}')
    for left, late in (("0", 7200), ("0", 60), ("1", 7200)):
        bodies.append(json.dumps({"error": {"metadata": {"headers": {"X-RateLimit-Remaining": left, "X-RateLimit-Reset": str(int((NOW + late) * 1000))}}}}))
    every = list(itertools.product(kinds, (None, 400, 404, 418, 429, 503), bodies, texts))
    random.seed(1)
    return random.sample(every, 1500)


def test_failures_one_by_one_as_in_columns(spark):
    rows = [(i, *c, i % 13) for i, c in enumerate(cases())]
    df = spark.createDataFrame(rows, "i int, kind string, status int, body string, text string, attempt int")
    f = errors.flags(F.col("kind"), F.col("status"), errors.parsed(F.col("body")), F.col("text"), F.lit(NOW))
    wait = errors.retry_after(errors.retry_value(errors.parsed(F.col("body"))))
    got = df.select("i", F.struct(*(c.alias(n) for n, c in f.items())).alias("f"), errors.failure_class(f).alias("named"), wait.alias("wait"), errors.backoff(f, F.col("attempt"), wait, F.lit(7.0)).alias("backoff")).collect()
    for r in got:
        _, kind, status, body, text, attempt = rows[r["i"]]
        v = verdict(Failed(kind, status, body, text), NOW)
        want = {"rate_limit": v.rate_limit, "daily_quota": v.daily_quota, "temporary": v.temporary, "transient": v.transient, "non_retryable": v.non_retryable, "retry_other_model": v.retry_other_model}
        assert {k: r["f"][k] for k in want} == want, rows[r["i"]]
        assert (r["named"], r["wait"], r["backoff"]) == (v.kind, v.wait, backoff(v, attempt, 7.0)), rows[r["i"]]


def test_strikes_blocks_and_pardons():
    lane = Lane({"a": Model(), "b": Model()})
    rate = verdict(Failed("rate", 429), 0)
    lane.register("a", verdict(Failed("status", 503), 0), 0)
    assert lane.available(0) == ["b"] and lane.models["a"].permanent and lane.until_available(0) == 0
    for strike, until in ((1, 10), (2, 10), (3, 90)):
        lane.register("a", rate, 0)
        assert (lane.models["a"].strikes, lane.models["a"].until) == (strike, until)
    assert not lane.models["a"].permanent and lane.until_available(89.9) == 0.5 and lane.available(90) == ["a", "b"]
    for _ in range(10):
        lane.register("b", rate, 5)
    assert lane.models["b"].until == 5 + 300
    lane.register("a", verdict(Failed("rate", 429, text="daily limit"), 0), 100)
    assert lane.models["a"].permanent and lane.models["a"].until == 0


def ended(ask, models=("a", "b"), upto=1e9, lane=None):
    lane = lane or Lane({m: Model() for m in models})
    done, left = lane.run([(0, Entry(5, "p", 64, 1.0, 1.0))], ask, upto)
    return done[0][1] if done else left[0]


def raising(*args):
    def ask(entry, model):
        raise Failed(*args)

    return ask


def test_ends_of_entries():
    assert ended(lambda e, m: " text ").answer == "text"
    skipped = ended(raising("status", 400, None, "maximum context"))
    assert (skipped.status, skipped.asked, skipped.attempts) == ("skipped", 1, 1)
    teapot = ended(raising("status", 418))
    assert (teapot.status, teapot.attempts, teapot.asked, teapot.waited) == ("failed", 12, 12, 5.0 * sum(range(1, 12)))
    broken = ended(raising("timeout"))  # 21 breaks an attempt: 20 waits of 5 to 60 seconds
    assert (broken.attempts, broken.asked) == (12, 12 * 21)
    assert broken.waited == 12 * sum(min(60.0, 5.0 * k) for k in range(1, 21)) + 5.0 * sum(range(1, 12))
    gone = ended(raising("status", 404))  # both models are out of use after two asks
    assert (gone.status, gone.asked, gone.attempts) == ("failed", 2, 12)
    assert ended(lambda e, m: "x", models=()).asked == 0
    blank = ended(lambda e, m: "" if e.asked < 3 else "x")
    assert (blank.status, blank.asked, blank.waited) == ("generated", 3, 30.0)
    waiting = ended(raising("rate", 429), upto=5)
    assert waiting.due == 11.0 and waiting.asked == 2


def test_a_lane_runs_the_same_in_parts():
    ask = rolling()
    entries = [(n, Entry(n % 90, f"p{n}", 64, n / 4, n / 4)) for n in range(120)]
    whole, none = Lane({m: Model() for m in MODELS}).run(entries, ask, 1e9)
    lane, done, left = Lane({m: Model() for m in MODELS}), [], {}
    for upto in (0, 3, 7.25, 20, 21, 90, 1e9):
        left |= {n: e for n, e in entries if e.at <= upto and n not in left and n not in {d for d, _ in done}}
        more, left = lane.run(left.items(), ask, upto)
        done += more
    assert not none and not left and sorted(whole, key=str) == sorted(done, key=str) and len(whole) == 120


class Clock:
    """Time that passes only by sleeping."""

    def __init__(self):
        self.now, self.slept = 0.0, []

    def time(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds
        self.slept.append(seconds)


def test_a_lane_goes_on_while_an_entry_waits():
    clock = Clock()
    entries = [Entry(n, f"p{n}", 64, 0.0, 0.0) for n in range(60)]
    got = list(generate.in_lane(entries, Lane({m: Model() for m in MODELS}), rolling(), clock.time, clock.sleep))
    want, _ = Lane({m: Model() for m in MODELS}).run(list(enumerate(entries)), rolling(), 1e9)
    assert sorted(got, key=str) == sorted((o for _, o in want), key=str)
    assert sum(clock.slept) < sum(o.waited for o in got) / 3  # waits overlap


def test_generation_by_availability(spark):
    def quick():
        return lambda entry, model: f"{model}: {entry.prompt}" if entry.asked > 1 or entry.id % 3 else (_ for _ in ()).throw(Failed("status", 404))

    df = spark.createDataFrame([(i, f"p{i}", 64) for i in range(30)] + [(3, "again", 64), (None, "p", 64)], "id long, prompt string, max_tokens int")
    got = generate.generated_by_availability(df, quick, [f"m{k}" for k in range(40)], lanes=3).collect()
    assert len(got) == 31 and {r["status"] for r in got} == {"generated"}
    assert all(r["asked"] == (1 if r["id"] % 3 else 2) and r["answer"].startswith(r["model"]) for r in got)
    with pytest.raises(ValueError, match="lanes"):
        generate.generated_by_availability(df, quick, ["m"], lanes=0)


def streamed(spark, files, per_trigger, **how):
    base = new_path(spark, "gen")
    schema = "id long, prompt string, max_tokens int, at double"
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    spark.createDataFrame([(generation.CLOSING, None, 0, 1e9)], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(f"{base}/in")
    done = generation.outcomes(read, rolling, MODELS, lanes=2, **how)
    q = generation.started(done.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True), spark)
    q.awaitTermination()
    return sorted(map(tuple, spark.read.schema(done.schema).parquet(f"{base}/out").collect()), key=str)


def test_stream_does_not_depend_on_batches(spark):
    rows = [(i, f"p{i}", 64, 1.0 + i / 4) for i in range(40)]
    twice = [*rows, (39, "again", 64, 11.0), (None, "p", 64, 11.0), (77, "p", 64, None)]
    one = streamed(spark, [twice], 10)
    many = streamed(spark, [rows[:13], rows[13:30], twice[30:]], 1)
    assert one == many and len(one) == 41
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != generation.ROCKS


SAMPLE = "split string, idx long, status string, text string, labels array<int>, model string, min_words_filter int, generation_mode string"


def sample_rows():
    random.seed(4)
    out = [("train", i, "skipped" if i // 10 == 2 or i % 11 == 0 else "failed" if i % 13 == 0 else "generated", f"t{i}", [0, 1], f"m{i % 3}", 3, "append") for i in range(95)]
    out += [("test", i, "generated", f"x{i}", [1], "m", None, None) for i in range(12) if i != 4]
    random.shuffle(out)
    return out


TOTALS = {"train": 95, "test": 12}


class Stopped(Exception):
    pass


def run(spark, base, store, failing=()):
    """Runs the stream until it ends; fails once at each of the (batch, step) given."""
    failing, at = set(failing), [0]
    read = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")

    def stop(step):
        if (at[0], step) in failing:
            failing.discard((at[0], step))
            raise Stopped(step)

    write = commits.sink(store, 10, TOTALS, stop)

    def each(batch, number):
        at[0] = number
        write(batch, number)

    for _ in range(10):
        try:
            read.writeStream.foreachBatch(each).option("checkpointLocation", f"{base}/state-{store[-6:]}").trigger(availableNow=True).start().awaitTermination()
            assert not failing
            return
        except Exception as e:  # noqa: BLE001  Spark wraps it
            assert "Stopped" in str(e)
            if commits.manifest(spark, store) is not None:
                whole(spark, store)


def whole(spark, store):
    """What is committed so far, each chunk whole; half-written batches must not show."""
    held = {(r["split"], r["chunk_id"]): (r["lo"], r["hi"], r["n"], r["dropped"], r["whole"]) for r in commits.manifest(spark, store).collect()}
    got = sorted(map(tuple, planned.read(spark, store).select("split", "idx", "text", "model", "chunk_id").collect()))
    keys = [(s, i // 10) for s, i, *_ in got]
    assert {k: keys.count(k) for k in held if held[k][2]} == {k: v[2] for k, v in held.items() if v[2]} and set(keys) <= set(held)
    return held, got


@pytest.fixture(scope="module")
def store(spark):
    base = new_path(spark, "commits")
    spark.createDataFrame(sample_rows(), SAMPLE).repartition(4).write.parquet(f"{base}/in")
    path = f"{base}/store-{uuid.uuid4().hex[:6]}"
    run(spark, base, path)
    return base, path


def test_committed_chunks(spark, store):
    base, path = store
    held, got = whole(spark, path)
    want = sorted((s, i, t, m, i // 10) for s, i, status, t, _, m, *_ in sample_rows() if status == "generated" and not (s == "test" and i < 10))
    assert got == want
    assert held[("train", 2)] == (None, None, 0, 10, True) and held[("train", 9)] == (90, 94, 4, 1, True) and ("test", 0) not in held and ("test", 1) in held


def test_failures_leave_what_a_run_without_them_leaves(spark, store):
    base, path = store
    other = f"{base}/store-{uuid.uuid4().hex[:6]}"
    run(spark, base, other, [(0, "rows"), (1, "manifest"), (3, "rows"), (3, "manifest")])
    assert whole(spark, other) == whole(spark, path)
    first = spark.createDataFrame(sample_rows()[:30], SAMPLE)
    assert commits.write_batch(first, 0, other, 10, TOTALS) is False  # a batch that comes again
    assert commits.write_batch(first, 9, other, 10, TOTALS) is True  # slots that come again
    assert whole(spark, other) == whole(spark, path)
    assert commits.finish(spark, other, 10, TOTALS, SAMPLE) is True and commits.finish(spark, other, 10, TOTALS, SAMPLE) is False
    held, got = whole(spark, other)
    assert held[("test", 0)] == (0, 9, 9, 0, False) and len(got) == len(whole(spark, path)[1]) + 9
    with pytest.raises(ValueError, match="ended"):
        commits.write_batch(first, 10, other, 10, TOTALS)
    with pytest.raises(ValueError, match="folders"):
        commits.write_batch(first, 11, f"{other}x", 10, {"a/b": 1})


def test_planned_reads_open_only_their_chunks(spark, store):
    _, path = store
    broken = f"{path}-broken"
    shutil.copytree(path.removeprefix("file:"), broken.removeprefix("file:"))
    for r in commits.manifest(spark, path).collect():
        if r["split"] != "train" or r["chunk_id"] not in (3, 4):
            shutil.rmtree(f"{broken.removeprefix('file:')}/{r['folder']}")
    want = [i for i in range(33, 50) if i % 11 and i % 13]
    assert sorted(r["idx"] for r in planned.read_range(spark, broken, "train", 33, 50).collect()) == want
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = planned.read(spark, broken)
        assert sorted(r["idx"] for r in some.where("split = 'train' AND idx > 32 AND idx <= 49").select("idx").collect()) == want
        assert some.where("split IN ('train') AND idx >= 41 AND idx < 42 AND model = 'm2'").select("model", "chunk_id", "text").collect() == [("m2", 4, "t41")]
        assert some.where("split = 'train' AND idx = 35").count() == 1
        assert some.where("split = 'nowhere'").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    with pytest.raises(Exception, match="FileNotFound|No such file|Cannot"):
        planned.read_range(spark, broken, "train", 60, 70).collect()
    assert planned.read(spark, path, task_rows=20).rdd.getNumPartitions() > 2
    with pytest.raises(ValueError, match="start"):
        planned.read_range(spark, path, "train", 5, 5)
    with pytest.raises(Exception, match="no committed chunks"):
        planned.read_range(spark, f"{path}-none", "train", 0, 5).collect()


def test_chunks_of_a_long_run_share_folders(spark):
    base = new_path(spark, "shared")
    rows = [(s, i, "failed" if i % 7 == 0 else "generated", f"{s}{i}", [0], "m", 3, "append") for s, n in (("a", 401), ("b", 9)) for i in range(n) if (s, i) != ("a", 9)]
    random.Random(5).shuffle(rows)
    spark.createDataFrame(rows, SAMPLE).repartition(3).write.parquet(f"{base}/in")
    path, totals = f"{base}/store", {"a": 401, "b": 9}
    stream = spark.readStream.schema(spark.createDataFrame([], SAMPLE).schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    stream.writeStream.foreachBatch(commits.sink(path, 2, totals)).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    held = commits.manifest(spark, path).collect()
    want = {(s, c): [i for x, i, status, *_ in rows if (x, i // 2, status) == (s, c, "generated")] for s, c in {(x, i // 2) for x, i, *_ in rows} - {("a", 4)}}
    assert {(r["split"], r["chunk_id"]): (r["lo"], r["hi"], r["n"], r["whole"]) for r in held} == {k: (min(v, default=None), max(v, default=None), len(v), True) for k, v in want.items()} and len(held) == len(want)
    made = {r["folder"] for r in held}
    assert len([f for f in made if "/split=a/" in f and "batch=2/" in f]) <= 16 and len(made) <= 3 * 21
    files = [str(f) for f in Path(path.removeprefix("file:")).rglob("rows/**/*.parquet")]
    assert len(files) <= 6 * 21
    got = sorted(map(tuple, planned.read(spark, path, task_rows=7).select("split", "idx", "chunk_id", "text").collect()))
    assert got == sorted((s, i, c, f"{s}{i}") for (s, c), v in want.items() for i in v)
    fits = lambda r: r["split"] == "a" and r["n"] and r["hi"] >= 5 and r["lo"] < 31
    for f in made - {r["folder"] for r in held if fits(r)}:
        shutil.rmtree(f"{path.removeprefix('file:')}/{f}")
    some = planned.read_range(spark, path, "a", 5, 31).select("idx", "chunk_id").collect()
    assert sorted(map(tuple, some)) == [(i, i // 2) for i in range(5, 31) if i % 7 and i not in (8, 9)]
    assert commits.chunks_a_folder(107, 10) == 1 and commits.chunks_a_folder(3_000_000, 20) == 1000 and commits.chunks_a_folder(0, 5) == 1 and commits.chunks_a_folder(10**9, 10**6) == 1


def test_places_need_no_texts_and_samples_only_first_words(spark):
    path = new_path(spark, "docs")
    rows = [(i, None if i % 5 == 0 else "w\u3000v " * (i % 30) + ("aé" * 20_000 if i % 30 > 20 else "\n")) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path.removeprefix('file:')}/documents.parquet/*.parquet'")
    want = con.execute(SQL["committed_range"]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(tuple, loops.committed_range(spark, path).select(*names).collect())) == sorted(want) and "" in {dict(zip(names, r, strict=True))["text"] for r in want}
    plan = loops.places(spark, path).groupBy("split").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "Generate" not in plan


def test_written_chunks_have_a_manifest(spark):
    path = new_path(spark, "written")
    df = spark.createDataFrame(sample_rows(), SAMPLE).drop("status")
    chunks.write(df.where("idx < 50"), path, 10)
    chunks.write(df.where("idx >= 50"), path, 10)
    assert sorted(r["idx"] for r in chunks.read_range(spark, path, "train", 45, 55).collect()) == list(range(45, 55))
    shutil.rmtree(f"{path.removeprefix('file:')}/split=train/chunk_id=7")
    assert chunks.read_range(spark, path, "train", 0, 70).count() == 70
    with pytest.raises(ValueError, match="without samples"):
        chunks.write(df.where("idx < 0"), path, 10)
    spark.createDataFrame([("a", "x", 1)], "split string, text string, idx long").write.partitionBy("split").parquet(f"{path}-bad/split=a")
    spark.createDataFrame([("a", 0, 1, 1, 1, "split=a")], "split string, chunk_id long, lo long, hi long, n long, folder string").write.parquet(f"{path}-bad/_manifest")
    with pytest.raises(Exception, match="lacks"):
        chunks.read_range(spark, f"{path}-bad", "a", 0, 5).collect()
