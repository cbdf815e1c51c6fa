"""Generation as a stream: requests wait in the state of their lane, timers release them, failures set the timers.

A lane is one key: its models' cooldowns and its waiting requests are its state. Concurrency is the number of lanes. By
event time a request is asked at the time it is due, once the watermark has passed it, so results depend neither on how
the stream is cut into batches nor on restarts. By processing time a request is asked when the clock says so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import astuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from wordspan.operators.entries import Ask, Entry, Lane, Model

OUTCOME = "lane int, id long, status string, answer string, model string, attempts int, asked int, waited double"
WAITING = "id long, prompt string, max_tokens int, at double, due double, attempt int, tries int, breaks int, asked int"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Requests(StatefulProcessor):
    """Waiting requests by number, models by name, the next number and the next timer."""

    def __init__(self, make: Callable[[], Ask], models: list[str], seed: int, by_clock: bool):
        self.make, self.models, self.seed, self.by_clock = make, models, seed, by_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.ask = handle, self.make()
        self.waiting = handle.getMapState("waiting", "n long", WAITING)
        self.cooling = handle.getMapState("models", "name string", "strikes int, until double, permanent boolean")
        self.counts = handle.getValueState("counts", "next long, timer long")

    def count(self) -> tuple[int, int]:
        return self.counts.get() if self.counts.exists() else (0, 0)

    def timer(self, number: int, due: float) -> None:
        """One timer at a time: that of the request that is due first."""
        at = int(-(-due * 1000 // 1))
        old = self.count()[1]
        if not old or at < old:
            if old:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(at)
            self.counts.update((number, at))
        else:
            self.counts.update((number, old))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if key[0] == NO_LANE:
            return iter(())
        now = timerValues.getCurrentProcessingTimeInMs() / 1000 if self.by_clock else None
        number = self.count()[0]
        first = None
        for frame in rows:
            for r in frame.itertuples():
                at = now if self.by_clock else float(r.at)
                self.waiting.updateValue((number,), astuple(Entry(int(r.id), r.prompt, int(r.max_tokens), at, at)))
                first = at if first is None else min(first, at)
                number += 1
        if first is not None:
            self.timer(number, first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = (timerValues.getCurrentProcessingTimeInMs() if self.by_clock else timerValues.getCurrentWatermarkInMs()) / 1000
        held = {name: Model(*state) for (name,), state in self.cooling.iterator()} if self.cooling.exists() else {}
        lane = Lane({name: held.get(name, Model()) for name in self.models}, self.seed)
        before = {n: Entry(*state) for (n,), state in self.waiting.iterator()} if self.waiting.exists() else {}
        done, left = lane.run(before.items(), self.ask, now)
        for n, _ in done:
            self.waiting.removeKey((n,))
        for n, entry in left.items():
            if entry != before[n]:
                self.waiting.updateValue((n,), astuple(entry))
        for name in lane.changed:
            self.cooling.updateValue((name,), astuple(lane.models[name]))
        self.counts.update((self.count()[0], 0))
        if left:
            self.timer(self.count()[0], min(e.due for e in left.values()))
        if done:
            yield pd.DataFrame([(key[0], *astuple(o)) for _, o in done], columns=[c.split()[0] for c in OUTCOME.split(", ")])

    def close(self) -> None:
        pass


def outcomes(requests: DataFrame, make: Callable[[], Ask], models: list[str], lanes: int = 32, seed: int = 0, lane: Column | None = None, by_clock: bool = False, late: str = "0 seconds") -> DataFrame:
    """A stream of the outcomes of a stream of requests (id, prompt, max_tokens, at in seconds).

    id, status, answer, model, attempts (of the entry), asked (times a model was), waited (seconds). `make` gives a task
    its generator; `lane` may say which requests are dealt together, else a hash of the id does. Requests of one lane are asked one after the other, those of different lanes side by side. Requests
    with equal ids wait on their own; null ids and times are left out. Times are after 1970, as Spark's are. By event time, requests that come more than
    `late` behind the newest are dropped by Spark, so give them out in order, and a last one in a lane of its own
    (`closing`) to release what waits. Without models every request fails.
    """
    lane = F.pmod(F.xxhash64("id"), F.lit(lanes)) if lane is None else lane
    lane = F.when(F.col("id") == CLOSING, NO_LANE).otherwise(lane).cast("int")
    timed = requests.where("id IS NOT NULL AND at IS NOT NULL").select("id", "prompt", F.col("max_tokens").cast("int"), F.col("at").cast("double"), lane.alias("lane"), F.timestamp_micros((F.col("at") * 1e6).cast("long")).alias("time"))
    if not by_clock:
        timed = timed.withWatermark("time", late)
    work = Requests(make, models, seed, by_clock)
    return timed.groupBy("lane").transformWithStateInPandas(work, OUTCOME, "Append", "ProcessingTime" if by_clock else "EventTime").drop("lane")


#: The id and the lane of a request that only moves the time on, and by how much.
CLOSING, NO_LANE, FAR = -(1 << 63), -1, 10 * 365 * 86400.0


def closing(requests: DataFrame) -> DataFrame:
    """One row, ten years after the last request: no wait is longer, so everything is released."""
    return requests.agg((F.coalesce(F.max("at"), F.lit(0.0)) + FAR).alias("at")).select(F.lit(CLOSING).alias("id"), F.lit(None).cast("string").alias("prompt"), F.lit(0).alias("max_tokens"), "at")


def started(writer: DataStreamWriter, spark):
    """Starts a query whose state is kept by RocksDB, which timers need; the session's setting stays what it was."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKS)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
