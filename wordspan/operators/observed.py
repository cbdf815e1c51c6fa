"""Counters of what is written, gathered by the job that writes it, in batch and in streams."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

STATUSES = ("generated", "skipped", "failed")


def run_counts() -> dict[str, Column]:
    """total, and entries by status, of results (status)."""
    return {n: F.count_if(F.col("status") == n) for n in STATUSES} | {"total": F.count(F.lit(1))}


def window_counts() -> dict[str, Column]:
    """Windows (label): how many, their words, those labelled 1, and the least and most words of one."""
    size = F.size("label")
    return {"windows": F.count(F.lit(1)), "words": F.sum(size), "ones": F.sum(F.aggregate("label", F.lit(0), lambda a, x: a + x)), "least": F.min(size), "most": F.max(size)}


def written(rows: DataFrame, path: str, counts: dict[str, Column], *partitions: str) -> dict[str, int | float | None]:
    """Writes the rows and returns the counters, all from one pass."""
    seen = Observation()
    rows.observe(seen, *(c.alias(n) for n, c in counts.items())).write.partitionBy(*partitions).parquet(path)
    return seen.get


def watched(rows: DataFrame, name: str, counts: dict[str, Column]) -> DataFrame:
    """A stream that reports its counters, of which sums are of use, with each batch; a `Totals` adds them up."""
    return rows.observe(name, *(c.alias(n) for n, c in counts.items()))


class Totals(StreamingQueryListener):
    """Sums of a stream's counters over its batches, each batch once, whatever runs again."""

    def __init__(self, name: str):
        self.name, self.batches, self.lock = name, {}, threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            with self.lock:
                self.batches[(str(event.progress.id), event.progress.batchId)] = {k: v for k, v in found.asDict().items() if v is not None}

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def sums(self) -> dict[str, int]:
        with self.lock:
            return dict(sum((Counter(b) for b in self.batches.values()), Counter()))
