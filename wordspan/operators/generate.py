"""Generation with an injected generator inside the tasks: models by turns, or by availability under cooldowns."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import astuple, replace
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from wordspan.functions.errors import MOST_ATTEMPTS
from wordspan.operators.entries import Ask, Entry, Lane, Model, Outcome

#: (prompt, max_tokens, model) to text.
Generator = Callable[[str, int, str], str]


class Permanent(Exception):
    """No other attempt can help this entry."""


class Transient(Exception):
    """The connection failed; the attempt doesn't count."""


def attempt(generate: Generator, prompt: str, budget: int, models: list[str], transient: int = 20, wait: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, str, int]:
    """(text, model, status, attempts): models by turns, as many attempts as there are models but ten at least."""
    tries, used, breaks = max(10, len(models)), 0, 0
    while used < tries:
        model = models[used % len(models)]
        try:
            text = generate(prompt, budget, model).strip()
            used += 1
            if text:
                return text, model, "generated", used
        except Permanent:
            return None, None, "skipped", used + 1
        except Transient:
            breaks += 1
            if breaks > transient:
                return None, None, "failed", used
            wait(min(60.0, 5.0 * breaks))
        except Exception:  # noqa: BLE001  whatever a generator raises, the next model is asked
            used += 1
    return None, None, "failed", used


def attempt_entry(generate: Generator, prompt: str, budget: int, models: list[str], entries: int = MOST_ATTEMPTS, wait: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, str, int]:
    """An entry's attempts with backoff between them: 5, 10, 15, ... seconds; none after a permanent failure."""
    total = 0
    for k in range(entries):
        text, model, status, tries = attempt(generate, prompt, budget, models, wait=wait)
        total += tries
        if status != "failed":
            return text, model, status, total
        if k + 1 < entries:
            wait(5.0 * (k + 1))
    return None, None, "failed", total


def generated(requests: DataFrame, make: Callable[[], Generator], models: list[str], concurrency: int | None = None, entries: int = 1) -> DataFrame:
    """Adds answer, model, status and attempts to requests (prompt, max_tokens, ...).

    `entries` attempts are made for each request, each of which asks the models by turns. `make` gives a task its generator. As many requests run at once as there are partitions; `concurrency` sets them.
    """
    if concurrency is not None and concurrency < 1:
        raise ValueError("concurrency must be at least 1")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = make()
        for pdf in frames:
            done = [attempt_entry(generate, p, int(b), models, entries) for p, b in zip(pdf["prompt"], pdf["max_tokens"], strict=True)]
            answers = pd.DataFrame(done, columns=["answer", "model", "status", "attempts"], index=pdf.index)
            yield pd.concat([pdf, answers], axis=1)

    dealt = requests if concurrency is None else requests.repartition(concurrency)
    schema = ", ".join(f"`{n}` {t}" for n, t in requests.dtypes)
    return dealt.mapInPandas(run, f"{schema}, answer string, model string, status string, attempts int")


def in_lane(entries: list[Entry], lane: Lane, ask: Ask, clock: Callable[[], float], sleep: Callable[[float], None]) -> Iterator[Outcome]:
    """Runs entries by a clock: whichever is due first is asked next, and the lane sleeps only when none is due."""
    queue = [(e.due, e.id, n, e) for n, e in enumerate(entries)]
    heapify(queue)
    while queue:
        due, _, n, entry = heappop(queue)
        now = clock()
        if due > now:
            sleep(due - now)
            now = max(due, clock())
        after = lane.step(replace(entry, due=now), ask)
        if isinstance(after, Outcome):
            yield after
        else:
            heappush(queue, (after.due, after.id, n, after))


def generated_by_availability(requests: DataFrame, make: Callable[[], Ask], models: list[str], lanes: int = 32, seed: int = 0, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """id, status, answer, model, attempts, asked and waited of requests (id, prompt, max_tokens), under cooldowns.

    A task is a lane: it asks one model at a time, of those that are available, by the rules of operators.entries, and
    goes on with other requests while one waits. `lanes` sets how many run at once. A lane takes an Arrow batch of
    requests at a time. Null ids are left out, equal ids wait on their own.
    """
    if lanes < 1:
        raise ValueError("lanes must be at least 1")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, lane = make(), Lane({m: Model() for m in models}, seed + TaskContext.get().partitionId())
        for pdf in frames:
            now = clock()
            entries = [Entry(int(i), p, int(b), now, now) for i, p, b in zip(pdf["id"], pdf["prompt"], pdf["max_tokens"], strict=True)]
            yield pd.DataFrame([astuple(o) for o in in_lane(entries, lane, ask, clock, sleep)], columns=["id", "status", "answer", "model", "attempts", "asked", "waited"])

    dealt = requests.where("id IS NOT NULL").select("id", "prompt", "max_tokens").repartition(lanes)
    return dealt.mapInPandas(run, "id long, status string, answer string, model string, attempts int, asked int, waited double")
