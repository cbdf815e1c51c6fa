"""Which generators to leave alone for a while after failures: in batch by windows, in streams by keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wordspan.functions.names import free
from wordspan.operators.scan import running
from wordspan.sources.corpus import key_bucket

# Strikes until cooldowns grow, seconds a strike, the longest cooldown, and that after an empty answer.
STRIKES, A_STRIKE, LONGEST, AFTER_EMPTY = 3, 30.0, 300.0, 30.0


def cooldowns(failures: DataFrame, order: list[str], segments: int | None = None) -> DataFrame:
    """Adds strikes, until (seconds; only ever grows), permanent and blocked to failures (model, at in seconds, kind, wait).

    kind is that of errors.failure_class. The third rate-limit strike and later ones end a permanent block. `order` names
    columns that put a model's failures in one order; the first, a number, cuts them into `segments`, so that a model
    with most of the failures is the work of many tasks: strikes are counted first, then what follows from them is run
    over. `failures` is read again and again.
    """
    width = segments or int(failures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block, pardon = free(failures.columns, "block", "pardon")
    bucket = key_bucket(failures, order[0], width)
    counted = running(failures, ["model"], order, bucket, sums={"strikes": (F.col("kind") == "rate").cast("long")})
    forgives = (F.col("kind") == "rate") & (F.col("strikes") >= STRIKES)
    lasts = F.when(forgives, F.least(F.lit(LONGEST), A_STRIKE * F.col("strikes"))).when(F.col("kind") == "rate", F.col("wait")).when(F.col("kind") == "content", AFTER_EMPTY)
    place = F.struct(*order)
    ends = {"until": F.col("at") + lasts, block: F.when(F.col("kind").isin("quota", "retry"), place), pardon: F.when(forgives, place)}
    out = running(counted, ["model"], order, bucket, maxima=ends)
    out = out.withColumn("permanent", F.col(block).isNotNull() & (F.col(pardon).isNull() | (F.col(block) > F.col(pardon))))
    return out.withColumn("blocked", F.col("permanent") | F.coalesce(F.col("at") < F.col("until"), F.lit(False))).drop(block, pardon)


#: Fixed value: the least time to wait for a model.
LEAST_WAIT = 0.5


def available(states: DataFrame, at: Column, *by: str) -> DataFrame:
    """Models that may be asked at a time, and how long to wait for the next, of states (model, until, permanent).

    models (sorted), blocked, and wait: 0 if no cooldown runs, else the shortest that is left, half a second at least.
    """
    cooling = F.coalesce(at < F.col("until"), F.lit(False))
    free = ~F.col("permanent") & ~cooling
    left = F.min(F.when(cooling & ~F.col("permanent"), F.col("until") - at))
    return states.groupBy(*by).agg(F.sort_array(F.collect_set(F.when(free, F.col("model")))).alias("models"), F.count_if(~free).alias("blocked"), F.coalesce(F.greatest(F.lit(LEAST_WAIT), left), F.lit(0.0)).alias("wait"))


def picked(models: Column, number: Column) -> Column:
    """One of the models, each as likely as the others; null if there is none. `number`: a whole random number."""
    return F.when(F.size(models) > 0, F.get(models, (number % F.greatest(F.size(models), F.lit(1))).cast("int")))


def after(strikes: int, until: float, permanent: bool, at: np.ndarray, kind: np.ndarray, wait: np.ndarray) -> tuple[int, float, bool]:
    """A model's state after failures, given in any order; as arrays, a few bytes for each."""
    order = np.argsort(at, kind="stable")
    at, kind, wait = at[order], kind[order], wait[order]
    rate = kind == "rate"
    count = strikes + np.cumsum(rate)
    forgives = rate & (count >= STRIKES)
    lasts = np.where(forgives, np.minimum(LONGEST, A_STRIKE * count), np.where(rate, wait, np.where(kind == "content", AFTER_EMPTY, -np.inf)))
    changes = np.flatnonzero(forgives | (kind == "quota") | (kind == "retry"))
    return int(count[-1]), float(max(until, (at + lasts).max())), bool(~forgives[changes[-1]]) if len(changes) else permanent


def strikes_stream(failures: DataFrame) -> DataFrame:
    """For a stream of failures (model, at, kind, wait): model, strikes, until and permanent after each micro-batch.

    State is three numbers a model. Events of a batch are taken in the order of `at`; batches must come in that order.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        strikes, until, permanent = state.get if state.exists else (0, 0.0, False)
        columns = zip(*([f[c].to_numpy() for c in ("at", "kind", "wait")] for f in frames), strict=True)
        strikes, until, permanent = after(strikes, until, permanent, *map(np.concatenate, columns))
        state.update((strikes, until, permanent))
        yield pd.DataFrame({"model": [key[0]], "strikes": [strikes], "until": [until], "permanent": [permanent]})

    return failures.groupBy("model").applyInPandasWithState(update, "model long, strikes long, until double, permanent boolean", "strikes long, until double, permanent boolean", "update", GroupStateTimeout.NoTimeout)
