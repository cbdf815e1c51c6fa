"""Entries that wait for generated text, and the models that may be asked: one lane of a run.

A lane has a few models and any number of entries. Time is a number the caller gives, so that a lane runs the same by a
clock, by a stream's watermark, or all at once. An entry asks models, one that is available at a time, until one answers;
failures put models into cooldown or out of use, and send entries back to wait.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from hashlib import md5

from wordspan.functions.errors import UNAVAILABLE
from wordspan.functions.failures import Failed, Verdict, backoff, verdict
from wordspan.streaming.cooldown import A_STRIKE, AFTER_EMPTY, LEAST_WAIT, LONGEST, STRIKES

# Model attempts at least, breaks of the connection, seconds that a break adds, and the longest of them.
LEAST_TRIES, MOST_BREAKS, A_BREAK, LONGEST_BREAK = 10, 20, 5.0, 60.0


@dataclass(frozen=True)
class Entry:
    """A request and how far it has come: attempts of the entry, tries and breaks of this attempt, times asked so far."""

    id: int
    prompt: str
    max_tokens: int
    at: float
    due: float
    attempt: int = 0
    tries: int = 0
    breaks: int = 0
    asked: int = 0


@dataclass(frozen=True)
class Outcome:
    """How an entry ended: generated, skipped (no attempt can help) or failed."""

    id: int
    status: str
    answer: str | None
    model: str | None
    attempts: int
    asked: int
    waited: float


@dataclass
class Model:
    strikes: int = 0
    until: float = 0.0
    permanent: bool = False


#: (entry, model) to text, None where the model has no choices to offer; raises Failed.
Ask = Callable[[Entry, str], str | None]


@dataclass
class Lane:
    """`changed` has the names of models whose state isn't what it was."""

    models: dict[str, Model]
    seed: int = 0
    changed: set[str] = field(default_factory=set)

    def available(self, now: float) -> list[str]:
        return [name for name, m in self.models.items() if not m.permanent and now >= m.until]

    def until_available(self, now: float) -> float:
        """Seconds until the next cooldown ends, half a second at least; 0 if none runs."""
        left = [m.until - now for m in self.models.values() if now < m.until]
        return max(LEAST_WAIT, min(left)) if left else 0.0

    def register(self, name: str, v: Verdict, now: float) -> None:
        model = self.models[name]
        if v.kind == "rate":
            model.strikes += 1
            often = model.strikes >= STRIKES
            model.until = max(model.until, now + (min(LONGEST, A_STRIKE * model.strikes) if often else v.wait))
            model.permanent = model.permanent and not often
        elif v.kind == "content":
            model.until = max(model.until, now + AFTER_EMPTY)
        elif v.kind in ("quota", "retry") and not model.permanent:
            model.permanent, model.until = True, 0.0
        self.changed.add(name)

    def pick(self, entry: Entry, free: list[str]) -> str:
        """One of them, by a hash of seed, id and the number of the ask."""
        return free[int(md5(f"{self.seed}|{entry.id}|{entry.asked}".encode()).hexdigest()[:8], 16) % len(free)]

    def step(self, entry: Entry, ask: Ask) -> Entry | Outcome:
        """One ask at the time the entry is due, or a wait; the entry with its next time, or how it ended."""
        now = entry.due
        free = self.available(now)
        if not free:
            if wait := self.until_available(now):
                return replace(entry, due=now + wait)
            return self.ended(entry, Failed("runtime", text=f"{UNAVAILABLE}: {len(self.models)}"), now)
        name = self.pick(entry, free)
        entry = replace(entry, asked=entry.asked + 1)
        try:
            said = ask(entry, name)
            if said is None:
                raise Failed("value", text=f"Model {name} returned no choices.")
            if not (text := said.strip()):
                raise Failed("value", text=f"Model {name} returned empty content.")
            return Outcome(entry.id, "generated", text, name, entry.attempt + 1, entry.asked, now - entry.at)
        except Failed as failure:
            v = verdict(failure, now)
            if v.transient:
                entry = replace(entry, breaks=entry.breaks + 1)
                if entry.breaks > MOST_BREAKS:
                    return self.ended(entry, Failed("runtime", text="the connection breaks again and again"), now)
                return replace(entry, due=now + min(LONGEST_BREAK, A_BREAK * entry.breaks))
            self.register(name, v, now)
            if not (v.retry_other_model or v.rate_limit):
                return self.ended(entry, failure, now)
            entry = replace(entry, tries=entry.tries + 1)
            if entry.tries >= max(LEAST_TRIES, len(self.models)):
                return self.ended(entry, Failed("runtime", text="no model has answered"), now)
            return entry

    def ended(self, entry: Entry, failure: Failed, now: float) -> Entry | Outcome:
        """An attempt of the entry has failed: it waits for the next one, or ends."""
        v = verdict(failure, now)
        wait = backoff(v, entry.attempt, self.until_available(now))
        if wait is None:
            return Outcome(entry.id, "skipped" if v.non_retryable else "failed", None, None, entry.attempt + 1, entry.asked, now - entry.at)
        return replace(entry, due=now + wait, attempt=entry.attempt + 1, tries=0, breaks=0)

    def run(self, entries: Iterable[tuple[int, Entry]], ask: Ask, upto: float) -> tuple[list[tuple[int, Outcome]], dict[int, Entry]]:
        """Steps of all (number, entry) that are due up to a time, in the order of time, id and number.

        Returns the outcomes and the entries that still wait, by number. Does the same in one call or in many.
        """
        queue = [(e.due, e.id, n, e) for n, e in entries]
        heapq.heapify(queue)
        done = []
        while queue and queue[0][0] <= upto:
            _, _, n, entry = heapq.heappop(queue)
            after = self.step(entry, ask)
            if isinstance(after, Outcome):
                done.append((n, after))
            else:
                heapq.heappush(queue, (after.due, after.id, n, after))
        return done, {n: e for _, _, n, e in queue}
