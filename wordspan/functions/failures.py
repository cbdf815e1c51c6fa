"""Failures as generators raise them, classed one at a time, inside a task; functions/errors.py does it for columns.

Both follow the same rules and values; a test holds them against each other.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from wordspan.functions import errors as E


class Failed(Exception):
    """A generator's failure: the exception's kind, a status, the answer's JSON body, and a text."""

    def __init__(self, kind: str, status: int | None = None, body: str | None = None, text: str | None = None):
        super().__init__(text or kind)
        self.kind, self.status, self.body, self.text = kind, status, body, text


@dataclass(frozen=True)
class Verdict:
    """What a failure is (`kind` is that of errors.failure_class) and how many seconds it asks to wait."""

    kind: str
    rate_limit: bool
    daily_quota: bool
    temporary: bool
    transient: bool
    non_retryable: bool
    retry_other_model: bool
    wait: float


def field(body: str | None, *path: str) -> str | None:
    """What stands at a path within the body's error object, as text; None where it is missing or null."""
    try:
        at = json.loads(body or "null", parse_float=str, parse_int=str)
    except ValueError:
        return None
    for name in ("error", *path):
        at = at.get(name) if isinstance(at, dict) else None
    return at if at is None or isinstance(at, str) else json.dumps(at)


def number(text: str | None) -> float | None:
    try:
        return None if text is None else float(text)
    except ValueError:
        return None


def verdict(failure: Failed, now: float) -> Verdict:
    """Classes a failure; `now` in seconds."""
    own, body, kind, status = failure.text or "", failure.body, failure.kind, failure.status
    said, raw = (field(body, "message") or own).lower(), own.lower()
    has = lambda text, marks: any(m in text for m in marks)
    header = lambda name: field(body, "metadata", "headers", name)
    asked = next((v for k in E.RETRY_KEYS if (v := field(body, "metadata", k)) is not None), None)
    reset = number(header("X-RateLimit-Reset"))
    rate = kind == "rate" or status == 429
    quota = has(said, E.DAILY_MARKS) or (header("X-RateLimit-Remaining") == "0" and reset is not None and reset / 1000 - now > E.FAR_RESET)
    transient = kind in E.CONNECTION or (kind == "runtime" and E.UNAVAILABLE in raw)
    content = kind == "value" and has(raw, E.EMPTY_MARKS)
    length = has(raw, E.LENGTH_MARKS)
    other = transient or content or kind in E.MODEL_KINDS or status == 429 or status in E.MODEL_STATUSES or (status == 400 and has(raw, E.MODEL_MARKS))
    seconds = number(asked)
    named = "quota" if quota else "rate" if rate else "content" if content else "retry" if other and not transient else "other"
    wait = E.USUAL_WAIT if seconds is None else min(E.LONGEST_WAIT, seconds + 1)
    never = has(own, E.ENTRY_MARKS) if kind == "value" else length
    return Verdict(named, rate, quota, rate and not quota and (has(said, E.TEMPORARY_MARKS) or asked is not None), transient, never, other, wait)


def backoff(v: Verdict, attempt: int, until_available: float) -> float | None:
    """Seconds before an entry's next attempt (counted from 0); None where there is none."""
    if v.non_retryable or v.daily_quota or attempt + 1 >= E.MOST_ATTEMPTS:
        return None
    grown = 5.0 * (attempt + 1)
    return max(until_available, grown) if v.transient else v.wait if v.temporary else grown
