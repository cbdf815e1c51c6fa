"""What kind of failure a generator's answer is: from the exception's kind, its status, its JSON body and its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks in messages, statuses, and limits that say what kind of failure it is.
DAILY_MARKS = ("daily limit", "limit_rpd")
TEMPORARY_MARKS = ("temporarily rate-limited", "retry shortly")
EMPTY_MARKS = ("returned no choices", "returned empty content")
LENGTH_MARKS = ("context length", "maximum context", "max context", "too many tokens", "token limit")
ENTRY_MARKS = ("words; need at least", "Could not produce begin, middle, and end")
MODEL_MARKS = ("provider returned error", "model_not_available", "model_not_found", "non-serverless", "not found", "does not exist", "do not have access", "no longer available", "invalid model", "unsupported model", "invalid argument", "invalid_argument")
UNAVAILABLE = "all models unavailable"
MODEL_STATUSES = (402, 403, 404, 500, 502, 503)
RETRY_KEYS = ("retry_after_seconds", "retry_after_seconds_raw")
FAR_RESET, LONGEST_WAIT, USUAL_WAIT = 3600, 60.0, 10.0

#: Kinds of exceptions: those of the connection, and those that stand for a status of their own.
CONNECTION = ("json", "connection", "timeout", "transport")
MODEL_KINDS = ("server", "not_found", "rate")


#: What is looked for in a body.
BODY = "error struct<message: string, metadata: struct<retry_after_seconds: string, retry_after_seconds_raw: string, headers: struct<`X-RateLimit-Remaining`: string, `X-RateLimit-Reset`: string>>>"


def parsed(body: Column) -> Column:
    """The body's error object, parsed once; null where the body is no JSON object or lacks it. The `error` of what follows."""
    return F.from_json(body, BODY)["error"]


def field(error: Column, *path: str) -> Column:
    for name in path:
        error = error.getField(name)
    return error


def message(error: Column, text: Column) -> Column:
    """The body's own message, else the exception's text."""
    return F.coalesce(F.nullif(field(error, "message"), F.lit("")), text, F.lit(""))


def has(text: Column, marks: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | text.contains(mark)
    return found


def retry_value(error: Column) -> Column:
    """How many seconds the body asks to wait, as it stands there."""
    return F.coalesce(*(field(error, "metadata", key) for key in RETRY_KEYS))


def retry_after(value: Column) -> Column:
    """Seconds to wait: one more than asked for, a minute at most, ten if nothing is said."""
    return F.least(F.lit(LONGEST_WAIT), F.coalesce(value.try_cast("double") + 1, F.lit(USUAL_WAIT)))


def flags(kind: Column, status: Column, error: Column, text: Column, now: Column) -> dict[str, Column]:
    """The predicates of a failure, its body `parsed`; `now` in seconds."""
    said, raw = F.lower(message(error, text)), F.lower(F.coalesce(text, F.lit("")))
    is_status = lambda *values: F.coalesce(status.isin(*values), F.lit(False))
    rate = (kind == "rate") | is_status(429)
    header = lambda name: field(error, "metadata", "headers", name)
    far = header("X-RateLimit-Reset").try_cast("long") / 1000 - now > FAR_RESET
    quota = has(said, DAILY_MARKS) | F.coalesce((header("X-RateLimit-Remaining") == "0") & far, F.lit(False))
    transient = kind.isin(*CONNECTION) | ((kind == "runtime") & has(raw, (UNAVAILABLE,)))
    content = (kind == "value") & has(raw, EMPTY_MARKS)
    length = has(raw, LENGTH_MARKS)
    other_model = transient | content | kind.isin(*MODEL_KINDS) | is_status(429, *MODEL_STATUSES) | (is_status(400) & has(raw, MODEL_MARKS))
    return {
        "rate_limit": rate,
        "daily_quota": quota,
        "temporary": rate & ~quota & (has(said, TEMPORARY_MARKS) | retry_value(error).isNotNull()),
        "transient": transient,
        "content": content,
        "context_length": length,
        "non_retryable": F.when(kind == "value", has(F.coalesce(text, F.lit("")), ENTRY_MARKS)).otherwise(length),
        "retry_other_model": other_model,
        "blocks_model": other_model & ~transient & ~content & ~rate & ~quota,
    }


def failure_class(f: dict[str, Column]) -> Column:
    """quota, rate, content, retry (the model is left alone for good) or other, by the first rule that applies."""
    return F.when(f["daily_quota"], "quota").when(f["rate_limit"], "rate").when(f["content"], "content").when(f["blocks_model"], "retry").otherwise("other")


def backoff(f: dict[str, Column], attempt: Column, wait: Column, until_available: Column) -> Column:
    """Seconds before an entry's next attempt (counted from 0); null where there is none."""
    none = f["non_retryable"] | f["daily_quota"] | (attempt + 1 >= MOST_ATTEMPTS)
    grown = 5.0 * (attempt + 1)
    return F.when(~none, F.when(f["transient"], F.greatest(until_available, grown)).when(f["temporary"], wait).otherwise(grown))


#: Fixed value: attempts of an entry.
MOST_ATTEMPTS = 12
