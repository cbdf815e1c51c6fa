"""Modes of generation: what a text must have, how it is cut, and what is asked of a generator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordspan.functions.once import once
from wordspan.functions.rng import draw
from wordspan.functions.text import has_words, join_words, tokens
from wordspan.operators import splits

#: Opening instructions of prompts, to choose from: for what stands between two parts, and for what follows one.
BRIDGE = (
    "Summarise the text in a few sentences.",
    "Give a short overview of the text.",
    "State the main points of the text.",
    "Write a synopsis of the text.",
    "Say briefly what happens in the text.",
    "Retell the passage in a few plain sentences.",
    "Condense the passage to what matters.",
    "Put the passage in your own words, shorter.",
)
FOLLOW = (
    "Continue the text.",
    "Write what could come next.",
    "Carry the text on in the same manner.",
    "Add to the text without repeating it.",
    "Go on from where the text stops.",
    "Extend the text in its own style.",
    "Write the next sentences.",
    "Keep the text going.",
)


def chosen(openings: tuple[str, ...], seed: int, key: Column) -> Column:
    """One of the openings, each as likely as the others."""
    which = draw(seed, key, "opening", below=F.lit(len(openings))).cast("int")
    return F.element_at(F.array(*map(F.lit, openings)), which + 1)


def summary_prompt(opening: Column, text: Column, words: Column) -> Column:
    return F.concat(opening, F.lit(" About "), words.cast("string"), F.lit(" words.\n\nText:\n"), text)


def continuation_prompt(opening: Column, text: Column, words: Column) -> Column:
    return F.concat(opening, F.lit(" Write "), words.cast("string"), F.lit(" words and nothing else.\n\n"), text)


def bridge_prompt(begin: Column, end: Column, words: Column) -> Column:
    """Asks for the text between two parts."""
    return F.concat(F.lit("Write "), words.cast("string"), F.lit(" words that lead from the first part to the second, and nothing else.\n\nFirst part:\n"), begin, F.lit("\n\nSecond part:\n"), end)


def whole_prompt(summary: Column, begin: Column, end: Column, words: Column) -> Column:
    """Asks for a whole text again, given its ends and a summary of what is between."""
    return F.concat(F.lit("Between the parts below the text said: "), summary, F.lit("\n\n"), bridge_prompt(begin, end, words))


@dataclass(frozen=True)
class Mode:
    """A mode's least words and its plan: texts to requests (prompt, words, max_tokens and the id)."""

    least_words: int
    plan: Callable[[DataFrame, int, str], DataFrame]


def request(df: DataFrame, id_col: str, prompt: Column, words: Column, budget_for: Column | None = None) -> DataFrame:
    return df.select(id_col, prompt.alias("prompt"), words.cast("int").alias("words"), splits.token_budget(words if budget_for is None else budget_for).alias("max_tokens"))


def append(docs: DataFrame, seed: int, id_col: str) -> DataFrame:
    p = splits.append_plan(docs, seed, id_col)
    return request(p, id_col, continuation_prompt(chosen(FOLLOW, seed, F.col(id_col)), F.col("kept"), F.col("need")), F.col("need"))


def halves(docs: DataFrame, seed: int, id_col: str) -> DataFrame:
    p = splits.prefix_suffix(docs).where("how IS NOT NULL")
    n, both = F.size("suffix"), F.size("prefix") + F.size("suffix")
    return request(p, id_col, continuation_prompt(chosen(FOLLOW, seed, F.col(id_col)), join_words(F.col("prefix")), n), n, both)


def sandwich(docs: DataFrame, seed: int, id_col: str) -> DataFrame:
    p = splits.sandwich_plan(docs, seed, id_col)
    return request(p, id_col, bridge_prompt(F.col("head_text"), F.col("tail_text"), F.col("need")), F.col("need"))


def thirds(docs: DataFrame, seed: int, id_col: str) -> DataFrame:
    p = splits.three_parts(docs).where("how IS NOT NULL")
    n = splits.summary_words(F.size("middle"))
    return request(p, id_col, summary_prompt(chosen(BRIDGE, seed, F.col(id_col)), join_words(F.col("middle")), n), n, F.size("middle"))


# Least words by mode.
MODES: dict[str, Mode] = {"append": Mode(3, append), "halves": Mode(30, halves), "sandwich": Mode(15, sandwich), "thirds": Mode(30, thirds)}


def requests(docs: DataFrame, mode: str, seed: int, id_col: str, text_col: str = "text") -> DataFrame:
    """Requests of a mode for the texts that have its least words. An unknown mode raises ValueError."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}")
    own = MODES[mode]
    kept = docs.where(has_words(F.col(text_col), own.least_words)).select(id_col, F.col(text_col).alias("text"))
    return own.plan(kept, seed, id_col).withColumn("mode", F.lit(mode))


def split_mode(detected: Column, stated: Column) -> Column:
    """How a sample's source was cut: as stated, where that is a mode, else as its labels say."""
    return F.when(stated.isin(*MODES), stated).otherwise(detected)


def source_segments(samples: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds source_start, source_end and skipped (word arrays) to samples (source text, mode, n_start, n_end words).

    These are the human parts that the mode keeps of the source, and what it leaves out; null where the source is too
    short to be cut. Each mode's rows go through its own cut only.
    """
    none = F.array().cast("array<string>")
    by_mode = {m: samples.where(F.col("mode") == m) for m in MODES}
    words = lambda m: once(by_mode[m], _w=tokens(F.col(text_col)))
    start, end, n = F.col("n_start"), F.col("n_end"), F.size("_w")
    rest = F.when((end > 0) & (start + end < n), F.slice("_w", start + 1, n - start - end)).otherwise(F.slice("_w", start + 1, n))
    parts = [
        words("append").withColumns({"source_start": F.slice("_w", F.lit(1), start), "source_end": none, "skipped": F.slice("_w", start + 1, n)}).drop("_w"),
        splits.prefix_suffix(by_mode["halves"], text_col).withColumns({"source_start": F.col("prefix"), "source_end": none, "skipped": F.col("suffix")}).drop("prefix", "suffix", "how", "reason"),
        # as many words as there are where none stand after the generated ones
        words("sandwich").withColumns({"source_start": F.slice("_w", F.lit(1), start), "source_end": F.when(end > 0, F.slice("_w", F.greatest(n - end + 1, F.lit(1)), end)).otherwise(F.col("_w")), "skipped": rest}).drop("_w"),
        splits.three_parts(by_mode["thirds"], text_col).withColumns({"source_start": F.col("begin"), "source_end": F.col("end"), "skipped": F.col("middle")}).drop("begin", "middle", "end", "how", "reason"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def compared(samples: DataFrame) -> DataFrame:
    """Adds start_match and end_match: whether recovered human words are those of the source."""
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return samples.withColumns({"start_match": same("human_start", "source_start"), "end_match": same("human_end", "source_end")})
