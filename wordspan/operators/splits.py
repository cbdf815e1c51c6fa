"""Cutting human texts into parts: balanced by sentences, by words, and the plans of what to generate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordspan.functions.labels import build
from wordspan.functions.once import once
from wordspan.functions.rng import draw
from wordspan.functions.text import join_words, sentences, tokens, total

# Moves of a balancer at most, words of a part and of a text that is cut by words.
MOVES, LEAST_PART, LEAST_TEXT = 10, 2, 30


def two_way_cut(lengths: Column) -> Column:
    """How many sentences the first half has; `lengths` has those of two sentences or more.

    From the middle, a sentence at a time moves to the shorter side while that helps, ten times at most. The state holds
    both sides' lengths, so the sentences are summed up once.
    """
    n = F.size(lengths)
    k = F.greatest(F.lit(1), F.floor(n / 2).cast("int"))
    start = F.struct(k.alias("k"), total(F.slice(lengths, F.lit(1), k)).alias("head"), total(F.slice(lengths, k + 1, n)).alias("tail"), F.lit(False).alias("done"))

    def move(state: Column, _: Column) -> Column:
        k, head, tail = state["k"], state["head"], state["tail"]
        last, nxt = F.get(lengths, k - 1), F.get(lengths, k)
        step = F.when(state["done"] | (k <= 1) | (k >= n - 1), 0).when(head > tail, -1).when(head + nxt < tail - nxt, 1).otherwise(0)
        moved = F.when(step == -1, -last).when(step == 1, nxt).otherwise(0)
        return F.struct((k + step).alias("k"), (head + moved).alias("head"), (tail - moved).alias("tail"), (step == 0).alias("done"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOVES)), start, move)["k"]


def three_way_cut(lengths: Column) -> Column:
    """(a, b): sentences before the middle, and before the end; `lengths` as above, of three sentences or more.

    A sentence moves across a cut while the larger side stays the larger; of the four moves the first that applies.
    """
    n = F.size(lengths)
    a, b = F.floor(n / 3).cast("int"), F.floor(2 * n / 3).cast("int")
    parts = {"first": F.slice(lengths, F.lit(1), a), "second": F.slice(lengths, a + 1, b - a), "third": F.slice(lengths, b + 1, n)}
    start = F.struct(a.alias("a"), b.alias("b"), *(total(v).alias(c) for c, v in parts.items()), F.lit(False).alias("done"))

    def move(state: Column, _: Column) -> Column:
        a, b, first, second, third = (state[c] for c in ("a", "b", "first", "second", "third"))
        before_a, after_a, before_b, after_b = (F.get(lengths, k) for k in (a - 1, a, b - 1, b))
        stop = state["done"] | (a <= 1) | (b <= a + 1) | (b >= n - 1)
        which = F.when(stop, 0).when(first - second > 2 * before_a, 1).when(second - third > 2 * before_b, 2).when(second - first > 2 * after_a, 3).when(third - second > 2 * after_b, 4).otherwise(0)
        step_a = F.when(which == 1, -1).when(which == 3, 1).otherwise(0)
        step_b = F.when(which == 2, -1).when(which == 4, 1).otherwise(0)
        over_a = F.when(which == 1, -before_a).when(which == 3, after_a).otherwise(0)
        over_b = F.when(which == 2, -before_b).when(which == 4, after_b).otherwise(0)
        return F.struct((a + step_a).alias("a"), (b + step_b).alias("b"), (first + over_a).alias("first"), (second - over_a + over_b).alias("second"), (third - over_b).alias("third"), (which == 0).alias("done"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOVES)), start, move)


def joined(parts: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(parts, start, length), "")


def with_sentences(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds _words, _parts (sentences) and _lengths (of these), each worked out once a row."""
    cut = once(docs, _words=tokens(F.col(text_col)), _parts=sentences(F.col(text_col)))
    return once(cut, _lengths=F.transform("_parts", F.length))


def prefix_suffix(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds prefix, suffix (word arrays), how (sentences, words) and reason (why there are none).

    By sentences if there are two or more and both parts have two words; else by words, which takes thirty.
    """
    few = lambda c: F.size(c) < LEAST_PART
    out = once(with_sentences(docs, text_col), _k=F.when(F.size("_parts") >= 2, two_way_cut(F.col("_lengths"))))
    out = once(out, _p=tokens(joined(F.col("_parts"), F.lit(1), F.col("_k"))), _s=tokens(joined(F.col("_parts"), F.col("_k") + 1, F.size("_parts"))))
    n = F.size("_words")
    half = F.greatest(F.lit(LEAST_PART), F.floor(n / 2).cast("int"))
    how = F.when(F.col("_k").isNotNull() & ~few("_p") & ~few("_s"), "sentences").when(n >= LEAST_TEXT, "words")
    out = out.withColumn("how", how)
    by_words = F.col("how") == "words"
    parts = {"prefix": F.when(by_words, F.slice("_words", F.lit(1), half)).when(F.col("how") == "sentences", F.col("_p")), "suffix": F.when(by_words, F.slice("_words", half + 1, n)).when(F.col("how") == "sentences", F.col("_s")), "reason": F.when(F.col("how").isNull(), "too few words")}
    return out.withColumns(parts).drop("_words", "_parts", "_lengths", "_k", "_p", "_s")


def three_parts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds begin, middle, end (word arrays), how and reason, like prefix_suffix."""
    out = once(with_sentences(docs, text_col), _c=F.when(F.size("_parts") >= 3, three_way_cut(F.col("_lengths"))))
    a, b, parts = F.col("_c.a"), F.col("_c.b"), F.col("_parts")
    cut = {"_b": joined(parts, F.lit(1), a), "_m": joined(parts, a + 1, b - a), "_e": joined(parts, b + 1, F.size(parts))}
    out = once(out, **{k: tokens(v) for k, v in cut.items()})
    n = F.size("_words")
    first = F.greatest(F.lit(LEAST_PART), F.floor(n / 3).cast("int"))
    second = F.least(F.greatest(first + LEAST_PART, F.floor(2 * n / 3).cast("int")), n - LEAST_PART)
    enough = F.least(F.size("_b"), F.size("_m"), F.size("_e")) >= LEAST_PART
    out = out.withColumn("how", F.when(F.col("_c").isNotNull() & enough, "sentences").when(n >= LEAST_TEXT, "words"))
    by = {"begin": ("_b", F.slice("_words", F.lit(1), first)), "middle": ("_m", F.slice("_words", first + 1, second - first)), "end": ("_e", F.slice("_words", second + 1, n))}
    out = out.withColumns({k: F.when(F.col("how") == "words", w).when(F.col("how") == "sentences", F.col(s)) for k, (s, w) in by.items()})
    return out.withColumn("reason", F.when(F.col("how").isNull(), "too few words")).drop("_words", "_parts", "_lengths", "_c", "_b", "_m", "_e")


def between(low: Column | int, high: Column, seed: int, *keys: Column | str) -> Column:
    low = F.lit(low) if isinstance(low, int) else low
    return (low + draw(seed, *keys, below=high - low + 1)).cast("int")


def append_plan(docs: DataFrame, seed: int, id_col: str, least: int = 10, most: int = 100, text_col: str = "text") -> DataFrame:
    """Adds cut (words kept), need (words to write), kept and total, for texts of three words or more."""
    out = once(docs, _w=tokens(F.col(text_col))).where(F.size("_w") >= 3)
    key = F.col(id_col)
    out = out.withColumns({"cut": between(3, F.least(F.lit(100), F.size("_w")), seed, key, "cut"), "need": between(least, F.lit(most), seed, key, "need")})
    return out.withColumns({"kept": join_words(F.slice("_w", F.lit(1), F.col("cut"))), "total": F.col("cut") + F.col("need")}).drop("_w")


def sandwich_plan(docs: DataFrame, seed: int, id_col: str, least: int = 50, most: int = 300, text_col: str = "text") -> DataFrame:
    """Adds start, tail (words kept at both ends), need, head_text and tail_text, for texts of fifteen words or more."""
    out = once(docs, _w=tokens(F.col(text_col))).where(F.size("_w") >= 15)
    key, n = F.col(id_col), F.size("_w")
    out = out.withColumns({"need": between(least, F.lit(most), seed, key, "need"), "start": between(3, F.greatest(F.lit(3), F.least(F.lit(50), F.floor(n / 3).cast("int"))), seed, key, "start")})
    out = out.withColumn("tail", between(3, F.greatest(F.lit(3), F.least(F.lit(50), n - F.col("start") - 1)), seed, key, "tail"))
    return out.withColumns({"head_text": join_words(F.slice("_w", F.lit(1), F.col("start"))), "tail_text": join_words(F.slice("_w", -F.col("tail"), F.col("tail")))}).drop("_w")


def token_budget(words: Column) -> Column:
    """Tokens to ask a generator for."""
    return F.greatest(F.lit(64), 2 * words.cast("int") + 20)


def summary_words(words: Column) -> Column:
    return F.greatest(F.lit(20), F.least(F.floor(words / 2).cast("int"), F.lit(150)))


def mixed(before: Column, generated: Column, after: Column | None = None) -> Column:
    """(full_text, labels) of human words, generated words and, for a sandwich, human words again."""
    runs = [(0, before), (1, generated), *([] if after is None else [(0, after)])]
    return F.struct(join_words(F.concat(*(w for _, w in runs))).alias("full_text"), build(*((label, F.size(w)) for label, w in runs)).alias("labels"))
