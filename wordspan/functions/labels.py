"""Arrays of word labels: 0 for human, 1 for generated words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED = -100


def build(*runs: tuple[int, Column]) -> Column:
    """Labels of consecutive runs, each (label, words)."""
    return F.concat(*(F.array_repeat(F.lit(label), n.cast("int")) for label, n in runs))


def is_valid(words: Column, labels: Column) -> Column:
    """As many labels as words, and only 0 and 1."""
    return F.coalesce((F.size(words) == F.size(labels)) & F.forall(labels, lambda x: x.isin(0, 1)), F.lit(False))


def boundaries(labels: Column) -> Column:
    """Places after which the label changes."""
    places = F.when(F.size(labels) > 1, F.sequence(F.lit(0), F.size(labels) - 2)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: F.get(labels, i) != F.get(labels, i + 1))


def has_boundary(labels: Column) -> Column:
    return F.size(boundaries(labels)) > 0


def mode(labels: Column, sandwich: str = "sandwich") -> Column:
    """unknown without generated words; sandwich if human words follow the last of them, else append."""
    after_last = F.array_position(F.reverse(labels), 1)
    return F.when(after_last == 0, "unknown").when(after_last > 1, sandwich).otherwise("append")


def segments(words: Column, labels: Column) -> Column:
    """(human_start, generated, human_end): human words before the first and after it, and all generated words."""
    first = F.array_position(labels, 1).cast("int")
    cut = F.when(first == 0, F.size(words)).otherwise(first - 1)
    rows = F.arrays_zip(words.alias("w"), labels.alias("l"))

    def of(part: Column, label: int) -> Column:
        return F.transform(F.filter(part, lambda r: r["l"] == label), lambda r: r["w"])

    rest = F.slice(rows, cut + 1, F.size(words))
    return F.struct(F.slice(words, F.lit(1), cut).alias("human_start"), of(rest, 1).alias("generated"), of(rest, 0).alias("human_end"))


def align(labels: Column, word_ids: Column) -> Column:
    """Labels of subwords: a word's first subword has its label; the others and special tokens are ignored."""

    def at(w: Column, i: Column) -> Column:
        again = (i > 0) & F.coalesce(F.get(word_ids, i - 1) == w, F.lit(False))
        return F.when(w.isNull() | again, F.lit(IGNORED)).otherwise(F.coalesce(F.get(labels, w), F.lit(IGNORED)))

    return F.transform(word_ids, at)


def pad(values: Column, width: Column, filler: int) -> Column:
    """The array, filled up to `width`."""
    return F.concat(values, F.array_repeat(F.lit(filler), F.greatest(width - F.size(values), F.lit(0)).cast("int")))


def as_ints(labels: Column) -> Column:
    """Numbers as ints, whatever kind of number they are; null stays null, and a number that isn't whole is null."""
    return F.transform(labels, lambda x: F.when(x == F.floor(x), x.cast("int")))


def parsed_ints(text: Column) -> Column:
    """Labels that were stored as JSON text; null where it is no array of numbers."""
    return as_ints(F.from_json(text, "array<double>"))
