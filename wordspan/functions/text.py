"""Words, sentences and small string helpers, as columns.

A word is a maximal run of characters that are not Unicode white space; an empty text has no words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that separate words.
SPACE_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACES = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Printable ASCII characters are told by one range; only others are held against all that separate words.
WORD = rf"(?:[!-~]++|[^{SPACE_CLASS}])+"
# Fixed value: a sentence runs up to and with its end marks, or to the end of the text.
SENTENCE = r"[^.!?]*[.!?]+|[^.!?]+$"


def tokens(text: Column) -> Column:
    """The words of a text; null for null."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("int")


def join_words(words: Column) -> Column:
    return F.array_join(words, " ")


def is_blank(text: Column) -> Column:
    """Null, or without a word."""
    return F.coalesce(~F.regexp_like(text, F.lit(WORD)), F.lit(True))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def sentences(text: Column) -> Column:
    """Sentences with their end marks and leading white space; a text without one is its own, a blank text has none."""
    whole = strip(text)
    found = F.filter(F.regexp_extract_all(whole, F.lit(SENTENCE), F.lit(0)), lambda s: strip(s) != "")
    return F.when(is_blank(text), F.array().cast("array<string>")).when(F.size(found) == 0, F.array(whole)).otherwise(found)


def first_words(text: Column, n: int) -> Column:
    """The first n words, or all of a shorter text; the rest of the text is not looked at."""
    opening = rf"^[{SPACE_CLASS}]*+(?:{WORD}+[{SPACE_CLASS}]++){{0,{max(0, n - 1)}}}+(?:{WORD}+)?"
    return F.slice(tokens(F.regexp_extract(text, opening, 0)), 1, n)


def has_words(text: Column, n: int) -> Column:
    """Whether the text has n words; null and blank texts have none."""
    return F.size(first_words(F.coalesce(text, F.lit("")), n)) >= n


#: Lengths that are summed up in a row by block_starts.
SUMMED = 32


def block_starts(lengths: Column) -> Column:
    """Running sums at every SUMMED-th place, from 0."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / SUMMED).cast("int")), lambda j: total(F.slice(lengths, j * SUMMED + 1, F.lit(SUMMED))))
    add = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["starts"], F.array(acc["sum"])).alias("starts"))
    return F.aggregate(blocks, F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("starts")), add)["starts"]


def sum_before(lengths: Column, starts: Column, k: Column) -> Column:
    """The sum of the first k lengths, from the block_starts of the lengths."""
    block = F.floor(k / SUMMED).cast("int")
    return F.get(starts, block) + total(F.slice(lengths, block * SUMMED + 1, k - block * SUMMED))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def starts_equal(words: Column, other: Column, count: int = 0) -> Column:
    """Whether the first `count` words agree; 0: as many as `other` has, 20 at most."""
    n = F.lit(count) if count else F.least(F.lit(20), F.size(other))
    return F.slice(words, F.lit(1), n) == F.slice(other, F.lit(1), n)


def preview(text: Column, length: int = 120) -> Column:
    """The start of a text on one line, with an ellipsis if there is more."""
    flat = F.translate(text, "\n", " ")
    return F.concat(F.left(flat, F.lit(length)), F.when(F.length(flat) > length, "...").otherwise(""))


def setting(value: Column) -> Column:
    """A setting's value without a trailing # comment."""
    return F.trim(F.substring_index(value, "#", 1))


def number_or_infinite(value: Column) -> Column:
    """A price; what is missing or no number costs infinitely much."""
    return F.coalesce(value.try_cast("double"), F.lit(float("inf")))


def chunk_range(name: Column) -> Column:
    """(lo, hi) from the last two numbers of a name like split_lo_hi.ext, or null."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    number = lambda k: F.regexp_extract(stem, r"_(\d+)_(\d+)$", k).cast("long")
    return F.when(F.regexp_like(stem, F.lit(r"_\d+_\d+$")), F.struct(number(1).alias("lo"), number(2).alias("hi")))
