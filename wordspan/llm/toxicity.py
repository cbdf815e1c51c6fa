"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary documents.

A class's model gives a word its continuation count (distinct words seen before it), less a discount; what is discounted
backs off to the same distribution over stems, and that to word counts shared by both classes, taken from the whole
corpus. Rare and inflected expressions thus get their likelihood from their stem and from the shared counts. Every word
and stem of the labelled documents counts; those that have just what they would back off to are not sent. A
document's score compares its two log-likelihoods, divided by a power of its number of words, through a logistic curve.
The curve, the power (0: evidence adds up however long the text, 1: it is diluted by every other word), and how far apart
the models must be on a word for it to count, are fitted across two halves of the labelled documents, each scored by the
models of the other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordspan.llm.common import arrow_pass, parts, stage, texts, where_arrow

#: Labelled rows that models learn from at most.
MOST_LABELLED = 200_000
#: Absolute discount (counts up to it are left to the backoff), and words a document counts as at least.
DISCOUNT, LEAST_WORDS = 2.0, 8
#: Step of the log ratios up to which the models may be taken not to tell a word apart: from 0 to the largest; the halves decide.
CUT_STEP = 1.0
#: Powers of its number of words by which a document's ratio may be divided; the halves decide.
POWERS = (1.0, 0.75, 0.5, 0.25, 0.0)
#: Characters of a stem.
STEM = 6
#: ASCII characters other than letters and digits separate words.
SEPARATE = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalnum()})


#: Words that a task keeps the codes of at once, and bytes of text it works on at once.
MOST_HELD, PART_BYTES = 200_000, 4 << 20


class Words(dict):
    """Places of words in the order they were met, with a 64-bit code for each and one for its stem."""

    def __init__(self):
        self.codes: list[int] = []
        self.stems: list[int] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self.codes)
        self.codes.append(xxhash.xxh64_intdigest(word))
        self.stems.append(xxhash.xxh64_intdigest(word[:STEM]))
        return at

    def of(self, text: str) -> np.ndarray:
        """The places of the words of the lower-cased text."""
        return np.array(list(map(self.__getitem__, text.lower().translate(SEPARATE).split())), np.int64)

    def arrays(self, since: int = 0) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array(x[since:], np.uint64).view(np.int64) for x in (self.codes, self.stems))


def places(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Each code's place from 1 on, or 0."""
    if not len(sorted_codes):
        return np.zeros(len(codes), np.int64)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return np.where(sorted_codes[at] == codes, at + 1, 0)


@dataclass
class Model:
    """Log-likelihood ratios of units: words that differ from their stem, then stems that stand for other words."""

    words: np.ndarray  # sorted codes
    stems: np.ndarray
    ratio: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)
    power: float = 1.0

    def units(self, codes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Places 0.. are words; from len(words) on stems, the first of which is the unknown stem."""
        word = places(self.words, codes[0]) - 1
        rest = np.flatnonzero(word < 0)
        word[rest] = len(self.words) + places(self.stems, codes[1][rest])
        return word

    def cut(self, least: float) -> Model:
        """The model without ratios up to `least`; words that then have what their stem has are still kept apart."""
        return Model(self.words, self.stems, np.where(np.abs(self.ratio) > least, self.ratio, 0.0))

    def slim(self, stem_of: np.ndarray) -> Model:
        """Without words and stems whose ratio is what they would back off to."""
        n = len(self.words)
        unknown = self.ratio[n]
        by_stem = np.concatenate([[unknown], self.ratio[n + 1 :]])[places(self.stems, stem_of)]
        apart, known = self.ratio[:n] != by_stem, self.ratio[n + 1 :] != unknown
        return Model(self.words[apart], self.stems[known], np.concatenate([self.ratio[:n][apart], [unknown], self.ratio[n + 1 :][known]]))

    def ratios(self, values: list[str]) -> np.ndarray:
        """Each text's log-likelihood ratio a word."""
        total, n = Reader(self).by_cut(values, [0.0])
        return total[:, 0] / n


class Reader:
    """Reads texts by a model; the ratio of a word is looked up once while the word is held."""

    def __init__(self, model: Model):
        self.model, self.words, self.ratio = model, Words(), np.zeros(0)

    def by_cut(self, values: list[str], cuts) -> tuple[np.ndarray, np.ndarray]:
        """Each text's log-likelihood ratio, without ratios up to each of several cuts, as columns; and its words."""
        if len(self.words) > MOST_HELD:
            self.words, self.ratio = Words(), np.zeros(0)
        found = list(map(self.words.of, values))
        if len(self.words) > len(self.ratio):
            self.ratio = np.concatenate([self.ratio, self.model.ratio[self.model.units(self.words.arrays(len(self.ratio)))]])
        n, own = np.array(list(map(len, found)), np.int64), np.concatenate([np.zeros(0, np.int64), *found])
        # each text's sum by the number of cuts that a ratio exceeds; a cut keeps all from its own number on
        exceeded, width = np.searchsorted(cuts, np.abs(self.ratio)), len(cuts) + 1
        at = np.repeat(np.arange(len(values)) * width, n) + exceeded[own]
        by_number = np.bincount(at, self.ratio[own], len(values) * width).reshape(-1, width)
        return by_number[:, :0:-1].cumsum(axis=1)[:, ::-1], np.maximum(n, LEAST_WORDS).astype(float)

    def scores(self, values: list[str]) -> np.ndarray:
        (slope, shift), (total, n) = self.model.curve, self.by_cut(values, [0.0])
        return 1 / (1 + np.exp(-np.clip(slope * total[:, 0] / n**self.model.power + shift, -40, 40)))


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """code, stem, n: how often each word occurs in the corpus. A task adds up the words it holds before it sends them."""

    def run(batches):
        words, n = Words(), np.zeros(0, np.int64)

        def counted():
            code, stem = words.arrays()
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(stem), pa.array(n)], ["code", "stem", "n"])

        for batch in batches:
            for part in parts(batch, PART_BYTES):
                met = np.concatenate([words.of(t) for t in texts(part, text_col)])
                n = np.bincount(met, minlength=len(words)) + np.pad(n, (0, len(words) - len(n)))
                if len(words) > MOST_HELD:
                    yield counted()
                    words, n = Words(), np.zeros(0, np.int64)
        yield counted()

    made = docs.select(text_col).mapInArrow(run, "code long, stem long, n long")
    return made.groupBy("code").agg(F.min("stem").alias("stem"), F.sum("n").alias("n"))


CLASSES = ("ordinary", "toxic")
HALVES = {"first": 1, "second": 2, "whole": 3}


def continuation_counts(labelled: DataFrame, text_col: str) -> DataFrame:
    """code, and for each class and each half and the whole, after how many distinct words the class has the word."""

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, found = Words(), {}
            for t, y, half in zip(texts(batch, text_col), batch.column("toxic").to_pylist(), batch.column("half").to_pylist(), strict=True):
                own = words.of(t)
                found.setdefault(half << 2 * y, []).append(np.concatenate([[-1], own])[:-1] << 32 | own)
            rows = {bit: np.unique(np.concatenate(own)) for bit, own in found.items()}
            pair = np.concatenate(list(rows.values()))
            code = words.arrays()[0]
            # the word before, in 32 bits: only within the pairs of one word must it be told apart
            before = np.concatenate([code, [0]])[pair >> 32] >> 32 if len(code) else pair
            where = np.repeat(np.array(list(rows), np.int32), list(map(len, rows.values())))
            return pa.RecordBatch.from_arrays([pa.array(code[pair & 0xFFFFFFFF]), pa.array(before.astype(np.int32)), pa.array(where)], ["code", "before", "where"])

        return turn

    # where: a bit for each half of the ordinary class (1, 2) and of the toxic one (4, 8)
    pairs = arrow_pass(labelled.select(text_col, "toxic", "half"), each, "code long, before int, where int", PART_BYTES)
    met = pairs.groupBy("code", "before").agg(F.bit_or("where").alias("where"))
    counts = [F.count_if(F.col("where").bitwiseAND(F.lit(bits << 2 * y)) > 0).alias(f"{h}_{c}") for h, bits in HALVES.items() for y, c in enumerate(CLASSES)]
    return met.groupBy("code").agg(*counts)


def by_stem(known: DataFrame) -> DataFrame:
    """The stems of words that a class has: corpus counts, and for each half and the whole the words and their counts."""
    words = [F.count_if(F.col(f"{h}_{CLASSES[0]}") + F.col(f"{h}_{CLASSES[1]}") > 0).alias(f"{h}_words") for h in HALVES]
    sums = [F.sum(f"{h}_{c}").alias(f"{h}_{c}") for h in HALVES for c in CLASSES]
    return known.groupBy("stem").agg(F.sum("n").alias("n"), *words, *sums).where("whole_words > 0")


def fetched(rows: DataFrame, by: str) -> dict[str, np.ndarray]:
    """Whole numbers as arrays by column, in the order of one."""
    made = rows.toArrow()
    order = np.argsort(np.asarray(made.column(by)), kind="stable")
    return {c: np.asarray(made.column(c))[order] for c in made.column_names}


def learnt(known: DataFrame, known_stems: DataFrame, half: str) -> tuple[Model, np.ndarray]:
    """The model of a half or the whole, all ratios kept, and the stems of its words.

    `known` has the corpus count, stem and continuation counts of every word, `known_stems` those of stems. A word that no class has more often than
    the discount has its stem's ratio whatever its counts, and such a stem that of the unknown stem; they enter the sums
    in Spark and only the others are fetched.
    """
    own = [F.col(f"{half}_{c}").alias(c) for c in CLASSES]
    own_counts = known.select("code", "stem", "n", *own, (F.col(f"{half}_{CLASSES[0]}") + F.col(f"{half}_{CLASSES[1]}") > 0).alias("seen"))
    stems = known_stems.select("stem", "n", F.col(f"{half}_words").alias("words"), *own).where("words > 0")
    often = " or ".join(f"{c} > {DISCOUNT}" for c in CLASSES)
    spare = [F.sum(F.least(F.col(c).cast("double"), F.lit(DISCOUNT))).alias(f"spare_{c}") for c in CLASSES]
    of_words = own_counts.agg(F.sum("n").alias("n"), F.count_if("seen").alias("units"), *(F.sum(c).alias(c) for c in CLASSES), *spare).first()
    of_stems = stems.agg(F.count("*").alias("units"), *spare).first()
    word, stem = fetched(own_counts.where(often).drop("seen"), "code"), fetched(stems.where(often), "stem")

    # Every unit (word, other words of a stem, words of unknown stems) has half an occurrence more.
    total = (of_words["n"] or 0) + 0.5 * (of_words["units"] + of_stems["units"] + 1)
    in_stem = (stem["n"] + 0.5 * (stem["words"] + 1)) / total
    shared = (word["n"] + 0.5) / total
    of = places(stem["stem"], word["stem"]) - 1
    logs = []
    for c in CLASSES:
        own = max(1.0, float(of_words[c] or 0))
        spare_word, spare_stem = (max(float(r[f"spare_{c}"] or 0) / own, 1e-6) for r in (of_words, of_stems))
        likely = np.maximum(stem[c] - DISCOUNT, 0) / own + spare_stem * in_stem
        words = np.maximum(word[c] - DISCOUNT, 0) / own + spare_word * likely[of] * shared / in_stem[of]
        # for other words the shared part is the same in both classes
        logs.append([np.log(words), np.log([spare_word * spare_stem]), np.log(spare_word * likely / in_stem)])
    ratio = np.concatenate([b - a for a, b in zip(*logs, strict=True)])
    return Model(word["code"], stem["stem"], ratio), word["stem"]


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Slope, shift and mean loss of a logistic curve by Newton's method, with a weak pull to a rise of 1 a deviation.

    A curve never falls: a higher ratio is never a lower score. With one class only, every score is the same.
    """
    if not len(x) or y.min() == y.max():
        return 0.0, 8.0 if len(x) and y.max() == 1 else -8.0, np.inf
    scale = x.std() or 1.0
    a = np.stack([(x - x.mean()) / scale, np.ones(len(x))], axis=1)
    w, prior, pull = np.array([1.0, 0.0]), np.array([1.0, 0.0]), np.diag([0.1, 1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + pull
        step = np.linalg.solve(h, a.T @ (y - p) - pull @ (w - prior))
        w = w + np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    w[0] = max(w[0], 0.1)
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale), float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", most_labelled: int = MOST_LABELLED) -> Model:
    """Learns a model from the documents that `labels` (id, toxic) marks; `usable`: a condition on the id.

    About `most_labelled` labelled rows at most, chosen by a hash of the id, are used, so they can be broadcast; word
    counts come from all of `docs`. Rows that are labelled twice count as toxic if one label says so; null labels and
    ids don't count; without labels of both classes every score is the same. Repeated documents each count.
    """
    spark = docs.sparkSession
    marks = labels.where(usable & F.col("toxic").isNotNull()).groupBy(id_col).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = marks.count()
    if n > most_labelled:
        marks = marks.where(F.pmod(F.xxhash64(F.lit(3), id_col), F.lit(1 << 40)) < int((1 << 40) * (most_labelled / n)))
    # the halves have as many documents of either class; at most `most_labelled` rows are put in order
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64(F.lit(5), id_col), id_col))
    marks = stage(marks.withColumn("half", (1 + place % 2).cast("int")))
    marked = docs.select(id_col, text_col).join(F.broadcast(marks), id_col)

    found = continuation_counts(marked, text_col)
    known = stage(word_counts(docs, text_col).join(found, "code", "left").na.fill(0))
    known_stems = stage(by_stem(known))
    models = {2: learnt(known, known_stems, "first")[0], 1: learnt(known, known_stems, "second")[0]}
    # chance ratios grow with the corpus, so what may be left out has no fixed bound
    cuts = np.arange(0.0, max(max(float(np.abs(m.ratio).max()) for m in models.values()), CUT_STEP), CUT_STEP).tolist()
    sent = spark.sparkContext.broadcast(models)
    del models

    def each():
        readers = {h: Reader(model) for h, model in sent.value.items()}

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            values, half = texts(batch, text_col), batch.column("half").to_numpy()
            x, n = np.zeros((len(values), len(cuts))), np.zeros(len(values))
            for h, reader in readers.items():
                own = np.flatnonzero(half == h)
                x[own], n[own] = reader.by_cut([values[i] for i in own], cuts)
            return pa.RecordBatch.from_arrays([*map(pa.array, x.T), pa.array(n), batch.column("toxic")], [*(f"x{k}" for k in range(len(cuts))), "n", "y"])

        return turn

    kinds = ", ".join(f"x{k} double" for k in range(len(cuts)))
    rows = arrow_pass(marked.select(text_col, "toxic", "half"), each, f"{kinds}, n double, y int", PART_BYTES).toArrow()
    y, n = np.asarray(rows.column("y")).astype(float), np.asarray(rows.column("n"))
    curves = {(cut, power): fit_curve(np.asarray(rows.column(f"x{k}")) / n**power, y) for k, cut in enumerate(cuts) for power in POWERS}
    del rows
    sent.destroy()
    cut, power = min(curves, key=lambda k: curves[k][2])
    whole, stem_of = learnt(known, known_stems, "whole")
    pa.default_memory_pool().release_unused()
    model = whole.cut(cut).slim(stem_of)
    model.curve, model.power = curves[cut, power][:2], power
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts are scored as texts without words; repeated rows alike."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each():
        reader = Reader(sent.value)
        return lambda batch: pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(reader.scores(texts(batch, text_col)))], ["doc_id", "score"])

    return arrow_pass(docs.select(id_col, text_col), each, "doc_id long, score double", PART_BYTES)


def ordinary(docs: DataFrame, model: Model, from_score: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose score is below `from_score`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each():
        reader = Reader(sent.value)
        return lambda batch: (reader.scores(texts(batch, text_col)) < from_score).tolist()

    return where_arrow(docs, each)
