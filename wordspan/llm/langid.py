"""Language identification: multinomial logistic regression on TF-IDF weighted character n-grams.

Letters of the lower-cased text, with runs of anything else as one space, give n-grams of one to three characters,
hashed into a fixed number of features. Document frequencies come from every training document; the weights are trained
by follow-the-regularised-leader with elastic-net penalties on a bounded, stratified sample; a temperature fitted on
documents left out makes the scores probabilities. Frequencies are relative to the document, so a text's logits are a
sum over its n-grams and whole texts of any length are scored in fixed memory.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordspan.llm.common import arrow_pass, texts, where_arrow

#: Features, documents that a language trains on at most, passes over them, and the share kept for the temperature.
FEATURES, MOST_A_LANGUAGE, MOST_IN_ALL, PASSES, TEMPERATURE_FOLD = 1 << 17, 600, 20_000, 3, 5
#: FTRL: learning rate, its smoothing, and the elastic-net penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: Characters worked on at once, and the predicted language of texts without letters.
SLICE, UNKNOWN = 400_000, "und"
SPACE = ord(" ")


@lru_cache(1)
def letter_table() -> np.ndarray:
    """For each code point, itself if it is a letter, else a space."""
    return np.array([c if unicodedata.category(chr(c))[0] == "L" else SPACE for c in range(0x110000)], np.uint32)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text between two spaces; runs of other characters than letters are one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = letter_table()[points]
    gap = points == SPACE
    return points[~(gap & np.concatenate([[False], gap[:-1]]))]


def features(points: np.ndarray) -> list[np.ndarray]:
    """Hashed n-grams of one, two and three characters that begin at each place where one fits."""
    out, code = [], np.zeros(len(points), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, 4):
            code = (code[: len(points) - n + 1] + points[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
            out.append((code >> np.uint64(23)).astype(np.int64) & (FEATURES - 1))
    return out


def slices(points: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of at most SLICE starting places, each with the two characters that follow."""
    for i in range(0, max(1, len(points)), SLICE):
        yield points[i : i + SLICE + 2]


def each_feature(points: np.ndarray) -> Iterator[np.ndarray]:
    for part in slices(points):
        for n, f in enumerate(features(part), 1):
            yield f[: SLICE if len(part) == SLICE + 2 else len(part) - n + 1]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # FEATURES by languages and one more column, the features' idf
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, points: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.languages) + 1)
        for f in each_feature(points):
            total += self.weights.take(f, axis=0).sum(axis=0, dtype=np.float64)
        return total[:-1] / max(total[-1], 1e-9) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        points = letters(text or "")
        if len(points) < 2 or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(points) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """How many documents hold each feature; the last entry counts the documents."""

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            count, seen = np.zeros(FEATURES + 1, np.int64), np.zeros(FEATURES, bool)
            for text in texts(batch, text_col):
                for f in each_feature(letters(text)):
                    seen[f] = True
                held = np.flatnonzero(seen)
                count[held] += 1
                seen[held] = False
            count[-1] = batch.num_rows
            kept = np.flatnonzero(count)
            return pa.RecordBatch.from_arrays([pa.array(kept), pa.array(count[kept])], ["feature", "n"])

        return turn

    rows = arrow_pass(docs.select(text_col), each, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(FEATURES + 1)
    out[rows["feature"].to_numpy(int)] = rows["n"].to_numpy(float)
    return out


#: Steps of the draw that picks documents: a language of any size keeps its share.
STEPS = 1 << 40


def share(n: int, most: int) -> int:
    """Below which step, of STEPS, a document of a language with n of them is drawn, so that about `most` are."""
    return STEPS if n <= most else max(1, STEPS * most // n)


def sample_vectors(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int, most_in_all: int) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """(language, fold, features, counts) of up to about `most` documents of each language, chosen by a hash.

    Of rows that share id and text one is taken; with many languages each has an equal part of `most_in_all`.
    """
    sizes = docs.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n"))
    counts = {r["lang"]: r["n"] for r in sizes.orderBy(F.desc("n"), "lang").limit(most_in_all).collect()}
    most = max(1, min(most, most_in_all // max(1, len(counts))))
    # the hash of the id alone would take all rows of one id or none
    draw = F.pmod(F.xxhash64(F.lit(11), id_col, F.xxhash64(text_col)), F.lit(STEPS))
    below = docs.sparkSession.createDataFrame([(lang, share(n, most)) for lang, n in counts.items()], "lang string, below long")

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, counts = [], []
            for text in texts(batch):
                f, n = np.unique(np.concatenate(list(each_feature(letters(text)))), return_counts=True)
                found.append(f.astype(np.int32).tobytes())
                counts.append(n.astype(np.float32).tobytes())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary()), pa.array(counts, pa.binary())], ["lang", "fold", "f", "n"])

        return turn

    fold = F.pmod(F.xxhash64(F.lit(13), id_col), F.lit(TEMPERATURE_FOLD)).cast("int")
    given = docs.select(F.col(lang_col).alias("lang"), fold.alias("fold"), F.col(text_col).alias("text"), draw.alias("draw"))
    picked = given.join(F.broadcast(below), "lang").where("draw < below").dropDuplicates(["lang", "draw", "text"]).select("lang", "fold", "text")
    rows = arrow_pass(picked, each, "lang string, fold int, f binary, n binary").collect()
    made = [(r["lang"], r["fold"], np.frombuffer(r["f"], np.int32), np.frombuffer(r["n"], np.float32)) for r in rows]
    return sorted(made, key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes()))


def train(sample, idf: np.ndarray) -> Model:
    """FTRL-proximal with softmax loss over the sample in a fixed shuffled order; temperature by golden section."""
    languages = sorted({r[0] for r in sample})
    k = len(languages)
    if not k:
        return Model([], np.zeros((FEATURES, 1), np.float32), np.zeros(0))
    z, n = np.zeros((FEATURES, k)), np.zeros((FEATURES, k))
    bias = np.zeros(k)
    vectors = []
    for lang, fold, f, c in sample:
        x = c * idf[f]
        vectors.append((languages.index(lang), fold, f, x / max(x.sum(), 1e-9)))
    learn = [v for v in vectors if v[1]] or vectors
    random = np.random.default_rng(17)

    def weights(f: np.ndarray) -> np.ndarray:
        zf = z[f]
        return np.where(np.abs(zf) <= L1, 0.0, -(zf - np.sign(zf) * L1) / ((BETA + np.sqrt(n[f])) / ALPHA + L2))

    for _ in range(PASSES):
        for i in random.permutation(len(learn)):
            y, _, f, x = learn[i]
            w = weights(f)
            x = x * 30  # relative frequencies are small; a common scale for the penalties
            g = softmax(x @ w + bias)
            g[y] -= 1
            bias -= 0.02 * g
            grad = x[:, None] * g
            step = (np.sqrt(n[f] + grad**2) - np.sqrt(n[f])) / ALPHA
            z[f] += grad - step * w
            n[f] += grad**2
    w = weights(np.arange(FEATURES)) * 30
    model = Model(languages, np.concatenate([w * idf[:, None], idf[:, None]], axis=1).astype(np.float32), bias)
    held = [v for v in vectors if not v[1]] or vectors
    logits = np.array([x @ w[f] + bias for _, _, f, x in held])
    y = np.array([v[0] for v in held])

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean() + 1e-3 * t * t

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    model.temperature = float(np.exp((low + high) / 2))
    return model


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_a_language: int = MOST_A_LANGUAGE, most_in_all: int = MOST_IN_ALL) -> Model:
    """Learns from text and non-null language of the rows where `usable` holds.

    Document frequencies are those of all these rows. Weights are learnt from about `most_a_language` of them for each
    language, `most_in_all` at most, which the driver holds as counts of features; beyond that many languages the rarest
    aren't learnt. Null texts count as empty, null ids are ids like others, and rows that share id and text are drawn
    once. Without rows nothing is predicted but `und`.
    """
    learn = docs.where(usable & F.col(lang_col).isNotNull())
    df = document_frequencies(learn, text_col)
    idf = np.log((df[-1] + 1) / (df[:-1] + 1)) + 1
    return train(sample_vectors(learn, id_col, text_col, lang_col, most_a_language, most_in_all), idf)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row; `und` with score 0 for null texts and texts without a letter.

    Repeated rows and null ids each have their own row; an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            lang, p = zip(*map(sent.value.predict, batch.column(text_col).to_pylist()), strict=True)
            return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(lang), pa.array(p)], ["doc_id", "lang_pred", "score"])

        return turn

    return arrow_pass(docs.select(id_col, text_col), each, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter and a language predicted with a score of `least` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each():
        return lambda batch: [lang != UNKNOWN and p >= least for lang, p in map(sent.value.predict, batch.column(text_col).to_pylist())]

    return where_arrow(docs, each)
