"""Hard negatives, licence scans and source divergence against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import pairwise

import duckdb
import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from wordspan.llm import divergence as D
from wordspan.llm import hard_negatives as H
from wordspan.llm import licenses as L
from wordspan.llm.queries import ORACLE_SQL, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, id long, v string, row int, score double"


def rows_of(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    got = QUERIES[name](spark, DATA)
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = c.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    want = sorted(found.fetchall())
    assert sorted(got.columns) == sorted(columns) and want
    assert rows_of(got, columns) == want


def vectors():
    random.seed(5)
    out = [(i, [random.choice((-1.0, 1.0)) * random.random() ** 3 + (0.6 if d == i % 3 else 0) for d in range(20)], i % 4 if i % 3 else 0) for i in range(160)]
    out += [(200, out[0][1], 0), (201, out[0][1], 1), (202, out[0][1], 1), (203, None, 1), (204, [0.5, None], 1), (205, [float("nan")] * 20, 1), (206, [float("inf")] * 20, 0), (207, out[1][1], None), (None, out[1][1], 1)]
    out += [(208, [0.5, -0.25], 2), (209, [], 2), (300, [3e38] * 20, 2), (20, out[20][1], out[20][2]), (21, out[21][1], out[21][2])]
    return out


def mined(rows, every):
    held = [(i, [max(-H.MOST, min(H.MOST, math.floor(256 * float(np.float32(x))))) for x in v], label) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    product = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, v, label in held:
        if i % every == 0:
            scored = sorted((-product(v, w), j, k) for j, w, k in held if j != i)
            for p, j, _ in [x for x in scored if x[2] == label][:5]:
                window = [x for x in scored if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
                out += [(i, j, r, k, -p, -s) for r, (s, k, _) in enumerate(window, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("block", [8192, 30])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "ANCHORS", block // 4)
    df = spark.createDataFrame([(*r, 1, "x", 2, 3.0) for r in vectors()], VECTORS)
    assert rows_of(H.mine(df, F.col("vec_id") % 10 == 0), COLUMNS) == mined(vectors(), 10)


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert H.mine(none, F.col("vec_id") % 10 == 0).count() == 0
    some = spark.createDataFrame([(*r, 1, "x", 2, 3.0) for r in vectors()[:20]], VECTORS)
    assert H.mine(some, F.lit(None).cast("boolean")).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1, 1, "x", 2, 3.0)], VECTORS)
    assert H.mine(alone, F.col("vec_id") == 0).count() == 0


def test_scan_drops_candidates_and_stays_exact():
    """Bounds must let go of candidates before the last dimension, else the scan is a plain product."""
    rng = np.random.default_rng(3)
    columns = rng.integers(-40, 41, (64, 4000))
    columns[:4] *= 30
    anchor = columns[:, 0].copy()
    looked = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            out = super().__getitem__(at)
            if isinstance(at, np.ndarray) and out.ndim == 2:
                looked.append(out.shape)
            return out

    ids, rows = np.arange(4000), np.arange(1, 4000)
    scores = anchor @ columns
    windows = [(-np.inf, np.inf), (int(0.3 * scores[1:].max()), int(0.5 * scores[1:].max()))]
    for window in windows:
        got = H.scan(anchor, columns.view(Watched), columns.min(1), columns.max(1), rows, ids, [window], 5)[0]
        fit = [r for r in rows if window[0] <= scores[r] <= window[1]]
        want = sorted(fit, key=lambda r: (-scores[r], r))[:5]
        assert got[0].tolist() == want and got[1].tolist() == [scores[r] for r in want]
    assert min(n for _, n in looked) < 400


def runs(words, sequences):
    """The longest run that ends at each word and stands in a sequence, the slow way."""
    held = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    out = []
    for i in range(len(words)):
        n = min(i + 1, 60)
        while n and tuple(words[i + 1 - n : i + 1]) not in held:
            n -= 1
        out.append(n)
    return out


def pieces_of(words, sequences, least=L.LEAST):
    sizes = runs(words, sequences)
    out = []
    for i, n in enumerate(sizes):
        if n > 1 and (i + 1 == len(sizes) or sizes[i + 1] != n + 1):
            run = words[i + 1 - n : i + 1]
            out += [(t, i + 1 - n, i, k) for t, s in enumerate(sequences) for k in range(len(s) - n + 1) if s[k : k + n] == run and (n >= least or n == len(s))]
    return sorted(out)


def license_texts():
    random.seed(3)
    templates = [t.split() for _, t in L.TEMPLATES]
    common = sorted({w for t in templates for w in t})
    texts = [None, "", " \n", "MIT license", "the mit\tLicense, mit license; MIT-LICENSE", "Apache License apache licenses general public license", "İ MIT License é", "\x00mit\x00license"]
    for k in range(60):
        words = []
        for _ in range(random.randint(1, 6)):
            t = list(random.choice(templates))
            kind = random.randrange(5)
            if kind == 0:
                t = t[random.randrange(len(t)) :]
            elif kind == 1:
                for _ in range(3):
                    t[random.randrange(len(t))] = random.choice([*common, "zebra"])
            elif kind == 2:
                at = random.randrange(len(t))
                t[at:at] = [random.choice(common) for _ in range(random.randint(1, 20))]
            elif kind == 3:
                t = [random.choice(common) for _ in range(30)]
            words += t + ["filler"] * random.randint(0, 20)
        texts.append(random.choice([" ", ", ", "\n"]).join(w.upper() if random.random() < 0.2 else w for w in words))
    return texts


def test_matching_statistics_and_pieces():
    given = L.prepared()
    sequences = [L.WORD.findall(t.encode()) for _, t in L.TEMPLATES] + [p.encode().split() for p in L.PHRASES]
    for text in license_texts():
        raw = (text or "").encode().lower()
        found = L.scan([raw], given.automaton, given.sizes)
        assert sorted(found.pieces) == pieces_of(L.WORD.findall(raw), sequences)
        for size in (1, 7, 50):
            cut = L.scan(L.slices(raw, L.BREAK, size), given.automaton, given.sizes)
            assert cut == found


def longest_chain(own, gap):
    """The best chain over all subsets that go on in text and template."""
    best = None

    def grow(chain, covered):
        nonlocal best
        key = (-covered, chain[0][1], chain[-1][2])
        best = key if best is None else min(best, key)
        _, s, e, b = chain[-1]
        for p in own:
            cut = max(0, e + 1 - p[1], b + e - s + 1 - p[3])
            if p > chain[-1] and (size := p[2] - p[1] + 1 - cut) > 0 and p[2] > e and p[1] - e <= gap + 1:
                grow([*chain, p], covered + size)

    for p in own:
        grow([p], p[2] - p[1] + 1)
    return best


def test_chains_against_all_chains():
    random.seed(9)
    for _ in range(200):
        own = sorted({(0, s := random.randrange(40), s + random.randrange(1, 6), random.randrange(30)) for _ in range(random.randint(1, 8))}, key=lambda p: (p[1], p[2], p[3]))
        _, first, last, covered = L.chained(own, 12)
        assert (-covered, first, last) == longest_chain(own, 12)


def test_license_scan(spark):
    texts = license_texts()
    df = spark.createDataFrame([(i if i != 4 else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, labels string, n_words int").repartition(3)
    got = {r["doc_id"]: r for r in L.scan_documents(df.unionByName(df.where("doc_id = 3"))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i if i != 4 else None]
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        starts = [(k, label) for p, label in L.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"]) == (len(words), len(starts))
        assert (r["first_word"], r["last_word"]) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in starts}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert set(r["labels"].split(",")) - {""} == {s["label"] for s in r["spans"]} | {x for _, x in starts}
    whole = {label: t for label, t in L.TEMPLATES}
    texts = [f"lead {whole['bsd']} tail " + "x " * 40 + whole["bsd"], "redistribution and use of zebras in binary stars", whole["isc"].replace("software", "program")]
    found = [r for r in L.scan_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [(s["label"], s["covered"], s["first_word"]) for s in found[0]["spans"]] == [("bsd", 1.0, 1), ("bsd", 1.0, len(whole["bsd"].split()) + 42)]
    assert found[1]["labels"] == "" and found[2]["labels"] == "isc" and found[2]["score"] < 1
    assert L.scan_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_query_base_columns(spark):
    """Every column that SQL can give, over the whole table."""
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    sql = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    f(p, label) AS (VALUES (['mit', 'license'], 'mit'), (['apache', 'license'], 'apache'), (['general', 'public', 'license'], 'gpl')),
    s AS (SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda k: w[k + 1:k + len(p)] = p)) AS k FROM d, f)
    SELECT d.doc_id, len(any_value(w)), count(k), min(k), max(k), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '')
    FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    assert rows_of(QUERIES["op12_license_scan"](spark, DATA).fillna(-1), columns) == sorted(tuple(-1 if x is None else x for x in r) for r in c.execute(sql).fetchall())


def audited(rows, least=3, most=200):
    docs = [(lang or "", source or "", Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        having = Counter(t for _, _, c in own for t in c)
        kept = sorted(t for t in having if having[t] >= least)
        counts = defaultdict(Counter)
        for _, source, c in own:
            counts[source].update(c)
        whole = sum(counts.values(), Counter())
        share = lambda c, kept=kept: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        p = {s: share(c) for s, c in counts.items()}
        q = share(whole)
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            out += [(lang, s, part, item, -v, r) for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])) for r, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def divergent():
    random.seed(2)
    words = [f"{a}{b}" for a in ("al", "Be", "ga", "é", "中") for b in ("ta", "mma", "É", "zu", "\U0001f600", "ﬀ")]
    rows = [(random.choice(("en", "de")), f"s{min(random.randrange(12), 6)}", " ".join(random.choices(words, weights=range(1, 31), k=random.randint(1, 60)))) for _ in range(120)]
    rows += [rows[0]] * 9 + [(None, None, "ta ta"), (None, "s1", "x"), ("en", None, None), ("en", "only", "unseen"), ("en", "empty", ""), ("fr", "a", "one"), ("fr", "b", "two"), ("fr", "ab", None), ("es", "single", "uno dos uno")]
    return [*rows, ("de", "s1", "lange " * 5000)]


@pytest.mark.parametrize("terms, sources", [(8192, 64), (4, 3)])
def test_divergence(spark, monkeypatch, terms, sources):
    monkeypatch.setattr(D, "TERMS", terms)
    monkeypatch.setattr(D, "SOURCES", sources)
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in divergent()], "lang string, source string, text string, n int, term string, total int").repartition(3)
    assert rows_of(D.divergence(df), ["lang", "source", "part", "item", "value", "rank"]) == audited(divergent())


def test_divergence_of_nothing_and_many_terms(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert D.divergence(none).count() == 0
    rows = [("en", s, " ".join(f"w{'abcdefghij'[k // 100]}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k % 10]}" for k in range(0, 600, step))) for s, step in (("a", 1), ("b", 1), ("c", 2), ("d", 3))]
    assert rows_of(D.divergence(spark.createDataFrame(rows, "lang string, source string, text string"), most_terms=7), ["lang", "source", "part", "item", "value", "rank"]) == audited(rows, most=7)


def test_trees_share_nodes_and_price_pairs_once():
    counts = np.zeros((3, 1000), np.int64)
    counts[0, :8], counts[1, :8], counts[2, 500:508] = range(8), range(8), range(8)
    trees = D.Trees(counts)
    assert trees.roots[0] == trees.roots[1] != trees.roots[2]
    assert sum(trees.sizes) < 100  # of 3 * 1024 leaves and the nodes above them
    asked = []

    def leaf(x, y):
        asked.append(len(x))
        return (x - y) ** 2 + 1

    assert trees.price(0, 2, leaf) == int(((counts[0] - counts[2]) ** 2 + 1).sum()) and asked[0] <= 16
    at, x, y = trees.counts(0, 2)
    assert sorted(at) == list(range(1, 8)) and trees.values[x].tolist() == counts[0][at].tolist() and trees.values[y].tolist() == counts[2][at].tolist()


def test_large_counts_are_exact():
    counts = np.array([0, 3, 10**13])
    assert D.shares(counts, 10**13, 3, 10**9).tolist() == [1 + 10**9 * (c + 1) // (10**13 + 3) for c in (0, 3, 10**13)]


def test_slices_end_between_words():
    raw = b"ab cd, efg" * 40
    for size in (1, 3, 64):
        parts = list(D.slices(raw, D.BREAK, size))
        assert b"".join(parts) == raw and [w for p in parts for w in D.TERM.findall(p)] == D.TERM.findall(raw)
        assert all(not (a[-1:].isalpha() and b[:1].isalpha()) for a, b in pairwise(parts))
    assert list(D.slices(b"", D.BREAK)) == [b""]
