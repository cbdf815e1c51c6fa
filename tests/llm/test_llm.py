"""The numbered operators against brute force, on small tables with nulls, empty and long texts, ties and repeated rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from wordspan.llm import html_text, langid, toxicity
from wordspan.llm.bpe import encode_documents
from wordspan.llm.common import remainder
from wordspan.llm.components import components
from wordspan.llm.embed_dedup import near_vectors
from wordspan.llm.exact_dedup import build, exact_dedup, grouped, index_of, look_up, position
from wordspan.llm.ngram_join import near_documents
from wordspan.llm.packing import best_fit, cut, pack_documents
from wordspan.llm.sharding import shard_documents
from wordspan.llm.token_counts import Tree, count_edited, piece_counts

RANKS, TOKENIZER = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, size int, n int, digest string"


def corpus():
    random.seed(7)
    vocabulary = [f"{a}{b}" for a in ("al", "be", "ga", "de", "ép") for b in ("ta", "mma", "lta", "silon", "zu")]
    texts = [" ".join(random.choice(vocabulary) for _ in range(random.randint(1, 120))) for _ in range(60)]
    for i in range(0, 30, 3):  # near copies
        words = texts[i].split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [texts[0]] * 25 + [texts[1].replace(" ", "\n\t"), texts[1].upper(), None, "", " \n ", "   ", "\x1c", "a" * 5000, "x y " * 4000, "<|endoftext|> don't\r\n\r\n 'll  123", "\U0001f469‍\U0001f469 中文  中"]
    return [(i, t, None, 1, 2, "z") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_dedup(docs, none):
    got = {r["doc_id"]: r for r in exact_dedup(docs).collect()}
    groups = {}
    for i, t, *_ in corpus():
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i))
    assert len(got) == len(corpus())
    for key, own in groups.items():
        for _, i in own:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["text_sha256"]) == (min(own)[1], len(own), hashlib.sha256(key.encode()).hexdigest())
            assert r["kept"] == (i == min(own)[1])
    assert exact_dedup(none).count() == 0
    twice = exact_dedup(docs.limit(5).unionByName(docs.limit(5)))
    assert twice.count() == 10 and {r["group_size"] % 2 for r in twice.collect()} == {0}


def test_index_of_earlier_loads(spark):
    rows = spark.createDataFrame([(i, 5, hashlib.sha256(str(i % 40).encode()).digest(), i < 50) for i in range(90)], "doc_id long, n_points long, digest binary, old boolean")
    both = grouped(rows, 4)
    got = look_up(both.where("not old").drop("old"), index_of(both.where("old").drop("old"))).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in got) == sorted((k, len(range(k, 90, 40))) for k in range(40))


def test_perfect_hash_is_minimal():
    for n in (1, 2, 7, 500):
        keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), "<u8").reshape(-1, 4)
        pilots = build(keys)
        at = position(keys, pilots[(keys[:, 1] % np.uint64(len(pilots))).astype(int)], n)
        assert sorted(at.tolist()) == list(range(n))


def test_byte_bpe_round_trip(docs, none):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {i: t or "" for i, t, *_ in corpus()}
    for r in encode_documents(docs, RANKS, P.PATTERN).collect():
        assert r["ids"] == own.encode_ordinary(texts[r["doc_id"]]) and bytes(r["decoded"]).decode() == texts[r["doc_id"]]
    for r in encode_documents(docs, RANKS, P.PATTERN, digest_only=True).collect():
        ids = own.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert encode_documents(none, RANKS, P.PATTERN).count() == 0


def shingle_sets():
    out = {}
    for i, t, *_ in corpus():
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ")
        words = [w for w in words if w]
        out[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return out


def test_ngram_join(docs, none):
    sets = shingle_sets()
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_documents(docs).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in sets}
    assert near_documents(none).count() == 0


def test_regions_join_recursively(spark, monkeypatch):
    """Families around a few texts, at all distances, in regions of many blocks, against brute force."""
    from wordspan.llm import ngram_join

    random.seed(21)
    texts = []
    for family in range(6):
        base = [f"f{family}w{k}" for k in range(70)]
        for _ in range(70):
            words = list(base)
            for at in random.sample(range(70), random.choice([0, 1, 2, 4, 8, 12, 16])):
                words[at] = f"x{random.randint(0, 3)}"
            texts.append(" ".join(words))
    sets = [frozenset(tuple(t.split()[k : k + 5]) for k in range(66)) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    cut, parts = ngram_join.divided, []
    monkeypatch.setattr(ngram_join, "divided", lambda *a: parts.append(cut(*a)) or parts[-1])
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in near_documents(df).collect()} == dict(enumerate(root))
    assert sum(p.where("part <> 0").count() for p in parts) > 50
    assert len(set(root)) > 6


@pytest.mark.parametrize("across", [True, False])
def test_a_large_side_that_meets_a_few_rows_is_sent_once(spark, monkeypatch, across):
    from itertools import combinations

    from wordspan.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    sizes = {0: (2, 90), 1: (3, 4), 2: (20, 17), 3: (11, 0), 4: (0, 30)}
    rows = [(p, 0, 100 * side + k, side) for p, n in sizes.items() for side in (0, 1) for k in range(n[side])]
    met, sent = {p: set() for p in sizes}, dict.fromkeys(sizes, 0)
    cells = {}
    for r in ngram_join.dealt(spark.createDataFrame(rows, "p long, part long, x long, side int"), ["p", "part"], across).collect():
        cells.setdefault((r["p"], r["i"], r["j"]), []).append((r["x"], r["side"], r["block"]))
        sent[r["p"]] += 1
    for (p, i, j), own in cells.items():
        for (x, s, a), (y, t, b) in combinations(own, 2):
            if sorted((a, b)) == [i, j] and (s != t if across else s * t == 0):
                assert frozenset((x, y)) not in met[p]
                met[p].add(frozenset((x, y)))
    assert {p: len(m) for p, m in met.items()} == {p: n * m + (0 if across else n * (n - 1) // 2) for p, (n, m) in sizes.items()}
    assert sent[0] <= 90 + 2 * 13


def test_sharding(docs, none):
    got = shard_documents(docs, 4).collect()
    texts = {i: t for i, t, *_ in corpus()}
    assert sorted(r["doc_id"] for r in got) == sorted(texts) and set(got[0].asDict()) == {"doc_id", "text", "lang", "n", "digest", "size", "shard", "slot"}
    bytes_in, slots = [0] * 4, {}
    for r in got:
        assert r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1
        bytes_in[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(bytes_in) - min(bytes_in) <= 2 * max(r["size"] for r in got)
    assert shard_documents(none).count() == 0


def test_packing(docs, none):
    got = pack_documents(docs, TOKENIZER, most=64, open_bins=4, group_rows=40, with_ids=True).collect()
    by_doc, by_bin = {}, {}
    for r in got:
        assert len(r["ids"]) == r["length"] <= 64 and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_doc) == [i for i, *_ in corpus()]
    for own in by_doc.values():
        own.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist() and own[-1]["ids"][-1] == 0
    for own in by_bin.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist() and own[-1]["offset"] + own[-1]["length"] <= 64
    assert len(by_bin) <= 1.1 * sum(r["length"] for r in got) / 64 + 4
    assert pack_documents(none, TOKENIZER).count() == 0


def test_packing_of_repeated_and_null_ids(spark):
    long, other = " ".join(f"word{i}" for i in range(90)), " ".join(f"next{i}" for i in range(90))
    big = (1 << 60) + 1
    rows = [(1, long), (1, long), (None, long), (None, other), (None, "short"), (big, "short"), (None, None)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, most=64, with_ids=True).collect()
    by_bin = {}
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        by_bin.setdefault(r["sequence_id"], []).append(r)
    for own in by_bin.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist() and own[-1]["offset"] + own[-1]["length"] <= 64
    firsts = [r["doc_id"] for r in got if r["piece"] == 0]
    assert sorted(map(str, firsts)) == sorted(str(i) for i, _ in rows)


def test_pipeline_carries_null_ids(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "changed"])
    alone, spaced = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(3, " ".join(words)), (None, " ".join(words)), (None, near), (None, alone), (None, spaced), (None, spaced.replace(" ", "  ")), (9, "c d e"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(3, " ".join(words)), (None, near), (None, alone), (None, spaced.replace(" ", "  ")), (9, "c d e"), (None, None)]
    exact = corpus_pipeline.exact(spark, docs, "")
    assert sorted(map(repr, map(tuple, exact.collect()))) == sorted(map(repr, want))
    assert sorted(map(repr, map(tuple, corpus_pipeline.near(spark, exact, "").collect()))) == sorted(map(repr, [r for r in want if r[1] != near]))
    of = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs).collect()}
    assert of[None, hashlib.sha256("".join(words).encode()).hexdigest()] == (3, 2, None)
    assert of[None, hashlib.sha256(spaced.replace(" ", "").encode()).hexdigest()] == (None, 2, None)


def test_cut_and_best_fit():
    assert cut(1, 8) == [(0, 1)] and cut(8, 8) == [(0, 8)] and cut(17, 8) == [(0, 1), (1, 8), (9, 8)]
    bins, offsets, still_open = best_fit([5, 4, 3, 3], 8, 8)
    assert bins == [0, 1, 0, 1] and offsets == [0, 0, 5, 4] and still_open == [1]
    assert best_fit([5, 6, 7, 1], 8, 2)[0] == [0, 1, 2, 2]  # the bin with 6 is the fullest and closes


def test_toxicity_learns_held_out(spark):
    random.seed(9)
    common, bad = [f"word{i}" for i in range(300)], ["vile", "rotten", "filthy"]
    rows, marks = [], []
    for i in range(900):
        words = [random.choice(common) for _ in range(random.randint(30, 90))]
        if i % 4 == 0:
            for _ in range(3):
                words[random.randrange(len(words))] = random.choice(bad)
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 == 0)))
    rows += [(5000, None), (5001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (7, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels, remainder("doc_id", 3) != 1)).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = [(got[i] >= 0.7) == (i % 4 == 0) for i in held]
    assert sum(right) > 0.95 * len(right) and all(0 <= s <= 1 for s in got.values()) and got[5000] < 0.7
    same = toxicity.score(docs, toxicity.fit(docs, labels.limit(0), F.lit(True))).select("score").distinct().count()
    assert same == 1


def test_toxicity_knows_rare_words_of_a_large_vocabulary(spark):
    """More ordinary words than any fixed vocabulary, all as frequent as the toxic ones, with which they share stems."""
    random.seed(10)
    ordinary = [f"common{i}" for i in range(140_000)] * 5
    random.shuffle(ordinary)
    rows = [(i, " ".join(ordinary[i * 350 : (i + 1) * 350]), 0) for i in range(2000)]
    bad = [f"commonvile{i}" for i in range(40)]
    rows += [(2000 + i, " ".join(w for x in random.sample(bad, 40) for w in (random.choice(ordinary), x)), 1) for i in range(5)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert min(model.ratios(bad)) > 0 >= max(model.ratios(ordinary[:200]))


def auc(score, y):
    from itertools import product

    pairs = [(a > b) + 0.5 * (a == b) for (a, u), (b, v) in product(zip(score, y, strict=True), repeat=2) if u > v]
    return sum(pairs) / len(pairs)


@pytest.mark.parametrize(("sf", "least"), [("sf0.001", 0.6), ("sf0.01", 0.9)])
def test_toxicity_ranks_held_out_rows_of_the_tables(spark, sf, least):
    from wordspan.llm.queries import op2_toxicity

    folder = f"/root/testdata/{sf}"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    rows = op2_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    assert auc([r["score"] for r in rows], [r["toxic"] for r in rows]) > least
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 1


def test_toxicity_of_long_documents(spark):
    """A few toxic words are enough however many ordinary ones stand around them, and ordinary length adds nothing."""
    random.seed(11)
    common, bad = [f"word{i}" for i in range(300)], ["vile", "rotten", "filthy"]
    rows = []
    for i in range(1200):
        words = [random.choice(common) for _ in range(random.choice([20, 60, 200, 600, 4000]) if i < 800 or i % 2 else 4000)]
        if i % 4 == 0:
            for _ in range(random.randint(3, 6)):
                words[random.randrange(len(words))] = random.choice(bad)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels, F.lit(True))).collect()}
    held = range(800, 1200)
    assert min(got[i] for i in held if i % 4 == 0) >= 0.7 > max(got[i] for i in held if i % 4)


def test_toxicity_beside_many_words_that_a_class_lacks_by_chance(spark):
    """Names that toxic documents are too few to have had differ by more between the models than any fixed bound."""
    random.seed(12)
    common, names, bad = [f"w{i}" for i in range(200)], [f"n{i}" for i in range(3000)], [f"vile{i}x" for i in range(10)]
    rows = []
    for i in range(6000):
        n = random.choice([60, 200, 600])
        words = random.choices(common, k=n) + random.choices(names, k=n // 10) + random.choices(bad, k=4 if i % 20 == 0 else 0)
        random.shuffle(words)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(4000)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels, F.lit(True))).collect()}
    held = [(got[i] >= 0.7, i % 20 == 0) for i in range(4000, 6000)]
    assert sum(hit for hit, y in held if y) > 0.95 * sum(y for _, y in held) and sum(hit for hit, y in held if not y) <= 1


def test_toxicity_sums_by_cut():
    words = {"aa": 0.5, "bb": -3.0, "cc": 6.5, "dd": 2.0}
    code = {xxhash.xxh64_intdigest(w): r for w, r in words.items()}
    order = np.array(sorted(np.array(list(code), np.uint64).view(np.int64)))
    ratio = np.array([code[c] for c in order.view(np.uint64).tolist()] + [-0.25])
    model = toxicity.Model(order, np.zeros(0, np.int64), ratio)
    total, n = toxicity.Reader(model).by_cut(["aa bb cc dd dd", "", "zz cc"], [0.0, 1.0, 2.0, 3.0])
    assert total.tolist() == [[8.0, 7.5, 3.5, 6.5], [0.0] * 4, [6.25, 6.5, 6.5, 6.5]] and n.tolist() == [8.0] * 3
    assert [x.shape for x in toxicity.Reader(model).by_cut([], [0.0, 1.0])] == [(0, 2), (0,)]


def test_toxicity_counts_of_words_and_stems(spark):
    """A pair of words is one row whatever classes and halves have it; the counts of stems are made once for all models."""
    random.seed(13)
    vocabulary = ["shared", "sharedly", "sharedness", "vile", "vileness", "a", "b"]
    rows = [(" ".join(random.choices(vocabulary, k=random.randint(0, 6))), random.randint(0, 1), random.randint(1, 2)) for _ in range(40)]
    labelled = spark.createDataFrame(rows, "text string, toxic int, half int")
    counts = toxicity.continuation_counts(labelled, "text")
    exchanges = [x for x in counts._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2 and not any("toxic" in x for x in exchanges)
    met = {(w, b, y, h) for t, y, h in rows for b, w in zip(["", *t.split()], t.split(), strict=False)}
    of = {xxhash.xxh64_intdigest(w) - ((xxhash.xxh64_intdigest(w) >> 63) << 64): w for w in vocabulary}
    names = [(h, y, f"{h}_{c}") for h in toxicity.HALVES for y, c in enumerate(toxicity.CLASSES)]
    got = {of[r["code"]]: r for r in counts.collect()}
    want = {w: {c: len({b for v, b, u, k in met if v == w and u == y and (h == "whole" or toxicity.HALVES[h] == k)}) for h, y, c in names} for w in vocabulary}
    assert {w: {c: r[c] for _, _, c in names} for w, r in got.items()} == want
    known = toxicity.word_counts(spark.createDataFrame([*((t,) for t, _, _ in rows), ("other",)], "text string"), "text").join(counts, "code", "left").na.fill(0)
    stems = {r["stem"]: r for r in toxicity.by_stem(known).collect()}
    assert len(stems) == 5 and sum(r["n"] for r in stems.values()) == sum(len(t.split()) for t, _, _ in rows)
    shared = max(stems.values(), key=lambda r: r["whole_words"])
    assert all(shared[c] == sum(want[w][c] for w in vocabulary[:3]) for _, _, c in names)
    assert all(shared[f"{h}_words"] == sum(want[w][f"{h}_ordinary"] + want[w][f"{h}_toxic"] > 0 for w in vocabulary[:3]) for h in toxicity.HALVES)


def test_toxicity_of_empty_tables(spark, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.fit(none, labels, F.lit(True))).count() == 0
    twice = spark.createDataFrame([(1, "vile words here"), (1, "vile words here"), (None, "vile"), (2, "plain words")], "doc_id long, text string")
    got = toxicity.score(twice, toxicity.fit(twice, labels, F.lit(True))).collect()
    assert len(got) == 4 and len({r["score"] for r in got if r["doc_id"] == 1}) == 1


def test_language_id(spark):
    random.seed(5)
    syllables = {"aa": ["ka", "to", "mi", "su"], "bb": ["sch", "ung", "ber", "eit"], "cc": ["ción", "que", "los", "ñar"]}
    rows = [(i, " ".join("".join(random.choices(syllables[lang], k=3)) for _ in range(20)), lang) for i, lang in enumerate(random.choices(list(syllables), k=300))]
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "123 ?!", "bb"), (902, "kato", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.fit(docs, remainder("doc_id", 4) != 2)).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i]["lang_pred"] == lang for i, lang in held) > 0.97 * len(held)
    assert {got[i]["lang_pred"] for i in (900, 901)} == {"und"} and got[902]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = langid.predict(docs, langid.fit(docs.limit(0), F.lit(True))).select("lang_pred").distinct().collect()
    assert [r[0] for r in nothing] == ["und"]


def test_features_of_long_texts_add_up():
    text = "bücher und häuser " * 100_000
    whole = sum(len(f) for f in langid.each_feature(langid.letters(text)))
    n = len(langid.letters(text))
    assert whole == n + (n - 1) + (n - 2)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("no tags at all", "no tags at all"),
        ("<nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One<b>two</b>\n three<br>four<p>Last &lt;p&gt;</article><footer>(c)</footer>", "A & B Onetwo three four Last <p>"),
        ("<article><p>Text here</p><div class='comments'><p>I say so</p></div><aside>Ad</aside><form>Name</form><script>var a='<p>x</p>'</script></article>", "Text here"),
        ("<main><!-- <p>gone</p> --><p>5 < 6 and so on</p><style>p{}</style></main>", "5 < 6 and so on"),
        ("<article><p>never closed", "never closed"),
    ],
)
def test_html_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><meta charset=utf-8><body><article><p>Text here and more</p></article></body>",
        "<head><link href=x><article><p>Text here and more</p></article>",
        "<head><script>a = '<!--'</script></head><body><article><p>Text here and more</p></article></body>",
        "<body><div><select><option>One</div><article><p>Text here and more</p></article></body>",
        "<body><p><button>Go</p><article><p>Text here and more</p></article></body>",
        "<body><article><svg><g><p>a</p></svg><p>Text here and more</p></article></body>",
    ],
)
def test_html_after_unclosed_silent_elements(page):
    assert html_text.main_text(page) == "Text here and more"


PROSE = " ".join(["some words of prose"] * 12)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<div class="content with-sidebar"><article><h1>A title</h1><p>{PROSE}</p></article></div>', f"A title {PROSE}"),
        (f'<div class="legal"><article><p>{PROSE}</p></article></div>', PROSE),
        (f'<article><header class="article-header"><h1>A title</h1></header><p>{PROSE}</p></article>', f"A title {PROSE}"),
        (f"<article><p>{PROSE}</p><ul><li>One<li>Two</ul><table><tr><td>2<td>alpha<tr><td>3<td>beta</table></article>", f"{PROSE} One Two 2 alpha 3 beta"),
        (f"<div><div><a href=1>Home</a></div></div><div><h1>A title of words</h1><p>{PROSE}</p><p>{PROSE}</p></div><div><a href=2>Next page here</a></div>", f"A title of words {PROSE} {PROSE}"),
        (f'<main><p>{PROSE}</p><section class="comment-list"><article class="comment"><p>{PROSE}</p></article></section></main>', PROSE),
        (f'<article><svg viewBox="0 0 1 1"/><p>{PROSE}</p></article>', PROSE),
        (f'<article title="a > b"><p class=\'x">y\'>{PROSE} 1 < 2 </></p></article>', f"{PROSE} 1 < 2"),
        (f"<article><p>{PROSE}</p><a {PROSE}", PROSE),
        (f"<article><p>{PROSE}</p><!-- no end {PROSE}", PROSE),
    ],
)
def test_html_designs(page, text):
    assert html_text.main_text(page) == text


def test_html_time_is_linear():
    import time

    began = time.time()
    for page in ("<a " * 350_000, "<div>" * 200_000 + "</section>" * 200_000, "<p title='" * 100_000, "<!-- " * 200_000, "<script>" * 100_000, '<div class="a b">' * 60_000 + "x", "< " * 300_000, "<p =" * 200_000):
        html_text.main_text(page)
    assert time.time() - began < 30


def test_html_blocks_against_words_and_links():
    """The tree uses more than where a block stands: link lists go and prose stays where nothing is named."""
    weights, node = html_text.trained()
    used, todo = set(), [node]
    while todo:
        if isinstance(n := todo.pop(), tuple):
            used.add(n[0])
            todo += n[2:]
    assert used & {0, 1, 2, 3, 4, 5} and weights["comments"] < -1 < 1 < weights["content"]


def test_html_pages_against_brute_force(spark):
    """The given pages have one article element each; its text without tags is the main text."""
    import html
    import re

    from conftest import DATA

    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.read.parquet(f"{DATA}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"] or "", re.S)
        plain = re.sub(r"<(?:br|/?p|/?h\d)[^>]*>", " ", re.sub(r"<!--.*?-->|</?b>", "", inner[1], flags=re.S)) if inner else ""
        assert got[r["page_id"]] == " ".join(html.unescape(plain).split())


def test_html_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", "<article><p>é x</p></article>")], "page_id long, url string, html string")
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(pages).orderBy("page_id").collect()] == [(1, "", 0), (2, "é x", 3)]


def test_near_vectors(spark):
    random.seed(1)
    base = [np.random.default_rng(i).standard_normal(16) for i in range(60)]
    rows = [(i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 6] + 0.02 * np.random.default_rng(900 + i).standard_normal(16)).astype(np.float32).tolist(), i % 2) for i in range(30)]
    rows += [(200 + i, rows[2][1], 0) for i in range(20)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [1.0, None] * 8, 0), (304, rows[0][1], None), (305, [], 1), (306, [1.0], 1)]
    nulls = [(None, rows[5][1], 1), (None, [9.0] * 16, 1), (None, [9.0] * 16, 1)]
    good = {i: (np.array(v) / np.linalg.norm(v), lab) for i, v, lab in rows if i < 300}
    root, links = {i: i for i, *_ in rows}, {i: 0 for i, *_ in rows}
    for a in good:
        for b in good:
            if a != b and good[a][1] == good[b][1] and good[a][0] @ good[b][0] >= 0.98:
                links[a] += 1
                if root[a] != root[b]:
                    low, high = sorted((root[a], root[b]))
                    root = {i: low if r == high else r for i, r in root.items()}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in near_vectors(df).collect()}
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {i: (links[i], root[i]) for i in root}
    assert near_vectors(df.limit(0)).count() == 0
    with_nulls = near_vectors(spark.createDataFrame(rows + nulls, df.schema)).where("vec_id IS NULL").collect()
    assert sorted((r["n_links"], r["component_id"] is None) for r in with_nulls) == [(1, True), (1, True), (links[5] + 1, False)]


def test_trees_grow_and_find_the_pairs(spark, monkeypatch):
    """One label of 6000 vectors with planted pairs, a tight cluster and copies, against brute force in double precision."""
    from wordspan.llm import embed_dedup

    random_ = np.random.default_rng(5)
    base = random_.standard_normal((4000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = base[:1500] + random_.standard_normal((1500, 32)) * 0.19 / np.sqrt(32)
    tight = base[:1] + random_.standard_normal((500, 32)) * 0.01
    x = np.concatenate([base, near, tight]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 3) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(4)
    fetched, kind = [], type(df)
    real = kind.toPandas
    monkeypatch.setattr(kind, "toPandas", lambda self: fetched.append(real(self)) or fetched[-1])
    grown, forests = embed_dedup.grown, []
    monkeypatch.setattr(embed_dedup, "grown", lambda *a: forests.append(grown(*a)) or forests[-1])
    got = {r["vec_id"]: r for r in near_vectors(df).collect()}
    forest = forests[0]
    assert (forest.direction >= 0).sum() > 50 and np.median(forest.count[forest.direction < 0]) <= embed_dedup.LEAF
    assert all("vector" not in t.columns and len(t) <= len(forest.count) for t in fetched)  # sums by leaf, no vectors
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    links = (y @ y.T >= 0.98).sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum() > 1000
    pairs = [(i, 4000 + i) for i in range(1500) if y[i] @ y[4000 + i] >= 0.98]
    assert len(pairs) > 400 and sum(got[a]["component_id"] == got[b]["component_id"] for a, b in pairs) >= 0.98 * len(pairs)


def test_many_labels_and_large_leaves(spark, monkeypatch):
    from wordspan.llm import embed_dedup

    rows = [(i, np.random.default_rng(i % 150).standard_normal(8).tolist(), 0 if i < 90 else i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    plain = sorted(map(tuple, near_vectors(df).collect()))
    monkeypatch.setattr(embed_dedup, "LEAF", 20)
    monkeypatch.setattr(embed_dedup, "BLOCK", 10)
    monkeypatch.setattr(embed_dedup, "MOST_NODES", 40)  # room for two labels' roots only
    assert sorted(map(tuple, near_vectors(df).collect())) == plain


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 7), (5, 5)]
    got = {r["a"]: r["b"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, 7: 3}


def test_edited_counts(docs):
    pieces = piece_counts(RANKS, P.PATTERN)
    random.seed(11)
    letters = "ab \n\t' s123.,é  "
    for _ in range(300):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 60)))
        tree = Tree(text, pieces)
        for _ in range(3):
            a = random.randint(0, len(text))
            b = random.randint(a, min(len(text), a + 5))
            new = "".join(random.choice(letters) for _ in range(random.randint(0, 4)))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.total == sum(pieces.counts(pieces.find(text)))
    texts = {i: t or "" for i, t, *_ in corpus()}
    for r in count_edited(docs, RANKS, P.PATTERN, edits=lambda t: [(0, 1, "Z"), (len(t) // 2 + 1, len(t) // 2 + 2, "")] if len(t) > 4 else []).collect():
        t = texts[r["doc_id"]]
        after = "Z" + t[1 : len(t) // 2 + 1] + t[len(t) // 2 + 2 :] if len(t) > 4 else t
        assert (r["n_tokens"], r["n_tokens_edited"]) == tuple(sum(pieces.counts(pieces.find(x))) for x in (t, after))


def test_pipeline_keeps_columns_and_clean_documents(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(step(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in last.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_personal_data_is_found_in_linear_time():
    import time

    from wordspan.llm.token_counts import PERSONAL, personal_edits

    began = time.time()
    for text in ("a" * 1_000_000, "1." * 500_000, "@a" * 300_000, "1 " * 300_000 + "(" * 300_000, "a@" + "b." * 300_000):
        personal_edits(text)
    assert time.time() - began < 20
    random.seed(3)
    for _ in range(3000):
        text = "".join(random.choice("11234. -()+aé\n") for _ in range(random.randint(0, 60)))
        assert personal_edits(text) == [(m.start(), m.end(), "[removed]") for m in PERSONAL.finditer(text)]
    assert personal_edits("mail me.now+x@ex-am.ple.org, or 1.2.3.4") == [(5, 27, "[removed]"), (32, 39, "[removed]")]


def test_leaves_are_kept_and_edited_later(docs, none):
    from wordspan.llm.token_counts import apply_edits, leaf_table

    pieces = piece_counts(RANKS, P.PATTERN)
    texts = {i: t or "" for i, t, *_ in corpus()}
    cut_out = lambda t: [(0, 1, "Z"), (len(t) // 2 + 1, len(t) // 2 + 2, "")] if len(t) > 4 else []
    for r in apply_edits(leaf_table(docs, RANKS, P.PATTERN, cut_out), RANKS, P.PATTERN).collect():
        after = r["text"] if r["n_edits"] else texts[r["doc_id"]]
        assert bytes(r["leaves"]) == pieces.leaves([after])[0] or r["n_edits"]
        assert Tree(after, pieces, bytes(r["leaves"])).total == r["n_tokens_edited"] == sum(pieces.counts(pieces.find(after)))
        assert r["n_reencoded"] <= 30 or len(after) > 4000
    assert count_edited(none, RANKS, P.PATTERN).count() == 0


def test_memo_is_bounded_and_exact():
    from wordspan.llm.bpe import Chunks, cut, is_mixed

    made = []
    chunks = Chunks(lambda some: made.extend(some) or [f"<{x}>".encode() for x in some], most_bytes=6000)
    random.seed(4)
    for _ in range(30):
        values = ["".join(random.choice("abc  \n　") for _ in range(random.randint(0, 50))) for _ in range(20)]
        for text, got in zip(values, list(chunks.encoded(values)), strict=True):
            first, *rest = cut(text, is_mixed(text))
            assert got == b"".join(f"<{x}>".encode() for x in [first, *(" " + x for x in rest)])
        assert chunks.size <= 3000
    assert list(Chunks(lambda some: [x.encode() for x in some]).encoded(["a b  c", ""])) == [b"a b  c", b""]


def test_sharding_keeps_columns_of_any_name(docs):
    named = docs.select("doc_id", "text", *(F.lit(7).alias(c) for c in ("_h", "_t", "_cell", "_first")))
    got = shard_documents(named, 4)
    assert {"_h", "_t", "_cell", "_first"} <= set(got.columns)
    assert got.agg(F.min("_h"), F.max("_t"), F.sum("_cell") / F.count("*"), F.min("_first")).first()[:] == (7, 7, 7.0, 7)
