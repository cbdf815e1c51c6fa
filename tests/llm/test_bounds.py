"""Very long pre-tokens, edits that come later, draws from large languages, and columns of any name."""

import random
import re
import time
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

import wordspan.llm as llm
from wordspan.llm import bpe, html_text, labelled_pages, langid, packing
from wordspan.llm.exact_dedup import build, longest, position
from wordspan.llm.sharding import shard_documents
from wordspan.llm.token_counts import edited_table, leaf_table, piece_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def single():
    ranks = bpe.load_ranks(RANKS)
    core = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    return lambda raw: list(core.encode_single_piece(raw))


SHAPES = {
    "ab": lambda n: "ab" * (n // 2),
    "han": lambda n: "中文字" * (n // 9),
    "letters": lambda n: "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=n)),
    "mixed": lambda n: "".join(random.choices(["the", "ing", "中", "ab", "ß", "a"], k=n // 3)),
}


@pytest.mark.parametrize("shape", list(SHAPES))
def test_very_long_pretokens(single, shape):
    random.seed(1)
    merges, took = bpe.merges_of(RANKS), {}
    for n in (3_000, 250_000, 1_000_000):
        raw = SHAPES[shape](n).encode()
        began = time.process_time()
        ids = np.frombuffer(bpe.encode_many([raw, b"the end", raw[:40]], merges)[0], "<u4").tolist()
        took[n] = time.process_time() - began
        assert ids == single(raw)
    assert took[1_000_000] < 20 and took[1_000_000] < 8 * took[250_000] + 1


def test_crowded_pretokens_beside_others(single):
    """Some pre-tokens of a batch leave the arrays in between, others stay."""
    random.seed(4)
    pieces = ["".join(random.choices(["a", "b", "ab", "th", "e", "é", "中", "文"], k=random.choice((3, 20, 200)))).encode() for _ in range(150)]
    for raw, got in zip(pieces, bpe.encode_many(pieces, bpe.merges_of(RANKS)), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == single(raw)


def test_chunks_are_split_as_one_string_and_encoded_together():
    from wordspan.llm.bpe import Chunks, splitter

    find = regex.compile(P.PATTERN).findall
    chunks = ["", " ", " a", " don't", " x,y", "first", " \u3000b", " c\n", " \x1c", " d1\n\ne", " 'll", " \U0001f469", " e\u0301", "f g"] * 3

    def split(pattern, some):
        flat, spans = splitter(pattern)(some)
        return [flat[a:b] for a, b in spans]

    assert split(P.PATTERN, chunks) == list(map(find, chunks)) and split(P.PATTERN, []) == []
    spanning = r"\w \w|."  # a pattern whose matches span chunks
    assert split(spanning, [" ab", " cd"]) == [list(" ab"), list(" cd")]
    calls = []

    def encode(some):
        calls.append(len(some))
        return [x.encode() for x in some]

    texts = [f"w{k} w{k + 1} w{k % 7}" for k in range(50)] + ["", "one\n two"]
    assert [x.decode() for x in Chunks(encode).encoded(texts)] == texts
    assert len(calls) == 1  # first chunks with the new ones


def test_ranks_as_the_library():
    path = P.path("byte_bpe_50k.json")
    tokenizer, chunks = packing.library_tokenizer(path), packing.library_chunks(path)
    assert packing.ranked(path) is not None
    random.seed(6)
    marks = ["<|endoftext|>", "'s", "'LL", " ", "  ", "\n", "\t", "a", "Zoo", "é", "中", "1", "٣", "!", "…", " ", "　", "​", "\U0001f600", "́", "\x00", "\x1c", "\x85", "words", "x" * 5000]
    values = ["".join(random.choices(marks, k=random.randint(0, 30))) for _ in range(400)]
    for text, raw in zip(values, chunks.encoded(values), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    some = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]  # each character between letters, numbers, marks and spaces
    values = [f"a{c}a 1{c}1 !{c}! {c} {c}{c}x\n{c}b's{c}" for c in some]
    for text, raw in zip(values, chunks.encoded(values), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_edits_that_come_later(spark):
    random.seed(2)
    texts = {i: " ".join(random.choices(["word", "12345", "é中", "don't", "\n"], k=random.randint(1, 60))) for i in range(40)} | {40: "", 41: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    table = leaf_table(docs, RANKS, P.PATTERN).select("doc_id", "n_tokens", "leaves").cache()
    pieces = piece_counts(RANKS, P.PATTERN)
    for turn in range(2):
        changes, after = [], dict(texts)
        for i in random.sample(range(42), 15):
            text, at = texts[i] or "", 0
            cuts = sorted(random.sample(range(len(text) + 1), min(len(text) + 1, 6)))
            own = [(a, b, random.choice(["", "x", " new words", None])) for a, b in zip(cuts[::2], cuts[1::2], strict=False)] or [(0, 0, "start")]
            changes += [(i, a, b, new) for a, b, new in own]
            made = []
            for a, b, new in own:
                made.append(text[at:a] + (new or ""))
                at = b
            after[i] = "".join(made) + text[at:]
        edits = spark.createDataFrame([*changes, (None, 0, 0, "x"), (999, 0, 0, "x")], "doc_id long, start int, end int, new string")
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        table = edited_table(table, docs, edits, RANKS, P.PATTERN).cache()
        got = {r["doc_id"]: r for r in table.collect()}
        assert set(got) == set(texts)
        for i, r in got.items():
            assert r["n_tokens"] == sum(pieces.counts(pieces.find(after[i] or ""))), (turn, i)
            assert (r["n_edits"] > 0) == any(c[0] == i for c in changes) and (r["n_edits"] or not r["n_reencoded"])
        texts = after
    for bad in ([(1, 0, 5, "x"), (1, 3, 6, "y")], [(1, 0, 100_000, "x")]):
        edits = spark.createDataFrame(bad, "doc_id long, start int, end int, new string")
        with pytest.raises(Exception, match="overlap"):
            edited_table(table, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), edits, RANKS, P.PATTERN).collect()


def test_draw_from_large_languages():
    for n in (1, 600, 601, 10**6, 10**9, 10**12):
        below = langid.share(n, 600)
        assert 0 < below <= langid.STEPS
        assert n * below / langid.STEPS == pytest.approx(min(n, 600), rel=0.01)


def test_repeated_rows_are_drawn_once(spark):
    rows = [(1, "the same words again", "en")] * 3000 + [(i, f"the words of {i}", "en") for i in range(2, 60)] + [(i, f"die wörter von {i}", "de") for i in range(100, 160)] + [(None, "null id", "en")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    made = langid.sample_vectors(docs, "doc_id", "text", "lang", 5000, 10_000)
    assert len(made) == 59 + 60 + 1
    few = langid.sample_vectors(docs, "doc_id", "text", "lang", 20, 10_000)
    assert 0 < len(few) < 120
    model = langid.fit(docs, F.lit(True), most_a_language=50)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert got[1] == "en" and got[120] == "de"


def names_in(*modules):
    """Every name that stands quoted in the sources, helper columns among them."""
    folder = Path(llm.__file__).parent
    text = "".join((folder / f"{m}.py").read_text() for m in modules) + Path(corpus_pipeline.__file__).read_text()
    return sorted(set(re.findall(r"[\"'`]([A-Za-z_]\w{0,24})[\"'`]", text)) | {"__h", "__t", "__cell", "__first", "_id", "_digest", "_n", "__key", "key", "id", "digest", "a b", "a.b", "x`y"})


def with_columns(spark, rows, names):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    taken = {c.lower() for c in docs.columns}
    extra = []
    for n in names:
        if n.lower() not in taken:
            taken.add(n.lower())
            extra.append(n)
    return docs.select("*", *(F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(n) for n in extra))


ROWS = [(i, " ".join(f"word{(i * j) % 17}" for j in range(30)), "en", "s") for i in range(1, 12)] + [(20, "short text", "en", "s"), (21, "short text", "en", "s"), (22, None, "en", "s")]


def test_sharding_keeps_columns_of_any_name(spark):
    docs = with_columns(spark, ROWS, [n for n in names_in("sharding", "common") if n.lower() not in ("size", "shard", "slot")])
    got = shard_documents(docs, 3)
    assert got.columns == [*docs.columns, "size", "shard", "slot"]
    assert sorted(map(str, got.select(*docs.toDF(*(f"`{c.replace('`', '``')}`" for c in docs.columns)).columns).collect())) == sorted(map(str, docs.collect()))


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns_of_any_name(spark, k):
    modules = [("langid",), ("toxicity",), ("exact_dedup",), ("ngram_join", "components")][k]
    docs = with_columns(spark, ROWS, names_in(*modules, "common"))
    folder = "/root/testdata/sf0.001"
    got = corpus_pipeline.STAGES[k][1](spark, docs, folder)
    assert got.columns == docs.columns
    given = {r["doc_id"]: r for r in docs.collect()}
    kept = got.collect()
    assert kept and all(r == given[r["doc_id"]] for r in kept)


def test_longest_of_columns_like_its_own(spark):
    docs = with_columns(spark, ROWS, ["_id", "_digest", "_n", "id", "digest", "n"])
    assert sorted(r["doc_id"] for r in longest(docs).collect()) == [*range(1, 12), 20, 22]


def test_an_article_is_not_dropped_for_its_own_names():
    prose = " ".join(["some words of prose"] * 12)
    for tag, name in (("article", "legal"), ("article", "ad-review"), ("main", "comments"), ("article", "share sidebar")):
        assert html_text.main_text(f'<{tag} class="{name}"><p>{prose}</p></{tag}>') == prose
    assert html_text.main_text(f'<main><p>{prose}</p><article class="comment"><p>{prose}</p></article></main>') == prose


def test_words_and_links_tell_where_nothing_is_named():
    weights, _ = html_text.trained()
    right = n = 0
    for blocks, kept in html_text.marked_pages(labelled_pages.training_pages(seed=7)):
        for row, k in zip(html_text.rows_of(blocks, weights), kept, strict=True):
            n, right = n + 1, right + (html_text.is_article(row) == k)
    assert n > 1500 and right / n > 0.97
    changed = dict.fromkeys(("own", "before", "after"), 0)
    draw, at = random.Random(9), {"own": (0, 1), "before": (2, 3), "after": (4, 5)}
    for page in filter(labelled_pages.is_plain, labelled_pages.PAGES):
        blocks = html_text.blocks_of(labelled_pages.filled(labelled_pages.bare(page), draw))
        for row in html_text.rows_of(blocks, weights):
            for name, places in at.items():  # each block's and each neighbour's words and links decide somewhere
                fixed = tuple(((40, 0.0)[k % 2] if k in places else x) for k, x in enumerate(row))
                changed[name] += html_text.is_article(fixed) != html_text.is_article(row)
    assert all(changed.values()), changed


@pytest.mark.parametrize("n", [2, 4, 8, 16, 32, 64, 128])
def test_perfect_hashes_of_powers_of_two_are_found(n):
    rng = np.random.default_rng(n)
    for _ in range(300):
        keys = rng.integers(0, 1 << 63, (n, 4), dtype=np.uint64)
        pilots = build(keys)
        at = position(keys, pilots[(keys[:, 1] % np.uint64(len(pilots))).astype(int)], n)
        assert sorted(at.tolist()) == list(range(n)) and pilots.max() < 1 << 20
