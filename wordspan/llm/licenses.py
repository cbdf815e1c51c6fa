"""Licence scans by a generalised suffix automaton of the templates' words.

The automaton accepts every run of words that stands in some template. A file's words go through it one after the other:
its state and length after a word are the matching statistics, the longest run that ends there and stands in a template.
Runs that can't grow on, and are long enough or a whole template, are pieces; pieces of one template in the template's
order, near to each other, are chained, and a chain that covers enough of its template is a span of it. Phrases that
must be counted wherever they stand are read off the same states.

A pass over the rows without a shuffle: each text on its own, in slices, so memory doesn't grow with the text's words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from wordspan.llm.common import arrow_pass
from wordspan.llm.divergence import slices

#: A word of a lower-cased UTF-8 text: digits, a-z and whatever isn't ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Words of a piece, unless it is its whole template; words between two pieces of a chain; share of a template that a
#: span covers.
LEAST, GAP, SHARE = 4, 12, 0.5

# The phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, words) of notices that stand at the head of files, shortened to what tells them apart.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "use of this source code is governed by a bsd style license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("cc", "licensed under a creative commons attribution"),
    ("proprietary", "all rights reserved unauthorized copying of this file via any medium is strictly prohibited proprietary and confidential"),
]


@dataclass
class Automaton:
    """A generalised suffix automaton of sequences of words; state 0 is the empty run."""

    ids: dict[bytes, int] = field(default_factory=dict)
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    #: (template, place of the run's last word) of every state.
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])
    #: (phrase, its length) of the phrases that a state's longest run ends with.
    phrases: list[list[tuple[int, int]]] = field(default_factory=list)

    def new(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def split(self, at: int, word: int) -> int:
        """The state of the run that `at` and the word make, on its own if it shares one with longer runs."""
        own = self.next[at][word]
        if self.length[own] == self.length[at] + 1:
            return own
        copy = self.new(self.length[at] + 1, self.link[own], dict(self.next[own]))
        self.link[own] = copy
        while at >= 0 and self.next[at].get(word) == own:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self.split(last, word)
        made = self.new(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = made
            at = self.link[at]
        if at >= 0:
            self.link[made] = self.split(at, word)
        return made

    def walk(self, words: list[bytes]) -> int:
        at = 0
        for w in words:
            at = self.next[at][self.ids[w]]
        return at


def build(templates: list[list[bytes]], phrases: list[list[bytes]]) -> Automaton:
    """The automaton of templates and phrases; phrases are templates too, after the others."""
    made = Automaton()
    marks = []
    for t, words in enumerate([*templates, *phrases]):
        last = 0
        for k, w in enumerate(words):
            last = made.add(last, made.ids.setdefault(w, len(made.ids)))
            marks.append((t, k, words))
    for t, k, words in marks:
        at = made.walk(words[: k + 1])
        made.ends[at].append((t, k))
    order = sorted(range(1, len(made.next)), key=made.length.__getitem__)
    for at in reversed(order):  # a run stands wherever a longer one stands that ends with it
        made.ends[made.link[at]] += made.ends[at]
    made.ends[0] = []
    made.ends = [sorted(set(e)) for e in made.ends]
    own: dict[int, list[tuple[int, int]]] = {}
    for p, words in enumerate(phrases):
        own.setdefault(made.walk(words), []).append((p, len(words)))
    made.phrases = [[]] * len(made.next)
    for at in order:
        made.phrases[at] = own.get(at, []) + made.phrases[made.link[at]]
    return made


#: (template, first word in the text, last word in the text, first word in the template)
Piece = tuple[int, int, int, int]


@dataclass(frozen=True)
class Scan:
    """What a text holds: words, places of phrases as (phrase, first word), and pieces of templates."""

    words: int
    places: list[tuple[int, int]]
    pieces: list[Piece]


def scan(parts: Iterable[bytes], made: Automaton, sizes: list[int], least: int = LEAST) -> Scan:
    """Runs lower-cased slices of a text through the automaton."""
    ids, nexts, length, link, phrases, ends = made.ids, made.next, made.length, made.link, made.phrases, made.ends
    places: list[tuple[int, int]] = []
    pieces: list[Piece] = []
    n, state, size = 0, 0, 0

    def closed(last: int) -> None:
        """The run that ends at word `last` can't grow on."""
        for t, k in ends[state]:
            if size >= least or size == sizes[t]:
                pieces.append((t, last - size + 1, last, k - size + 1))

    for part in parts:
        words = WORD.findall(part)
        for i, w in enumerate(map(ids.get, words), n):
            if w is None:
                if size > 1:
                    closed(i - 1)
                state = size = 0
                continue
            if w in nexts[state]:
                state, size = nexts[state][w], size + 1
            else:
                if size > 1:
                    closed(i - 1)
                while state and w not in nexts[state]:
                    state = link[state]
                    size = length[state]
                state = nexts[state].get(w, 0)
                size = size + 1 if state else 0
            if size > 1:
                for p, long in phrases[state]:
                    if long <= size:
                        places.append((p, i - long + 1))
        n += len(words)
    if size > 1:
        closed(n - 1)
    return Scan(n, places, pieces)


#: (template, first word, last word, words of the template that are covered)
Span = tuple[int, int, int, int]


def chains(pieces: list[Piece], gap: int = GAP) -> Iterator[Span]:
    """Chains of one template's pieces, the best of each stretch first; stretches are over `gap` words apart.

    In a chain text and template go on from piece to piece; where two overlap the later one is cut. What is left of a
    stretch before and after its best chain is chained again.
    """
    pieces = sorted(pieces, key=lambda p: (p[1], p[2], p[3]))
    at = 0
    while at < len(pieces):
        to, end = at + 1, pieces[at][2]
        while to < len(pieces) and pieces[to][1] - end <= gap + 1:
            end = max(end, pieces[to][2])
            to += 1
        work = [pieces[at:to]]
        while work:
            own = work.pop()
            span = chained(own, gap)
            yield span
            for rest in ([p for p in own if p[2] < span[1]], [p for p in own if p[1] > span[2]]):
                if rest:
                    work.append(rest)
        at = to


def chained(own: list[Piece], gap: int) -> Span:
    """The best chain of a stretch: most words covered, then the first to start, then the shortest."""
    reach = gap + 1 + max(p[2] - p[1] for p in own)
    best: list[tuple[int, int]] = []  # words covered and first word of the best chain that ends with each piece
    first = 0
    for k, (_, start, end, begin) in enumerate(own):
        while own[first][1] < start - reach:
            first += 1
        most = (end - start + 1, start)
        for j in range(first, k):
            _, s, e, b = own[j]
            cut = max(0, e + 1 - start, b + (e - s) + 1 - begin)
            size = end - start + 1 - cut
            if size > 0 and end > e and start - e <= gap + 1:
                most = max(most, (best[j][0] + size, best[j][1]), key=lambda x: (x[0], -x[1]))
        best.append(most)
    k = min(range(len(own)), key=lambda k: (-best[k][0], best[k][1], own[k][2]))
    return own[k][0], best[k][1], own[k][2], best[k][0]


@dataclass(frozen=True)
class Templates:
    """Labelled templates and phrases, and their automaton."""

    labels: list[str]
    sizes: list[int]
    phrases: list[str]
    automaton: Automaton


def prepared(templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> Templates:
    words = [WORD.findall(t.encode().lower()) for _, t in templates]
    short = [WORD.findall(p.encode().lower()) for p in phrases]
    if not all(words) or min(map(len, short), default=2) < 2:
        raise ValueError("templates need a word, phrases two")
    return Templates([*(label for label, _ in templates), *phrases.values()], [*map(len, words), *map(len, short)], list(phrases.values()), build(words, short))


def spans(found: Scan, given: Templates, gap: int = GAP) -> list[Span]:
    """All chains of all templates, by template and first word."""
    by: dict[int, list[Piece]] = {}
    for p in found.pieces:
        by.setdefault(p[0], []).append(p)
    return sorted(s for own in by.values() for s in chains(own, gap))


SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first_word: bigint, last_word: bigint, covered: double>>"


def scan_documents(docs: DataFrame, given: Templates | None = None, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document, with what licences its text names or quotes.

    n_words; n_base, first_word and last_word: number, least and greatest first word of the phrases' places, overlapping
    ones too; base_labels: of the phrases; labels: of phrases and spans (distinct, sorted, joined by commas); score: the
    largest share of a template that a chain covers, 1 with a phrase, 0 without a piece; spans: chains that cover at
    least `share` of their template, by label and first word. A template that repeats has a span each time.

    Words are those of the whole text with A-Z lowered, counted from 0. Null text counts as empty: no words, score 0.
    Rows that repeat and null ids are scanned each; other columns are not looked at; an empty table gives none.
    """
    given = given or prepared()

    def each():
        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for raw in batch.column("text").cast(pa.binary()):
                found = scan((p.lower() for p in slices(raw.as_py() or b"", BREAK)), given.automaton, given.sizes)
                covered = [(given.labels[t], a, b, n / given.sizes[t]) for t, a, b, n in spans(found, given)] if found.pieces else []
                kept = sorted(s for s in covered if s[3] >= share)
                base = {given.phrases[p] for p, _ in found.places}
                starts = [a for _, a in found.places]
                score = 1.0 if base else max((s[3] for s in covered), default=0.0)
                out.append((found.words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {s[0] for s in kept})), score, [dict(zip(("label", "first_word", "last_word", "covered"), s, strict=True)) for s in kept]))
            shape = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]))
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), shape]
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            return pa.record_batch([batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

        return turn

    named = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    return arrow_pass(named, each, SCANNED)
