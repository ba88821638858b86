"""License scan: matching statistics of texts against templates, chained into covered spans.

All templates, token by token, are in one generalised suffix automaton.  A text is
streamed through it: after every word the automaton's state and depth say how long
the longest run of words that ends here and stands in some template is.  Of each
template position at which such a run ends, the match is taken where it can't go on
(``Automaton.matches``), so every maximal match of ``shortest`` words or more is
found, with its place in each template that holds it.

Matches of one template that lie at most ``gap`` words apart, in the text and in the
template, chain in rising order; a chain's cover is the number of template words
that its matches hold.  Chains that lie apart give spans of their own.  A span of
``cover`` of its template or more adds the template's label, unless it lies inside
another one that covers as many words (``outer``).

Phrases (the base labels) are in the same automaton: a phrase ends where its state
is on the suffix path of the current one and the depth reaches its length.

Work is linear in the text: outside of matches a word costs one lookup, inside one
step per template place.  Templates and phrases are broadcast: they are a parameter
of some thousand words, counted against ``MOST_TOKENS``.

Defined cases: a null or empty text has no words, places, labels or spans, and the
score 0; texts of any length are read whole; repeated rows give equal results;
extra columns are ignored; ids may be of any type, or null.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import text_batches

#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Short forms in which well-known licences are named, and openings of their texts.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Words of the shortest match, words that may lie between two matches, and the share of a template that gives its label.
SHORTEST, GAP, COVER = 3, 8, 0.8
MOST_TOKENS = 100_000

#: ASCII letters lower-cased; everything that isn't an ASCII letter, a digit or beyond ASCII is a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Match(NamedTuple):
    """``length`` words from ``start`` of the text are those from ``at`` of the template."""

    start: int
    length: int
    template: int
    at: int


class Span(NamedTuple):
    label: str
    start: int
    end: int
    template: int
    template_start: int
    template_end: int
    covered: int
    share: float


class Automaton:
    """A generalised suffix automaton of templates and phrases over words."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]] = ()):
        self.labels = [label for label, _ in templates]
        self.texts = [words_of(text) for _, text in templates]
        self.phrases = [(words_of(text), label) for text, label in phrases]
        every = self.texts + [words for words, _ in self.phrases]
        if sum(map(len, every)) > MOST_TOKENS:
            raise ValueError(f"templates hold more than {MOST_TOKENS} words")
        if not all(every):
            raise ValueError("templates and phrases must hold words")
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.depth = [-1], [0]
        #: template places that end in a state itself, not in those above it
        self.own: list[list[tuple[int, int]]] = [[]]
        ends: dict[int, int] = {}
        for k, words in enumerate(every):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word)
                if k < len(self.texts):
                    self.own[last].append((k, at))
            if k >= len(self.texts):
                ends[k - len(self.texts)] = last
        order = sorted(range(1, len(self.depth)), key=self.depth.__getitem__)
        #: all template places that end in a state, longest states first into their suffixes
        self.places = [list(p) for p in self.own]
        for state in reversed(order):
            if self.link[state] > 0:
                self.places[self.link[state]] += self.places[state]
        #: lengths of the phrases on a state's suffix path
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.depth]
        for phrase, state in ends.items():
            self.ending[state].append((len(self.phrases[phrase][0]), phrase))
        for state in order:
            if self.link[state] > 0:
                self.ending[state] = self.ending[state] + self.ending[self.link[state]]

    def _state(self, depth: int, link: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.depth.append(depth)
        self.own.append([])
        return len(self.depth) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state of exactly one word more than ``state``, cut off the one that its edge leads to where that is deeper."""
        target = self.next[state][word]
        if self.depth[target] == self.depth[state] + 1:
            return target
        copy = self._state(self.depth[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.depth[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def statistics(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, int]]:
        """``(i, state, length)`` of every word at which some template word ends: the longest run up to word i."""
        edges, link, depth = self.next, self.link, self.depth
        root = edges[0]
        state = length = 0
        for i, word in enumerate(words):
            if not state:
                if word in root:
                    state, length = root[word], 1
                    yield i, state, 1
                continue
            found = edges[state].get(word)
            while found is None and state:
                state = link[state]
                length = depth[state]
                found = edges[state].get(word)
            if found is None:
                length = 0
                continue
            state, length = found, length + 1
            yield i, state, length

    def scan(self, words: Sequence[bytes], shortest: int = SHORTEST) -> tuple[list[tuple[int, int]], list[Match]]:
        """Places of the phrases as ``(start, phrase)``, and all maximal matches of ``shortest`` words or more."""
        phrases: list[tuple[int, int]] = []
        matches: list[Match] = []
        for i, state, length in self.statistics(words):
            for size, phrase in self.ending[state]:
                if size <= length:
                    phrases.append((i + 1 - size, phrase))
            if length < shortest:
                continue
            following = words[i + 1] if i + 1 < len(words) else None
            # up the suffix path: places that only a shorter suffix shares match that suffix alone
            seen: set[tuple[int, int]] = set()
            while state > 0 and length >= shortest:
                for place in self.places[state]:
                    if place not in seen:
                        seen.add(place)
                        template, end = place
                        text = self.texts[template]
                        if end + 1 >= len(text) or text[end + 1] != following:
                            matches.append(Match(i + 1 - length, length, template, end + 1 - length))
                state = self.link[state]
                length = self.depth[state] if state >= 0 else 0
        return phrases, matches

    def chains(self, matches: Sequence[Match], gap: int = GAP) -> list[Span]:
        """The best chain of each stretch of matches that lie at most ``gap`` words apart, template by template."""
        by_template: dict[int, list[Match]] = defaultdict(list)
        for m in matches:
            by_template[m.template].append(m)
        spans = []
        for template, own in sorted(by_template.items()):
            own.sort(key=lambda m: (m.start, m.at, m.length))
            size = len(self.texts[template])
            stretch: list[Match] = []
            reach = 0
            for m in own:
                if stretch and m.start > reach + gap:
                    spans.append(self._best(stretch, template, size, gap))
                    stretch = []
                stretch.append(m)
                reach = max(reach, m.start + m.length) if len(stretch) > 1 else m.start + m.length
            if stretch:
                spans.append(self._best(stretch, template, size, gap))
        return spans

    def _best(self, stretch: list[Match], template: int, size: int, gap: int) -> Span:
        """The chain that covers most words of the template; of equals the one that starts first."""
        best: list[tuple[int, int, int]] = []  # words covered, minus text start, minus template start
        low = 0
        for k, m in enumerate(stretch):
            # no match is longer than the template, so earlier ones can't reach this one
            while stretch[low].start + size + gap < m.start:
                low += 1
            found = (m.length, -m.start, -m.at)
            for j in range(low, k):
                p = stretch[j]
                apart, apart_there = m.start - p.start - p.length, m.at - p.at - p.length
                if p.start < m.start and p.at < m.at and apart <= gap and apart_there <= gap:
                    gain = m.length + min(apart, apart_there, 0)
                    if gain > 0:
                        found = max(found, (best[j][0] + gain, *best[j][1:]))
            best.append(found)
        k = max(range(len(stretch)), key=lambda x: (best[x][0], best[x][1], -x))
        covered, start, at = best[k]
        m = stretch[k]
        return Span(self.labels[template], -start, m.start + m.length, template, -at, m.at + m.length, covered, covered / size)


def outer(spans: Sequence[Span]) -> list[Span]:
    """The spans in text order without those that lie inside another one that covers as many words: a version number apart, texts of licences are alike."""
    kept: list[Span] = []
    around: list[Span] = []
    for s in sorted(spans, key=lambda s: (s.start, -s.end, -s.covered, s.template)):
        around = [k for k in around if k.end > s.start]
        if not any(k.end >= s.end and k.covered >= s.covered and (k.start, k.end, k.covered) != (s.start, s.end, s.covered) for k in around):
            kept.append(s)
            around.append(s)
    return kept


_SPANS = pa.list_(
    pa.struct(
        [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("template", pa.int32()), ("template_start", pa.int32()), ("template_end", pa.int32()), ("covered", pa.int32()), ("share", pa.float64())]
    )
)
_SPANS_DDL = "array<struct<label:string,start:bigint,end:bigint,template:int,template_start:int,template_end:int,covered:int,share:double>>"


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    shortest: int = SHORTEST,
    gap: int = GAP,
    cover: float = COVER,
) -> DataFrame:
    """Licenses in every row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans``: places of the phrases, the smallest and the largest start among
    them (null without any), their labels, these and those of the templates that are
    covered to ``cover`` or more, the best covered share, and the covered spans in
    words of the text and of the template.
    """
    spark = docs.sparkSession
    text_batches(spark)
    Automaton(templates, phrases)  # refuses what is too large or empty on the driver
    sent = spark.sparkContext.broadcast((tuple(templates), tuple(phrases)))
    id_type = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    types = [None, *[pa.int64()] * 4, *[pa.string()] * 2, pa.float64(), _SPANS]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*sent.value)
        for batch in batches:
            rows = []
            for value in batch["text"]:
                words = words_of(value.as_py() or "")
                found, matches = automaton.scan(words, shortest)
                spans = automaton.chains(matches, gap)
                starts = [start for start, _ in found]
                base = {automaton.phrases[p][1] for _, p in found}
                kept = outer([s for s in spans if s.share >= cover])
                rows.append(
                    (
                        len(words),
                        len(starts),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | {s.label for s in kept})),
                        max((s.share for s in spans), default=0.0),
                        [s._asdict() for s in kept],
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types[1:], strict=True))], names)

    schema = f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {_SPANS_DDL}"
    return docs.select("doc_id", "text").mapInArrow(scanned, schema)


#: The words of the scan as a pattern, for tests and for other engines.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
