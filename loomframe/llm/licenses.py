"""Licence scans with a generalised suffix automaton over the words of licence templates.

A document's words are streamed through the automaton, which gives at each word the length
of the longest run ending there that some template has (the matching statistics); the suffix
links give that of every other template. Runs of ``LONG`` words or more that cannot be extended
within their template are chained per template, in order of place in both texts with gaps of at
most ``GAP`` words, to cover as much as they can; a chain covers a span of the document and a
part of the template. A template covered to ``COVERED`` or more gives its label.
Base phrases are strings of the same automaton, found at every place.

Null or empty text has no words. Every row is judged by itself, repeated rows alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomframe.llm import arrow_text as at
from loomframe.llm.shared import only

LONG, GAP, COVERED = 3, 12, 0.7

#: Base phrases and their labels.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

#: Characteristic sentences of common licences.
TEMPLATES = {
    "apache-2": "Licensed under the Apache License, Version 2.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
           "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
           "in all copies",
    "gpl": "licensed under the GNU General Public License",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                  "the GNU General Public License as published by the Free Software Foundation",
    "lgpl": "under the terms of the GNU Lesser General Public License",
    "agpl": "under the terms of the GNU Affero General Public License",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "epl": "made available under the terms of the Eclipse Public License",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc-by": "licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc": "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring "
           "rights to this work",
    "zlib": "This software is provided 'as-is', without any express or implied warranty",
}


def words_of(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, stops, _ = at.word_bounds(data, np.array([0, len(data)]), at.ALNUM_LOWER)
    folded = at.ALNUM_LOWER[1][data]
    return [folded[a:b].tobytes() for a, b in zip(starts, stops)]


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.names = list(templates)
        self.phrase_names, self.phrase_sizes = list(phrases), []
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: State -> {template: where in the template the state's strings end first}
        self.ends: list[dict[int, int]] = [{}]
        self.sizes, self.bigrams = [], set()
        vocabulary: dict[bytes, int] = {}
        finals = []
        for k, text in enumerate([*templates.values(), *phrases.values()]):
            words = words_of(text)
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
            self.bigrams.update(zip(ids, ids[1:]))
            state = 0
            for place, word in enumerate(ids):
                state = self._extend(state, word)
                if k < len(templates):
                    self.ends[state].setdefault(k, place)
            if k < len(templates):
                self.sizes.append(len(ids))
            else:
                self.phrase_sizes.append(len(ids))
                finals.append(ids)
        self.least = min([LONG, *self.phrase_sizes])
        if self.least < 2:
            raise ValueError("a phrase needs two words")
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            for k, place in self.ends[state].items():  # a suffix ends where the longer string ends
                up = self.ends[self.link[state]]
                up[k] = min(place, up.get(k, place))
        self.ends[0] = {}
        #: State -> {template: (its longest suffix of the state's strings, where that ends)}
        self.held: list[dict[int, tuple[int, int]]] = [{}]
        for state in range(1, len(self.next)):
            held, s = {}, state
            while self.length[s] >= LONG:
                for k, place in self.ends[s].items():
                    held.setdefault(k, (self.length[s], place))
                s = self.link[s]
            self.held.append(held)
        own = {}
        for p, ids in enumerate(finals):
            state = 0
            for word in ids:
                state = self.next[state][word]
            own.setdefault(state, []).append(p)
        #: State -> phrases that end with it: (phrase, words needed).
        self.found: list[list[int]] = [[]]
        for state in range(1, len(self.next)):
            chain, s = [], state
            while s > 0:
                chain += own.get(s, [])
                s = self.link[s]
            self.found.append(chain)
        hashes = [int(at.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]),
                                     at.ALNUM_LOWER)[0]) for w in vocabulary]
        order = np.argsort(np.array(hashes, np.uint64))
        self.hashes, self.ids = np.array(hashes, np.uint64)[order], np.arange(len(hashes))[order]
        self.pairs = np.zeros((len(vocabulary), len(vocabulary)), bool)
        for a, b in self.bigrams:
            self.pairs[a, b] = True

    def _new(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.next.append(onward)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state for the strings of q that come from p: q itself or a clone."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        state, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, word, self.next[p][word])
        return state

    def stream(self, ids: list[int]):
        """(state, matched words) after each word."""
        state, length = 0, 0
        for word in ids:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                length = 0
            yield state, length


def scan(automaton: Automaton, runs: list[tuple[int, list[int]]]):
    """Base places and covered spans of one document.

    ``runs``: its maximal runs of words whose neighbours are neighbours in a template, as
    (index of the first word, word ids). Gives base places (start, phrase) and
    spans (template, coverage, first word, last word).
    """
    places, matches = [], {}
    for start, ids in runs:
        open_runs: dict[int, tuple[int, int]] = {}  # template: length and end of its run up to here
        for k, (state, length) in enumerate(automaton.stream(ids)):
            places += [(start + k + 1 - automaton.phrase_sizes[p], p) for p in automaton.found[state]
                       if length >= automaton.phrase_sizes[p]]
            longest = {t: (min(n, length), end) for t, (n, end) in automaton.held[state].items()} \
                if length >= LONG else {}
            _close(matches, open_runs, longest, start + k)
            open_runs = longest
        _close(matches, open_runs, {}, start + len(ids))
    return places, [(t, min(1.0, covered / automaton.sizes[t]), first, last)
                    for t, found in matches.items() for covered, first, last in chains(found)]


def _close(matches: dict, open_runs: dict, longest: dict, word: int) -> None:
    """Adds the runs up to ``word`` that the template's run behind it does not extend."""
    for t, (length, end) in open_runs.items():
        if t not in longest or longest[t][0] <= length:
            matches.setdefault(t, []).append((word - length, end + 1 - length, length))


def chains(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(covered words, first word, last word) of chains of one template's matches.

    ``found``: (word, template word, length). A match goes on from the chain that covers most.
    Chains are taken by covered words; each match counts for one chain.
    """
    found = sorted(found)
    best: list[tuple[int, int]] = []  # covered words, match before or -1
    near: list[int] = []
    for m, (word, place, length) in enumerate(found):
        near = [p for p in near if word - found[p][0] - found[p][2] <= GAP]
        covered, before = max(((best[p][0], p) for p in near if found[p][0] + found[p][2] <= word
                               and found[p][1] + found[p][2] <= place), default=(0, -1))
        best.append((covered + length, before))
        near.append(m)
    out, used = [], set()
    for m in sorted(range(len(found)), key=lambda m: (-best[m][0], m)):
        covered, first, last = 0, m, m
        while m >= 0 and m not in used:
            used.add(m)
            covered, first, m = covered + found[m][2], m, best[m][1]
        if covered:
            out.append((covered, found[first][0], found[last][0] + found[last][2] - 1))
    return out


def scan_rows(automaton: Automaton, data: np.ndarray, offsets: np.ndarray):
    """Word counts of the rows, and {row: scan result} of rows with a run worth streaming."""
    starts, stops, first = at.word_bounds(data, offsets, at.ALNUM_LOWER)
    h = at.word_hashes(data, starts, stops, at.ALNUM_LOWER)
    spot = np.minimum(np.searchsorted(automaton.hashes, h), len(automaton.hashes) - 1)
    word = np.where(automaton.hashes[spot] == h, automaton.ids[spot], -1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    joined = (word[:-1] >= 0) & (word[1:] >= 0) & (row[:-1] == row[1:])
    joined[joined] = automaton.pairs[word[:-1][joined], word[1:][joined]]
    edge = np.diff(np.concatenate([[0], joined.astype(np.int8), [0]]))
    runs: dict[int, list] = {}
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        if b - a >= automaton.least - 1:
            r = int(row[a])
            runs.setdefault(r, []).append((int(a - first[r]), word[a:b + 1].tolist()))
    return np.diff(first), {r: scan(automaton, found) for r, found in runs.items()}


def find(docs: DataFrame, templates: dict[str, str] | None = None,
         phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans: ``label:first word:last word:coverage`` of every chain that gives a label.
    """
    automaton = Automaton(templates or TEMPLATES, phrases or PHRASES)

    def run(batches):
        for batch in batches:
            data, offsets = at.utf8(batch.column(1))
            out = []
            for i, j in at.pieces(offsets):
                n_words, found = scan_rows(automaton, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for r in range(j - i):
                    places, spans = found.get(r, ((), ()))
                    base = {automaton.phrase_names[p] for _, p in places}
                    kept = [s for s in spans if s[1] >= COVERED]
                    labels = base | {automaton.names[s[0]] for s in kept}
                    score = 1.0 if base else max((s[1] for s in spans), default=0.0)
                    out.append((int(n_words[r]), len(places), min(places)[0] if places else None,
                                max(places)[0] if places else None, ",".join(sorted(base)),
                                ",".join(sorted(labels)), score, ",".join(
                                    f"{automaton.names[t]}:{a}:{b}:{c:.3f}" for t, c, a, b in sorted(kept))))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*out), types)]], names=names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
    return only(docs, doc_id="doc_id", text="text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double, spans string")
