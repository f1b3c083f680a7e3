"""Licence scan: a generalised suffix automaton of licence words, matching statistics, and chains of long matches.

The automaton holds every run of words of every template. A document's words go through it once: at each word the state
gives the longest run that ends there and stands in some template (its matching statistic). A run that the next
word does not lengthen is a match; matches of ``min_match`` words or more are chained per template, forward in both texts
and with at most ``max_gap`` words between, into spans. A span that covers ``min_cover`` of its template's words, or
``enough`` words of a long one, is a find of that template's label if one of its matches is telling: it stands in templates of that
label alone. Notices are made from the names of the licences and the words before them; in a notice a match counts only if it holds
the whole name, so the wording that all notices share finds nothing. A base phrase is found wherever its state lies on the
suffix path of the current state and the statistic is long enough, so all its places come from the same pass.

``score``: the largest share of a template that one span with a telling match covers; 1 if a base phrase stands in the text; else 0.
The automaton's state is a number and a length; the matches of one text are held until it ends, so memory grows with its licence wording.

Null and empty texts have no words and no labels. Words of other scripts take part as they are. Repeated rows give
repeated results; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from obslake.llm.common import batches, texts

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Names of public licences, by label.
NAMES = [
    ("agpl", "gnu affero general public license"),
    ("apache", "apache license version 2.0"),
    ("apache", "apache license 2.0"),
    ("bsd", "bsd license"),
    ("bsd", "bsd 2 clause license"),
    ("bsd", "bsd 3 clause license"),
    ("cc-by", "creative commons attribution 4.0 international license"),
    ("cc-by", "cc by 4.0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4.0 international license"),
    ("cc-by-nc", "cc by nc 4.0"),
    ("cc-by-sa", "creative commons attribution sharealike 4.0 international license"),
    ("cc-by-sa", "cc by sa 4.0"),
    ("cc0", "creative commons zero license"),
    ("epl", "eclipse public license"),
    ("gpl", "gnu general public license"),
    ("isc", "isc license"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "mit license"),
    ("mpl", "mozilla public license"),
]

#: The words before a name in a notice.
BEFORE = ["licensed under", "released under", "distributed under", "published under", "available under", "under the terms of"]

#: The wording of public licences, by label.
TEMPLATES = [
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache"
               " org licenses license 2.0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed"
               " on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
            " license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied"
            " warranty of merchantability or fitness for a particular purpose"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
            " files the software to deal in the software without restriction including without limitation the rights to use copy"
            " modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the"
            " following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
            " from this software without specific prior written permission"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
]

#: A-Z to a-z, and all that is not part of a word to a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def notices(names: Sequence[tuple[str, str]] = NAMES, before: Sequence[str] = BEFORE) -> list[tuple[str, list[bytes], int]]:
    """(label, words, place of the name) of every notice; articles stand before a name or do not."""
    return [(label, words_of(f"{b} {article} {name}"), len(words_of(f"{b} {article}")))
            for label, name in names for b in before for article in ("", "the", "a")]


class Automaton:
    """Generalised suffix automaton of word sequences; each state knows where in the templates its runs end."""

    def __init__(self, sequences: Sequence[Sequence[bytes]]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for which, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word, ends)
                ends[last].append((which, at))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            ends[self.link[state]] += ends[state]
        self.ends = [sorted(set(e)) if i else [] for i, e in enumerate(ends)]

    def _new(self, length: int, link: int, following: dict[bytes, int], ends: list[list[tuple[int, int]]]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        ends.append([])
        return len(self.link) - 1

    def _split(self, p: int, word: bytes, q: int, ends: list[list[tuple[int, int]]]) -> int:
        """The state of the shorter runs of ``q`` that ``p`` and ``word`` give."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]), ends)
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: bytes, ends: list[list[tuple[int, int]]]) -> int:
        if word in self.next[last]:  # the run stands in an earlier sequence
            return self._split(last, word, self.next[last][word], ends)
        state = self._new(self.length[last] + 1, 0, {}, ends)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, word, self.next[p][word], ends)
        return state

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """State and length of the longest run that ends with ``word``."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0

    def run(self, words: Sequence[bytes]) -> int | None:
        """The state of a run of words, if some sequence holds it."""
        state = 0
        for word in words:
            state = self.next[state].get(word, -1)
            if state < 0:
                return None
        return state


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, base: dict[str, str] = BASE, min_match: int = 3,
                 max_gap: int = 12, min_cover: float = 0.6, enough: int = 12, names: Sequence[tuple[str, str]] = NAMES) -> None:
        self.base = [(words_of(p), label) for p, label in base.items()]
        made = notices(names)
        self.labels = [label for label, _ in templates] + [label for label, *_ in made]
        sequences = [words_of(t) for _, t in templates] + [words for _, words, _ in made]
        self.name_at = [-1] * len(templates) + [at for *_, at in made]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton([*sequences, *(p for p, _ in self.base)])
        self.vocabulary = {w for following in self.automaton.next for w in following}
        self.min_match, self.max_gap, self.min_cover, self.enough = min_match, max_gap, min_cover, enough
        #: Of each state: whether its runs stand in the templates of one label alone.
        self.telling = [len({self.labels[q] for q, _ in ends if q < len(self.labels)}) == 1 for ends in self.automaton.ends]
        whole = {self.automaton.run(p): i for i, (p, _) in enumerate(self.base)}
        self.phrases: list[list[int]] = []  # of each state: base phrases on its suffix path
        for state in range(len(self.automaton.link)):
            found = []
            while state > 0:
                if state in whole:
                    found.append(whole[state])
                state = self.automaton.link[state]
            self.phrases.append(found)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int, bool]]]:
        """Base places (phrase, first word), and matches (template, place there, place here, words, telling)."""
        step, phrases, vocabulary = self.automaton.step, self.phrases, self.vocabulary
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int, int, bool]] = []
        state = length = 0
        before = -1
        for i, word in enumerate(words):
            if word not in vocabulary:
                continue
            if i != before + 1:
                self._close(state, length, before, matches)
                state = length = 0
            was, run = state, length
            state, length = step(state, length, word)
            if length <= run:
                self._close(was, run, i - 1, matches)
            for phrase in phrases[state]:
                size = len(self.base[phrase][0])
                if length >= size:
                    places.append((phrase, i - size + 1))
            before = i
        self._close(state, length, before, matches)
        return places, matches

    def _close(self, state: int, length: int, last: int, matches: list[tuple[int, int, int, int, bool]]) -> None:
        if length >= self.min_match:
            telling = self.telling[state]
            for which, at in self.automaton.ends[state]:
                if which >= len(self.labels):
                    continue
                name = self.name_at[which]
                if name < 0 or (telling and at == self.sizes[which] - 1 and at - length + 1 <= name):
                    matches.append((which, at - length + 1, last - length + 1, length, telling))

    def spans(self, matches: list[tuple[int, int, int, int, bool]]) -> Iterator[tuple[str, int, int, float, bool]]:
        """Chains as (label, first word, end, share of the template, found)."""
        by_template: dict[int, list[tuple[int, int, int, bool]]] = {}
        for which, there, here, n, telling in matches:
            by_template.setdefault(which, []).append((here, there, n, telling))
        for which, ms in by_template.items():
            ms.sort()
            best: list[tuple[int, int, bool]] = []  # covered words, first word, telling; of the best chain that ends with each match
            first_open, used = 0, set()
            for j, (here, there, n, telling) in enumerate(ms):
                while ms[first_open][0] + self.sizes[which] + self.max_gap < here:
                    first_open += 1
                covered, start, came = n, here, -1
                for i in range(first_open, j):
                    h, t, m, _ = ms[i]
                    over = max(0, h + m - here, t + m - there)  # shared words count once
                    if h < here and t < there and over < n and here - h - m <= self.max_gap and there - t - m <= self.max_gap \
                            and best[i][0] + n - over > covered:
                        covered, start, came = best[i][0] + n - over, best[i][1], i
                best.append((covered, start, telling or (came >= 0 and best[came][2])))
                if came >= 0:
                    used.add(came)
            for j, (covered, start, telling) in enumerate(best):
                if j not in used and telling:
                    share = min(1.0, covered / self.sizes[which])
                    yield self.labels[which], start, ms[j][0] + ms[j][2], share, share >= self.min_cover or covered >= self.enough


_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("cover", pa.float64())])
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])


def scan_licences(docs: DataFrame, **settings) -> DataFrame:
    """Per row: n_words, places of base phrases, labels, score and the found spans (words from 0, end exclusive)."""

    def run(it):
        scanner = Scanner(**settings)
        for batch in it:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                words = words_of(text.as_py())
                places, matches = scanner.scan(words)
                starts = [p for _, p in places]
                base = {scanner.base[b][1] for b, _ in places}
                spans, score = [], 1.0 if places else 0.0
                for label, first, end, share, found in scanner.spans(matches):
                    score = max(score, share)
                    if found:
                        spans.append({"label": label, "first_word": first, "end_word": end, "cover": share})
                labels = base | {s["label"] for s in spans}
                rows.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(base)), ",".join(sorted(labels)), score, spans))
            yield from batches(rows, _SCHEMA, 5_000)

    return texts(docs).mapInArrow(run, (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, spans array<struct<label: string, first_word: long, end_word: long, cover: double>>"))
