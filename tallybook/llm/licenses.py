"""Licence scans: template markup compiled into token automata.

A template is the wording of a licence or notice in markup. Plain words are mandatory. What lies
between ``<<beginOptional>>`` and ``<<endOptional>>`` may be absent as a whole; optional regions
nest. ``<<var;name="...";words=1..4>>`` is replaceable by one to four words of any kind, and
``<<var;name="...";match="a b|c">>`` by one of the wordings given. All templates and phrases become
one automaton over words, whose positions are the templates' words. It is started wherever the
first two words allow it and accepts a place when a template has been read to its end: all mandatory
wording stood there exactly, in order, with nothing else than its regions allow between.

Words are runs of letters a to z (A to Z lowered), digits and non-ASCII characters, so punctuation,
line breaks and comment marks do not count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import text_runs, word_bounds

# The phrases of the base result.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_GRANT = '<<var;name="grant";match="licensed|released|distributed|published|made available">> under'
_SUBJECT = '<<beginOptional>>this <<var;name="work";words=1..4>> is<<endOptional>>'
_LICENSE = '<<var;name="spelling";match="license|licence">>'

# The wording of public licences and their customary notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        f"{_SUBJECT} {_GRANT} <<beginOptional>>the terms of<<endOptional>> the mit {_LICENSE}",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name="work";match="this software and associated documentation files|this software">>
        <<beginOptional>>(the "Software")<<endOptional>>, to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
        the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice <<beginOptional>>(including the next
        paragraph)<<endOptional>> shall be included in all copies or substantial portions of the
        Software.""",
    ),
    "isc": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
    ),
    "bsd-2-clause": (
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met:
        <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.""",
    ),
    "bsd-3-clause": (
        """<<beginOptional>>3.<<endOptional>> Neither the name of
        <<var;name="holder";words=1..12>> nor the names of its contributors may be used to endorse
        or promote products derived from this software without specific prior written
        permission.""",
    ),
    "apache-2": (
        f"""{_SUBJECT} {_GRANT} <<beginOptional>>the terms of<<endOptional>> the apache {_LICENSE}
        <<beginOptional>>version<<endOptional>> 2<<beginOptional>> 0<<endOptional>>""",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License.""",
    ),
    "gpl-2": (
        f"""{_SUBJECT} {_GRANT} <<beginOptional>>the terms of<<endOptional>> the gnu general public
        {_LICENSE} <<beginOptional>>as published by the free software
        foundation either<<endOptional>> version 2""",
    ),
    "gpl-3": (
        f"""{_SUBJECT} {_GRANT} <<beginOptional>>the terms of<<endOptional>> the gnu general public
        {_LICENSE} <<beginOptional>>as published by the free software
        foundation either<<endOptional>> version 3""",
        """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version
        3 of the License""",
    ),
    "cc-by-4": (f'{_SUBJECT} {_GRANT} <<var;name="name";match="a creative commons attribution|cc by">> 4 0',),
    "cc-by-nc-4": (
        f"""{_SUBJECT} {_GRANT}
        <<var;name="name";match="a creative commons attribution noncommercial|cc by nc">> 4 0""",
    ),
    "cc0-1": (
        f"""{_SUBJECT} {_GRANT}
        <<var;name="name";match="cc0 1 0|the creative commons cc0 1 0 universal public domain dedication">>""",
    ),
}

_MARK = re.compile(r"<<(.*?)>>", re.S)
_WORDS = re.compile(r"[0-9a-z\x80-\U0010FFFF]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAKS = np.ones(256, bool)
_BREAKS[48:58] = _BREAKS[97:123] = _BREAKS[128:] = False

ANY = -1


def _template_words(text: str) -> list[str]:
    return _WORDS.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def parse(markup: str) -> list[tuple]:
    """The template as a list of ("word", w), ("optional", parts), ("gap", least, most) and
    ("choice", wordings). Unknown or unbalanced markup is an error."""
    stack: list[list[tuple]] = [[]]
    at = 0
    for mark in _MARK.finditer(markup):
        stack[-1] += [("word", w) for w in _template_words(markup[at : mark.start()])]
        at = mark.end()
        kind, _, rest = mark[1].partition(";")
        gap = re.search(r"words=(\d+)\.\.(\d+)", rest)
        choice = re.search(r'match="([^"]*)"', rest)
        if kind == "beginOptional":
            stack.append([])
        elif kind == "endOptional" and len(stack) > 1:
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif kind == "var" and gap:
            stack[-1].append(("gap", int(gap[1]), int(gap[2])))
        elif kind == "var" and choice:
            stack[-1].append(("choice", [[("word", w) for w in _template_words(x)] for x in choice[1].split("|")]))
        else:
            raise ValueError(f"markup not understood: <<{mark[1]}>>")
    if len(stack) > 1:
        raise ValueError("an optional region is not closed")
    return stack[0] + [("word", w) for w in _template_words(markup[at:])]


def fewest_words(parts: Sequence[tuple]) -> int:
    """Words of the shortest text that the template accepts: its mandatory wording."""
    least = {
        "word": lambda p: 1,
        "optional": lambda p: 0,
        "gap": lambda p: p[1],
        "choice": lambda p: min(fewest_words(x) for x in p[1]),
    }
    return sum(least[p[0]](p) for p in parts)


@dataclass
class Automaton:
    """Position automaton of several templates. Sets of positions are the bits of an integer.

    ``accepts[w]`` has the positions that read the word w, ``wild`` those that read any,
    ``follow[p]`` the positions after p, and ``ends`` the template that is complete at p.
    """

    vocabulary: dict[str, int] = field(default_factory=dict)
    reads: list[int] = field(default_factory=list)
    follow: list[int] = field(default_factory=list)
    first: int = 0
    ends: dict[int, int] = field(default_factory=dict)
    accepts: list[int] = field(default_factory=list)
    wild: int = 0
    final: int = 0

    def add(self, template: int, parts: Sequence[tuple]) -> None:
        first, last, empty = self._sequence(parts)
        if empty:
            raise ValueError("a template must have mandatory words")
        if any(self.reads[p] == ANY for p in bits(first)):
            raise ValueError("a template must start with a word of its own")
        self.first |= first
        for p in bits(last):
            self.ends[p] = template

    def close(self) -> Automaton:
        self.accepts = [0] * (len(self.vocabulary) + 1)
        for p, w in enumerate(self.reads):
            if w == ANY:
                self.wild |= 1 << p
            else:
                self.accepts[w] |= 1 << p
        self.accepts = [x | self.wild for x in self.accepts]
        self.final = sum(1 << p for p in self.ends)
        return self

    def _position(self, word: int) -> int:
        self.reads.append(word)
        self.follow.append(0)
        return len(self.reads) - 1

    def _part(self, part: tuple) -> tuple[int, int, bool]:
        kind = part[0]
        if kind == "word":
            at = 1 << self._position(self.vocabulary.setdefault(part[1], len(self.vocabulary) + 1))
            return at, at, False
        if kind == "optional":
            first, last, _ = self._sequence(part[1])
            return first, last, True
        if kind == "choice":
            ways = [self._sequence(x) for x in part[1]]
            first = last = 0
            for a, b, _ in ways:
                first, last = first | a, last | b
            return first, last, any(empty for *_, empty in ways)
        if kind == "gap":
            some, more = [("any",)] * part[1], [("optional", [("any",)])] * (part[2] - part[1])
            return self._sequence(some + more)
        at = 1 << self._position(ANY)
        return at, at, False

    def _sequence(self, parts: Sequence[tuple]) -> tuple[int, int, bool]:
        """Positions that may come first and last, and whether all may be absent."""
        first = last = 0
        empty = True
        for part in parts:
            a, b, absent = self._part(part)
            for p in bits(last):
                self.follow[p] |= a
            first |= a if empty else 0
            last = b | (last if absent else 0)
            empty &= absent
        return first, last, empty

    def run(self, words: Sequence[int], start: int, stop: int) -> dict[int, int]:
        """Templates accepted from ``start`` on, each with its farthest end."""
        found: dict[int, int] = {}
        active = self.first
        for at in range(start, stop):
            active &= self.accepts[words[at]]
            if not active:
                break
            for p in bits(active & self.final):
                found[self.ends[p]] = at + 1
            following = 0
            for p in bits(active):
                following |= self.follow[p]
            active = following
        return found

    def openings(self) -> np.ndarray:
        """For each word and the next whether a template may start so. The last column stands
        for the end of the text; row and column 0 for words of no template."""
        n = len(self.vocabulary) + 1
        allowed = np.zeros((n, n + 1), bool)
        for p in bits(self.first):
            row = allowed[self.reads[p]]
            row[:] |= p in self.ends
            for q in bits(self.follow[p]):
                if self.reads[q] == ANY:
                    row[:n] = True
                else:
                    row[self.reads[q]] = True
        return allowed


def bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


class Lexicon:
    """Numbers of the words that templates use; 0 for all others. Words are compared whole."""

    def __init__(self, vocabulary: Mapping[str, int]):
        words = [w.encode() for w in vocabulary]
        text = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = ends - [len(w) for w in words]
        keys, *_ = self._keys(text, starts, ends)
        order = np.argsort(keys, kind="stable")
        self.keys, self.words = keys[order], [words[i] for i in order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two words of the templates have one key")
        self.numbers = np.array(list(vocabulary.values()), np.int32)[order]
        _, self.head, self.tail, self.sizes = (x[order] for x in self._keys(text, starts, ends))

    @staticmethod
    def _keys(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """A hash, the first eight bytes, the last eight (of longer words) and the length."""
        sizes = ends - starts
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        eight = np.arange(8)
        head = padded[starts[:, None] + eight].view(np.uint64)[:, 0]
        short = np.minimum(sizes, 8)
        masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        head &= masks[short]
        tail = np.zeros(len(starts), np.uint64)
        longer = np.flatnonzero(sizes > 8)
        tail[longer] = padded[ends[longer][:, None] - 8 + eight].view(np.uint64)[:, 0]
        mixed = (head ^ (tail * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return mixed ^ sizes.astype(np.uint64), head, tail, sizes

    def numbered(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.int32)
        known = np.flatnonzero(ends - starts <= self.sizes.max())
        keys, head, tail, sizes = self._keys(text, starts[known], ends[known])
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = (self.head[at] == head) & (self.tail[at] == tail) & (self.sizes[at] == sizes)
        for i in np.flatnonzero(same & (sizes > 16)):
            same[i] = text[starts[known[i]] : ends[known[i]]].tobytes() == self.words[at[i]]
        out[known[same]] = self.numbers[at[same]]
        return out


_RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:long,end:long>>"
)
_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_ARROW = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("spans", pa.list_(_SPAN)),
]


def compiled(
    templates: Mapping[str, Sequence[str]], phrases: Mapping[str, str]
) -> tuple[Automaton, list[tuple[str, bool, float]]]:
    """The automaton of all templates and phrases, and for each its label, whether it is a
    phrase, and the score of a match: m / (m + 1) for m mandatory words."""
    automaton, told = Automaton(), []
    wordings = [(p, label, True) for p, label in phrases.items()]
    wordings += [(t, label, False) for label, several in templates.items() for t in several]
    for markup, label, is_phrase in wordings:
        parts = parse(markup)
        automaton.add(len(told), parts)
        least = fewest_words(parts)
        told.append((label, is_phrase, least / (least + 1)))
    return automaton.close(), told


def scan(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licence labels of each text, and the words at which they stand.

    n_words; n_base, the places where a phrase stands, overlapping ones each counted; first_word
    and last_word, the smallest and largest of their starts (null if there is none); base_labels,
    the phrases' labels; labels, those and the accepted templates', both distinct, sorted and
    joined by commas; score, that of the longest mandatory wording found: m words give m / (m + 1),
    nothing found gives 0; spans, (label, start, end) of every phrase and accepted template, the
    farthest end for each start.

    A null text counts as an empty one: no words, no labels, score 0. Every row gives one row, also
    rows with equal or null identifiers; an empty table gives none. Other columns of ``docs`` play
    no part, whatever their names. Texts of any length are scanned whole, one at a time if they are
    longer than a slice (a megabyte); a task then holds some 60 bytes per word of that text.
    """
    automaton, told = compiled(templates, phrases)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(automaton.vocabulary)
        allowed = automaton.openings()
        for batch in batches:
            rows: list[tuple] = []
            for _, raw, offsets in text_runs(batch.column(1)):
                text = _LOWER[raw]
                starts, ends, bounds = word_bounds(text, offsets, _BREAKS)
                numbers = lexicon.numbered(text, starts, ends)
                following = np.full(len(numbers), allowed.shape[1] - 1, np.int32)
                following[:-1] = numbers[1:]
                stops = bounds[1:][np.diff(bounds) > 0]
                following[stops - 1] = allowed.shape[1] - 1
                places = np.flatnonzero(allowed[numbers, following])
                of_text = np.searchsorted(bounds, places, "right") - 1
                hits: dict[int, list[tuple[int, int, int]]] = {}
                for at, i in zip(places.tolist(), of_text.tolist(), strict=True):
                    for t, end in automaton.run(numbers, at, bounds[i + 1]).items():
                        hits.setdefault(i, []).append((t, at - int(bounds[i]), end - int(bounds[i])))
                rows += [_told(n, hits.get(i, []), told) for i, n in enumerate(np.diff(bounds).tolist())]
            columns = zip(*rows, strict=True) if rows else [()] * len(_ARROW)
            found = [pa.array(list(c), kind) for c, (_, kind) in zip(columns, _ARROW, strict=True)]
            yield pa.record_batch([batch.column(0), *found], ["id", *[name for name, _ in _ARROW]])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(find, f"id {kind}, {_RESULT}").withColumnRenamed("id", id_col)


def _told(n: int, hits: list[tuple[int, int, int]], told: Sequence[tuple[str, bool, float]]) -> tuple:
    base = [start for t, start, _ in hits if told[t][1]]
    spans = sorted({(told[t][0], start, end) for t, start, end in hits})
    return (
        n,
        len(base),
        min(base, default=None),
        max(base, default=None),
        ",".join(sorted({told[t][0] for t, *_ in hits if told[t][1]})),
        ",".join(sorted({told[t][0] for t, *_ in hits})),
        max((told[t][2] for t, *_ in hits), default=0.0),
        [{"label": label, "start": start, "end": end} for label, start, end in spans],
    )
