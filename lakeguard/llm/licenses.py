"""License scans by template-markup matching.

A template is license wording with two kinds of markup.  ``<<beginOptional>>``
... ``<<endOptional>>`` (they may nest) holds words that may be missing, and
``<<var;name="holder";words="0-12";match="[0-9]+">>`` stands for words that may
be anything: from the first to the second number of them, each matching the
pattern as a whole if one is given.  All other words are mandatory and must
stand in the text exactly, one behind the other.

All templates are compiled into one automaton over words.  Optional regions are
ways around their words, replaceable regions chains of positions that take any
(matching) word.  The automaton is made deterministic by subset construction,
a state at a time when a text first reaches it.  A run starts at each word that
can begin a template and ends when no wording is left that could still match;
templates have no loops, so it takes at most the words of the longest one.

The base phrases are templates without markup and go through the same
automaton.  Every place of theirs counts; of the other templates' matches the
leftmost-longest that do not overlap count, template by template.

Defined cases: null and empty texts have no word, no span and score 0; a
template must begin with a mandatory or optional word; repeated rows are
scanned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeguard.llm.common import map_texts, small_batches

# Words on UTF-8 bytes after lower-casing A-Z: digits, letters a-z and all that is not ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(.*?)>>", re.DOTALL)
_FIELD = re.compile(r'(\w+)="([^"]*)"')


@dataclass(frozen=True)
class Template:
    label: str
    text: str


# The base phrases of the contract and their labels.
BASE = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)

# Public license wording, with the regions its matching guidelines let vary.
ADDED = (
    Template("mit-text", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files <<beginOptional>>(the "Software")<<endOptional>>, to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"""),
    Template("isc-text", """
        Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear
        in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="author";words="1-10">> DISCLAIMS ALL WARRANTIES"""),
    Template("bsd-text", """
        Redistribution and use in source and binary forms, with or without modification, are permitted
        <<beginOptional>>(subject to the limitations in the disclaimer below)<<endOptional>> provided that the following
        conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer"""),
    Template("apache-2-notice", """
        Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License")<<endOptional>>; you may not use
        this file except in compliance with the License"""),
    Template("gpl", """
        <<beginOptional>>This <<var;name="work";words="1-4">> is<<endOptional>> licensed under the
        <<beginOptional>>terms of the<<endOptional>> GNU General Public License<<beginOptional>>,
        version <<var;name="version";words="1-1";match="[23]">><<endOptional>>"""),
    Template("gpl-notice", """
        This <<var;name="work";words="1-4">> is free software<<beginOptional>>:<<endOptional>> you can redistribute it
        and/or modify it under the terms of the GNU <<beginOptional>>Lesser<<endOptional>> General Public License as
        published by the Free Software Foundation"""),
    Template("mit", "released under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    Template("mpl-2-notice", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"""),
    Template("creative-commons", """
        licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> Creative Commons
        Attribution<<beginOptional>>-NonCommercial<<endOptional>> <<beginOptional>>-NoDerivatives<<endOptional>>
        <<beginOptional>>-ShareAlike<<endOptional>>
        <<beginOptional>><<var;name="version";words="2-2";match="[0-9]">><<endOptional>>
        <<beginOptional>>International<<endOptional>> License"""),
    Template("creative-commons", """
        licensed under CC BY<<beginOptional>>-NC<<endOptional>> <<beginOptional>>-ND<<endOptional>>
        <<beginOptional>>-SA<<endOptional>> <<var;name="version";words="2-2";match="[0-9]">>"""),
    Template("unlicense-text", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software"""),
    Template("spdx-tag", 'SPDX-License-Identifier: <<var;name="id";words="1-1">>'),
    Template("all-rights-reserved", 'Copyright <<beginOptional>>(c)<<endOptional>> <<var;name="holder";words="1-20">> All rights reserved'),
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text in order; only A-Z are lower-cased."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def parse(text: str) -> list:
    """Wording as a list of words (bytes), ("any", least, most, pattern) and ("optional", [...])."""
    stack: list[list] = [[]]
    at = 0
    for mark in _MARK.finditer(text):
        stack[-1] += words_of(text[at:mark.start()])
        at = mark.end()
        name, _, rest = mark[1].partition(";")
        if name == "beginOptional":
            stack.append([])
        elif name == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            region = stack.pop()
            stack[-1].append(("optional", region))
        elif name == "var":
            fields = dict(_FIELD.findall(rest))
            least, _, most = fields.get("words", "0-10").partition("-")
            if not (least.isdigit() and most.isdigit()) or int(least) > int(most):
                raise ValueError(f"words of a replaceable region: {fields.get('words')}")
            pattern = fields.get("match")
            stack[-1].append(("any", int(least), int(most), re.compile(pattern.encode()) if pattern else None))
        else:
            raise ValueError(f"unknown markup: {mark[0]}")
    stack[-1] += words_of(text[at:])
    if len(stack) != 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0]


class TokenAutomaton:
    """All templates as one automaton over words, made deterministic as texts reach its states."""

    def __init__(self, templates):
        self.step: list[list] = []       # position -> [(word or None, pattern, next position)]
        self.free: list[list[int]] = []  # position -> positions reached without a word
        self.ends: dict[int, int] = {}   # position -> template that is complete there
        start = self._position()
        for number, template in enumerate(templates):
            entry = self._position()
            self.free[start].append(entry)
            last = self._add(parse(template.text), entry)
            self.ends[last] = number
        self.vocabulary = frozenset(w for steps in self.step for w, _, _ in steps if w is not None)
        self.patterns = list({p.pattern: p for steps in self.step for _, p, _ in steps if p is not None}.values())
        self.masks = {w: self._mask(w) for w in self.vocabulary}
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.accepts: list[tuple[int, ...]] = []
        self.moves: list[dict] = []
        self.start = self._state(self._closure({start}))
        if self.accepts[self.start]:
            raise ValueError("a template without a mandatory word")
        openings = [s for p in self.members[self.start] for s in self.step[p]]
        if any(word is None for word, _, _ in openings):
            raise ValueError("a template begins with a replaceable region")
        self.openings = frozenset(word for word, _, _ in openings)

    def _position(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def _add(self, parts: list, at: int) -> int:
        for part in parts:
            if isinstance(part, bytes):
                to = self._position()
                self.step[at].append((part, None, to))
            elif part[0] == "optional":
                to = self._position()
                self.free[at].append(to)
                self.free[self._add(part[1], at)].append(to)
            else:
                _, least, most, pattern = part
                to = self._position()
                for n in range(most + 1):
                    if n >= least:
                        self.free[at].append(to)
                    if n < most:
                        beyond = self._position()
                        self.step[at].append((None, pattern, beyond))
                        at = beyond
            at = to
        return at

    def _closure(self, positions) -> frozenset:
        seen, todo = set(positions), list(positions)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def _state(self, members: frozenset) -> int:
        if members not in self.states:
            self.states[members] = len(self.members)
            self.members.append(members)
            self.accepts.append(tuple(sorted(self.ends[p] for p in members if p in self.ends)))
            self.moves.append({})
        return self.states[members]

    def _mask(self, word: bytes) -> int:
        return sum(1 << i for i, p in enumerate(self.patterns) if p.fullmatch(word))

    def move(self, state: int, word: bytes) -> int | None:
        """The next state, None if no template can go on."""
        known = word in self.vocabulary
        symbol = word if known else self._mask(word)
        moves = self.moves[state]
        if symbol not in moves:
            mask = self.masks[word] if known else symbol
            matching = {p.pattern for i, p in enumerate(self.patterns) if mask >> i & 1}
            reached = {to for at in self.members[state] for literal, pattern, to in self.step[at]
                       if (literal == word if literal is not None else pattern is None or pattern.pattern in matching)}
            moves[symbol] = self._state(self._closure(reached)) if reached else None
        return moves[symbol]

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, end, template): the longest match of every template at every start."""
        if self.openings.isdisjoint(words):
            return []
        found = []
        for start in [i for i, w in enumerate(words) if w in self.openings]:
            state, longest = self.start, {}
            for end in range(start, len(words)):
                state = self.move(state, words[end])
                if state is None:
                    break
                for number in self.accepts[state]:
                    longest[number] = end + 1
            found += [(start, end, number) for number, end in sorted(longest.items())]
        return found


class Scanner:
    def __init__(self, base, added):
        self.templates = (*base, *added)
        self.n_base = len(base)
        self.automaton = TokenAutomaton(self.templates)

    def scan(self, text: str | None) -> tuple[int, list[tuple], float]:
        """Number of words, spans (label, start, end, base) by start, and the share of words inside a span."""
        words = words_of(text)
        spans, behind, covered, reach = [], {}, 0, 0
        for start, end, number in self.automaton.matches(words):
            base = number < self.n_base
            if not base:
                if start < behind.get(number, 0):
                    continue
                behind[number] = end
            spans.append((self.templates[number].label, start, end, base))
            covered += max(0, end - max(start, reach))
            reach = max(reach, end)
        return len(words), spans, covered / len(words) if words else 0.0


SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def scan(docs: DataFrame, keep: list[str], base=BASE, added=ADDED) -> DataFrame:
    """Columns ``keep`` with n_words, spans (label, start, end, base; word numbers, end exclusive) and score.

    Only the templates' texts travel to the tasks; each worker compiles them once.
    """
    small_batches(docs.sparkSession)
    state: dict = {}

    def fn(texts):
        scanner = state.get("scanner")
        if scanner is None:
            scanner = state["scanner"] = Scanner(base, added)
        made = [scanner.scan(t) for t in texts]
        return {"n_words": [m[0] for m in made], "score": [m[2] for m in made],
                "spans": [[dict(zip(("label", "start", "end", "base"), s)) for s in m[1]] for m in made]}

    return map_texts(docs, keep, fn, {"n_words": pa.int64(), "spans": SPANS, "score": pa.float64()},
                     "n_words long, spans array<struct<label:string,start:bigint,end:bigint,base:boolean>>, score double")


def summary(scanned: DataFrame, keep: list[str]) -> DataFrame:
    """Counts, first and last word of the base spans, and the labels of all spans."""
    of_base = F.filter("spans", lambda s: s["base"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(of_base, lambda s: s["start"])
    return scanned.select(*keep, "n_words", F.size(of_base).cast("long").alias("n_base"),
                          F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                          labels(of_base).alias("base_labels"), labels(F.col("spans")).alias("labels"), "score")
