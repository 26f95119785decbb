"""License scans: a generalised suffix automaton of licence texts, and chains of long matches.

All templates (licence texts, short notices, names) are read into one automaton of their words.
A file's words are streamed through it once: at each word the automaton knows the longest run
of words ending there that stands in some template (the matching statistics). Where that run
cannot grow it is a maximal match. Maximal matches of at least LONG words are chained for each
template, in order in both texts and with gaps of at most GAP words; the share of a template
that its best chain covers decides about its label and gives the span. A template that is one of
NAMES is reported at each place where it stands whole, which the same stream tells.

Words are runs of ASCII letters, digits and non-ASCII characters; A-Z are lower-cased. Null and
empty texts have no words, no places, no labels and score 0. Repeated rows and further columns pass
through untouched. Of equal chains the one that ends first is the span. Texts are read whole; memory
is that of one text's words and, while chaining, of the chains within GAP words.
"""

from bisect import bisect_left
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.llm.arrow import over_texts

#: Least words of a match that enters a chain; most words between two matches of a chain.
LONG, GAP = 4, 40
#: Least share of a template that a chain must cover for its label.
COVERED = 0.6

# fixed values: names of licences and their labels
NAMES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# fixed values: public licence texts and notices, as their stewards word them
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details. You should have received a copy of the GNU General Public License along with this program.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "agpl",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
]

SCAN = (
    "struct<n_words:bigint,places:array<struct<word:bigint,label:string>>,"
    "spans:array<struct<label:string,template:int,first:bigint,last:bigint,covered:double>>>"
)
_PLACE = pa.struct([("word", pa.int64()), ("label", pa.string())])
_SPAN = pa.struct(
    [("label", pa.string()), ("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())]
)
_SCAN = pa.struct([("n_words", pa.int64()), ("places", pa.list_(_PLACE)), ("spans", pa.list_(_SPAN))])

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text) -> list:
    """Words of a text or of its UTF-8 bytes, in which every byte of a non-ASCII character is a word's."""
    raw = text.encode() if isinstance(text, str) else text
    return raw.translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """Suffix automaton of several word sequences.

    A state is a class of word runs that end at the same places. `moves` are its transitions,
    `link` the state of its longest proper suffix of another class, `size` its longest run,
    `ends` the (template, last word) places of its runs.
    """

    vocabulary: dict = field(default_factory=dict)
    moves: list = field(default_factory=lambda: [{}])
    link: list = field(default_factory=lambda: [-1])
    size: list = field(default_factory=lambda: [0])
    ends: list = field(default_factory=lambda: [set()])
    templates: list = field(default_factory=list)  # (label, words, whether a name)
    names: list = field(default_factory=list)  # per state: (words, label) of names that end with its runs

    def _state(self, size, moves, link):
        self.moves.append(moves)
        self.link.append(link)
        self.size.append(size)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, state, word, onto):
        """The state of the runs of `onto` that are no longer than those of `state` with `word`."""
        if self.size[onto] == self.size[state] + 1:
            return onto
        copy = self._state(self.size[state] + 1, dict(self.moves[onto]), self.link[onto])
        while state >= 0 and self.moves[state].get(word) == onto:
            self.moves[state][word] = copy
            state = self.link[state]
        self.link[onto] = copy
        return copy

    def _extend(self, last, word):
        known = self.moves[last].get(word)
        if known is not None:  # another template has this run already
            return self._split(last, word, known)
        new = self._state(self.size[last] + 1, {}, 0)
        while last >= 0 and word not in self.moves[last]:
            self.moves[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.moves[last][word])
        return new

    def add(self, label, text, name=False):
        words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
        if not words:
            raise ValueError(f"a template of {label!r} has no words")
        number, last = len(self.templates), 0
        self.templates.append((label, len(words), name))
        for word in words:
            last = self._extend(last, word)
        return number, words

    def finish(self, added):
        """Places and names of each state, passed on along the suffix links."""
        self.names = [()] * len(self.size)
        for number, words in added:
            state = 0
            for at, word in enumerate(words):
                state = self.moves[state][word]
                self.ends[state].add((number, at))
        by_size = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for state in reversed(by_size):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]
        for number, words in added:
            label, n, name = self.templates[number]
            if name:
                state = 0
                for word in words:
                    state = self.moves[state][word]
                self.names[state] += ((n, label),)
        for state in by_size:  # a run ends with all that its suffixes end with
            if self.link[state] > 0:
                self.names[state] += self.names[self.link[state]]
        self.ends = [tuple(sorted(e)) for e in self.ends]
        return self


def automaton(templates=None, names=None) -> Automaton:
    """The automaton of (label, text) templates and (phrase, label) names; its size is that of their words."""
    built = Automaton()
    added = [built.add(label, phrase, name=True) for phrase, label in (NAMES if names is None else names)]
    added += [built.add(label, text) for label, text in (TEMPLATES if templates is None else templates)]
    return built.finish(added)


def matching_statistics(built: Automaton, ids):
    """(state, length) of the longest run ending at each word that stands in a template; ids: -1 is a foreign word."""
    moves, link, size = built.moves, built.link, built.size
    state = length = 0
    for word in ids:
        while state and word not in moves[state]:
            state = link[state]
            length = size[state]
        following = moves[state].get(word)
        if following is None:
            state = length = 0
        else:
            state, length = following, length + 1
        yield state, length


class Chains:
    """Best chain of each template, fed with maximal matches in the order of their ends in the text."""

    def __init__(self, built, gap):
        self.templates, self.gap = built.templates, gap
        self.open = {}  # template -> matches whose ends are near: (text end, template end, covered, text start)
        self.spans = []

    def add(self, end, length, places):
        first = end - length + 1
        for template, at in places:
            label, n, name = self.templates[template]
            if name:
                continue
            near = self.open.setdefault(template, deque())
            while near and near[0][0] < first - 1 - self.gap:
                near.popleft()
            covered, start = length, first
            for text_end, template_end, before, begun in near:
                if text_end < end and template_end < at:
                    joined = before + min(length, end - text_end, at - template_end)
                    if joined > covered:
                        covered, start = joined, begun
            near.append((end, at, covered, start))
            self.spans.append((template, covered, start, end))

    def best(self, share):
        """Spans that cover enough of their template; of spans that meet, the one that covers most."""
        found, taken = [], {}  # taken: template -> its spans' starts and ends, in order and apart
        enough = [s for s in self.spans if s[1] >= share * self.templates[s[0]][1]]
        for template, covered, start, end in sorted(enough, key=lambda s: (s[0], -s[1], s[3], s[2])):
            starts, ends = taken.setdefault(template, ([], []))
            at = bisect_left(ends, start)
            if at == len(starts) or starts[at] > end:
                starts.insert(at, start)
                ends.insert(at, end)
                found.append((template, covered, start, end))
        return [
            {"label": self.templates[t][0], "template": t, "first": s, "last": e, "covered": c / self.templates[t][1]}
            for t, c, s, e in sorted(found, key=lambda f: (f[2], f[3], f[0]))
        ]


def scan(built: Automaton, text, long=LONG, gap=GAP, share=COVERED) -> dict:
    """Words, places of names and covered spans of one text (or its UTF-8 bytes)."""
    words = words_of(text) if text else []
    ids = np.fromiter(map(built.vocabulary.get, words, [-1] * len(words)), np.int32, len(words))
    inside = np.flatnonzero(ids >= 0)
    if not len(inside):
        return {"n_words": len(words), "places": [], "spans": []}
    # no run crosses a foreign word; a lone known word is neither a name nor a long match
    breaks = np.flatnonzero(np.diff(inside) > 1)
    starts, stops = inside[np.append(0, breaks + 1)], inside[np.append(breaks, len(inside) - 1)] + 1
    least = min([long] + [n for _, n, name in built.templates if name])
    wide = stops - starts >= least
    chains, places = Chains(built, gap), []
    for start, stop in zip(starts[wide].tolist(), stops[wide].tolist()):
        before = (0, 0)
        for at, (state, length) in enumerate(matching_statistics(built, ids[start:stop].tolist()), start):
            if before[1] >= long and length <= before[1]:
                chains.add(at - 1, before[1], built.ends[before[0]])
            places += [{"word": at - n + 1, "label": label} for n, label in built.names[state] if n <= length]
            before = (state, length)
        if before[1] >= long:
            chains.add(stop - 1, before[1], built.ends[before[0]])
    return {"n_words": len(words), "places": sorted(places, key=lambda p: (p["word"], p["label"])), "spans": chains.best(share)}


def scanner(spark, built: Automaton, long=LONG, gap=GAP, share=COVERED):
    """A function from a text column to SCAN: the number of words, the places of names, the covered spans."""
    shared = spark.sparkContext.broadcast(built)

    def prepare():
        return lambda texts: [scan(shared.value, text, long, gap, share) for text in texts]

    def apply(text: Column) -> Column:
        return over_texts(SCAN, _SCAN, prepare, raw=True)(text)

    return apply


def summary(found: Column) -> list:
    """Columns that sum a scan up; score is the largest share of a template that stands in the text (a name is one)."""
    at = F.transform(found["places"], lambda p: p["word"])
    named = F.transform(found["places"], lambda p: p["label"])
    covered = F.transform(found["spans"], lambda s: s["label"])
    best = F.coalesce(F.array_max(F.transform(found["spans"], lambda s: s["covered"])), F.lit(0.0))
    written = [F.array_join(F.array_sort(F.array_distinct(labels)), ",") for labels in (named, F.concat(named, covered))]
    return [
        found["n_words"].alias("n_words"),
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        written[0].alias("base_labels"),
        written[1].alias("labels"),
        F.when(F.size(at) > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"),
    ]
