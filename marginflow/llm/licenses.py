"""Licence scans with a positional index of rare words.

Notice templates are indexed by word: each word has postings (template, position).  Document
frequencies of the template words over all documents give their IDF.  In a file, the template
words of high IDF (at least ``rare`` times the highest of their template) are looked up; every
posting proposes that its template starts at (file position - template position).  Postings that
propose starts near each other, within a slack that grows with the template's length (inserted and
lost words shift what follows them), are intersected: the heaviest chain of postings that ascend in
the file and in the template counts.  A template matches where the IDF of such a chain reaches
``min_share`` of all its rare words', and each of its key phrases stands in full within that place.

Plain phrases that name a licence are counted everywhere as well.  Words are runs of ASCII
letters, digits and non-ASCII characters, with A-Z lower-cased.  The score is the best share of a
template, or 1 where a plain phrase stands.  Defined results: a null or empty text has no words, no
labels and score 0; places are null where no phrase stands; of equal shares the first template
counts; very long texts are scanned whole; repeated rows each have their row; no rows give no rows;
columns beside the two named are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, small_batches, texts

_KEEP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

# Phrases that name a licence, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]


# Well-known licence notices, short and in full, and the phrases that must stand in them.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
             ("hereby granted free of charge",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
             "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
             "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
             "subject to the following conditions: The above copyright notice and this permission notice shall be "
             "included in all copies or substantial portions of the Software.",
             ("hereby granted free of charge", "substantial portions of the software")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
             "copies.", ("permission to use copy modify", "with or without fee")),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of "
             "the License at http://www.apache.org/licenses/LICENSE-2.0", ("compliance with the license",)),
    Template("apache", "Unless required by applicable law or agreed to in writing, software distributed under the "
             "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
             "or implied. See the License for the specific language governing permissions and limitations under the "
             "License.", ("unless required by applicable law", "specific language governing permissions")),
    Template("gpl", "This work is licensed under the GNU General Public License version 3", ("gnu general public license",)),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
             "published by the Free Software Foundation", ("gnu general public license",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
             "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
             "PURPOSE.", ("gnu general public license", "free software foundation")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software "
             "Foundation", ("lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software "
             "Foundation", ("affero general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met", ("redistribution and use", "are permitted provided")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met: Redistributions of source code must retain the above "
             "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
             "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
             "documentation and/or other materials provided with the distribution.",
             ("redistribution and use", "redistributions in binary form")),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
             "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
             ("mozilla public license",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license",)),
    Template("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
             "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", ("eclipse public license",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to "
             "copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
             "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
             ("free and unencumbered software", "public domain")),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the "
             "authors be held liable for any damages arising from the use of this software. Permission is granted to "
             "anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely", ("permission is granted to anyone", "redistribute it freely")),
    Template("bsl", "Boost Software License - Version 1.0 - August 17th, 2003", ("boost software license",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
             "rights to this work", ("waived all copyright",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("creative commons attribution noncommercial",)),
    Template("all-rights-reserved", "All rights reserved", ("all rights reserved",)),
)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_KEEP).split()


def places(words: list[bytes], phrase: list[bytes], low: int = 0, high: int | None = None) -> list[int]:
    """Starts of a phrase within words[low:high]."""
    high = len(words) if high is None else min(high, len(words))
    out, at, n = [], low, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at, high)
        except ValueError:
            return out
        if at + n <= high and words[at:at + n] == phrase:
            out.append(at)
        at += 1


def heaviest_chain(steps: list[tuple[int, int, float]]) -> float:
    """Greatest weight of steps (file position, template position, weight) that ascend in both.

    A running maximum over template positions (a Fenwick tree), so dense places stay cheap.
    """
    steps = sorted(steps, key=lambda s: (s[0], -s[1]))
    size = max(i for _, i, _ in steps) + 1
    tree = [0.0] * (size + 1)
    for _, i, weight in steps:
        best, j = 0.0, i  # chains that end before template position i
        while j > 0:
            best, j = max(best, tree[j]), j & (j - 1)
        best, j = best + weight, i + 1
        while j <= size:
            tree[j], j = max(tree[j], best), j + (j & -j)
    return max(tree)


class Index:
    """Rare words of the templates, their postings and weights."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float], rare: float,
                 min_share: float, slack: float):
        self.templates, self.min_share = templates, min_share
        self.words = [words_of(t.text.encode()) for t in templates]
        self.slack = [max(2, round(slack * len(w))) for w in self.words]
        self.keys = [[k.encode().split() for k in t.keys] for t in templates]
        self.idf = idf
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.total = []
        for t, words in enumerate(self.words):
            least = rare * max(idf[w] for w in words)
            chosen = [(i, w) for i, w in enumerate(words) if idf[w] >= least]
            self.total.append(sum(idf[w] for _, w in chosen))
            for i, w in chosen:
                self.postings.setdefault(w, []).append((t, i))

    def match(self, words: list[bytes]) -> dict[str, float]:
        """Best share of each label whose template and key phrases are found."""
        if not words or self.postings.keys().isdisjoint(words):
            return {}
        proposed: dict[int, list[tuple[int, int, int, float]]] = {}
        for at, word in enumerate(words):
            for t, i in self.postings.get(word, ()):
                proposed.setdefault(t, []).append((at - i, at, i, self.idf[word]))
        found: dict[str, float] = {}
        for t, steps in proposed.items():
            label, slack = self.templates[t].label, self.slack[t]
            need = max(self.min_share, found.get(label, 0.0))
            if sum({i: w for _, _, i, w in steps}.values()) / self.total[t] < need:
                continue  # not even with all its words anywhere
            steps.sort()
            low = high = 0
            for start in sorted({s[0] for s in steps}):
                while steps[low][0] < start - slack:
                    low += 1
                while high < len(steps) and steps[high][0] <= start + slack:
                    high += 1
                near = steps[low:high]
                most = sum({i: w for _, _, i, w in near}.values()) / self.total[t]
                if most < self.min_share or most <= found.get(label, 0.0):
                    continue
                share = heaviest_chain([s[1:] for s in near]) / self.total[t]
                if share < self.min_share or share <= found.get(label, 0.0):
                    continue
                first, stop = max(0, start - slack), start + len(self.words[t]) + slack
                if all(places(words, key, first, stop) for key in self.keys[t]):
                    found[label] = min(1.0, share)
        return found


def frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """Documents that have each word of a fixed vocabulary (one row a word reaches the driver), and all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for _, raws in rows_of(batches):
            count[b""] += len(raws)  # no word is empty
            for text in raws:
                count.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in count], pa.string()), pa.array(count.values(), pa.int64())], ["word", "n"])

    counted = docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"].encode(): r["n"] for r in counted.collect()}
    return found, found.pop(b"", 0)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases=PHRASES, rare: float = 0.5,
         min_share: float = 0.8, slack: float = 0.15, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``slack`` is the share of a template's length by which its words may stand shifted (2 words at least).
    """
    small_batches(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    vocabulary = {w for t in templates for w in words_of(t.text.encode())}
    seen, total = frequencies(rows, vocabulary)
    idf = {w: math.log((max(1, total) + 1) / (seen.get(w, 0) + 0.5)) for w in vocabulary}
    named = [(p.encode().split(), label) for p, label in phrases]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, idf, rare, min_share, slack)
        for batch, raws in rows_of(batches):
            out = []
            for text in raws:
                words = words_of(text)
                stands = {(at, label) for phrase, label in named for at in places(words, phrase)}
                base = {label for _, label in stands}
                more = index.match(words)
                score = 1.0 if base else max(more.values(), default=0.0)
                out.append((len(words), len(stands), min(stands)[0] if stands else None,
                            max(stands)[0] if stands else None, ",".join(sorted(base)),
                            ",".join(sorted(base | more.keys())), score))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names)

    return rows.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                "base_labels string, labels string, score double")
