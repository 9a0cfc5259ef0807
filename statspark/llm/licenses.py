"""License scan with a positional index of rare words.

Licence templates are indexed by word: for each word its templates and places there. A file is looked up by those of
its words that are in the index, rarest in the corpus first; a posting and a place in the file give the place where
the template would begin, and words that agree on it, within a few words, are votes for that template there. A template
is found where half of its rarest words vote for a place, a mandatory phrase stands word by word, and most of it stands.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import FOLD, in_batches

#: Phrases of the base scan and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Label, mandatory phrases of which one must stand, and a notice (public licence texts, by clause).
TEMPLATES = [
    ("mit", ("under the mit license",), "released under the MIT License"),
    ("mit", ("permission is hereby granted", "associated documentation files"), "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")"),
    ("mit", ("to deal in the software without restriction",), "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", ("permission notice shall be included",), "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", ("merchantability fitness for a particular purpose and noninfringement",), "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("mit", ("in no event shall the authors or copyright holders be liable",), "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"),
    ("apache-2", ("apache license version 2",), "Apache License, Version 2.0"),
    ("apache-2", ("apache org licenses license 2 0",), "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", ("you may not use this file except in compliance with the license", "distributed under the license is distributed on an as is basis"), "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("cc-by-nc", ("cc by nc",), "CC BY-NC"),
    ("cc-by-nc", ("attribution noncommercial",), "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", ("cc by sa",), "CC BY-SA"),
    ("cc-by-sa", ("attribution sharealike",), "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0-1", ("cc0 1 0 universal",), "CC0 1.0 Universal"),
    ("gpl-3", ("gnu general public license version 3",), "GNU General Public License version 3"),
    ("gpl-3", ("either version 3 of the license",), "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-2", ("gnu general public license version 2",), "GNU General Public License version 2"),
    ("gpl-2", ("either version 2 of the license",), "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl", ("terms of the gnu general public license",), "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", ("gnu lesser general public license",), "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl", ("under the gnu lesser general public license",), "licensed under the GNU Lesser General Public License"),
    ("agpl-3", ("gnu affero general public license",), "redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("agpl-3", ("under the gnu affero general public license",), "licensed under the GNU Affero General Public License"),
    ("mpl-2", ("mozilla public license v 2 0",), "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", ("redistribution and use in source and binary forms",), "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", ("redistributions of source code must retain",), "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", ("redistributions in binary form must reproduce",), "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", ("may be used to endorse or promote products derived",), "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", ("permission to use copy modify and or distribute this software",), "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", ("altered source versions must be plainly marked as such", "the origin of this software must not be misrepresented"), "The origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("zlib", ("altered source versions must be plainly marked as such",), "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("unlicense", ("free and unencumbered software",), "This is free and unencumbered software released into the public domain"),
    ("epl-2", ("eclipse public license",), "made available under the terms of the Eclipse Public License 2.0"),
]
#: Rarest words of a notice that are looked up, of which half must vote for a place.
RARE = 12
#: Words by which places may differ that still agree, and the share of a notice's weight that must stand.
SLACK, SHARE = 4, 0.6
#: Weight of a word beyond its IDF, so that words which all rows hold weigh something.
LEAST = 0.01


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII characters that are neither letters nor digits, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def vocabulary() -> set[bytes]:
    """Words of all notices and phrases."""
    return {w for _, phrases, notice in TEMPLATES for t in (notice, *phrases) for w in words_of(t)} | {w for p in BASE for w in words_of(p)}


def document_frequency(docs: DataFrame, text: str = "text") -> dict[bytes, int]:
    """In how many rows each licence word stands, over all rows; the result is as small as the vocabulary."""
    known = vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter({b"": 0})
        for batch in batches:
            for value in batch.column(0):
                total.update(known.intersection(words_of(value.as_py())))
                total[b""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], ["word", "n"])

    counted = in_batches(docs.select(text), count, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def idf_of(frequency: dict[bytes, int]) -> dict[bytes, float]:
    rows = frequency.get(b"", 0)
    return {w: math.log((rows + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary()}


class Index:
    """Postings of the templates' rarest words, and the phrases to verify."""

    def __init__(self, idf: dict[bytes, float]):
        self.weight = {w: v + LEAST for w, v in idf.items()}
        self.templates = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed = []
        for number, (label, phrases, notice) in enumerate(TEMPLATES):
            words = words_of(notice)
            rare = set(sorted(set(words), key=lambda w: (-idf[w], w))[:RARE])
            self.templates.append((label, [words_of(p) for p in phrases], words, sum(self.weight[w] for w in words)))
            self.needed.append((rare, (len(rare) + 1) // 2))
            for place, word in enumerate(words):
                if word in rare:
                    self.postings[word].append((number, place))
        self.base = [(p.encode().split(), label) for p, label in BASE.items()]

    def base_places(self, words: list[bytes], present: set[bytes]) -> list[tuple[int, int, str]]:
        """(start, end, label) of the base phrases."""
        found = []
        for key, label in self.base:
            if present.issuperset(key):
                at = -1
                while (at := _next(words, key[0], at + 1)) >= 0:
                    if words[at : at + len(key)] == key:
                        found.append((at, at + len(key), label))
        return found

    def templates_at(self, words: list[bytes], present: set[bytes]) -> list[tuple[int, str, float]]:
        """(place where the template would begin, label, share of its weight that stands), by the rule of ``licences``."""
        likely = {t for t, (rare, least) in enumerate(self.needed) if len(rare & present) >= least}
        if not likely:
            return []
        votes: dict[int, dict[int, set[bytes]]] = {t: defaultdict(set) for t in likely}
        for at, word in enumerate(words):
            if word in self.postings:
                for number, place in self.postings[word]:
                    if number in likely:
                        votes[number][at - place].add(word)
        found = []
        for number, by_place in votes.items():
            label, keys, notice, weight = self.templates[number]
            least = self.needed[number][1]
            places = sorted(by_place)
            ahead = 0
            for i, at in enumerate(places):
                while ahead < len(places) and places[ahead] <= at + SLACK:
                    ahead += 1
                if len(set().union(*(by_place[p] for p in places[i:ahead]))) >= least:
                    low, high = max(0, at), at + len(notice) + SLACK
                    if any(_stands(words, key, low, high) for key in keys):
                        near = (words[max(0, at + j) : max(0, at + j + SLACK + 1)] for j in range(len(notice)))
                        share = min(1.0, sum(self.weight[w] for w, part in zip(notice, near, strict=True) if w in part) / weight)
                        if share >= SHARE:
                            found.append((at, label, share))
        return found


def _stands(words: list[bytes], key: list[bytes], low: int, high: int) -> bool:
    """Whether a phrase stands as a whole between two places."""
    part = words[low:high]
    return any(part[i] == key[0] and part[i : i + len(key)] == key for i in range(len(part) - len(key) + 1))


def _next(words: list[bytes], word: bytes, start: int) -> int:
    try:
        return words.index(word, start)
    except ValueError:
        return -1


def _scan(index: Index):
    known = vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                words = words_of(value.as_py())
                present = known.intersection(words)
                base = index.base_places(words, present) if present else []
                more = index.templates_at(words, present) if present else []
                starts = [a for a, _, _ in base]
                rows.append(
                    (
                        len(words),
                        len(base),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted({x[2] for x in base})),
                        ",".join(sorted({x[2] for x in base} | {x[1] for x in more})),
                        max((x[2] for x in more), default=1.0 if base else 0.0),
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def licences(
    docs: DataFrame, key: str = "doc_id", text: str = "text", frequency: dict[bytes, int] | None = None
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per row of ``docs``.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are the first and last of them
    (words from 0; null without any). A template is found at a place when half of its rarest words or more stand where
    they would if it began there or up to ``SLACK`` words later, one of its mandatory phrases stands there as a whole, and
    so does ``SHARE`` of its notice by weight, each word within the same slack. ``labels`` adds the labels of those, and
    ``score`` is the greatest such share (1 for a base phrase alone, 0 without a label). Null and empty texts have no words. Rows may
    repeat and lack an id; other columns are not read. An empty table gives no rows.
    """
    index = Index(idf_of(document_frequency(docs, text) if frequency is None else frequency))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return in_batches(docs.select(F.col(key).cast("long").alias("doc_id"), text), _scan(index), schema)
