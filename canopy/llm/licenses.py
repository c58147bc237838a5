"""License scan by an exact set-similarity join (op 11).

Every text is laid out in blocks of consecutive words, every license template is a set of words, and
the join finds each block that holds at least the share `threshold` of a template's distinct words
(containment). Blocks come in sizes: a template of up to m words (m a power of two) is sought in
blocks of 2m words that start at the multiples of m, so a passage of m words lies whole in a block
wherever it begins.

The join is exact and reads few blocks. Template words are ordered by their frequency in the whole
corpus, counted in a first pass, rarest first.
* Prefix filter: a block with `need` words of a template of k words holds one of its k - need + 1
  rarest. Only the blocks around such words are looked at, and in a block only its own prefix, the
  words of the size's templates but the last need - 1, can open a pair.
* Length filter: a block with fewer than `need` words of the size's templates can't reach it.
* Positional filter: at a shared word, the words behind it in both sets bound what the overlap can
  still become.
A pair that passes is verified by the size of the intersection.

The templates are parameters: their words and the index go to the tasks with the code, and more than
MAX_TEMPLATE_BYTES of them are refused. Texts are read in place, none is shuffled, so no key is hot.

A match gives its template's label, unless a template that holds all the words of the matched one
matches in an overlapping block (the text of CC BY-NC holds that of CC BY). The base labels are the
places where the words of a phrase stand consecutively. The score is 1 at such a place, else the
largest containment found, else 0.

Null and empty texts have no words and no label. Repeated rows and null ids are judged each, texts of
any length whole. Empty tables give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, raw_text, ship, sliced

# Phrases with their labels, in the order of the contract.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Labels and public wordings of license notices.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("bsd", "licensed under the BSD 3-Clause License"),
    ("bsd", "licensed under the BSD 2-Clause License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]

#: Share of a template's distinct words, in hundredths.
THRESHOLD = 90
LEAST_SIZE = 8
MAX_TEMPLATE_BYTES = 4 << 20
SCHEMA = ("doc_id long, n_words long, places array<struct<phrase: int, word: long>>, "
          "blocks array<struct<template: int, first_word: long, shared: int, containment: double>>")

#: What separates words becomes a blank, A-Z become a-z; digits, letters and all bytes from 0x80 on stay.
_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
               for c in range(256))


def spelled(text: bytes) -> list[bytes]:
    """The words of a text."""
    return text.translate(_WORDS).split()


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: frozenset[bytes]
    size: int      # blocks hold 2 * size words
    need: int      # least number of shared words


def templates_of(texts: list[tuple[str, str]], threshold: int = THRESHOLD) -> list[Template]:
    if sum(len(t.encode()) for _, t in texts) > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_BYTES} bytes")
    if not 0 < threshold <= 100:
        raise ValueError("threshold: 1 to 100")
    out = []
    for i, (label, text) in enumerate(texts):
        words = spelled(text.encode())
        if words:
            size = max(LEAST_SIZE, 1 << (len(words) - 1).bit_length())
            k = len(set(words))
            out.append(Template(i, label, frozenset(words), size, -(-threshold * k // 100)))
    return out


class _Numbers(dict):
    """Word -> its rank by frequency; -1 for words of no template."""

    def __missing__(self, word: bytes) -> int:
        return -1


def frequencies(docs: DataFrame, templates: list[Template]) -> dict[bytes, int]:
    """How often each template word stands in the whole corpus: at most as many rows as template words."""
    ship(docs.sparkSession)
    vocabulary = sorted(set().union(*(t.words for t in templates)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers((w, i) for i, w in enumerate(vocabulary))
        total = np.zeros(len(vocabulary) + 1, np.int64)
        for b in batches:
            for part in sliced(b):
                for text in part.column(0).to_pylist():
                    words = spelled(text or b"")
                    at = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                    total += np.bincount(at + 1, minlength=len(total))
        yield pa.RecordBatch.from_pydict({"word": pa.array(range(len(vocabulary)), pa.int32()), "n": pa.array(total[1:], pa.int64())})

    rows = docs.select(raw_text().alias("_text")).mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = {r["word"]: r["n"] for r in rows.collect()}
    return {w: counted.get(i, 0) for i, w in enumerate(vocabulary)}


class Join:
    """The index of the templates' prefixes, and the join of a text's blocks with it."""

    def __init__(self, templates: list[Template], counts: dict[bytes, int]):
        order = sorted(set().union(*(t.words for t in templates)), key=lambda w: (counts.get(w, 0), w))
        self.rank = _Numbers((w, i) for i, w in enumerate(order))
        self.templates = {t.number: t for t in templates}
        #: per template, its ranks in order, and the position of each
        self.ranks = {t.number: sorted(self.rank[w] for w in t.words) for t in templates}
        self.position = {i: {r: p for p, r in enumerate(rs)} for i, rs in self.ranks.items()}
        #: size -> rank -> (template, position there) of prefix words
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for t in templates:
            of_size = self.index.setdefault(t.size, {})
            for p, r in enumerate(self.ranks[t.number][:len(t.words) - t.need + 1]):
                of_size.setdefault(r, []).append((t.number, p))
        self.in_prefix, self.in_size = {}, {}
        for size, of_size in self.index.items():
            self.in_prefix[size] = np.zeros(len(order) + 1, bool)
            self.in_prefix[size][list(of_size)] = True
            self.in_size[size] = frozenset().union(*(self.ranks[t.number] for t in templates if t.size == size))

    def text(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(template, first word of the block, shared words, containment) of every pair that meets the threshold."""
        at = np.fromiter(map(self.rank.__getitem__, words), np.int64, len(words))
        out = []
        for size, prefixes in self.in_prefix.items():
            hits = np.flatnonzero(prefixes[at]) // size
            if len(hits):
                for block in np.unique(np.concatenate([hits, hits[hits > 0] - 1])).tolist():
                    out += self._block(size, block * size, at[block * size:(block + 2) * size])
        return sorted(out)

    def _block(self, size: int, start: int, at: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        held = sorted(self.in_size[size].intersection(at.tolist()))
        index = self.index[size]
        seen: dict[int, int] = {}  # shared prefix words of a template; -1: it can't reach its need
        for j, r in enumerate(held):
            for number, i in index.get(r, ()):
                t = self.templates[number]
                so_far = seen.get(number, 0)
                if so_far < 0 or len(held) < t.need or not so_far and j > len(held) - t.need:
                    continue
                # the words behind this one in both sets bound the overlap
                ahead = min(len(t.words) - i - 1, len(held) - j - 1)
                seen[number] = so_far + 1 if so_far + 1 + ahead >= t.need else -1
        here = set(held)
        for number, so_far in seen.items():
            if so_far > 0:
                t = self.templates[number]
                shared = len(here.intersection(self.ranks[number]))
                if shared >= t.need:
                    yield number, start, shared, shared / len(t.words)


def phrase_places(words: list[bytes], phrases: list[tuple[str, str]] = PHRASES) -> list[tuple[int, int]]:
    """(phrase, first word) of every place where a phrase's words stand consecutively."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for number, (phrase, _) in enumerate(phrases):
        sought = b" " + b" ".join(spelled(phrase.encode())) + b" "
        at, seen, word = line.find(sought), 0, 0
        while at >= 0:
            word += line.count(b" ", seen, at)
            seen = at
            out.append((number, word))
            at = line.find(sought, at + 1)
    return out


def scan(docs: DataFrame, texts: list[tuple[str, str]] = TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_words, places of the phrases, and every block that meets a template's threshold."""
    templates = templates_of(texts, threshold)
    counts = frequencies(docs, templates)

    def rows(items: Iterator[tuple]) -> Iterator[tuple]:
        join = Join(templates, counts)
        for doc_id, text in items:
            words = spelled(text or b"")
            yield doc_id, len(words), phrase_places(words), join.text(words)

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("_text")), rows, SCHEMA)


def digest(found: DataFrame, texts: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Counts, labels and score of each document."""
    templates = {t.number: t for t in templates_of(texts)}
    numbers = [t.number if (t := templates.get(i)) else -1 for i in range(len(texts))]
    size = F.array(*(F.lit(2 * templates[i].size if i >= 0 else 0).cast("long") for i in numbers))
    label = F.array(*(F.lit(label) for label, _ in texts))
    base = F.array(*(F.lit(label) for _, label in PHRASES))
    #: templates whose words another one holds besides words of its own
    wider = F.array(*(F.array(*(F.lit(j) for j, other in templates.items() if i >= 0 and templates[i].words < other.words))
                      .cast("array<int>") for i in numbers))

    def refined(b):
        end = b["first_word"] + F.element_at(size, b["template"] + 1)
        return F.exists("blocks", lambda o: F.array_contains(F.element_at(wider, b["template"] + 1), o["template"])
                        & (o["first_word"] < end) & (b["first_word"] < o["first_word"] + F.element_at(size, o["template"] + 1)))

    base_labels = F.transform("places", lambda p: F.element_at(base, p["phrase"] + 1))
    own = F.transform(F.filter("blocks", lambda b: ~refined(b)), lambda b: F.element_at(label, b["template"] + 1))
    score = (F.when(F.size("places") > 0, F.lit(1.0))
             .otherwise(F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))))
    starts = F.transform("places", lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"), score.alias("score"))


def matches(found: DataFrame, texts: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per block that meets a template's threshold: doc_id, template, label, block, containment."""
    label = F.array(*(F.lit(label) for label, _ in texts))
    return found.select("doc_id", F.explode("blocks").alias("b")).select(
        "doc_id", "b.template", F.element_at(label, F.col("b.template") + 1).alias("label"), "b.first_word", "b.shared", "b.containment")
