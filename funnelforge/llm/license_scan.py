"""Licence statements: an exact set-similarity join of text blocks with templates.

A block is a line; a line of more than ``2 * reach`` words is cut into windows
of that length that start every ``reach`` words.  Statements may be wrapped, so
the whole text is cut into such windows as well, and those that hold more than
one line are blocks too: every passage of ``reach`` words lies in one block.  A
block matches a template if it holds at least ``containment`` of the template's
distinct words; a window reports only what it matches without the words of
single lines' matches.

One pass counts in how many documents each template word occurs.  Words are
ordered by that, rarest first.  In the join a template is indexed by its prefix
(all but ``needed - 1`` of its words, in that order): a matching block must hold
one of them.  Blocks with fewer template words than needed fall to the length
filter, and at a block's first common word the positions bound the overlap that
can still follow.  What is left is verified by the exact overlap.
A match names its template's label unless another template of the same block
explains it better: it matched these words and more, or the same words with a
larger containment (BY inside BY-NC).

Independently every place of the base phrases is found in the whole text.

Defined results: null or wordless text has no place and no label (empty
strings, score 0); repeated rows count as given; with no template only the base
phrases are found; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Base phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Statements of well-known licences, and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("mpl", "Subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright, CC0 public domain dedication"),
    ("all-rights-reserved", "All rights reserved."),
]
CONTAINMENT = 0.85
REACH = 32
TEMPLATE_BYTES = 8 << 20
SCAN_SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
               "labels string, score double, matches array<struct<label: string, line: bigint, word: bigint, "
               "containment: double>>")


class TemplateIndex:
    """Templates as rarest-first word lists, indexed by their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], documents_with: dict[bytes, int], containment: float):
        self.labels = [label for label, _ in templates]
        sets = [set(common.alnum_words(text.encode())) for _, text in templates]
        order = sorted(set().union(*sets), key=lambda w: (documents_with.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.sorted = [sorted(self.rank[w] for w in s) for s in sets]
        self.needed = [max(1, -(-round(len(s) * containment * 1e6) // 1_000_000)) for s in sets]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, (words, needed) in enumerate(zip(self.sorted, self.needed)):
            for i, w in enumerate(words[:len(words) - needed + 1]):
                self.prefix.setdefault(w, []).append((t, i))
        self.leads = {order[i] for i in self.prefix}
        self.least = min(self.needed, default=0)

    def join(self, block: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that the block matches."""
        own = sorted({self.rank[w] for w in block if w in self.rank})
        if len(own) < self.least:
            return []
        candidates: dict[int, bool] = {}
        for j, w in enumerate(own):
            for t, i in self.prefix.get(w, ()):
                if t not in candidates:
                    candidates[t] = 1 + min(len(self.sorted[t]) - i, len(own) - j) - 1 >= self.needed[t]
        held = set(own)
        found = ((t, len(held.intersection(self.sorted[t]))) for t, alive in candidates.items() if alive)
        return [(t, n / len(self.sorted[t])) for t, n in found if n >= self.needed[t]]

    def leading(self, block: list[bytes], found: list[tuple[int, float]]) -> set[str]:
        """Labels of the matches that no other match explains better: by these
        words and more, or by the same words with a larger containment."""
        held = {self.rank[w] for w in block if w in self.rank}
        shared = [(held.intersection(self.sorted[t]), c) for t, c in found]
        return {self.labels[t] for (t, _), (own, c) in zip(found, shared)
                if not any(own < other or own == other and c < d for other, d in shared)}


def blocks(text: bytes, reach: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(line, first word in the line, words) of every block inside a line."""
    for line, body in enumerate(text.split(b"\n")):
        words = common.alnum_words(body)
        if not words:
            continue
        for at in range(0, max(1, len(words) - reach), reach):
            yield line, at, words[at:at + 2 * reach]


def line_starts(text: bytes) -> dict[int, int]:
    """Line -> its first word in the text, for the lines that have words."""
    counts = [len(common.alnum_words(body)) for body in text.split(b"\n")]
    return {line: first for line, (n, first) in enumerate(zip(counts, accumulate(counts, initial=0))) if n}


def wrapped_blocks(words: list[bytes], starts: dict[int, int], reach: int) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """(line, first word in the line, first word in the text, words) of every
    block that holds words of several lines."""
    lines, firsts = list(starts), list(starts.values())
    for at in range(0, max(1, len(words) - reach), reach):
        block = words[at:at + 2 * reach]
        i = bisect_right(firsts, at) - 1
        if i + 1 < len(firsts) and firsts[i + 1] < at + len(block):
            yield lines[i], at - firsts[i], at, block


def phrase_places(words: list[bytes], phrases: list[tuple[bytes, str]]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a phrase."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases:
        at = joined.find(phrase)
        word, counted = 0, 0
        while at >= 0:
            word, counted = word + joined.count(b" ", counted, at), at
            found.append((word, label))
            at = joined.find(phrase, at + 1)
    return found


def scan(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         templates: list[tuple[str, str]] | None = None, containment: float = CONTAINMENT,
         reach: int = REACH) -> DataFrame:
    """Base places and template matches of every document."""
    spark = documents.sparkSession
    templates = TEMPLATES if templates is None else templates
    if sum(len(a) + len(b) for a, b in templates) > TEMPLATE_BYTES:
        raise ValueError(f"templates of over {TEMPLATE_BYTES} bytes: scan them in parts")
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    vocabulary = set().union(*(common.alnum_words(text.encode()) for _, text in templates)) if templates else set()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in common.byte_texts(batch.column(0)):
                counts.update(vocabulary.intersection(common.alnum_words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                                         ["word", "n"])

    counted = (docs.select("text").mapInArrow(frequencies, "word binary, n bigint").groupBy("word")
               .agg(F.sum("n").alias("n")).collect()) if vocabulary else []  # a row per template word
    index = common.Sent(spark, TemplateIndex(templates, {bytes(r.word): r.n for r in counted}, containment))
    phrases = [(f" {p} ".encode(), label) for p, label in PHRASES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = index.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), common.byte_texts(batch.column(1))):
                words = common.alnum_words(text)
                places = phrase_places(words, phrases)
                matches, named = [], set()
                if not join.leads.isdisjoint(words):
                    starts = line_starts(text)
                    in_line: dict[int, bytearray] = {}  # of a template: marks of the words of its blocks
                    for line, at, block in blocks(text, reach):
                        if found := join.join(block):
                            matches += [{"label": join.labels[t], "line": line, "word": at, "containment": c}
                                        for t, c in found]
                            named |= join.leading(block, found)
                            for t, _ in found:
                                first = starts[line] + at
                                in_line.setdefault(t, bytearray(len(words)))[first:first + len(block)] = b"\1" * len(block)
                    for line, at, first, block in wrapped_blocks(words, starts, reach):
                        if found := join.join(block):
                            new = []
                            for t, c in found:
                                marks = in_line.get(t)
                                rest = block if marks is None else [w for w, m in zip(block, marks[first:first + len(block)]) if not m]
                                if len(rest) == len(block) or t in dict(join.join(rest)):
                                    new.append((t, c))
                            matches += [{"label": join.labels[t], "line": line, "word": at, "containment": c}
                                        for t, c in new]
                            named |= join.leading(block, found) & {join.labels[t] for t, _ in new}
                base = {label for _, label in places}
                rows.append((doc_id, len(words), len(places), min((w for w, _ in places), default=None),
                             max((w for w, _ in places), default=None), ",".join(sorted(base)),
                             ",".join(sorted(base | named)),
                             1.0 if places else max((m["containment"] for m in matches), default=0.0), matches))
            match = pa.struct([("label", pa.string()), ("line", pa.int64()), ("word", pa.int64()),
                               ("containment", pa.float64())])
            types = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.float64(), pa.list_(match)]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 9, types)], names)

    return docs.mapInArrow(run, SCAN_SCHEMA)
