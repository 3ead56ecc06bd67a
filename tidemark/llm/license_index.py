"""Licence scan by a positional rare-token index (operator 8).

Templates (short base phrases and longer notices) are indexed by word and
position.  One pass counts in how many documents each licence word occurs; the
highest-IDF words of a template are its anchors.  A second pass looks the
anchors up in each text: an anchor at word p that stands at place q of a template
votes for the template starting at p - q.  A start whose votes agree is verified:
the words are compared in place, and every mandatory key phrase must stand there
in whole.  A base phrase is its own key phrase, so it must stand word for word.

Words: A-Z lower-cased, runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F].  Null or
empty text: no words, no labels, score 0.  Rows are judged one by one, so
repeated rows and null ids keep their rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_SPACED).split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]
    least: float = 0.8  # part of the words that must stand in place
    base: bool = False


def phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), 1.0, True)


# The base phrases, then the sentences by which public licences are recognised.
TEMPLATES = (
    phrase("mit", "under the mit license"),
    phrase("apache-2", "apache license version 2"),
    phrase("cc-by-nc", "cc by nc"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction",
             ("hereby granted free of charge", "without restriction")),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the "
             "License at http://www.apache.org/licenses/LICENSE-2.0", ("apache org licenses license 2 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met", ("source and binary forms", "with or without modification")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted", ("for any purpose with or without fee",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             ("gnu lesser general public license",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license v 2 0",)),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("attribution noncommercial 4 0",)),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",), 1.0),
)
ANCHORS = 4


def document_frequency(docs: DataFrame, vocabulary: frozenset[bytes], text_col: str = "text") -> DataFrame:
    """(word, n): documents of the whole table that hold each licence word; word null counts all documents."""
    src = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                n.update(vocabulary.intersection(words(text.as_py())))
            n[None] += batch.num_rows
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([None if w is None else w.decode() for w in n], pa.string()),
            "n": pa.array(list(n.values()), pa.int64())})

    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """Template postings of the highest-IDF words."""

    def __init__(self, templates: tuple[Template, ...], counts: dict[str | None, int], anchors: int = ANCHORS):
        self.templates = templates
        self.words = [words(t.text) for t in templates]
        self.keys = [[words(k) for k in t.keys] for t in templates]
        total = counts.get(None, 0)
        self.idf = {w: math.log((total + 1) / (counts.get(w.decode(), 0) + 1)) for ws in self.words for w in ws}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.votes = []
        for k, ws in enumerate(self.words):
            best = sorted(set(ws), key=lambda w: (-self.idf[w], w))[: 1 if templates[k].base else anchors]
            # a base phrase has one anchor; a longer notice needs half of its anchors to agree
            self.votes.append(max(1, len(best) // 2))
            for at, w in enumerate(ws):
                if w in best:
                    self.postings[w].append((k, at))

    def match(self, ws: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, part of its words in place) of every verified place."""
        post = self.postings
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for p, w in enumerate(ws):
            if w in post:
                for k, q in post[w]:
                    if p >= q:
                        votes[k, p - q].add(w)
        found = []
        for (k, start), agreed in votes.items():
            if len(agreed) < self.votes[k]:
                continue
            own, here = self.words[k], ws[start : start + len(self.words[k])]
            part = sum(a == b for a, b in zip(own, here)) / len(own)
            if part >= self.templates[k].least and all(
                any(here[i : i + len(key)] == key for i in range(len(here) - len(key) + 1)) for key in self.keys[k]
            ):
                found.append((k, start, part))
        return found


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, matches array<struct<label, base, start, words, part>>) of every text."""
    vocabulary = frozenset(w for t in templates for w in words(t.text))
    # bounded by the templates' words
    counts = {r["word"]: r["n"] for r in document_frequency(docs, vocabulary, text_col).collect()}
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (f"id {src.schema['id'].dataType.simpleString()}, n_words long, "
              "matches array<struct<label:string,base:boolean,start:bigint,words:int,part:double>>")
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()),
                               ("words", pa.int32()), ("part", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, counts)
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(1):
                ws = words(text.as_py())
                sizes.append(len(ws))
                found.append([
                    {"label": templates[k].label, "base": templates[k].base, "start": at, "words": len(index.words[k]), "part": part}
                    for k, at, part in sorted(index.match(ws), key=lambda m: (m[1], m[0]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind)], names=["id", "n_words", "matches"])

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    names = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["part"])), F.lit(0.0)).alias("score"))
