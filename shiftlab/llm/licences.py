"""Licences of files: TF-IDF cosine of their notices to templates, then inheritance along directories.

Notices are looked for in the whole of every text: a notice is a run of words that
occur in some template, with no more than ``GAP`` other words in a row, or, where the
whole run is like no template, the stretches of it that are most like one, so that
prose around a notice does not hide it. Its TF-IDF vector is held against each
template's. Document frequencies of the templates'
terms are counted over all texts; any other word weighs as one that is in a single
text. Files that show no licence take that of the nearest directory above them
that holds a licence file which does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlab.llm import hashing
from shiftlab.llm.common import own_columns, ship, stored

#: Licence names and usual notices, a few of each.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root for full license information."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
]
ALIKE = 0.75
GAP = 2
#: A stretch of a run has at most twice a template's terms and so many more.
MORE = 16
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"


def term_spans(data: np.ndarray, offsets: np.ndarray):
    """(first byte, byte behind, row) of words, without the marks before and behind their letters and digits."""
    first, behind, row = hashing.word_spans(data, offsets)
    solid = np.flatnonzero(_ALNUM[data])
    if not len(solid):
        return first[:0], behind[:0], row[:0]
    low = np.searchsorted(solid, first)
    high = np.searchsorted(solid, behind) - 1
    some = high >= low
    return solid[low[some]], solid[high[some]] + 1, row[some]


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the term, number of its text)."""
    data, offsets = hashing.text_bytes(pa.array(texts, pa.string()))
    first, behind, row = term_spans(data, offsets)
    return hashing.word_hashes(data, first, behind), row


class Templates:
    """The templates' vocabulary and their weights in it."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        self.names = [n for n, _ in templates]
        found, owner = terms([t for _, t in templates])
        self.vocabulary = hashing.distinct(found)
        self.counts = np.zeros((len(self.vocabulary), len(templates)))
        np.add.at(self.counts, (np.searchsorted(self.vocabulary, found), owner), 1)
        # Most words are told apart from the vocabulary by 16 bits of their hash.
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True

    def weigh(self, frequency: np.ndarray, texts: int) -> Templates:
        """With document frequencies of the vocabulary among so many texts."""
        self.idf = np.log((texts + 1) / (frequency + 1)) + 1
        self.other = float(np.log((texts + 1) / 2) + 1)
        weights = self.counts * self.idf[:, None]
        self.unit = weights / np.sqrt((weights ** 2).sum(0))
        self.sizes = self.counts.sum(0).astype(np.int64)
        return self

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of words in the vocabulary, their numbers there)."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        number = np.searchsorted(self.vocabulary, hashes[at])
        number[number == len(self.vocabulary)] = 0
        same = self.vocabulary[number] == hashes[at]
        return at[same], number[same]

    def notices(self, hashes: np.ndarray, row: np.ndarray, gap: int, alike: float):
        """(row, first term, terms, template, cosine) of every run of known terms, or stretch of one, that is like a template."""
        at, number = self.known(hashes)
        if not len(at):
            return []
        heads = np.flatnonzero(np.r_[True, (np.diff(at) > gap + 1) | (row[at[1:]] != row[at[:-1]])])
        lasts = np.r_[heads[1:], len(at)] - 1
        dots = np.add.reduceat(self.idf[number][:, None] * self.unit[number], heads, axis=0)
        # A cosine is at most the product over the length of the heaviest term alone.
        heaviest = np.maximum.reduceat(self.idf[number], heads)
        # That of a stretch is at most the length of what the template has of the run's terms.
        pairs = hashing.distinct(np.repeat(np.arange(len(heads)), lasts - heads + 1) * len(self.vocabulary) + number)
        runs = pairs // len(self.vocabulary)
        reach = np.add.reduceat(self.unit[pairs % len(self.vocabulary)] ** 2, np.searchsorted(runs, np.arange(len(heads))), axis=0)
        whole = dots.max(1) >= alike * heaviest
        near = reach >= alike ** 2 - 1e-9
        out = []
        for i in np.flatnonzero(whole | near.any(1)):
            inside, places = number[heads[i]:lasts[i] + 1], at[heads[i]:lasts[i] + 1]
            best, cosine = 0, -1.0
            if whole[i]:
                others = places[-1] - places[0] + 1 - len(inside)
                counts = np.bincount(inside)
                length = np.sqrt(((counts[counts > 0] * self.idf[np.flatnonzero(counts)]) ** 2).sum() + others * self.other ** 2)
                best = int(dots[i].argmax())
                cosine = float(dots[i, best] / length)
            found = [(0, len(inside) - 1, best, cosine)] if cosine >= alike else \
                self.stretches(inside, places, np.flatnonzero(near[i]), alike) if near[i].any() else []
            for first, last, template, value in found:
                out.append((int(row[places[0]]), int(places[first]), int(places[last] - places[first] + 1), template, min(value, 1.0)))
        return out

    def stretches(self, number: np.ndarray, places: np.ndarray, some: np.ndarray, alike: float) -> list[tuple[int, int, int, float]]:
        """(first, last, template, cosine) of the stretches of a run that are most like one of ``some`` templates, without overlap, in order."""
        n, wide = len(number), 2 * int(self.sizes[some].max()) + MORE
        dots = np.zeros((n + 1, len(some)))
        np.cumsum(self.idf[number][:, None] * self.unit[number][:, some], axis=0, out=dots[1:])
        square = self.idf[number] ** 2
        order = np.argsort(number, kind="stable")
        earlier = np.full(n, -1)
        same = number[order[1:]] == number[order[:-1]]
        earlier[order[1:][same]] = order[:-1][same]
        best, ends, kinds = np.full(n, -1.0), np.zeros(n, np.int64), np.zeros(n, np.int64)

        def scan(low: int, high: int, behind: int) -> None:
            """The best stretch from each place in [low, high), all before ``behind``."""
            best[low:high] = -1.0
            starts = np.arange(low, high)
            length = np.zeros(high - low)
            # Occurrences of the term at each place since the start of the stretch are counted along ``earlier``.
            for d in range(min(wide, behind - low)):
                starts = starts[:max(0, min(high, behind - d) - low)]
                last = starts + d
                times, back = np.zeros(len(starts)), earlier[last]
                while (held := back >= starts).any():
                    times += held
                    back = np.where(held, earlier[back], -1)
                length = length[:len(starts)] + square[last] * (2 * times + 1)
                others = places[last] - places[starts] - d
                cosine = (dots[last + 1] - dots[starts]) / np.sqrt(length + others * self.other ** 2)[:, None]
                kind = cosine.argmax(1)
                value = cosine[np.arange(len(starts)), kind]
                better = np.flatnonzero(value > best[starts] + 1e-12)
                best[starts[better]], ends[starts[better]], kinds[starts[better]] = value[better], last[better], kind[better]

        scan(0, n, n)
        out = []
        while best[first := int(best.argmax())] >= alike:
            last = int(ends[first])
            out.append((first, last, int(some[kinds[first]]), float(best[first])))
            best[first:last + 1] = -1.0
            # Stretches from before that reach into this one are sought again up to it.
            reaching = np.flatnonzero((best[:first] >= 0) & (ends[:first] >= first))
            for low in reaching.tolist():
                scan(low, low + 1, first)
        return sorted(out)


def frequencies(templates: Templates):
    """Texts of a task with each term of the vocabulary; their number under -1."""
    def run(batches):
        counts = np.zeros(len(templates.vocabulary) + 1, np.int64)
        for batch in batches:
            data, offsets = hashing.text_bytes(batch.column("text"))
            counts[-1] += batch.num_rows
            for a, b in hashing.slices(offsets):
                part = data[offsets[a]:offsets[b]]
                first, behind, row = term_spans(part, offsets[a:b + 1] - offsets[a])
                at, number = templates.known(hashing.word_hashes(part, first, behind))
                pairs = hashing.distinct(row[at] * len(counts) + number)
                counts += np.bincount(pairs % len(counts), minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(np.where(some == len(counts) - 1, -1, some)), pa.array(counts[some])], ["term", "n"])
    return run


def scanner(templates: Templates, gap: int, alike: float):
    def run(batches):
        for batch in batches:
            data, offsets = hashing.text_bytes(batch.column("text"))
            rows = batch.num_rows
            best: list = [None] * rows
            found: list[set] = [set() for _ in range(rows)]
            for a, b in hashing.slices(offsets):
                part = data[offsets[a]:offsets[b]]
                first, behind, row = term_spans(part, offsets[a:b + 1] - offsets[a])
                for r, start, count, template, cosine in templates.notices(hashing.word_hashes(part, first, behind), row, gap, alike):
                    r += a
                    found[r].add(templates.names[template])
                    if best[r] is None or cosine > best[r][1]:
                        best[r] = templates.names[template], cosine
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("path"), pa.array([x and x[0] for x in best], pa.string()),
                 pa.array([x and x[1] for x in best], pa.float64()), pa.array([sorted(x) for x in found], pa.list_(pa.string()))],
                ["doc_id", "path", "licence", "score", "notices"])
    return run


def directory(path: str) -> Column:
    """What stands before the last slash; the root is empty."""
    return F.regexp_extract(path, r"^(?s)(.*)/", 1)


def scanned(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, alike: float = ALIKE, gap: int = GAP) -> DataFrame:
    """doc_id, path, licence, score, notices, inherited_from, effective: one row per row of ``files`` (doc_id, path, text).

    licence is the name of the template that a notice of the text is most like, by
    a cosine (score) of at least ``alike``; the first such notice if several are equally so.
    notices names all licences found. effective is licence, or else that of the
    nearest directory at or above the file's own (inherited_from, the root being empty)
    with a licence file (``LICENCE_FILE``) that shows one, of several the first by
    path, then by licence. Null and empty texts show none; without a path nothing is inherited and
    nothing handed on. Rows may repeat. Other columns are ignored. Without rows, no rows.
    """
    ship(files.sparkSession)
    files = own_columns(files, doc_id="doc_id", path=F.col("path").cast("string"), text="text")
    known = Templates(templates)
    counts = {r.term: r.n for r in files.select("text").where("text is not null").mapInArrow(
        frequencies(known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    known.weigh(np.array([counts.get(i, 0) for i in range(len(known.vocabulary))]), counts.get(-1, 0))
    kind = dict(files.dtypes)["doc_id"]
    found = stored(files.mapInArrow(
        scanner(known, gap, alike),
        f"doc_id {kind}, path string, licence string, score double, notices array<string>"), "licences")

    name = F.regexp_extract("path", r"(?s)([^/]*)$", 1)
    givers = found.where(F.col("licence").isNotNull() & name.rlike(LICENCE_FILE)).groupBy(directory("path").alias("above")).agg(
        F.min(F.struct("path", "licence"))["licence"].alias("handed"))
    takers = found.where("licence is null and path is not null").select(directory("path").alias("folder")).distinct()
    steps = F.split("folder", "/")
    chain = takers.withColumn("depth", F.explode(F.sequence(F.lit(0), F.when(F.col("folder") == "", 0).otherwise(F.size(steps)))))
    chain = chain.withColumn("above", F.array_join(F.slice(steps, 1, F.col("depth")), "/"))
    nearest = chain.join(givers, "above").groupBy("folder").agg(
        F.max(F.struct("depth", "above", "handed")).alias("x")).select("folder", "x.above", "x.handed")
    out = found.withColumn("folder", F.when(F.col("licence").isNull(), directory("path"))).join(nearest, "folder", "left")
    return out.select("doc_id", "path", "licence", "score", "notices", F.col("above").alias("inherited_from"),
                      F.coalesce("licence", "handed").alias("effective"))


def laid_out(docs: DataFrame) -> DataFrame:
    """Documents as files: a tree of folders per source, in which every tenth document is its folder's licence file."""
    doc = F.col("doc_id")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), (doc / 10000).cast("long").cast("string"),
                         ((doc / 100).cast("long") % 10).cast("string"))
    name = F.when(doc % 10 == 0, F.concat(F.lit("LICENSE."), doc.cast("string"))).otherwise(F.concat(doc.cast("string"), F.lit(".txt")))
    return docs.select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text")
