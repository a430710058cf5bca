"""Licence scans against plain TF-IDF over all runs of words, and inheritance by walking up."""

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from shiftlab.llm import hashing, licences
from shiftlab.llm.common import documents
from shiftlab.llm.queries import QUERIES
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def terms(text):
    out = []
    for word in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode()):
        word = re.sub(rb"^[^0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+$", b"", word)
        if word:
            out.append(word.lower())
    return out


def brute(rows):
    """{doc_id: (path, licence, score, notices, from, effective)} of (doc_id, path, text)."""
    templates = [(n, collections.Counter(terms(t))) for n, t in licences.TEMPLATES]
    known = {w for _, c in templates for w in c}
    texts = [set(terms(t)) for _, _, t in rows if t is not None]
    idf = {w: math.log((len(texts) + 1) / (sum(w in t for t in texts) + 1)) + 1 for w in known}
    other = math.log((len(texts) + 1) / 2) + 1

    def cosine(words, template):
        counts = collections.Counter(words)
        a = {w: n * idf.get(w, other) for w, n in counts.items() if w in known}
        b = {w: n * idf[w] for w, n in template.items()}
        length = sum(x * x for x in a.values()) + other ** 2 * sum(w not in known for w in words)
        return sum(a.get(w, 0) * x for w, x in b.items()) / math.sqrt(length) / math.sqrt(sum(x * x for x in b.values()))

    own = {}
    for doc_id, path, text in rows:
        words, runs, run = terms(text), [], []
        for i, w in enumerate(words):
            if w in known:
                if run and i - run[-1] > licences.GAP + 1:
                    runs.append(run)
                    run = []
                run.append(i)
        found = []
        for run in runs + [run] * bool(run):
            part = words[run[0]:run[-1] + 1]
            score, place = max((cosine(part, c), -i) for i, (_, c) in enumerate(templates))
            if score >= licences.ALIKE:
                found.append((score, templates[-place][0]))
        best = max(found, key=lambda x: x[0], default=(None, None))
        own[doc_id] = path, best[1], best[0], sorted({n for _, n in found})
    givers = {}
    for path, licence, *_ in sorted((v for v in own.values() if v[1] and v[0]), key=lambda v: v[0]):
        folder, _, name = path.rpartition("/")
        if re.match(licences.LICENCE_FILE, name):
            givers.setdefault(folder, licence)
    out = {}
    for doc_id, (path, licence, score, notices) in own.items():
        at, effective = None, licence
        if licence is None and path is not None:
            folder = path.rpartition("/")[0]
            steps = folder.split("/") if folder else []
            for depth in range(len(steps), -1, -1):
                if (above := "/".join(steps[:depth])) in givers:
                    at, effective = above, givers[above]
                    break
        out[doc_id] = path, licence, score, notices, at, effective
    return out


def same(found, want):
    assert {r.doc_id for r in found} == want.keys() and len(found) == len(want)
    for r in found:
        path, licence, score, notices, at, effective = want[r.doc_id]
        assert (r.path, r.licence, r.notices, r.inherited_from, r.effective) == (path, licence, notices, at, effective)
        assert (r.score is None) == (score is None) and (score is None or abs(r.score - score) < 1e-9)


def test_query_over_a_table(spark):
    rows = [tuple(r) for r in licences.laid_out(documents(spark, SF)).collect()]
    found = QUERIES["op6_licence_scan"](spark, SF).collect()
    same(found, brute(rows))
    named = {r.doc_id: r.licence for r in found}
    for doc_id, _, text in rows:
        for name, notice in (("MIT", "the MIT License."), ("Apache-2.0", "Apache License, Version 2.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
                             ("GPL-3.0", "GNU General Public License, version 3")):
            assert (notice in text) == (named[doc_id] == name)


def test_inheritance_and_odd_files(spark):
    rows = [
        (1, "LICENSE", "Released under the MIT License."), (2, "a/x.py", "nothing"), (3, "a/LICENSE.txt", "no notice here"),
        (4, "a/b/COPYING", "preamble\nThis work is licensed under the GNU General Public License, version 3.\nmore"),
        (5, "a/b/c/d/file", None), (6, "a/b/c/own.c", "// SPDX-License-Identifier: Apache-2.0"), (7, None, "Licensed under CC BY 4.0."),
        (8, None, ""), (9, "z", cases.LONG), (10, "a/b/COPYING.old", "Licensed under the Apache License, Version 2.0."),
        (11, "ab/licence", "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0."), (12, "ab/", "日本"), (13, "/root/x", "x")]
    found = licences.scanned(spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, path string, text string, above string")).collect()
    same(found, brute(rows))
    effective = {r.doc_id: r.effective for r in found}
    assert [effective[i] for i in (2, 3, 5, 6, 7, 8, 9)] == ["MIT", "MIT", "GPL-3.0", "Apache-2.0", "CC-BY-4.0", None, "MIT"]


def test_no_files(spark):
    assert licences.scanned(spark.createDataFrame([], "doc_id long, path string, text string")).collect() == []


PLANTED = (("MIT", "the MIT License."), ("Apache-2.0", "Apache License, Version 2.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
           ("GPL-3.0", "GNU General Public License, version 3"))


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1"])
def test_planted_notices_in_tables_of_any_size(spark, table):
    """A plain search for the planted notices, with the table's document frequencies in 1 to 10,000 times as many texts."""
    texts = [r.text for r in documents(spark, f"/root/testdata/{table}").select("text").where("text is not null").collect()]
    known = licences.Templates()
    hits = [(t, {n for n, notice in PLANTED if notice in t}) for t in texts]
    planted = [(t, want) for t, want in hits if want]
    plain = [(t, want) for t, want in hits if not want][:2000]
    assert len(planted) >= 39
    counts = np.zeros(len(known.vocabulary))
    for batch in licences.frequencies(known)([pa.record_batch([pa.array(texts)], ["text"])]):
        for term, n in zip(*(c.to_pylist() for c in batch.columns)):
            if term >= 0:
                counts[term] = n
    for times in (1, 100, 10_000):
        known.weigh(counts * times, len(texts) * times)
        for part in (planted, plain):
            data, offsets = hashing.text_bytes(pa.array([t for t, _ in part]))
            first, behind, row = licences.term_spans(data, offsets)
            found = [set() for _ in part]
            for r, _, _, template, _ in known.notices(hashing.word_hashes(data, first, behind), row, licences.GAP, licences.ALIKE):
                found[r].add(known.names[template])
            names = {n for n, _ in PLANTED}
            assert [x & names for x in found] == [want for _, want in part]


def test_stretches_equal_all_stretches():
    """The best stretch of a run by trying all; then those beside it."""
    rng = np.random.default_rng(4)
    known = licences.Templates()
    known.weigh(rng.integers(1, 50, len(known.vocabulary)), 1000)
    for _ in range(30):
        number = rng.integers(0, len(known.vocabulary), 30)
        own = np.flatnonzero(known.counts[:, rng.integers(len(known.names))])
        number[10:10 + len(own)] = own[:20]
        places = np.cumsum(rng.integers(1, 3, len(number)))
        some = np.arange(len(known.names))

        def cosine(i, j):
            counts = np.bincount(number[i:j + 1], minlength=len(known.vocabulary)) * known.idf
            length = (counts ** 2).sum() + (places[j] - places[i] - j + i) * known.other ** 2
            return max(counts @ known.unit) / math.sqrt(length)
        found = known.stretches(number, places, some, 0.5)
        taken, want = set(), []
        while True:
            free = [(i, j) for i in range(len(number)) for j in range(i, len(number)) if not taken & set(range(i, j + 1))]
            value = max((cosine(i, j) for i, j in free), default=0)
            if value < 0.5:
                break
            want.append(value)
            i, j = next((i, j) for i, j in free if cosine(i, j) >= value - 1e-12)
            taken |= set(range(i, j + 1))
        assert np.allclose(sorted(x[3] for x in found), sorted(want))
