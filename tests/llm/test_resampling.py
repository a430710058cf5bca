"""Importance resampling against plain counting, and against its SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from tests.llm.cases import LONG, docs, odd, small

from shiftlab.llm import resampling
from shiftlab.llm.oracle import ORACLE
from shiftlab.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets(text):
    w = words(text)
    runs = [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(rows, target, share=5, least=20):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    n, m = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n + 10000) / ((s[b] + 1) * (m + 10000)))) for b in s}
    out, long = [], []
    for i, text in rows:
        found = buckets(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None])
        if len(words(text)) >= least:
            long.append(out[-1])
    long.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for place, row in enumerate(long[:share * len(long) // 100]):
        row[4] = place + 1
    return sorted(map(tuple, out), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def target(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


TEXTS = ["", None, "one", "One two", "a-b_c'd 1.5\x00x", "É é İ ß ẞ 日本 語 x", " ,.; \n\t", "A" * 300 + " b", LONG]


@pytest.mark.parametrize("text", TEXTS)
def test_runs_of_words(text):
    n, got = resampling.ngram_buckets(text)
    assert n == len(words(text)) and sorted(got) == sorted(buckets(text))


def test_odd_documents(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    asked = ["one two three four", None, "", "word7 word8 word9"]
    got = found(resampling.resampled(odd(spark), target(spark, asked), share=100, least=1))
    assert got == brute(rows, asked, share=100, least=1)


def test_shares_ties_and_repeats(spark):
    rows = [(i % 90, " ".join(f"w{(i * 7 + j) % 31}" for j in range(i % 40))) for i in range(120)] + [(None, "x " * 30)] * 2
    asked = [" ".join(f"w{j}" for j in range(12))] * 3
    for share, least in ((5, 20), (50, 20), (100, 0)):
        got = found(resampling.resampled(small(spark, rows), target(spark, asked), share=share, least=least))
        assert got == brute(rows, asked, share, least)


def test_empty_tables(spark):
    assert found(resampling.resampled(docs(spark, []), target(spark, ["a b"]))) == []
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 25))) for i in range(40)]
    assert found(resampling.resampled(small(spark, rows), target(spark, []))) == brute(rows, [])


def test_bytes_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(resampling, "PART", 100)
    rows = [(i, " ".join(f"w{j % 17}" for j in range(i))) for i in range(60)]
    import pyarrow as pa
    batch = pa.record_batch([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["doc_id", "text"])
    out = list(resampling.scanner(10000)([batch]))
    assert len(out) > 10 and [i for b in out for i in b.column("doc_id").to_pylist()] == list(range(60))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = con.execute(ORACLE["op13_importance_resampling"])
    names = [d[0] for d in result.description]
    want = [tuple(row[names.index(c)] for c in ("doc_id", "n_features", "weight", "score", "rank")) for row in result.fetchall()]
    assert found(QUERIES["op13_importance_resampling"](spark, folder)) == sorted(want, key=repr)
