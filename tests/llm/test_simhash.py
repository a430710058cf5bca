"""Fingerprints against a term-by-term vote; searches against all pairs."""

import hashlib
import random
import statistics

import numpy as np
import pyarrow as pa
import pytest

from shiftlab.llm import common, hashing, simhash
from shiftlab.llm.queries import QUERIES
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def check(rows, found, bits=simhash.BITS):
    """rows: (doc_id, text) in order."""
    texts = [t or "" for _, t in rows]
    after = texts[1:] + texts[:1]
    changed = [t[:len(t) - len(t) // 4] + f[:len(t) // 4] for t, f in zip(texts, after)]
    own, other = (simhash.fingerprints(pa.array(x, pa.string()), bits) for x in (texts, changed))

    def near(a, b):
        return 1 - sum(bin(x ^ y).count("1") for x, y in zip(a.tolist(), b.tolist())) / bits
    want = [(i, len(t), hashlib.sha256(c.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), near(a, b), near(a, n))
            for (i, _), t, c, a, b, n in zip(rows, texts, changed, own, other, np.roll(own, -1, 0))]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_votes_term_by_term():
    text = "a b c d a b c d a b x y " + " ".join(map(str, range(300)))
    words = text.split()
    data, offsets = hashing.text_bytes(pa.array([text]))
    first, behind, row = hashing.word_spans(data, offsets)
    hashes, _ = hashing.shingle_hashes(hashing.word_hashes(data, first, behind), row, 3)
    terms = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    by_term = dict(zip(terms, hashes))
    votes = [0] * 128
    for term, h in by_term.items():
        weight = round(16 * (1 + np.log2(terms.count(term))))
        lanes = [int(hashing.mix(np.array([h]) ^ np.uint64(0x632BE59BD9B4E019 * i % (1 << 64)))[0]) for i in (1, 2)]
        raw = b"".join(x.to_bytes(8, "little") for x in lanes)
        for i in range(128):
            votes[i] += weight if raw[i // 8] >> (7 - i % 8) & 1 else -weight
    want = bytes(sum((votes[8 * k + j] > 0) << (7 - j) for j in range(8)) for k in range(16))
    assert simhash.fingerprints(pa.array([text]))[0].tobytes() == want


def test_query_over_a_table(spark):
    rows = sorted((r.doc_id, r.text) for r in common.documents(spark, SF).collect())
    found = QUERIES["op2_simhash"](spark, SF).collect()
    check(rows, found)
    far = [r for r in found if r.near_next < 1]
    assert statistics.mean(r.near_edited for r in far) > statistics.mean(r.near_next for r in far) + 0.15
    assert sum(r.near_edited > r.near_next for r in far) >= 0.95 * len(far)


@pytest.mark.parametrize("rows", [
    [r[:2] for r in cases.ODD], [(1, "only one document, here")], [(1, None)], [],
    [(i, f"{'é' * i} text {i}") for i in range(20)]])
def test_small_tables(spark, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    check(rows, simhash.fingerprinted(cases.small(spark, random.Random(2).sample(rows, len(rows)))).collect())


def test_clashing_columns(spark):
    assert simhash.fingerprinted(cases.odd(spark)).count() == len(cases.ODD)


@pytest.mark.parametrize("bits,radius,blocks", [(64, 3, 4), (64, 3, 6), (128, 3, 4), (64, 0, 1)])
def test_search_equals_all_pairs(spark, bits, radius, blocks):
    rng = random.Random(bits + blocks)
    codes = []
    for _ in range(40):
        code = rng.getrandbits(bits)
        codes += [code] + [code ^ sum(1 << b for b in rng.sample(range(bits), rng.randint(0, 5))) for _ in range(5)]
    names = [f"{c:0{bits // 4}x}" for c in codes]
    index = spark.createDataFrame([(n,) for n in names] + [(None,)], "fingerprint string")
    queries = spark.createDataFrame([(n,) for n in names[::7]] * 2 + [(None,)], "fingerprint string")
    found = sorted(map(tuple, simhash.within_radius(queries, index, bits, radius, blocks).collect()))
    want = sorted({(a, b, d) for a in names[::7] for b in names if (d := bin(int(a, 16) ^ int(b, 16)).count("1")) <= radius})
    assert found == want


def test_search_query(spark):
    docs = {r.doc_id: r.fingerprint for r in QUERIES["op2_simhash"](spark, SF).collect()}
    found = {(r.query, r.fingerprint): (r.distance, r.doc_id, r.n_documents) for r in QUERIES["simhash_neighbours"](spark, SF).collect()}
    want = {}
    for a in {f for i, f in docs.items() if i % 20 == 0}:
        for b in set(docs.values()):
            if (d := bin(int(a, 16) ^ int(b, 16)).count("1")) <= simhash.RADIUS:
                ids = [i for i, f in docs.items() if f == b]
                want[a, b] = d, min(ids), len(ids)
    assert found == want


def test_votes_of_equal_weight_are_counted_in_bytes():
    """Groups of more than 255 terms take several pieces; the sums are those of the plain votes."""
    rng = np.random.default_rng(4)
    sizes = [1, 254, 255, 256, 3, 2000]
    starts, n = np.r_[0, np.cumsum(sizes)[:-1]], sum(sizes)
    for values in (rng.integers(0, 1 << 63, n).astype(np.uint64), np.full(n, 77, np.uint64)):
        for bits in (64, 128):
            group, votes = simhash._equal_votes(values, starts, bits)
            sums = np.zeros((len(sizes), bits), np.int64)
            np.add.at(sums, group, simhash.UNIT * votes)
            assert (sums == simhash._votes(values, np.full(n, simhash.UNIT, np.int32), starts, bits)).all()
            assert len(group) == 1 + 1 + 1 + 2 + 1 + 8
