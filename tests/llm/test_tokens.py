"""Token counts, token files and packing against the tokenizers themselves."""

import collections
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shiftlab.llm import common, packing, token_counts, token_files, tokens
from shiftlab.llm.queries import QUERIES
from tests.llm import cases

SF = "/root/testdata/sf0.001"
BYTE, WORD = (tokens.tokenizer_path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECE = tokens.tokenizer_path("piece_bpe_32k.model")
ALPHABET = st.sampled_from(list("ab Zé.'\n\t1_▁<|>-’ß中") + ["  ", " the", "<|endoftext|>", "'s", " \n", "don't"])
TEXTS = st.lists(ALPHABET, max_size=25).map("".join)


@pytest.fixture(scope="module")
def encoders():
    return {p: (Tokenizer.from_file(p), tokens.IdEncoder(p)) for p in (BYTE, WORD)}


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, min_size=1, max_size=4))
def test_ids_of_pieces_are_those_of_the_whole(encoders, texts):
    for plain, cached in encoders.values():
        for text, ids in zip(texts, cached(texts)):
            assert np.frombuffer(ids, cached.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, min_size=1, max_size=4))
def test_counts_of_pieces_add_up(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert tokens.PieceCounter(PIECE, {}).count(texts) == [len(x) for x in model.encode(texts)]


def test_cache_stays_bounded_and_right():
    cache = tokens.PieceCache(lambda pieces: [len(p) for p in pieces], kept=3, first={"a": 1})
    for text in (["a", "bb", "ccc"], ["dddd", "a", "x" * 100], ["bb", "dddd"]):
        assert cache.look_up([text]) == [[len(p) for p in text]]
        assert len(cache.values) <= 4


@pytest.mark.parametrize("path", [PIECE, BYTE])
def test_counts_of_odd_documents(spark, path):
    found = token_counts.token_counts(cases.odd(spark), path, limit=6).collect()
    texts = [r[1] or "" for r in cases.ODD]
    if path == PIECE:
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found] == [
        (row[0], len(t.encode()), n, n > 6) for row, t, n in zip(cases.ODD, texts, want)]


def test_count_query_over_a_table(spark):
    found = {r.doc_id: r for r in QUERIES["op4_token_counts"](spark, SF).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for row in common.documents(spark, SF).collect():
        assert found.pop(row.doc_id)[1:] == (len(row.text.encode()), n := len(model.encode(row.text)), n > 4096)
    assert not found


@settings(max_examples=100, deadline=None)
@given(bits=st.integers(1, 32), data=st.data())
def test_packed_bits_round_trip(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, (1 << bits) - 1), max_size=60)), np.int64)
    payload = token_files.pack(ids, bits)
    assert len(payload) == (len(ids) * bits + 7) // 8
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert token_files.unpack(payload, bits, a, b - a).tolist() == ids[a:b].tolist()


def check_files(spark, frame, rows, tmp_path, size):
    folder = str(tmp_path / "ids")
    token_files.write(frame, folder, WORD, end=1, size=size)
    plain = Tokenizer.from_file(WORD)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), cases.crc(ids), ids))
        start += len(ids)
    found = [tuple(r) for r in token_files.read(spark, folder, with_ids=True).collect()]
    assert sorted(found, key=lambda r: r[1]) == want
    return folder, want


@pytest.mark.parametrize("size", [1, 8, 1 << 16])
def test_files_of_odd_documents(spark, tmp_path, size):
    folder, want = check_files(spark, cases.odd(spark), [r[:2] for r in cases.ODD], tmp_path, size)
    assert token_files.lookup(spark, folder, 8) == [w[4] for w in want if w[0] == 8]


def test_files_of_a_table(spark, tmp_path):
    docs = common.documents(spark, SF)
    check_files(spark, docs, [(r.doc_id, r.text) for r in docs.collect()], tmp_path, 5000)


def test_nothing_to_store(spark, tmp_path):
    token_files.write(cases.docs(spark, []), str(tmp_path / "x"), WORD, end=1)
    assert token_files.read(spark, str(tmp_path / "x")).collect() == []
    assert token_counts.token_counts(cases.docs(spark, []), PIECE).collect() == []
    assert packing.packed(cases.docs(spark, []), BYTE).collect() == []


def check_pieces(found, rows, end, window):
    """Every id in one piece, sequences full and gapless; the queues' proportions in every window."""
    plain = Tokenizer.from_file(BYTE)
    ids = {}
    for doc_id, text in rows:
        ids.setdefault(doc_id, []).append(plain.encode(text or "", add_special_tokens=False).ids + [end])
    by_doc = collections.defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == ids.keys()
    for doc_id, pieces in by_doc.items():
        texts = ids[doc_id]
        places = collections.Counter((r.start, r.length, r.ids_crc32) for r in pieces)
        if len(texts) == 1:
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert (r.start, r.ids_crc32, r.doc_tokens) == (
                    at, cases.crc(texts[0][at:at + r.length]), len(texts[0])) and r.length > 0
                at += r.length
            assert at == len(texts[0])
        else:
            assert sum(r.length for r in pieces) == sum(map(len, texts)), places
    by_window = collections.defaultdict(list)
    for r in found:
        by_window[r.sequence_id].append((r.offset, r.length))
    assert sorted(by_window) == list(range(len(by_window)))
    for w, runs in by_window.items():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at == window or w == max(by_window) and at <= window


def test_packing_of_a_table_keeps_proportions(spark):
    docs = common.documents(spark, SF).collect()
    found = QUERIES["op3_mixture_packing"](spark, SF).collect()
    check_pieces(found, [(r.doc_id, r.text) for r in docs], 0, 1024)
    source = {r.doc_id: r.source for r in docs}
    totals, windows = collections.Counter(), collections.defaultdict(collections.Counter)
    for r in found:
        totals[source[r.doc_id]] += r.length
        windows[r.sequence_id][source[r.doc_id]] += r.length
    for w, counts in windows.items():
        if w != max(windows):
            for s, n in totals.items():
                assert abs(counts[s] - 1024 * n / sum(totals.values())) <= 2


def test_packing_of_odd_documents(spark):
    check_pieces(packing.packed(cases.odd(spark), BYTE, window=64).collect(), [r[:2] for r in cases.ODD], 0, 64)


def test_packing_to_given_weights(spark):
    rows = [(i, "word " * 40, "en", "ab"[i % 2], 0) for i in range(60)]
    found = packing.packed(cases.docs(spark, rows), BYTE, window=100, weights={"a": 3.0, "b": 1.0}).collect()
    check_pieces(found, [r[:2] for r in rows], 0, 100)
    first = collections.Counter("ab"[r.doc_id % 2] for r in found for _ in range(r.length) if r.sequence_id == 0)
    assert first == {"a": 75, "b": 25}


def test_schedule_is_the_token_by_token_rule():
    rng = random.Random(3)
    for _ in range(30):
        totals = [rng.choice([1, 2, 50, 400]) for _ in range(rng.randint(1, 7))]
        weights = [rng.choice([float(t), 0.5, 3.0]) for t in totals]
        schedule = packing.Schedule(np.array(totals), np.array(weights))
        given, want = [0] * len(totals), [[0] * len(totals)]
        for _ in range(sum(totals)):
            turn = min((i for i in range(len(totals)) if given[i] < totals[i]),
                       key=lambda i: ((given[i] + 0.5) / weights[i], i))
            given[turn] += 1
            want.append(list(given))
        assert schedule.stands(np.arange(sum(totals) + 1)).tolist() == want


ODD_BITS = ["a", "Bc", "it's", "don't", "'s", " ", "  ", "\n", "\n\n", "\r\n", "\t", " \n", "\n ", "é", "Ö", "×", "÷", "ÿ", "À", "日本", "5", "12",
            ".", ",", "!?", "<", "<|endoftext|>", "_", "-", "\xa0", "\u0301", "\x85", "\u2028", "ß", "ΑΣ", "İ", "🙂", "the", "Word", "\x00",
            "\x0b", "\x1c", "\u3000", "▁", "x" * 20, "y" * 50, "(a)", "[b]", "~", "a.b", "q\nq", "Q.\nW", "é\né", "!\n!", "1\n2"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_equal_the_library(name):
    """Random strings of odd parts in batches, with a cache that overflows."""
    import random
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(name)
    encoder, library = tokens.IdEncoder(path), Tokenizer.from_file(path)
    encoder.kept = 300
    rng = random.Random(4)
    texts = ["".join(rng.choice(ODD_BITS) for _ in range(rng.randint(0, 14))) for _ in range(8000)] + [None, ""] + [" ".join(ODD_BITS)] * 3
    for at in range(0, len(texts), 400):
        part = texts[at:at + 400]
        want = [e.ids for e in library.encode_batch_fast([t or "" for t in part], add_special_tokens=False)]
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder(part)] == want
    assert encoder([]) == [] and any(encoder.units[0]) and any(encoder.units[2])
    encoder.kept = 100
    distinct = 0
    for at in range(0, 4000, 5):
        encoder([f"word{chr(97 + at % 23)}{chr(97 + at // 26 % 26)}{chr(97 + at // 676)} the same" for at in range(at, at + 5)])
        distinct = max(distinct, sum(map(len, encoder.units[0])))
    assert 20 < distinct <= 100 and any(b"same" in held for held in encoder.units[0])


def test_units_of_one_hash_are_told_apart(monkeypatch):
    """Were two units to share their hash, their texts go the longer way."""
    encoder = tokens.IdEncoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    texts = ["some words here", "and others there", "a\x00b a b " + "z" * 30]
    want = encoder(texts)
    monkeypatch.setattr(tokens.hashing, "mix", lambda h: h & np.uint64(1))
    assert encoder(texts) == want


def test_frequent_pieces_are_of_the_whole_table(spark):
    """Whatever the order of rows; and no text goes to one task."""
    rows = [(i, f"early{i % 3} " * 5) for i in range(1200)] + [(5000 + i, "late one late two") for i in range(4000)]
    found = token_counts.frequent_pieces(cases.small(spark, rows), pieces=4)
    assert [(r.piece, r.n) for r in found.collect()] == [("late", 8000), ("one", 4000), ("two", 4000), ("early0", 2000)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "text" not in plan.split("MapInArrow")[0]
    tight = token_counts.frequent_pieces(cases.small(spark, rows), pieces=1, proposed=2, counted=4)
    assert [r.piece for r in tight.collect()] == ["late"]
    assert token_counts.frequent_pieces(cases.docs(spark, [])).collect() == []
