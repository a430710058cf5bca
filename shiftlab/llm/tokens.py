"""Token ids of whole texts by public tokenizers, through a cache of pieces in each Python worker.

A text is cut where its tokenizer never joins two sides, so that the ids of the
text are those of its pieces in order; most pieces are single words, and repeat.
Cutting texts and putting ids together is array work over a batch of texts.
Pieces that a worker has met are looked up; the others go to the tokenizer in one
call per batch. The cache is bounded and only saves work: results do not depend
on what it holds.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa

from shiftlab.llm import hashing

#: Pieces and units a worker keeps, about 200 bytes each, and the longest one it keeps.
KEPT, KEPT_UNITS, LONGEST = 500_000, 600_000, 48

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_SPACE_RUN = re.compile(r" \s")
_MARKED = re.compile(r"[ ▁]+[^ ▁]+|[ ▁]+$")
#: Letters, then marks, without digits, apostrophes and special strings: two words to either tokenizer.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=>?@\[-`{-~]*)")
#: Words that go to the tokenizer as one text.
TOGETHER = 256


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_level_pieces(text: str) -> list[str]:
    """Pieces of a byte-level tokenizer, whose words begin with the space before them.

    A single space between two other characters always begins a word; where white
    space runs on, the text is left uncut.
    """
    words = _SAFE_SPACE.split(text) if _SPACE_RUN.search(text) else text.split(" ")
    return words


def word_pieces(text: str) -> list[str]:
    """Pieces of a tokenizer that drops white space: cut at every space."""
    return text.split(" ")


def marked_pieces(text: str) -> list[str]:
    """Pieces of a sentencepiece model none of whose entries holds a space mark behind a letter.

    Each is what follows one space: further spaces, and all up to the next one.
    """
    if not text:
        return []
    if "  " in text or "▁" in text or text[0] == " " or text[-1] == " ":
        return [p[1:] for p in _MARKED.findall(" " + text)]
    return text.split(" ")


class PieceCache:
    """piece -> value; ``encode`` gives the values of a list of pieces."""

    def __init__(self, encode: Callable[[list[str]], list], kept: int = KEPT, first: dict | None = None):
        self.encode, self.kept, self.first = encode, kept, first or {}
        self.values = dict(self.first)

    def look_up(self, texts: Iterable[list[str]]) -> list[list]:
        """The values of each text's pieces."""
        texts = list(texts)
        distinct = set().union(*texts)
        missing = list(distinct.difference(self.values))
        if missing and len(self.values) + len(missing) > self.kept:
            self.values = dict(self.first)
            missing = list(distinct.difference(self.values))
        self.values.update(zip(missing, self.encode(missing)))
        value = self.values.__getitem__
        found = [list(map(value, pieces)) for pieces in texts]
        for p in missing:
            if len(p) > LONGEST:
                del self.values[p]
        return found


#: What bytes add up to: one for a letter of :data:`_PLAIN`, nothing for what may stand behind letters, more than any text for others.
_WEIGHT = np.array([1 if re.fullmatch("[A-Za-z]", chr(i)) else 0 if re.fullmatch(r"[!-&(-/:;=>?@\[-`{-~]", chr(i)) else 1 << 40
                    for i in range(128)] + [1 << 40] * 128)
#: Units of a text: letters behind a space, marks behind them, other pieces behind a space, first pieces.
HEAD, TAIL, OTHER, FIRST = range(4)
_KIND = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
#: Masks of the first 0 to 8 bytes of a little-endian word of 8.
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


#: Bytes that stand alone beside a line break: visible ASCII.
_VISIBLE = np.array([0x21 <= i <= 0x7E for i in range(256)])


def breaks(data: np.ndarray, offsets: np.ndarray, any_line: bool) -> np.ndarray:
    """Places of spaces and line breaks at which texts may be cut, in order.

    With ``any_line`` every line break is one; else those between two visible
    characters, which are a word of their own.
    """
    lines = np.flatnonzero(data == 0x0A)
    if not any_line and len(lines):
        inner = lines[(lines > 0) & (lines < len(data) - 1)]
        inner = inner[_VISIBLE[data[inner - 1]] & _VISIBLE[data[inner + 1]]]
        row = np.searchsorted(offsets, inner, "right")
        lines = inner[(inner > offsets[row - 1]) & (inner + 1 < offsets[np.minimum(row, len(offsets) - 1)])]
    spaces = np.flatnonzero(data == 0x20)
    return np.sort(np.concatenate([spaces, lines])) if len(lines) else spaces


def cut_pieces(offsets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte behind, is its text's first, pieces of each text) of texts cut at those places; an empty text has none."""
    full = np.diff(offsets) > 0
    many = np.where(full, 1 + np.diff(np.searchsorted(cuts, offsets)), 0)
    ends = np.cumsum(many)
    leads, lasts = (ends - many)[full], ends[full] - 1
    begin, behind = np.empty(int(many.sum()), np.int64), np.empty(int(many.sum()), np.int64)
    lead, last = np.zeros(len(begin), bool), np.zeros(len(begin), bool)
    lead[leads], last[lasts] = True, True
    begin[leads], begin[~lead] = offsets[:-1][full], cuts + 1
    behind[lasts], behind[~last] = offsets[1:][full], cuts
    return begin, behind, lead, many


def letters_then_marks(data: np.ndarray, begin: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """How many bytes of letters each piece begins with, if all behind them are marks, else 0: :data:`_PLAIN` over bytes."""
    weight = _WEIGHT[data]
    wide = np.flatnonzero(data[:-1] == 0xC3)
    second = data[wide + 1]
    wide = wide[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
    weight[wide] = weight[wide + 1] = 1
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(weight, out=total[1:])
    base = total[begin]
    n = total[behind] - base
    n[n >= 1 << 40] = 0
    return np.where(total[begin + n] - base == n, n, 0)


def eights(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 8 bytes of each unit, and the 8 behind them, as numbers; nothing for bytes behind its end."""
    padded = np.concatenate([data, np.zeros(24, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    return (words[first] & _FIRST_BYTES[np.minimum(size, 8)], words[first + 8] & _FIRST_BYTES[np.clip(size - 8, 0, 8)])


def ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places first, first + 1, ... of every run, one run after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(first - before, length)


_encoders: dict[tuple, object] = {}


class IdEncoder:
    """Ids of whole texts as little-endian bytes, for a file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocabulary = max(names.values()) + 1
        self.dtype = np.dtype("<u2") if self.vocabulary <= 1 << 16 else np.dtype("<u4")
        suffix = self.tokenizer.model.end_of_word_suffix
        self.drops_space = bool(suffix)
        self.edge = np.zeros(self.vocabulary, bool)
        self.edge[[i for name, i in names.items() if (name.endswith(suffix) if suffix else name[0] == "Ġ")]] = True
        self.words = PieceCache(self._words, kept=50_000)
        self.bare = PieceCache(self._one_by_one, kept=50_000)
        self.pieces = PieceCache(self._pieces, kept=50_000)
        self.units: list[list[dict[bytes, bytes]]] = [[{}, {}] for _ in range(4)]
        self.kept = KEPT_UNITS

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, each after a space; many are told apart in one text by their edges."""
        out = []
        for at in range(0, len(words), TOGETHER):
            some = words[at:at + TOGETHER]
            text = " " + " ".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(some):
                out += self._one_by_one([" " + w for w in some])
                continue
            cuts = np.r_[0, edges + 1] if self.drops_space else np.r_[edges, len(ids)]
            cuts, joined = (cuts * self.dtype.itemsize).tolist(), ids.tobytes()
            out += [joined[cuts[i]:cuts[i + 1]] for i in range(len(some))]
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, each after a space."""
        out: list = [None] * len(pieces)
        places, heads, tails, others = [], [], [], []
        for i, m in enumerate(map(_PLAIN.fullmatch, pieces)):
            if m:
                places.append(i)
                heads.append(m[1])
                tails.append(m[2])
            else:
                others.append(i)
        for i, head, tail in zip(places, self.words.look_up([heads])[0], self.bare.look_up([tails])[0]):
            out[i] = head + tail
        for i, ids in zip(others, self._one_by_one([" " + pieces[i] for i in others])):
            out[i] = ids
        return out

    def _known(self, kind: int, units: list[bytes]) -> list[bytes]:
        """Ids of distinct units of one kind; those not met before go to the tokenizer.

        Two generations are kept. When the younger is full the older goes, and units
        that are met again have moved to the younger by then, so that frequent ones stay.
        """
        older, held = self.units[kind]
        if len(held) + len(units) > (self.kept if kind == HEAD else self.kept // 4) // 2:
            older, held = self.units[kind] = [held, {}]
        absent = [u for u in units if u not in held]
        again = {u: older[u] for u in absent if u in older}
        held.update(again)
        missing = [u for u in absent if u not in again]
        names = [u.decode() for u in missing]
        if kind == HEAD:
            found = self._words(names)
        else:
            found = self._one_by_one([" " + n for n in names] if kind == OTHER else names)
        held.update(zip(missing, found))
        out = [held[u] for u in units]
        for u in missing:
            if len(u) > LONGEST:
                del held[u]
        return out

    def _by_units(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts that may be cut at every space.

        Cutting, counting and putting together are array work; Python sees each
        distinct unit of the texts once. Units are told apart by a hash, and then
        compared in all bytes with the one that stands for them.
        """
        data, offsets = hashing.text_bytes(pa.array(texts, pa.large_string()))
        begin, behind, lead, many = cut_pieces(offsets, breaks(data, offsets, self.drops_space))
        n = letters_then_marks(data, begin, behind)
        tail = (n > 0) & (begin + n < behind)
        # A line break is a unit of its own where white space counts, and what follows it has no space before it.
        line = np.zeros(len(begin), bool)
        if not self.drops_space and len(begin):
            bare = lead.copy()
            bare[1:] |= ~lead[1:] & (data[begin[1:] - 1] == 0x0A)
            line[:-1] = ~lead[1:] & bare[1:]
        parts = 1 + tail + line
        place = np.cumsum(parts) - parts
        first, last = np.empty(int(parts.sum()), np.int64), np.empty(int(parts.sum()), np.int64)
        kind = np.full(len(first), TAIL)
        first[place], last[place] = begin, np.where(n > 0, begin + n, behind)
        kind[place] = np.where(n > 0, HEAD, OTHER)
        if not self.drops_space and len(begin):
            kind[place[bare]] = FIRST
        first[place[tail] + 1], last[place[tail] + 1] = (begin + n)[tail], behind[tail]
        ending = (place + parts - 1)[line]
        first[ending], last[ending] = behind[line], behind[line] + 1
        size = last - first
        low, high = eights(data, first, size)
        mark = hashing.mix(hashing.mix(low + size.astype(np.uint64)) ^ high ^ _KIND[kind])
        wide = np.flatnonzero(size > 16)
        if len(wide):
            mark[wide] ^= hashing.word_hashes(data, first[wide], last[wide], lower=False)
        number, _ = pd.factorize(mark)
        chosen = np.empty(int(number.max()) + 1 if len(number) else 0, np.int64)
        chosen[number[::-1]] = np.arange(len(number))[::-1]
        same = chosen[number]
        alike = all((x == x[same]).all() for x in (size, kind, low, high))
        if not alike or (data[ragged(first[wide], size[wide])] != data[ragged(first[same[wide]], size[wide])]).any():
            return [self._by_pieces([t])[0] for t in texts]
        chosen_kind = kind[chosen]
        order = np.argsort(chosen_kind, kind="stable")
        whole = data.tobytes()
        units = [whole[x:y] for x, y in zip(first[chosen[order]].tolist(), last[chosen[order]].tolist())]
        cuts = np.searchsorted(chosen_kind[order], np.arange(5)).tolist()
        values = [ids for k in range(4) for ids in self._known(k, units[cuts[k]:cuts[k + 1]])]
        width = self.dtype.itemsize
        length, start = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // width
        length[order], start[order] = sizes, np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(values), self.dtype)
        per_unit = length[number]
        ids = pool[ragged(start[number], per_unit)].tobytes()
        units_before = np.concatenate([[0], np.cumsum(parts)])[np.concatenate([[0], np.cumsum(many)])]
        ends = (np.concatenate([[0], np.cumsum(per_unit)])[units_before] * width).tolist()
        return [ids[x:y] for x, y in zip(ends, ends[1:])]

    def _by_pieces(self, texts: list[str | None]) -> list[bytes]:
        if self.drops_space:
            return [b"".join(v) for v in self.pieces.look_up(word_pieces(t) if t else [] for t in texts)]
        cut = [byte_level_pieces(t) if t else [] for t in texts]
        heads = self.bare.look_up([p[:1] for p in cut])
        tails = self.pieces.look_up([p[1:] for p in cut])
        return [b"".join(h) + b"".join(t) for h, t in zip(heads, tails)]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        plain = [self.drops_space or not t or not _SPACE_RUN.search(t) for t in texts]
        found = iter(self._by_units([t for t, p in zip(texts, plain) if p]))
        others = iter(self._by_pieces([t for t, p in zip(texts, plain) if not p]))
        return [next(found if p else others) for p in plain]


def forget() -> None:
    """Give up what this worker keeps; work that needs memory of its own begins with it."""
    _encoders.clear()


def id_encoder(path: str) -> IdEncoder:
    """This worker's encoder for the file."""
    if ("ids", path) not in _encoders:
        _encoders["ids", path] = IdEncoder(path)
    return _encoders["ids", path]


class PieceCounter:
    """Numbers of ids of whole texts, for a sentencepiece model, or a file of ``tokenizers``."""

    def __init__(self, path: str, frequent: dict[str, int]):
        if path.endswith(".json"):
            encoder = id_encoder(path)
            size = encoder.dtype.itemsize
            self.count = lambda texts: [len(ids) // size for ids in encoder(texts)]
            return
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size())):
            self.count = lambda texts: [len(ids) for ids in model.encode([t or "" for t in texts], num_threads=1)]
            return
        cache = PieceCache(lambda pieces: piece_lengths(model, pieces), first=frequent)
        self.count = lambda texts: [sum(v) for v in cache.look_up(marked_pieces(t) if t else [] for t in texts)]


def piece_lengths(model, pieces: list[str]) -> list[int]:
    """Ids of each piece behind a space; the empty piece is that space."""
    return [len(ids) if p else 1 for p, ids in zip(pieces, model.encode(pieces, num_threads=1))]


def piece_counter(path: str, frequent: dict[str, int]) -> PieceCounter:
    """This worker's counter for the file; it begins with the frequent pieces."""
    if ("counts", path) not in _encoders:
        _encoders["counts", path] = PieceCounter(path, frequent)
    return _encoders["counts", path]


def portions(texts, rows: int = 1024, chars: int = 1 << 21):
    """Runs of a batch's texts, short enough for their pieces to fit in memory."""
    first, size = 0, 0
    for i, n in enumerate(map(lambda t: len(t or ""), texts)):
        if i > first and (i - first >= rows or size + n > chars):
            yield first, i
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, len(texts)
