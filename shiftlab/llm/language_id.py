"""Languages of the words and spans of a text, and of the whole.

The script of a word's first letter, by ranges of code points, leaves those
languages that write in it. Each of them scores the word by its byte trigrams,
and a Viterbi path over the words pays ``SWITCH`` for each change of language, so
that a text becomes a few spans. The language of most of the text, by characters
of words, is that of the whole.

The model is counted over every labelled text, map-side, so it depends on no
sample; what the driver and a task hold of it is bounded by the number of trigram
buckets times languages.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlab.llm import hashing, tokens
from shiftlab.llm.common import own_columns, ship

BUCKETS = 1 << 16
MOST_LANGUAGES = 200
#: Cost of a change of language between words, in nats.
SWITCH = 12.0
#: Score of a word for a language that does not write in its script.
FOREIGN = -20.0
#: Share of a language's letters from which it is said to write in a script.
WRITES = 0.01
SMOOTHING = 0.5
#: Words times languages that are worked on at once.
CELLS = 1 << 22

#: First code point (hex) of each range and the script of its letters; "-" has marks that go with any script.
RANGES = [r.split() for r in """
0 Latin, 300 -, 370 Greek, 400 Cyrillic, 530 Armenian, 590 Hebrew, 600 Arabic, 700 Syriac, 750 Arabic, 780 Thaana, 7C0 Nko,
800 Samaritan, 840 Mandaic, 860 Syriac, 870 Arabic, 900 Devanagari, 980 Bengali, A00 Gurmukhi, A80 Gujarati, B00 Odia, B80 Tamil,
C00 Telugu, C80 Kannada, D00 Malayalam, D80 Sinhala, E00 Thai, E80 Lao, F00 Tibetan, 1000 Burmese, 10A0 Georgian, 1100 Hangul,
1200 Ethiopic, 13A0 Cherokee, 1400 Canadian, 1680 Ogham, 16A0 Runic, 1700 Tagalog, 1720 Hanunoo, 1740 Buhid, 1760 Tagbanwa,
1780 Khmer, 1800 Mongolian, 18B0 Canadian, 1900 Limbu, 1950 TaiLe, 1980 NewTaiLue, 1A00 Buginese, 1A20 TaiTham, 1AB0 -,
1B00 Balinese, 1B80 Sundanese, 1BC0 Batak, 1C00 Lepcha, 1C50 OlChiki, 1C80 Cyrillic, 1C90 Georgian, 1CC0 Sundanese,
1CD0 Devanagari, 1D00 Latin, 1DC0 -, 1E00 Latin, 1F00 Greek, 2000 Latin, 20D0 -, 2100 Latin, 2C00 Glagolitic, 2C60 Latin,
2C80 Coptic, 2D00 Georgian, 2D30 Tifinagh, 2D80 Ethiopic, 2DE0 Cyrillic, 2E00 Latin, 2E80 Han, 3030 Kana, 3036 Han, 3040 Kana,
3100 Bopomofo, 3130 Hangul, 3190 Han, 31A0 Bopomofo, 31C0 Han, 31F0 Kana, 3200 Han, A000 Yi, A4D0 Lisu, A500 Vai, A640 Cyrillic,
A6A0 Bamum, A700 Latin, A800 SylotiNagri, A840 PhagsPa, A880 Saurashtra, A8E0 Devanagari, A900 KayahLi, A930 Rejang, A960 Hangul,
A980 Javanese, A9E0 Burmese, AA00 Cham, AA60 Burmese, AA80 TaiViet, AAE0 Meetei, AB00 Ethiopic, AB30 Latin, AB70 Cherokee,
ABC0 Meetei, AC00 Hangul, D800 -, F900 Han, FB00 Latin, FB13 Armenian, FB1D Hebrew, FB50 Arabic, FE00 -, FE70 Arabic, FF00 Latin,
FF66 Kana, FFA0 Hangul, FFE0 -, 10000 LinearB, 10100 -, 10280 Lycian, 102A0 Carian, 102E0 -, 10300 OldItalic, 10330 Gothic,
10350 OldPermic, 10380 Ugaritic, 103A0 OldPersian, 10400 Deseret, 10450 Shavian, 10480 Osmanya, 104B0 Osage, 10500 Elbasan,
10530 Albanian, 10570 Vithkuqi, 105C0 Todhri, 10600 LinearA, 10780 Latin, 10800 Cypriot, 10840 Aramaic, 10860 Palmyrene,
10880 Nabataean, 108E0 Hatran, 10900 Phoenician, 10920 Lydian, 10980 Meroitic, 10A00 Kharoshthi, 10A60 SouthArabian,
10A80 NorthArabian, 10AC0 Manichaean, 10B00 Avestan, 10B40 Parthian, 10B60 Pahlavi, 10B80 Psalter, 10C00 OldTurkic,
10C80 OldHungarian, 10D00 Rohingya, 10D40 Garay, 10E80 Yezidi, 10EC0 Arabic, 10F00 OldSogdian, 10F30 Sogdian, 10F70 OldUyghur,
10FB0 Chorasmian, 10FE0 Elymaic, 11000 Brahmi, 11080 Kaithi, 110D0 Sora, 11100 Chakma, 11150 Mahajani, 11180 Sharada,
111E0 Sinhala, 11200 Khojki, 11280 Multani, 112B0 Khudawadi, 11300 Grantha, 11380 Tigalari, 11400 Newa, 11480 Tirhuta,
11580 Siddham, 11600 Modi, 11660 Mongolian, 11680 Takri, 116D0 Burmese, 11700 Ahom, 11800 Dogra, 118A0 WarangCiti,
11900 DivesAkuru, 119A0 Nandinagari, 11A00 Zanabazar, 11A50 Soyombo, 11AB0 Canadian, 11AC0 PauCinHau, 11B00 Devanagari,
11BC0 Sunuwar, 11C00 Bhaiksuki, 11C70 Marchen, 11D00 MasaramGondi, 11D60 GunjalaGondi, 11EE0 Makasar, 11F00 Kawi, 11FB0 Lisu,
11FC0 Tamil, 12000 Cuneiform, 12F90 CyproMinoan, 13000 Egyptian, 14400 Anatolian, 16100 Gurung, 16800 Bamum, 16A40 Mro,
16A70 Tangsa, 16AD0 Bassa, 16B00 PahawhHmong, 16D40 Kirat, 16E40 Medefaidrin, 16F00 Miao, 16FE0 Han, 17000 Tangut, 18B00 Khitan,
18D00 Tangut, 1AFF0 Kana, 1B170 Nushu, 1BC00 Duployan, 1CC00 -, 1D400 Latin, 1D800 SignWriting, 1DF00 Latin, 1E000 Glagolitic,
1E030 Cyrillic, 1E100 Nyiakeng, 1E290 Toto, 1E2C0 Wancho, 1E4D0 NagMundari, 1E5D0 OlOnal, 1E7E0 Ethiopic, 1E800 Mende,
1E900 Adlam, 1EE00 Arabic, 1F000 -, 20000 Han, E0000 -
""".split(",")]
_NAMES = ["-", *dict.fromkeys(n for _, n in RANGES if n != "-")]
SCRIPTS = len(_NAMES)


def _scripts() -> np.ndarray:
    """The script of every code point by its place in ``_NAMES``; 0 for all but letters and their marks."""
    starts = [int(a, 16) for a, _ in RANGES] + [0x110000]
    out = np.repeat(np.array([_NAMES.index(n) for _, n in RANGES], np.uint8), np.diff(starts))
    out[[c for c in np.flatnonzero(out[:0x40000]).tolist() if unicodedata.category(chr(c))[0] not in "LM"]] = 0
    out[0x40000:] = 0
    return out


_SCRIPT_OF = _scripts()
_ASCII_SCRIPT = np.where(np.arange(256) < 128, _SCRIPT_OF[:256], 0).astype(np.uint8)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the accented capitals of Latin-1 in lower case."""
    out = hashing._LOWER[data]
    wide = np.flatnonzero(data[:-1] == 0xC3) + 1
    high = data[wide]
    out[wide[(high >= 0x80) & (high <= 0x9E) & (high != 0x97)]] += 0x20
    return out


def byte_scripts(data: np.ndarray) -> np.ndarray:
    """The script of the character that begins at each byte, 0 inside characters."""
    out = _ASCII_SCRIPT[data]
    at = np.flatnonzero(data >= 0xC2)
    if len(at):
        padded = np.r_[data, np.zeros(3, np.uint8)].astype(np.int32)
        a, b, c = padded[at], padded[at + 1] & 63, padded[at + 2] & 63
        point = np.where(a < 0xE0, (a & 31) << 6 | b, (a & 15) << 12 | b << 6 | c)
        far = np.flatnonzero(a >= 0xF0)
        point[far] = (a[far] & 7) << 18 | b[far] << 12 | c[far] << 6 | padded[at[far] + 3] & 63
        out[at] = _SCRIPT_OF[np.minimum(point, 0x10FFFF)]
    return out


class Words:
    """Words of some texts with their script and the trigram bucket of each byte."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.first, self.behind, self.row = hashing.word_spans(data, offsets)
        lower = lowered(data) if len(data) else data
        inside = np.zeros(len(data) + 2, bool)
        before, after = np.full(len(data), 32, np.uint32), np.full(len(data), 32, np.uint32)
        if len(data):
            before[1:], after[:-1] = lower[:-1], lower[1:]
            before[self.first] = 32
            after[self.behind - 1] = 32
            np.add.at(steps := np.zeros(len(data) + 1, np.int8), self.first, 1)
            np.subtract.at(steps, self.behind, 1)
            inside = np.cumsum(steps[:-1]) > 0
        code = before << np.uint32(16) | lower.astype(np.uint32) << np.uint32(8) | after
        bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
        self.bucket = bucket[inside[:len(data)]]
        self.length = self.behind - self.first
        self.at = np.cumsum(self.length) - self.length
        begins = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        self.chars = begins[self.behind] - begins[self.first]
        self.byte_script = byte_scripts(data)[inside[:len(data)]] if len(data) else np.zeros(0, np.uint8)
        letters = np.flatnonzero(self.byte_script)
        nearest = np.searchsorted(letters, self.at)
        found = np.r_[letters, 1 << 60][nearest]
        self.script = np.where(found < self.at + self.length, self.byte_script[np.minimum(found, max(0, len(self.byte_script) - 1))]
                               if len(self.byte_script) else 0, 0)


def counter(batches):
    """(lang, bucket, n) of the labelled texts of a task; scripts are buckets behind those of trigrams."""
    tokens.forget()
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = hashing.text_bytes(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for a, b in hashing.slices(offsets):
            words = Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            names = sorted(set(langs[a:b]))
            number = np.array([names.index(x) for x in langs[a:b]])
            owner = number[np.repeat(words.row, words.length)]
            width = BUCKETS + SCRIPTS
            for values in (words.bucket.astype(np.int64), BUCKETS + words.byte_script.astype(np.int64)):
                found = np.bincount(owner * width + values, minlength=len(names) * width).reshape(len(names), width)
                for i, name in enumerate(names):
                    if name not in counts:
                        if len(counts) == MOST_LANGUAGES:
                            raise ValueError(f"more than {MOST_LANGUAGES} languages")
                        counts[name] = np.zeros(width, np.int64)
                    counts[name] += found[i]
    for name, found in counts.items():
        some = np.flatnonzero(found)
        yield pa.record_batch([pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(found[some])],
                              ["lang", "bucket", "n"])


class Model:
    """Languages by code point; log probabilities of trigram buckets; scripts each writes in; the most common one."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts, key=str.encode)
        grams = np.array([counts[x][:BUCKETS] for x in self.languages], np.float64).reshape(-1, BUCKETS)
        scripts = np.array([counts[x][BUCKETS:] for x in self.languages], np.float64).reshape(-1, SCRIPTS)
        sums = grams.sum(1, keepdims=True)
        scores = np.log((grams + SMOOTHING) / (sums + SMOOTHING * BUCKETS)).T
        self.scores = np.ascontiguousarray(scores - scores.mean(1, keepdims=True) if len(self.languages) else scores, np.float32)
        letters = scripts[:, 1:].sum(1, keepdims=True)
        self.writes = (scripts >= WRITES * np.maximum(letters, 1)).T
        if len(self.languages):
            self.writes[1 + scripts[:, 1:].argmax(1), np.arange(len(self.languages))] = True
        self.writes[0] = True
        self.writes[~self.writes.any(1)] = True
        self.known = np.r_[False, (scripts[:, 1:] > 0).any(0)] if len(self.languages) else np.zeros(SCRIPTS, bool)
        self.usual = int(sums.argmax()) if len(self.languages) else -1


def train(docs: DataFrame) -> Model:
    """Count over the rows of ``docs`` (text, lang) that have both."""
    ship(docs.sparkSession)
    rows = own_columns(docs, text="text", lang=F.col("lang").cast("string")).where("text is not null and lang is not null")
    counts = rows.mapInArrow(counter, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    languages = found.column("lang").to_numpy()
    bucket, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()
    out = {}
    for lang in set(languages):
        out[lang] = np.zeros(BUCKETS + SCRIPTS, np.int64)
        some = languages == lang
        out[lang][bucket[some]] = n[some]
    if len(out) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return Model(out)


def paths(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """The best language of every word; ``counts`` words of each text follow each other in ``scores``."""
    state = np.zeros(len(scores), np.int16)
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    starts, lengths = starts[order], counts[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(longest), "right")
    moved = np.zeros(scores.shape, bool)
    leader = np.zeros(len(scores), np.int16)
    value = scores[starts[:active[0]]].copy() if longest else scores
    ends = np.zeros(len(lengths), np.int64)
    for t in range(1, longest):
        n = active[t]
        if n < len(value):
            ends[n:len(value)] = value[n:].argmax(1)
            value = value[:n]
        rows = starts[:n] + t
        best = value.argmax(1)
        bound = value[np.arange(n), best][:, None] - switch
        moved[rows] = value < bound
        leader[rows] = best
        value = np.maximum(value, bound) + scores[rows]
    if longest:
        ends[:len(value)] = value.argmax(1)
    now = ends.copy()
    for t in range(longest - 1, -1, -1):
        n = active[t]
        rows = starts[:n] + t
        state[rows] = now[:n]
        if t:
            turn = moved[rows, now[:n]]
            now[:n][turn] = leader[rows[turn]]
    return state


def identifier(shared, switch: float):
    def run(batches):
        tokens.forget()
        model: Model = shared.value
        many = len(model.languages)
        for batch in batches:
            data, offsets = hashing.text_bytes(batch.column("text"))
            letter = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            for a, b in hashing.slices(offsets, max(hashing.SLICE // 4, min(hashing.SLICE * 2, CELLS // max(1, many) * 2))):
                yield label(model, many, batch.slice(a, b - a), data[offsets[a]:offsets[b]],
                            offsets[a:b + 1] - offsets[a], letter[a:b], switch)
    return run


def word_scores(model: Model, words: Words) -> np.ndarray:
    many = len(model.languages)
    scores = np.zeros((len(words.first), many), np.float32)
    step = max(1, (hashing.SLICE * 4 // max(1, many)))
    begin = 0
    while begin < len(words.first):
        stop = max(begin + 1, int(np.searchsorted(words.at + words.length, words.at[begin] + step, "right")))
        low, high = words.at[begin], words.at[stop - 1] + words.length[stop - 1]
        scores[begin:stop] = np.add.reduceat(model.scores[words.bucket[low:high]], words.at[begin:stop] - low, axis=0)
        begin = stop
    scores[~model.known[words.script]] = 0
    scores[~model.writes[words.script]] = FOREIGN
    return scores


def label(model, many, batch, data, offsets, letter, switch):
    rows = len(offsets) - 1
    spans, names, share = [[] for _ in range(rows)], ["und"] * rows, np.zeros(rows)
    if many:
        words = Words(data, offsets)
        counts = np.bincount(words.row, minlength=rows)
        state = paths(word_scores(model, words), counts, switch)
        known = model.known[words.script]
        weight = np.bincount(words.row * many + state, words.chars * known, rows * many).reshape(rows, many)
        total = weight.sum(1)
        best = np.where(total > 0, weight.argmax(1), model.usual)
        letters = np.bincount(words.row, words.chars * (words.script > 0), rows)
        share = np.where(total > 0, weight.max(1) / np.maximum(letters, 1), 0.0) * letter
        names = [model.languages[i] if has else "und" for i, has in zip(best, letter)]
        turn = np.flatnonzero(np.r_[True, (words.row[1:] != words.row[:-1]) | (state[1:] != state[:-1])]) if len(state) else []
        begins = np.cumsum(counts) - counts
        for i, j in zip(turn, [*turn[1:], len(state)]):
            r = int(words.row[i])
            if letter[r]:
                spans[r].append({"first_word": int(i - begins[r]), "n_words": int(j - i), "lang": model.languages[state[i]]})
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))
    return pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                            pa.array(share, pa.float64()), pa.array(spans, kind)],
                           ["doc_id", "held_out", "lang_pred", "score", "spans"])


def held_out(doc_id: str) -> Column:
    """crc32 of the id's text leaves 1 when divided by 3; without an id false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans: one row for each row of ``docs`` (doc_id, text).

    spans (first_word, n_words, lang) cover the words ``[^\\x20\\x09-\\x0D]+`` of a text
    in order. lang_pred has most characters of words, ties by code point; score is its
    share of the characters of all words with letters, 0 to 1. A null or empty text, or one without a letter (\\p{L}), is ``und``
    with score 0 and no spans. Where no word is in a script that the model has met,
    the most common language is told with score 0. A model without languages
    tells ``und``. Other columns are ignored; doc_id may be null or repeat.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = own_columns(docs, doc_id="doc_id", text="text", held_out=held_out("doc_id"),
                       letter=F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(
        identifier(spark.sparkContext.broadcast(model), switch),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
        "spans array<struct<first_word: long, n_words: long, lang: string>>")
