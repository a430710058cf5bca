"""Languages: held-out accuracy, spans of mixed texts, and paths against all paths."""

import itertools
import sys
import unicodedata
import zlib

import numpy as np

from shiftlab.llm import common, language_id
from shiftlab.llm.queries import QUERIES
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op7_language_id"](spark, SF).collect()
    truth = {r.doc_id: r.lang for r in common.documents(spark, SF).collect()}
    assert len(found) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_best_paths():
    rng = np.random.default_rng(1)
    counts = np.array([4, 0, 1, 5, 3])
    scores = rng.normal(size=(counts.sum(), 3)).astype(np.float32) * 2
    state = language_id.paths(scores, counts, 1.5)
    at = 0
    for n in counts:
        part = scores[at:at + n]

        def worth(path):
            return sum(part[i, s] for i, s in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))
        if n:
            best = max(map(worth, itertools.product(range(3), repeat=int(n))))
            assert abs(worth(state[at:at + n]) - best) < 1e-5
        at += n


def mixed(spark):
    russian, english = "мама мыла раму это слово хорошее", "the cat sat upon a good mat there"
    rows = [(i, t, lang, "s", 0) for i in range(20) for lang, t in (("ru", russian), ("en", english))]
    return cases.docs(spark, rows)


def test_spans(spark):
    model = language_id.train(mixed(spark))
    assert model.languages == ["en", "ru"]
    text = "the good cat sat there мама мыла раму слово 12 the cat sat upon"
    found = language_id.identified(cases.small(spark, [(1, text)]), model, switch=3.0).collect()[0]
    assert [(s.first_word, s.lang) for s in found.spans] == [(0, "en"), (5, "ru"), (10, "en")] or \
        [(s.first_word, s.lang) for s in found.spans] == [(0, "en"), (5, "ru"), (9, "en")]
    assert found.lang_pred == "en" and 0.4 < found.score < 0.75


def test_odd_documents(spark):
    model = language_id.train(mixed(spark))
    rows = cases.small(spark, [(1, None), (2, ""), (3, "12 -- 7"), (4, "日本"), (4, "ΟΔΟΣ x"), (None, "the cat"), (6, cases.LONG)])
    found = sorted(((r.doc_id or 0, r.lang_pred, r.score, r.held_out) for r in language_id.identified(rows, model).collect()))
    assert [f[:3] for f in found[1:4]] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert found[0][1:] == ("en", 1.0, False)
    assert {f[1] for f in found[4:6]} == {"en", model.languages[model.usual]} and found[6][1] in ("en", "ru")
    assert len(language_id.identified(cases.odd(spark), model).collect()) == len(cases.ODD)


def test_nothing_to_learn_from(spark):
    model = language_id.train(cases.docs(spark, [(1, "text", None, "s", 4), (2, None, "en", "s", 0)]))
    found = language_id.identified(cases.small(spark, [(1, "text")]), model).collect()
    assert [(r.lang_pred, r.score, r.spans) for r in found] == [("und", 0.0, [])]
    assert language_id.identified(cases.docs(spark, []), model).collect() == []


def test_every_letter_has_a_script():
    """Letters by the character database, through the bytes of a text."""
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    scripts = language_id.byte_scripts(np.frombuffer("".join(map(chr, points)).encode(), np.uint8))
    width = np.array([len(chr(c).encode()) for c in points])
    of = dict(zip(points, scripts[np.cumsum(width) - width].tolist()))
    kinds = {c: unicodedata.category(chr(c))[0] for c in points}
    assert [hex(c) for c in points if kinds[c] == "L" and not of[c]] == []
    assert [hex(c) for c in points if kinds[c] not in "LM" and of[c]] == []
    assert len({of[ord(c)] for c in "aαкԱאعकবਕકଓதతಕമකกລཀကგ가አខᠠ𞤀𐌰"}) == 27


def test_labelled_languages_of_all_scripts(spark):
    texts = {"am": "ሰላም ለዓለም ሁሉ ይሁን", "bo": "བོད ཡིག ནི ལེགས", "en": "the cat sat upon a good mat there", "ff": "𞤀𞤣𞤤𞤢𞤥 𞤆𞤵𞤤𞤢𞤪",
             "gu": "ગુજરાતી ભાષા સારી છે", "km": "ភាសា ខ្មែរ ល្អ", "kn": "ಕನ್ನಡ ಭಾಷೆ ಒಳ್ಳೆಯದು", "lo": "ພາສາ ລາວ ດີ", "ml": "മലയാളം നല്ല ഭാഷ",
             "mn": "ᠮᠣᠩᠭᠣᠯ ᠪᠢᠴᠢᠭ", "my": "မြန်မာ ဘာသာ ကောင်း", "or": "ଓଡ଼ିଆ ଭାଷା ଭଲ", "pa": "ਪੰਜਾਬੀ ਭਾਸ਼ਾ ਚੰਗੀ", "si": "සිංහල භාෂාව හොඳයි", "te": "తెలుగు భాష మంచిది"}
    model = language_id.train(cases.docs(spark, [(i, t, lang, "s", 0) for i in range(5) for lang, t in texts.items()]))
    names = sorted(texts)
    found = language_id.identified(cases.small(spark, [(i, texts[x] + " 12") for i, x in enumerate(names)] + [
        (100, texts["te"] + " ok")]), model).collect()
    told = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert [told[i] for i in range(len(names))] == [(x, 1.0) for x in names]
    assert told[100][0] == "te" and told[100][1] > 0.8


def test_a_word_does_not_name_a_text_in_an_unlabelled_script(spark):
    found = language_id.identified(cases.small(spark, [(1, "తెలుగు భాష మంచిది cat")]), language_id.train(mixed(spark))).collect()
    assert found[0].lang_pred == "en" and found[0].score < 0.4
