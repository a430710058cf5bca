"""Documents with odd values, and helpers of the tests."""

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i}" for i in range(30000))

ODD = [
    (5, "one two three four five six seven", "en", "a", 33),
    (1, None, "en", "a", None),
    (2, "", None, "b", 0),
    (3, "  \t\n ", "en", None, 5),
    (4, "few words", None, None, 9),
    (6, "one two three four five six seven", "en", "b", 33),
    (6, "one two three four five six seven", "en", "b", 33),
    (None, "no id here at all but some words", "en", "a", 32),
    (7, LONG, "en", "c", len(LONG)),
    (8, "日本語 テキスト é <|endoftext|> İx  two  spaces ▁ mark nbsp", "ja", "a", 30),
]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def small(spark, rows):
    """(doc_id, text) rows."""
    return docs(spark, [(i, t, "en", "s", len(t or "")) for i, t in rows])


def odd(spark):
    """The odd documents, with further columns under names that operators use themselves."""
    from pyspark.sql import functions as F
    return docs(spark, ODD).withColumns({c: F.lit("x") for c in (
        "id", "n", "a", "b", "part", "row", "component", "size", "file", "bucket", "before", "first")})


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def brute_sets(rows, size=5):
    import re
    upper, lower = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
    out = []
    for text in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(bytes.maketrans(upper, lower)))
        n = max(1, len(words) - size + 1) if words else 0
        out.append({tuple(words[i:i + size]) for i in range(n)})
    return out


def brute_components(ids, links):
    name = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(name[a], name[b])
            for x in (a, b):
                if name[x] != low:
                    name[x], changed = low, True
    return name
