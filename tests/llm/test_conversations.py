"""Repair of conversations against all edits, against its SQL, and over conversations that span many tasks."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shiftlab.llm import conversations as c
from shiftlab.llm.oracle import ORACLE
from shiftlab.llm.queries import QUERIES

KIND = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NAMES = {"u": "user", "a": "assistant"}


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND)


def in_order(rows):
    def key(row):
        turn, role, text = row
        return (turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=key)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, found, i=0, roles="", inserted=0):
    """Every (cost, audit, lines) that makes the roles legal, with up to two rows inserted at a place."""
    if i == len(rows):
        if re.fullmatch(r"(s?(ua)+)?", roles):
            yield 0, "", []
    else:
        _, role, text = rows[i]
        extra = 5 if found[i] == "truncated" else 0
        options = [("D", 2, None, None)]
        if found[i] not in ("blank", "duplicate"):
            options += [("K", extra, role[:1] or "-", role)] + [("R", 1 + extra, x, NAMES[x]) for x in "ua"]
        for edit, cost, initial, name in options:
            for rest, audit, lines in all_edits(rows, found, i + 1, roles + (initial or "")):
                yield cost + rest, edit + audit, ([f"{name}:{text}"] if name is not None else []) + lines
    if inserted < 2:
        for x in "ua":
            for rest, audit, lines in all_edits(rows, found, i, roles + x, inserted + 1):
                yield 5 + rest, "I" + audit, [NAMES[x] + ":"] + lines


def counts(rows, found):
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, *[found.count(x) for x in ("blank", "duplicate", "truncated")], illegal


def brute(conv, rows):
    rows = in_order(rows)
    found = faults(rows)
    cost, audit, lines = min(all_edits(rows, found), key=lambda x: x[:2])
    return (conv, *counts(rows, found), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def fast(conv, rows):
    rows = in_order(rows)
    return stepwise(conv, rows, faults(rows))


def stepwise(conv, rows, found):
    """The same over long conversations: costs back to front, then edit by edit, a row at a time."""
    step = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    wanted = "uuau"

    def options(i, q, here, there):
        out = []
        if i < len(rows):
            out.append((2 + there[q], "D", q))
            if found[i] not in ("blank", "duplicate"):
                extra = 5 if found[i] == "truncated" else 0
                if rows[i][1][:1] in step[q]:
                    to = step[q][rows[i][1][:1]]
                    out.append((extra + there[to], "K", to))
                to = step[q][wanted[q]]
                out.append((1 + extra + there[to], "R", to))
        if here:
            to = step[q][wanted[q]]
            out.append((5 + here[to], "I", to))
        return out
    costs = [None] * len(rows) + [[0, 10, 5, 0]]
    for i in reversed(range(len(rows))):
        plain = [min(options(i, q, None, costs[i + 1]))[0] for q in range(4)]
        costs[i] = [min(plain[0], 5 + plain[2], 10 + plain[3]), min(plain[1], 5 + plain[2], 10 + plain[3]),
                    min(plain[2], 5 + plain[3]), min(plain[3], 5 + plain[2])]
    i, q, audit, lines = 0, 0, "", []
    while i < len(rows) or q not in (0, 3):
        there = costs[i + 1] if i < len(rows) else None
        _, edit, to = min((x for x in options(i, q, costs[i], there) if x[0] == costs[i][q]), key=lambda x: x[1])
        audit += edit
        if edit in "RI":
            lines.append(NAMES[wanted[q]] + ":" + (rows[i][2] if edit == "R" else ""))
        elif edit == "K":
            lines.append(rows[i][1] + ":" + rows[i][2])
        i, q = i + (edit != "I"), to
    return (conv, *counts(rows, found), costs[0][0], audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0] is not None, r[0]))


def made_up(rng, n, roles=("system", "user", "assistant", "tool", "", None)):
    texts = ["All done.", "Why?", "no end", " \t\n", "", None, "x! \n", "日本。", "Yes!"]
    return [(rng.choice([None, *range(n + 2)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_against_all_edits(spark):
    rng = random.Random(3)
    held = {i: made_up(rng, rng.randint(1, 4)) for i in range(150)}
    held |= {i: made_up(rng, rng.randint(1, 4), ("user", "assistant", "system")) for i in range(150, 300)}
    held[None] = [(0, "user", "A."), (1, "assistant", "B.")]
    rows = [(conv, *row) for conv, found in held.items() for row in found]
    rng.shuffle(rows)
    df = frame(spark, rows).withColumns({x: F.lit("x") for x in (
        "part", "digest", "symbol", "matrix", "audit", "cost", "is_row", "kind", "_conv", "blank", "after")})
    found = result(c.repaired(df))
    assert found == sorted((brute(*x) for x in held.items()), key=lambda r: (r[0] is not None, r[0]))
    assert found == sorted((fast(*x) for x in held.items()), key=lambda r: (r[0] is not None, r[0]))


def test_a_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    held = {1: made_up(rng, 40), 3: made_up(rng, 30)}
    held[2] = [(i, rng.choice(["user", "assistant", "assistant"]), f"text {i}" + rng.choice([".", "?", ""])) for i in range(3000)]
    held[2] += [(None, "user", "Again."), *[(5000 + i, "user", "Again.") for i in range(4000)]]
    df = frame(spark, [(conv, *row) for conv, found in held.items() for row in found])
    clean = c._clean(df)
    parts = c._edits(clean, c._faults(clean)).where("is_row = 0 and conv_id = 2").count()
    assert parts >= 4
    assert result(c.repaired(df)) == [fast(*x) for x in sorted(held.items())]


def test_runs_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 7)
    rng = random.Random(7)
    for _ in range(200):
        runs = [(rng.randrange(9), rng.randint(1, 30)) for _ in range(rng.randint(1, 6))]
        rows, found = [], []
        for symbol, n in runs:
            for _ in range(n):
                rows.append((len(rows), "suat"[(symbol - 1) % 4] if symbol else "u", ""))
                found.append("blank" if not symbol else "truncated" if symbol > 4 else "")
        audit, _ = c.unroll(runs, c.END[:, 0].tolist(), 0, True)
        assert audit == stepwise(0, rows, found)[7]


def test_powers_are_products_of_single_steps():
    for symbol in range(9):
        one = c.END
        for n in range(1, 40):
            one = c.advance(symbol, 1, one)
            assert (c.advance(symbol, n, c.END) == one).all()


def test_lines_are_what_was_hashed(spark):
    rng = random.Random(9)
    held = {i: made_up(rng, rng.randint(1, 12)) for i in range(60)}
    df = frame(spark, [(conv, *row) for conv, found in held.items() for row in found])
    lines = {}
    for r in sorted(c.repaired_lines(df).collect(), key=lambda r: (r.conv_id, r.line)):
        lines.setdefault(r.conv_id, []).append((r.line, f"{r.role}:{r.text}"))
    for row in c.repaired(df).collect():
        said = lines.get(row.conv_id, [])
        assert [n for n, _ in said] == list(range(len(said)))
        assert row.repaired_sha256 == hashlib.sha256("\n".join(x for _, x in said).encode()).hexdigest()
        assert re.fullmatch(r"(s?(ua)+)?", "".join(x[0] for _, x in said))


def test_no_rows(spark):
    empty = frame(spark, [])
    assert result(c.repaired(empty)) == []
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ids = spark.createDataFrame([(7,), (None,)], "conv_id long")
    assert result(c.repaired(empty, ids)) == [(None, *nothing), (7, *nothing)]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def test_damage(spark):
    rows = [(conv, turn, role, text) for conv in [None, *range(40)] for turn, (role, text) in enumerate(
        [("system", "Be kind."), ("user", "Why? Yes!"), ("assistant", None), (None, "So. \n"), ("user", "x" * 5000)])]
    rows += [(1, None, "user", "No turn.")] * 2
    found = [(r.conv_id, r.turn, r.role, r.text) for r in c.damaged(frame(spark, rows)).collect() for _ in range(r.copies)]
    assert sorted(found, key=repr) == sorted(damage(rows), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    found = con.execute(ORACLE["op11_conversation_repair"])
    want = [dict(zip([d[0] for d in found.description], row)) for row in found.fetchall()]
    got = QUERIES["op11_conversation_repair"](spark, folder)
    assert result(got) == sorted(tuple(r[x] for x in COLUMNS) for r in want)


def test_sql_on_odd_rows(spark):
    rng = random.Random(13)
    rows = [(i, *row) for i in [None, *range(200)] for row in made_up(rng, rng.randint(1, 7))]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = con.execute(ORACLE["op11_conversation_repair"])
    names = [d[0] for d in found.description]
    want = [tuple(row[names.index(x)] for x in COLUMNS) for row in found.fetchall()]
    df = frame(spark, rows)
    got = result(c.repaired(c.damaged(df), df.select("conv_id")))
    assert got == sorted(want, key=lambda r: (r[0] is not None, r[0]))
