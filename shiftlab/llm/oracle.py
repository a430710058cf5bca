"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_SETS = r"""
words AS (SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2)
"""

#: CRC-32 by its table: ``crc_step`` carries a state over the bytes of a text.
_CRC = r"""
crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)
"""


def _crc_bytes(text: str) -> str:
    return (f"list_transform(range(0, strlen({text})), lambda i: "
            f"('0x' || substr(hex({text}), (2 * i + 1)::BIGINT, 2))::BIGINT)")


def _crc_over(state: str, numbers: str) -> str:
    return f"list_reduce({numbers}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), {state})"


def _words_of(table: str, key: str) -> str:
    return rf"""SELECT {key} AS id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT {key}, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})"""


def _move(state: int, after: str) -> str:
    """Least cost of one row and what follows it, from a state; ``after`` is the prefix of the later costs."""
    to = (2, 2, 3, 2)[state]
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
    kept = " ".join(f"WHEN initial = '{i}' THEN extra + {after}{q}" for i, q in kept.items())
    return f"least(2 + {after}{state}, CASE WHEN gone THEN NULL ELSE 1 + extra + {after}{to} END, CASE WHEN gone THEN NULL {kept} END)"


ORACLE: dict[str, str] = {
    "op11_conversation_repair": rf"""
WITH RECURSIVE {_CRC},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT * EXCLUDE (k), xor({_crc_over("4294967295", _crc_bytes("k"))}, 4294967295) % 20 AS kind FROM keyed, crc_table),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text)) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid, substr(role, 1, 1) AS initial FROM damaged),
faults AS (SELECT *, solid = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    right(solid, 1) NOT IN ('.', '!', '?') AS cut, lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM ordered),
rows AS MATERIALIZED (SELECT *, blank OR again AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS extra FROM faults),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
    count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows GROUP BY conv_id),
steps AS (SELECT conv_id, n AS i, 0::BIGINT AS h0, 10::BIGINT AS h1, 5::BIGINT AS h2, 0::BIGINT AS h3 FROM counted
  UNION ALL
  SELECT conv_id, i, least(r0, 5 + r2, 10 + r3), least(r1, 5 + r2, 10 + r3), least(r2, 5 + r3), least(r3, 5 + r2)
  FROM (SELECT steps.conv_id, steps.i - 1 AS i, {", ".join(f"{_move(q, 'h')} AS r{q}" for q in range(4))}
    FROM steps JOIN rows ON rows.conv_id IS NOT DISTINCT FROM steps.conv_id AND rows.i = steps.i)),
costs AS MATERIALIZED (SELECT conv_id, i, [h0, h1, h2, h3] AS h FROM steps),
walk AS (SELECT conv_id, 0::BIGINT AS i, 0 AS q, '' AS audit, []::VARCHAR[] AS said FROM counted
  UNION ALL
  SELECT conv_id, CASE edit WHEN 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN q WHEN 'K' THEN kept ELSE to_q END, audit || edit,
    CASE edit WHEN 'D' THEN said ELSE said || [CASE edit WHEN 'K' THEN role ELSE CASE to_q WHEN 2 THEN 'user' ELSE 'assistant' END END
      || ':' || CASE edit WHEN 'I' THEN '' ELSE text END] END
  FROM (SELECT *, CASE WHEN 2 + later[q + 1] = h[q + 1] THEN 'D' WHEN 5 + h[to_q + 1] = h[q + 1] THEN 'I'
      WHEN NOT gone AND extra + later[kept + 1] = h[q + 1] THEN 'K' ELSE 'R' END AS edit
    FROM (SELECT walk.*, costs.h, next.h AS later, rows.role, rows.text, rows.gone, rows.extra, [2, 2, 3, 2][q + 1] AS to_q,
        CASE WHEN q = 0 AND initial = 's' THEN 1 WHEN q IN (0, 1, 3) AND initial = 'u' THEN 2 WHEN q = 2 AND initial = 'a' THEN 3 END AS kept
      FROM walk JOIN costs ON costs.conv_id IS NOT DISTINCT FROM walk.conv_id AND costs.i = walk.i
      LEFT JOIN costs next ON next.conv_id IS NOT DISTINCT FROM walk.conv_id AND next.i = walk.i + 1
      LEFT JOIN rows ON rows.conv_id IS NOT DISTINCT FROM walk.conv_id AND rows.i = walk.i + 1
      WHERE NOT (next.h IS NULL AND q IN (0, 3))))),
ends AS (SELECT walk.conv_id, audit, said FROM walk JOIN counted ON counted.conv_id IS NOT DISTINCT FROM walk.conv_id
  WHERE walk.i = n AND q IN (0, 3)),
known AS (SELECT DISTINCT conv_id FROM conversations)
SELECT known.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(costs.h[1], 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM known LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM known.conv_id
LEFT JOIN costs ON costs.conv_id IS NOT DISTINCT FROM known.conv_id AND costs.i = 0
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM known.conv_id
""",
    "op12_exact_top_k": """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
""",
    "op13_importance_resampling": f"""
WITH {_CRC},
numbered AS (SELECT row_number() OVER () AS id, doc_id, text FROM documents),
words AS MATERIALIZED (SELECT true AS own, * FROM ({_words_of("numbered", "id")})
  UNION ALL SELECT false, * FROM ({_words_of("(SELECT row_number() OVER () AS id, text FROM benchmark)", "id")})),
runs AS MATERIALIZED (SELECT own, id, w AS a, lead(w) OVER x AS b, lead(w, 2) OVER x AS c FROM words WINDOW x AS (PARTITION BY own, id ORDER BY i)),
spelled AS MATERIALIZED (SELECT w, {_crc_bytes("w")} AS n FROM (SELECT DISTINCT w FROM words)),
ones AS MATERIALIZED (SELECT w AS a, {_crc_over("4294967295", "n")} AS state FROM spelled, crc_table),
twos AS MATERIALIZED (SELECT a, b, {_crc_over("state", "[32::BIGINT] || n")} AS state
  FROM (SELECT DISTINCT a, b FROM runs WHERE b IS NOT NULL) JOIN ones USING (a) JOIN spelled ON spelled.w = b, crc_table),
threes AS MATERIALIZED (SELECT a, b, c, {_crc_over("state", "[32::BIGINT] || n")} AS state
  FROM (SELECT DISTINCT a, b, c FROM runs WHERE c IS NOT NULL) JOIN twos USING (a, b) JOIN spelled ON spelled.w = c, crc_table),
features AS MATERIALIZED (SELECT own, id, xor(state, 4294967295) % 10000 AS bucket FROM (
  SELECT own, id, state FROM runs JOIN ones USING (a) UNION ALL SELECT own, id, state FROM runs JOIN twos USING (a, b)
  UNION ALL SELECT own, id, state FROM runs JOIN threes USING (a, b, c))),
shares AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM features GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM shares),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM shares, totals),
weights AS (SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM features JOIN gains USING (bucket) WHERE own GROUP BY id),
n_words AS (SELECT id, count(*) AS n_words FROM words WHERE own GROUP BY id),
scored AS (SELECT numbered.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(n_words, 0) >= 20 AS enough,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(numbered.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))))::BIGINT AS score
  FROM numbered LEFT JOIN weights USING (id) LEFT JOIN n_words USING (id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place,
    count(*) FILTER (enough) OVER () * 5 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= drawn THEN place END::BIGINT AS rank FROM placed
""",
    "op1_minhash_near_dedup": f"""
WITH RECURSIVE {_SETS},
edges AS (SELECT links.a, links.b FROM links JOIN sizes x ON x.doc_id = links.a JOIN sizes y ON y.doc_id = links.b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reached AS (SELECT DISTINCT doc_id, doc_id AS other FROM documents WHERE doc_id IS NOT NULL
  UNION SELECT reached.doc_id, edges.b FROM reached JOIN edges ON reached.other = edges.a),
found AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT documents.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, found.component_id,
  coalesce(documents.doc_id = found.component_id, true) AS kept
FROM documents LEFT JOIN sizes ON sizes.doc_id = documents.doc_id LEFT JOIN found ON found.doc_id = documents.doc_id
""",
    "op10_source_mixing": r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS n,
    [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS w,
    row_number() OVER (ORDER BY source IS NULL, encode(source)) AS i
  FROM sized GROUP BY source),
placed AS (SELECT *, sum(n) OVER () * 1.5 - coalesce(sum(2 * n) OVER (ORDER BY n / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY n / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
    row_number() OVER (ORDER BY n / w, i) AS place FROM sources),
full_to AS (SELECT coalesce(min(place), 1000000000) AS first_open FROM placed WHERE 2 * n * open_w > rest * w),
shared AS (SELECT source, n, CASE WHEN place < first_open THEN (2 * n)::DOUBLE ELSE
    (SELECT p.rest::DOUBLE FROM placed p WHERE p.place = first_open) * w / (SELECT p.open_w::DOUBLE FROM placed p WHERE p.place = first_open)
    END AS target FROM placed, full_to),
queued AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM sized)
SELECT doc_id, size, n AS source_size, target,
  (greatest(0, least(first + size, round_even(target, 0)) - first)
   + greatest(0, least(first + size, round_even(target, 0) - n) - first))::BIGINT AS taken
FROM queued JOIN shared ON queued.source IS NOT DISTINCT FROM shared.source
""",
}
