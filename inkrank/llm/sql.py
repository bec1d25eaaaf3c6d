"""The registered queries in SQL, where SQL can say them."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

# CRC-32 of a text's bytes, by a table that a recursion over the eight bits makes.
# 3988292384 and 4294967295 are fixed values of that checksum.
_CRC = """
crc_bits AS (
  SELECT 0 AS round, i, i AS c FROM range(256) r(i)
  UNION ALL
  SELECT round + 1, i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM crc_bits WHERE round < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE round = 8)"""


def _crc_of(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::BIGINT))"""


def jump_shards(shards: int) -> str:
    """Each distinct id jumps on until it would leave the shards; ``n`` counts them."""
    return f"""
WITH RECURSIVE {_CRC},
rows AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    {_crc_of("coalesce(text, '')")} AS text_crc32
  FROM documents, crc_table),
jumps AS (
  SELECT doc_id, n, (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616 AS state,
    -1::BIGINT AS shard, 0::DOUBLE AS landed
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES ({shards}), ({shards + 1})) counts(n)
  UNION ALL
  SELECT doc_id, n, drawn, landed::BIGINT, floor((landed + 1) * (2147483648::DOUBLE / ((drawn >> 33) + 1)::DOUBLE))
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS drawn FROM jumps WHERE landed < n)),
places AS (
  SELECT doc_id, CAST(max(jumps.shard) FILTER (WHERE n = {shards}) AS INTEGER) AS shard,
    CAST(max(jumps.shard) FILTER (WHERE n = {shards + 1}) AS INTEGER) AS grown_shard
  FROM jumps GROUP BY doc_id)
SELECT rows.doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY rows.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM rows JOIN places ON rows.doc_id IS NOT DISTINCT FROM places.doc_id"""


def _assigned(books: str, name: str) -> str:
    """``(vec_id, row, part, entry, error)`` by all distances, the least of equal ones."""
    return f"""
{name} AS MATERIALIZED (
  SELECT id, part, least.entry AS entry, least.error AS error FROM (
    SELECT id, part, min({{'error': error, 'entry': entry}}) AS least FROM (
      SELECT id, x.part, entry, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS error
      FROM xs x JOIN {books} b ON x.part = b.part AND x.i = b.i GROUP BY id, x.part, entry)
    GROUP BY id, part))"""


def vector_codes(parts: int, entries: int, rounds: int) -> str:
    """Codebooks by rounds of tables; for vectors of one length that the parts divide."""
    steps = []
    for turn in range(rounds):
        steps.append(_assigned(f"books{turn}", f"near{turn}"))
        steps.append(f"""
books{turn + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.i, coalesce(m.v, b.v) AS v FROM books{turn} b LEFT JOIN (
    SELECT n.part, n.entry, x.i, CAST(floor(sum(x.v)::DOUBLE / count(*)) AS BIGINT) AS v
    FROM near{turn} n JOIN xs x ON n.id = x.id AND n.part = x.part GROUP BY n.part, n.entry, x.i) m
  ON b.part = m.part AND b.entry = m.entry AND b.i = m.i)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS id, vec_id, label, embedding
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (
  SELECT id, len(embedding) // {parts} AS width, generate_subscripts(embedding, 1) - 1 AS place,
    CAST(floor(4096 * unnest(embedding)::DOUBLE) AS BIGINT) AS v FROM kept),
xs AS MATERIALIZED (SELECT id, place // width AS part, place % width AS i, v FROM flat),
books0 AS MATERIALIZED (SELECT part, id AS entry, i, v FROM xs WHERE id < {entries}),
{",".join(steps)},
{_assigned(f"books{rounds}", "last")},
coded AS (
  SELECT id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM last GROUP BY id),
hashed AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, i)) AS h FROM books{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (id), hashed"""


def conversation_repair() -> str:
    """The cheapest edits turn by turn: of each state the least (cost, audit) so far.

    Two ways to one state at one turn never have audits of which one begins with the
    other at equal cost, so the least so far stays the least."""
    return rf"""
WITH RECURSIVE {_CRC},
turns AS (
  SELECT coalesce('=' || conv_id, '') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc_of("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate, row_number() OVER () AS r
  FROM conversations, crc_table),
damaged AS (
  SELECT key, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, 2 * r + c AS r
  FROM turns, range(2) copies(c) WHERE fate <> 0 AND c <= (fate = 3)::INT),
said AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER in_turn AS i, row_number() OVER (PARTITION BY key, role, text ORDER BY turn NULLS FIRST, r) AS nth,
    lag(role) OVER in_turn AS before
  FROM damaged WINDOW in_turn AS (PARTITION BY key ORDER BY turn NULLS FIRST, role, text, r)),
rows AS MATERIALIZED (
  SELECT key, i, turn, role, text, before, left(role, 1) AS initial,
    CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM said),
steps(state, spoken, after) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
made(state, after, edits, lines, cost) AS (VALUES
  ('', '', '', '', 0), ('s', 's', '', '', 0), ('u', 'u', '', '', 0), ('a', 'a', '', '', 0),
  ('', 'u', 'I', E'\nuser:', 5), ('s', 'u', 'I', E'\nuser:', 5), ('u', 'a', 'I', E'\nassistant:', 5), ('a', 'u', 'I', E'\nuser:', 5),
  ('', 'a', 'II', E'\nuser:\nassistant:', 10), ('s', 'a', 'II', E'\nuser:\nassistant:', 10)),
ways AS (
  SELECT DISTINCT key, 0::BIGINT AS i, '' AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} AS way FROM turns
  UNION ALL
  SELECT key, i, state, min(way) FROM (
    SELECT r.key, r.i, m.after AS state, {{'cost': (way.cost + m.cost + 2)::BIGINT, 'audit': way.audit || m.edits || 'D', 'lines': way.lines || m.lines}} AS way
    FROM ways JOIN rows r ON r.key = ways.key AND r.i = ways.i + 1 JOIN made m ON m.state = ways.state
    UNION ALL
    SELECT r.key, r.i, s.after, {{'cost': (way.cost + m.cost + (fault = 'truncated')::INT * 5 + (e.edit = 'R')::INT)::BIGINT,
      'audit': way.audit || m.edits || e.edit,
      'lines': way.lines || m.lines || E'\n' || CASE WHEN e.edit = 'K' THEN role WHEN s.spoken = 'u' THEN 'user' ELSE 'assistant' END || ':' || text}}
    FROM ways JOIN rows r ON r.key = ways.key AND r.i = ways.i + 1 JOIN made m ON m.state = ways.state
    JOIN steps s ON s.state = m.after JOIN (VALUES ('K'), ('R')) e(edit) ON CASE WHEN e.edit = 'K' THEN initial = s.spoken ELSE s.spoken <> 's' END
    WHERE fault NOT IN ('blank', 'duplicate'))
  GROUP BY key, i, state),
counted AS (
  SELECT key, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE i > 1 AND left(before, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY key),
best AS (
  SELECT w.key, min({{'cost': (way.cost + m.cost)::BIGINT, 'audit': way.audit || m.edits, 'lines': way.lines || m.lines}}) AS way
  FROM ways w LEFT JOIN counted c ON w.key = c.key JOIN made m ON m.state = w.state AND m.after IN ('', 'a')
  WHERE w.i = coalesce(c.n, 0) GROUP BY w.key)
SELECT CAST(nullif(substr(best.key, 2), '') AS BIGINT) AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  way.cost AS cost, way.audit AS audit, sha256(substr(way.lines, 2)) AS repaired_sha256
FROM best LEFT JOIN counted ON best.key = counted.key"""


def repeated_bytes(window: int) -> str:
    """Bytes in rows; a window is its bytes joined, and goes if a smaller id has it."""
    return f"""
WITH db AS (
  SELECT doc_id, unnest(parts) AS byte, generate_subscripts(parts, 1) AS i, len(parts) AS size FROM (
    SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS parts FROM documents)),
win AS (
  SELECT doc_id, i, md5(string_agg(byte, '') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)) AS gram, i + {window - 1} <= size AS whole FROM db),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM win WHERE whole) WHERE doc_id > least),
marked AS (
  SELECT doc_id, i, byte, max(later.i) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM db LEFT JOIN later USING (doc_id, i)),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM marked)
SELECT doc_id, CAST(count(byte) AS BIGINT) AS n_bytes, CAST(count_if(gone) AS BIGINT) AS n_removed, CAST(count_if(starts) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept_sha256
FROM (SELECT doc_id FROM documents) LEFT JOIN runs USING (doc_id) GROUP BY doc_id"""


def contaminated(window: int, share: int) -> str:
    """Windows of items and of documents as joined words, by each window length."""
    folded = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
    words = f"regexp_extract_all({folded}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
WITH dw AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM (
    SELECT doc_id, {words} AS words FROM documents)),
it AS (
  SELECT item_id, words, least({window}, len(words)) AS size FROM (
    SELECT item_id, {words} AS words FROM benchmark) WHERE len(words) > 0),
win AS (
  SELECT DISTINCT item_id, size, array_to_string(words[a:a + size - 1], ' ') AS gram
  FROM (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS a FROM it)),
sizes AS (SELECT DISTINCT size FROM win),
wide AS (
  SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS words FROM dw),
hits AS (
  SELECT doc_id, i, size, item_id FROM (
    SELECT doc_id, i, size, array_to_string(words[1:size], ' ') AS gram FROM wide, sizes WHERE len(words) >= size) g
  JOIN win USING (size, gram)),
covered AS (
  SELECT doc_id, CAST(count(DISTINCT place) AS BIGINT) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id),
sized AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words FROM dw GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= coalesce(n_words, 0) AS contaminated
FROM (SELECT doc_id FROM documents) LEFT JOIN sized USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


def repeated_words(window: int) -> str:
    """Words in rows; a window is its words joined, and goes if it is not its first."""
    return f"""
WITH dw AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS size FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents)),
win AS (
  SELECT doc_id, i, md5(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)) AS gram, i + {window - 1} <= size AS whole FROM dw),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS place FROM win WHERE whole) WHERE place > 1),
marked AS (
  SELECT doc_id, i, word, max(later.i) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM dw LEFT JOIN later USING (doc_id, i)),
runs AS (
  SELECT doc_id, min(i) - 1 AS first, max(i) AS last FROM (
    SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked WHERE gone) GROUP BY doc_id, run),
spans AS (SELECT doc_id, string_agg(first || ':' || last, ',' ORDER BY first) AS spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(count(word) AS BIGINT) AS n_words, CAST(count_if(gone) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256,
  coalesce(any_value(spans), '') AS spans
FROM (SELECT doc_id FROM documents) LEFT JOIN marked USING (doc_id) LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""
