"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

_W = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, coalesce('=' || source, 'null') AS host,
         regexp_extract_all(coalesce(text, ''), '{_W}') AS w
  FROM documents),
g AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS t
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS k FROM g) WHERE k > 1),
rep AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup)
  GROUP BY rid),
l AS (
  SELECT rid, host, body, line, regexp_extract_all(line, '{_W}') AS lw
  FROM (SELECT rid, host, body, unnest(string_split(body, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_W}')),
n AS (SELECT rid, host, body, line, len(lw) AS k, lower(array_to_string(lw, ' ')) AS norm FROM l),
hosts AS (SELECT host, count(DISTINCT body) AS nd FROM d GROUP BY host),
freq AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT body) AS c FROM n GROUP BY host, norm) JOIN hosts USING (host)
         WHERE c >= 20 AND c >= nd * 0.05e0),
gone AS (SELECT rid, sum(k) AS n FROM n SEMI JOIN freq USING (host, norm) GROUP BY rid),
dl AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM n GROUP BY rid),
s AS (
  SELECT d.rid, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dl.n, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS removed_words
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN dl USING (rid) LEFT JOIN gone USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - removed_words >= n_words * 0.3e0 AS kept, removed_words
FROM b
"""

OP9 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS t
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT *, least(10, len(w)) AS m FROM b WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT m FROM p),
g AS (SELECT rid, m, i, array_to_string(w[i:i + m - 1], ' ') AS t
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT g.rid, g.i, g.m, p.item_id FROM g JOIN p ON g.m = p.m AND g.t = p.t),
cov AS (SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(range(i, i + m)) AS pos FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
  sha256(coalesce(its.l, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""


def _crc_table() -> list[int]:
    """CRC-32 by bytes, from its polynomial."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        out.append(byte)
    return out


def _feistel(source: str, x: str, rounds: int = 4, seed: int = 17) -> str:
    """rn and its number after one pass through the rounds; ``source`` has rn, x, a and b."""
    draw = lambda half, r: f"CAST('0x' || substr(md5('{seed}:{r}:' || {half}), 1, 8) AS BIGINT)"
    sql = f"SELECT rn, a, b, n, {x} // b AS l, {x} % b AS r FROM {source}"
    for k in range(rounds):
        left, right = (f"(l + {draw('r', k)}) % a", "r") if k % 2 == 0 else ("l", f"(r + {draw('l', k)}) % b")
        sql = f"SELECT rn, a, b, n, {left} AS l, {right} AS r FROM ({sql})"
    return f"SELECT rn, a, b, n, l * b + r AS y FROM ({sql})"


OP2 = rf"""
WITH RECURSIVE size AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (SELECT n, greatest(1, CAST(floor(sqrt(n)) AS BIGINT)) AS a FROM (SELECT count(*) AS n FROM documents))),
crc AS (SELECT {_crc_table()} AS t),
raw AS (SELECT doc_id, encode(coalesce(text, '')) AS bytes FROM documents),
d AS (SELECT doc_id, CAST(octet_length(bytes) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(bytes), '..'), lambda h: CAST('0x' || h AS BIGINT))), lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM raw, crc),
k AS (SELECT *, row_number() OVER (ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || size || ':' || text_crc32)) - 1 AS rn FROM d),
start AS (SELECT rn, rn AS x, a, b, n FROM k, size),
walk AS (SELECT * FROM ({_feistel('start', 'x')}) UNION ALL SELECT * FROM ({_feistel('(SELECT rn, a, b, n, y AS x FROM walk WHERE y >= n)', 'x')}))
SELECT doc_id, k.size, text_crc32, 'rows' AS law, CAST(y % 8 AS INT) AS shard, y // 8 AS slot, CAST(NULL AS INT) AS grown_shard, rn AS row_number
FROM k JOIN walk USING (rn) WHERE y < n
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_W}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS node, doc_id AS r FROM d UNION SELECT node, b FROM reach JOIN sym ON r = a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT node, min(r) AS component_id FROM reach GROUP BY node) ON node = doc_id
"""

OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS m FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM d)),
again AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
marked AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM again),
run AS (SELECT doc_id, min(s) AS b, max(s) + 100 AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM marked) GROUP BY doc_id, g),
keep AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS b, b AS e FROM (SELECT doc_id, b, e FROM run UNION ALL SELECT doc_id, length(h) // 2, length(h) // 2 FROM d)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) AS k FROM keep JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS n, sum(e - b) AS size FROM run GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone.size, 0)::BIGINT AS n_removed, coalesce(gone.n, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

ORACLES: dict[str, str] = {"op2_feistel_sharding": OP2, "op3_line_frequency_rules": OP3, "op5_signature_tree_join": OP5, "op8_deep_shallow_repeats": OP8, "op9_wu_manber_decontamination": OP9}
