"""DuckDB SQL of the queries that SQL can express.  The others hash with
XXH64, learn models or tokenize; they are tested against brute force."""
from __future__ import annotations

from . import sharding
from .decontam import LOWER, UPPER, WINDOW

PROBE = r"'\### Assistant: </turn> ok'"


def op1() -> str:
    order = "ORDER BY turn NULLS FIRST, role0 NULLS FIRST, text0 NULLS FIRST"
    role = "replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    text = r"regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g')"
    return f"""
WITH c AS (SELECT conv_id, turn, role AS role0, text AS text0, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {PROBE} UNION ALL SELECT -7, 1, 'assistant', {PROBE}))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
       CAST(COALESCE(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn ') + length({role}) + length('>') + length({text}) + length('</turn>') + 1) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id"""


def crc_table() -> str:
    """SQL for one row with the list ``t`` of the 256 CRC-32 table entries."""
    crc = "SELECT i, i AS x FROM range(256) t(i)"
    for _ in range(8):
        crc = f"SELECT i, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END AS x FROM ({crc})"
    return f"SELECT list(x ORDER BY i) AS t FROM ({crc})"


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, next to ``crc_table``."""
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode({text})), '..'),
            lambda h: ('0x' || h)::BIGINT)), lambda acc, byte: xor(t[(xor(acc, byte) & 255) + 1], acc >> 8)), 4294967295)"""


def op2(shards: int = 24, seed: int = 42) -> str:
    p = sharding.PRIME

    rounds = "SELECT id, x % a AS l, x // a AS r, a, b, n FROM w WHERE fresh OR x >= n"
    for i, k in enumerate(sharding.round_keys(seed)):
        side, to, size = ("r", "l", "a") if i % 2 == 0 else ("l", "r", "b")
        other = "r" if to == "l" else "l"
        rounds = (f"SELECT id, {other}, ({to} + xor(z, z >> 13)) % {size} AS {to}, a, b, n FROM ("
                  f"SELECT *, (xor(y, y >> 15) * 1812433253 + {k}) % {p} AS z FROM ("
                  f"SELECT *, ({side} + {k}) % {p} * 1103515245 % {p} AS y FROM ({rounds})))")
    return f"""
WITH RECURSIVE crc AS ({crc_table()}),
d AS (SELECT doc_id, octet_length(encode(COALESCE(text, ''))) + 8 AS size, {crc32("COALESCE(text, '')")} AS crc
      FROM documents, crc),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS id FROM d),
shape AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (
  SELECT count(*) AS n, greatest(CAST(floor(sqrt(count(*))) AS BIGINT), 1) AS a FROM documents)),
w AS (SELECT id, id AS x, a, b, n, TRUE AS fresh FROM numbered, shape
      UNION ALL SELECT id, r * a + l, a, b, n, FALSE FROM ({rounds}))
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law, CAST(x % {shards} AS INTEGER) AS shard,
       x // {shards} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN w USING (id) WHERE NOT fresh AND x < n"""


def op4() -> str:
    return """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
             max(page_id) OVER (PARTITION BY html) AS kept FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM q"""


def op6(window: int = WINDOW) -> str:
    words = f"regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH b AS (SELECT item_id, w, least(len(w), {window}) AS n FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, w[i:i + n - 1] AS gram FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
d AS (SELECT row_number() OVER () AS id, doc_id, {words} AS w FROM documents),
spots AS (SELECT id, i, n, w[i:i + n - 1] AS gram FROM (
  SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hits AS (SELECT id, i, s.n, item_id FROM spots s JOIN grams g ON s.n = g.n AND s.gram = g.gram),
covered AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY id)
SELECT doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (id) LEFT JOIN named USING (id)"""


def op10(threshold: float = 0.95) -> str:
    return f"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS id, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT id, vec_id, v FROM e WHERE len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND list_dot_product(v, v) > 0),
links AS (SELECT a.id AS a, b.id AS b FROM ok a JOIN ok b ON a.id <> b.id
          AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {threshold}),
reach AS (SELECT id AS a, id AS b FROM e UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, COALESCE(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM e JOIN (SELECT a, min(vec_id) AS component_id FROM reach JOIN e ON reach.b = e.id GROUP BY a) c ON e.id = c.a
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) k ON e.id = k.a"""


def op11() -> str:
    return """
WITH e AS (SELECT row_number() OVER () AS ref, vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.ref AS anchor, a.id AS anchor_id, a.label = b.label AS alike, b.ref, b.id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.id % 50 = 0 AND a.ref <> b.ref AND len(a.q) = len(b.q)),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM s WHERE alike QUALIFY place <= 5)
SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""


def op13() -> str:
    text = "COALESCE(role, '')", "COALESCE(text, '')"
    words = r"len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+'))"
    return f"""
WITH RECURSIVE crc AS ({crc_table()}),
c AS (SELECT CAST(conv_id AS BIGINT) AS c, list({{'r': {text[0]}, 'x': {text[1]}}}
    ORDER BY turn NULLS FIRST, sha256(length({text[0]}) || ':' || {text[0]} || {text[1]})) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, ts, {crc32("CAST(c AS VARCHAR)")} % 4 AS h FROM c, crc),
r AS (SELECT h.c, list_concat(COALESCE(b.ts[1:h.h], []), h.ts[h.h + 1:]) AS p FROM h LEFT JOIN c b ON b.c = h.c - h.c % 20),
m AS (SELECT c, d, p[1:d] AS k, len(p) = d AS ends FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(c) AS c, count(*) AS n, COALESCE(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS e
  FROM m GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, COALESCE(kids, 0) AS kids, CASE WHEN d > 0 THEN (n - 1) * {words.replace("k[d]", "n.k[d]")} ELSE 0 END AS own
  FROM n LEFT JOIN kids ON n.k = kids.k),
sums AS (SELECT a, count(*) FILTER (kids = 0) AS leaves, sum(own) AS saved FROM (
  SELECT k[1:i] AS a, kids, own FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM f)) GROUP BY a)
SELECT f.c AS conv_id, f.d AS depth, up.c AS parent_conv_id, f.n AS n_convs, f.kids AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(f.e) AS ends_sha256
FROM f JOIN sums ON sums.a = f.k LEFT JOIN f up ON f.d > 0 AND up.k = f.k[1:f.d - 1] AND up.d = f.d - 1"""


ORACLE = {"op1_chat_format": op1(), "op2_feistel_shards": op2(), "op4_warc_zstd": op4(), "op6_decontaminate": op6(),
          "op10_itq_near_duplicates": op10(), "op11_rtree_hard_negatives": op11(), "op13_prefix_trie": op13()}
