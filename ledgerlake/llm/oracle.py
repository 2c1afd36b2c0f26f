"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

OP3 = f"""
WITH words AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR), NULL,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')
  FROM benchmark
), windows AS (
  SELECT DISTINCT id AS item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM words WHERE kind = 'b' AND len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), spots AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE kind = 'd' AND len(w) >= n)
), hits AS (SELECT doc_id, i, spots.n, item FROM spots JOIN windows USING (win) WHERE spots.n = windows.n
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) WHERE kind = 'd'
"""


HOST = "lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))"
OP6 = f"""
WITH hosts AS (SELECT page_id, url, page_id * 37 % 730 AS day, {HOST} AS host FROM pages
), asked AS (
  SELECT page_id, day, host, array_to_string(l[i:], '.') AS pattern
  FROM (SELECT *, unnest(range(1, greatest(len(l), 2))) AS i FROM (SELECT *, string_split(host, '.') AS l FROM hosts))
), named AS (
  SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 8) AS BIGINT) AS h
  FROM asked WHERE pattern <> ''
), listed AS (
  SELECT *, (['ads', 'malware', 'spam'])[h % 7 % 3 + 1] AS list, h % 500 AS first FROM named WHERE h % 3 <> 0
), entries AS (
  SELECT list, pattern, first AS day, 'add' AS action FROM listed
  UNION ALL SELECT list, pattern, first + 30 + h % 211, 'remove' FROM listed WHERE h % 2 = 0
  UNION ALL SELECT list, pattern, first + 90 + h % 307, 'add' FROM listed WHERE h % 4 = 0
), daily AS (SELECT list, pattern, day, max(action) AS action FROM entries GROUP BY ALL
), state AS (
  SELECT page_id, asked.pattern, list, arg_max(action, daily.day) AS action
  FROM asked JOIN daily ON asked.pattern = daily.pattern AND daily.day <= asked.day
  GROUP BY page_id, asked.pattern, list
), met AS (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         max(struct_pack(n := length(pattern), pattern := pattern)).pattern AS pattern
  FROM state WHERE action = 'add' GROUP BY page_id
)
SELECT page_id, url, day, host, coalesce(lists, '') AS lists, pattern, lists IS NOT NULL AS blocked
FROM hosts LEFT JOIN met USING (page_id)
"""

def _nibbles(polynomial: int = 0xEDB88320) -> str:
    """The table of the CRC-32 taken by half bytes: 16 numbers of 8 hex digits."""
    table = list(range(16))
    for _ in range(4):
        table = [(c >> 1) ^ (polynomial if c & 1 else 0) for c in table]
    return "".join(f"{c:08x}" for c in table)


def _network(x: str) -> str:
    """One pass through the six rounds, as nested SELECTs over (l, r)."""
    mix = "CAST('0x' || substr(md5(concat('20240501:', {i}, ':', {v})), 1, 15) AS BIGINT)"
    sql = f"SELECT row_number, w, a, b, n, {x} // b AS l, {x} % b AS r FROM walk WHERE w = 0 OR {x} >= n"
    for i in range(6):
        l_, r_ = (f"(l + {mix.format(i=i, v='r')} % a) % a", "r") if i % 2 == 0 else ("l", f"(r + {mix.format(i=i, v='l')} % b) % b")
        sql = f"SELECT row_number, w, a, b, n, {l_} AS l, {r_} AS r FROM ({sql})"
    return f"SELECT row_number, w + 1, l * b + r, a, b, n FROM ({sql})"


OP8 = f"""
WITH RECURSIVE halves AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents
), sized AS (
  SELECT doc_id, CAST(len(x) // 2 + 1 AS BIGINT) AS size,
         xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(len(x)), lambda i: CAST('0x' || substr(x, i + 2 - 2 * (i % 2), 1) AS BIGINT))),
           lambda s, d: xor(s >> 4, CAST('0x' || substr('{_nibbles()}', (xor(s, d) & 15) * 8 + 1, 8) AS BIGINT)))) AS text_crc32
  FROM halves
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, size, text_crc32) - 1 AS row_number, count(*) OVER () AS n FROM sized
), walk(row_number, w, p, a, b, n) AS (
  SELECT row_number, 0, row_number, a, (n + a - 1) // a, n
  FROM (SELECT row_number, n, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a FROM numbered)
  UNION ALL
  {_network('p')}
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % 8 AS INTEGER) AS shard, p // 8 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (row_number) WHERE w > 0 AND p < walk.n
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, half a byte at a time."""
    return f"""(SELECT xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(len(x)), lambda i: CAST('0x' || substr(x, i + 2 - 2 * (i % 2), 1) AS BIGINT))),
      lambda s, d: xor(s >> 4, CAST('0x' || substr('{_nibbles()}', (xor(s, d) & 15) * 8 + 1, 8) AS BIGINT))))
      FROM (SELECT lower(hex(encode({text}))) AS x))"""


def _value(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"


_OTHERS = " || ".join(map(_value, ("doc_id", "source", "lang", "n_chars")))
OP11 = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, sha256({_OTHERS} || {_value('text')}) AS leaf,
         CASE WHEN {_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} % 5 = 0
              THEN sha256({_OTHERS} || {_value(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS changed
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM hashed
), nodes(tree, level, place, n, digest) AS (
  SELECT tree, 0, place, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY tree, level, place // 16, n
), tops(level, place, n, digest) AS (
  SELECT 0, tree, (SELECT count(DISTINCT tree) FROM leaves), digest FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE n > 1 GROUP BY level, place // 16, n
), runs AS (
  SELECT tree, level, place // 16 AS run, list(digest ORDER BY place) AS ds FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, place // 16, list(digest ORDER BY place) FROM tops WHERE n > 1 GROUP BY ALL
), low(tree, place, level, spot, folded, proof) AS (
  SELECT tree, place, 0, place, coalesce(changed, leaf), '' FROM leaves
  UNION ALL
  SELECT low.tree, low.place, low.level + 1, spot // 16,
         sha256(array_to_string(ds[:spot % 16], '') || folded || array_to_string(ds[spot % 16 + 2:], '')),
         proof || array_to_string(ds[:spot % 16], '') || array_to_string(ds[spot % 16 + 2:], '')
  FROM low JOIN runs ON runs.tree = low.tree AND runs.level = low.level AND runs.run = spot // 16
), high(tree, place, level, spot, folded, proof) AS (
  SELECT tree, place, 0, tree, folded, proof
  FROM (SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level DESC) AS r FROM low) WHERE r = 1
  UNION ALL
  SELECT high.tree, high.place, high.level + 1, spot // 16,
         sha256(array_to_string(ds[:spot % 16], '') || folded || array_to_string(ds[spot % 16 + 2:], '')),
         proof || array_to_string(ds[:spot % 16], '') || array_to_string(ds[spot % 16 + 2:], '')
  FROM high JOIN runs ON runs.tree = -1 AND runs.level = high.level AND runs.run = spot // 16
), folds AS (
  SELECT tree, place, folded, proof
  FROM (SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level DESC) AS r FROM high) WHERE r = 1
)
SELECT doc_id, leaf, nodes.digest AS subroot, tops.digest AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = tops.digest AS verified
FROM leaves JOIN folds USING (tree, place) JOIN nodes ON nodes.tree = leaves.tree AND nodes.n = 1 JOIN tops ON tops.n = 1
"""


OP12 = f"""
WITH turns AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id AS c, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(bytes ORDER BY turn NULLS FIRST, k) AS bs,
         {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT own.c, list_concat(coalesce(base.ks, [])[:own.h], own.ks[own.h + 1:]) AS ks,
         list_concat(coalesce(base.bs, [])[:own.h], own.bs[own.h + 1:]) AS bs
  FROM own LEFT JOIN own AS base ON base.c = own.c - own.c % 5
), steps AS (
  SELECT c, d, sha256(array_to_string(ks[:d], '')) AS p, sha256(array_to_string(ks[:d - 1], '')) AS up,
         coalesce(bs[d], 0) AS bytes, d = len(ks) AS ended
  FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, d, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended) AS ends
  FROM steps GROUP BY p, d
), counted AS (
  SELECT nodes.*, coalesce(kids, 0) AS kids
  FROM nodes LEFT JOIN (SELECT up AS p, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY up) USING (p)
), below AS (
  SELECT DISTINCT a.p AS top, b.p AS p FROM steps AS a JOIN steps AS b ON a.c = b.c AND b.d >= a.d
), sums AS (
  SELECT top AS p, count(*) FILTER (kids = 0) AS leaves, sum((n - 1) * bytes) AS saved
  FROM below JOIN counted USING (p) GROUP BY top
)
SELECT t.c AS conv_id, CAST(t.d AS BIGINT) AS depth, parent.c AS parent_conv_id, t.n AS n_convs, t.kids AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(t.ends, '')) AS ends_sha256
FROM counted AS t JOIN sums USING (p) LEFT JOIN nodes AS parent ON t.d > 0 AND parent.p = t.up
"""


def queries() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op3_decontamination": OP3, "op6_url_lists": OP6, "op8_sharding": OP8,
            "op11_merkle": OP11, "op12_prefix_trie": OP12}
