"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from .queries import SHARDS
from .sharding import BUCKETS, Tree, _weight, grown

TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

CHAT = """
WITH t AS (SELECT conv_id, count(*) AS n_turns,
                  list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
           FROM conversations GROUP BY conv_id),
f AS (SELECT min(conv_id) AS conv_id, n_turns, turns, count(*) AS n_snapshots FROM t GROUP BY n_turns, turns),
p AS (SELECT DISTINCT turns[1:i] AS prefix FROM (SELECT turns, unnest(range(1, n_turns)) AS i FROM f))
SELECT conv_id, n_turns, n_snapshots,
       array_to_string(list_transform(turns, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)), '') AS chat
FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.prefix = f.turns)
"""

URL = """
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, CASE
  WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
  WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
  WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
  WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
  WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule FROM b)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM c
"""


def _hash52(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


def _choose(names: list[str], weights: list[float], then: list[str]) -> str:
    """The entry of ``then`` whose child draws most."""
    if len(then) == 1:
        return then[0]
    draws = [f"ln(({_hash52(f"k || '|{n}'")} + 0.5) / {float(1 << 52)!r}) / {float(w)!r}" for n, w in zip(names, weights, strict=True)]
    best = f"greatest({', '.join(draws)})"
    return "CASE " + " ".join(f"WHEN {d} = {best} THEN {t}" for d, t in zip(draws[:-1], then[:-1], strict=True)) + f" ELSE {then[-1]} END"


def _tree_sql(tree: Tree) -> str:
    region = _choose(list(tree), [_weight(x) for x in tree.values()], [
        _choose(list(racks), [_weight(x) for x in racks.values()], [
            _choose([f"shard{s}" for s in shards], list(shards.values()), [str(s) for s in shards])
            for shards in racks.values()])
        for racks in tree.values()])
    return f"({region})::INTEGER"


#: CRC-32 of a byte string in SQL: one table step for each byte.
CRC32 = """
WITH RECURSIVE bit(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS crc FROM bit WHERE k = 8)
"""

SHARD = CRC32 + f""",
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
e AS (SELECT doc_id, k, length(h) // 2 + 1 AS size,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                             lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
      FROM d, tab),
s AS (SELECT *, {_tree_sql(SHARDS)} AS shard, {_tree_sql(grown(SHARDS))} AS grown_shard, {_hash52("'slot|' || k")} % {BUCKETS} AS bucket FROM e)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM s
"""

_SPACE = r"[\x20\x09-\x0D]+"

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
r(doc_id, near) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.near)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, d.component_id
FROM (SELECT doc_id, min(near) AS component_id FROM r GROUP BY doc_id) d LEFT JOIN n USING (doc_id)
"""

SUBSTRING = rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
m AS (SELECT h, min(doc_id) AS least FROM s GROUP BY h),
g AS (SELECT DISTINCT s.doc_id, s.i + k.k AS i FROM s JOIN m ON s.h = m.h AND s.doc_id > m.least, range(50) k(k)),
t AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
k AS (SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS kept, count(*) AS n FROM t ANTI JOIN g ON t.doc_id = g.doc_id AND t.i = g.i
      GROUP BY t.doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

_TERMS = "list_filter(regexp_extract_all({t}, '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '')"
_FOLDED = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(t=_FOLDED.format(t="text"))} AS ts FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, {_TERMS.format(t=_FOLDED.format(t="text"))} AS ts FROM benchmark),
s AS (SELECT count(*) AS nd, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, nd),
x AS (SELECT r, doc_id, 100 - 75 + (75 * len(ts) * nd) // l AS m FROM d, s),
q AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(ts) AS term FROM b) GROUP BY ALL),
c AS (SELECT q.q, q.item_id, x.r, x.doc_id, sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * x.m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN x ON x.r = p.r GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM c WHERE score > 0 QUALIFY rank <= 10
"""

ORACLES = {"op13_search": SEARCH, "op1_topk": TOPK, "op4_jaccard_join": JACCARD, "op6_substring_dedup": SUBSTRING, "op5_chat": CHAT, "op8_url_filters": URL, "op9_shards": SHARD}
