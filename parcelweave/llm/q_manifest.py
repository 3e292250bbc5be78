"""Query of the Merkle manifest."""

from __future__ import annotations

from parcelweave.llm.common import LOWER, UPPER, table
from parcelweave.llm.manifest import manifest

NAME = "op11_merkle_manifest"


def query(spark, folder):
    return manifest(table(spark, folder, "documents"))


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(parts)})"


def _runs(nodes: str) -> str:
    """What stands left and right of each node in its run of eight."""
    run = "OVER (PARTITION BY g, lvl, idx // 8 ORDER BY idx ROWS BETWEEN {})"
    return f"""SELECT g, lvl, idx, n, coalesce(string_agg(digest, '') {run.format('UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS l,
         coalesce(string_agg(digest, '') {run.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS r FROM {nodes}"""


def _climb(name: str, leaves: str) -> str:
    return f"""{name} AS (
  {leaves}
  UNION ALL
  SELECT g, lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 7) // 8 FROM {name} WHERE n > 1 GROUP BY g, lvl, idx // 8)"""


SQL = rf"""
WITH RECURSIVE
b AS (SELECT *, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT) AS codes FROM documents),
c AS (SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, codes), lambda c, x:
        list_reduce([xor(c, x), 0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT) AS crc FROM b),
d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf('text')} AS leaf,
        CASE WHEN crc % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM d),
{_climb('t', 'SELECT g, 0 AS lvl, idx, leaf AS digest, n FROM p')},
s AS (SELECT g AS name, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
{_climb('u', "SELECT '' AS g, 0 AS lvl, idx, subroot AS digest, n FROM s")},
root AS (SELECT digest AS root FROM u WHERE n = 1),
low AS ({_runs('t')}),
high AS ({_runs('u')}),
f AS (
  SELECT p.doc_id, p.g, 0 AS lvl, p.idx, coalesce(p.changed, p.leaf) AS cur, '' AS seen FROM p
  UNION ALL
  SELECT f.doc_id, f.g, f.lvl + 1, f.idx // 8, sha256(l || cur || r), seen || l || r FROM f JOIN low ON low.g = f.g AND low.lvl = f.lvl AND low.idx = f.idx WHERE low.n > 1),
top AS (
  SELECT f.doc_id, f.g, 0 AS lvl, s.idx, cur, seen FROM f JOIN t ON t.g = f.g AND t.lvl = f.lvl AND t.n = 1 JOIN s ON s.name = f.g
  UNION ALL
  SELECT top.doc_id, top.g, top.lvl + 1, top.idx // 8, sha256(l || cur || r), seen || l || r FROM top JOIN high ON high.lvl = top.lvl AND high.idx = top.idx WHERE high.n > 1)
SELECT top.doc_id, p.leaf, s.subroot, root.root, sha256(top.seen) AS proof_sha256, top.cur AS folded_root, top.cur = root.root AS verified
FROM top JOIN u ON u.lvl = top.lvl AND u.n = 1 JOIN p ON p.doc_id = top.doc_id AND p.g = top.g JOIN s ON s.name = top.g CROSS JOIN root
"""
