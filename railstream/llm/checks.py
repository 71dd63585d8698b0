"""DuckDB SQL for the queries that SQL can express, over the table ``documents``.

Long, but only as text: each step is written for every level or step at hand.
"""

from __future__ import annotations

import string

from railstream.llm import merkle
from railstream.llm.merkle import ARITY

_WORD = r"[^\x20\x09-\x0D]+"


def checksum(column: str) -> str:
    """The unsigned CRC-32 of a whole number in decimal, eight steps for each digit."""
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split("
            f"CAST({column} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: {bits}), 4294967295)")


def manifest_sql(levels: int = 20) -> str:
    """DuckDB SQL for ``checked`` where every row whose id's checksum is even has lost its newlines,
    for trees of up to ``ARITY ** levels`` leaves."""
    def row(text: str) -> str:
        return "sha256(" + " || ".join(
            f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')"
            for f in (*merkle.FIELDS[:-1], text)) + ")"

    parts = [f"""docs AS MATERIALIZED (SELECT *, coalesce('=' || source, '') AS tree, {row("text")} AS leaf,
  CASE WHEN {checksum("doc_id")} % 2 = 0 THEN {row("replace(text, chr(10), '')")} END AS other FROM documents),
s0 AS MATERIALIZED (SELECT tree, doc_id, leaf AS h, coalesce(other, leaf) AS found,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM docs)"""]

    def climb(name: str) -> None:
        for k in range(levels):
            parts.append(f"""{name}_runs{k} AS MATERIALIZED (
  SELECT tree, p // {ARITY} AS r, list(h ORDER BY p) AS hs,
    sum(count(*)) OVER (PARTITION BY tree) = 1 AS whole FROM {name}{k} GROUP BY tree, p // {ARITY}),
{name}{k + 1} AS MATERIALIZED (SELECT tree, r AS p,
  CASE WHEN whole THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_runs{k})""")

    def fold(start: str, source: str, name: str) -> str:
        last = start
        for k in range(levels):
            at = f"f.p % {ARITY}"
            parts.append(f"""{name}{k} AS MATERIALIZED (SELECT f.* REPLACE (f.p // {ARITY} AS p,
  CASE WHEN whole THEN sibs ELSE sibs || array_to_string(hs[1:{at}] || hs[{at} + 2:], '') END AS sibs,
  CASE WHEN whole THEN cur ELSE
    sha256(array_to_string(hs[1:{at}] || [cur] || hs[{at} + 2:], '')) END AS cur)
  FROM {last} f JOIN {source}_runs{k} n ON f.tree = n.tree AND f.p // {ARITY} = n.r)""")
            last = f"{name}{k}"
        return last

    climb("s")
    parts.append(f"""t0 AS MATERIALIZED (SELECT '' AS tree, tree AS source_tree, h,
  row_number() OVER (ORDER BY tree) - 1 AS p FROM s{levels})""")
    climb("t")
    parts.append("""first AS MATERIALIZED (SELECT tree, doc_id, h AS leaf, found AS cur, p, '' AS sibs FROM s0)""")
    below = fold("first", "s", "f")
    parts.append(f"""second AS MATERIALIZED (SELECT f.* REPLACE ('' AS tree, t.p AS p), t.h AS subroot
  FROM {below} f JOIN t0 t ON f.tree = t.source_tree)""")
    above = fold("second", "t", "g")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root.h AS root, sha256(sibs) AS proof_sha256, cur AS folded_root,
  cur = root.h AS verified FROM {above}, (SELECT h FROM t{levels}) root"""


def jaccard_sql(words: int = 4, percent: int = 85) -> str:
    """Documents that share enough of their word shingles, and what follows from that."""
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce({lower}, ''), '{_WORD}') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))
  END)) AS shingles FROM words),
kinds AS MATERIALIZED (SELECT min(doc_id) AS id, shingles FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
single AS MATERIALIZED (SELECT id, len(shingles) AS n, unnest(shingles) AS shingle FROM kinds),
links AS MATERIALIZED (SELECT a.id AS x, b.id AS y FROM single a JOIN single b
  ON a.shingle = b.shingle AND a.id < b.id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT id AS x, id AS y FROM kinds UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id
FROM sets s LEFT JOIN kinds k ON s.shingles = k.shingles AND len(s.shingles) > 0
LEFT JOIN (SELECT x, min(y) AS component FROM reach GROUP BY x) c ON k.id = c.x"""


def periods_sql(least: int = 6, copies: int = 4) -> str:
    """Periodic runs of words: matches of equal words at equal distance, joined where they adjoin."""
    return f"""WITH split AS MATERIALIZED (SELECT doc_id, {checksum("doc_id")} AS h,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
planned AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM split),
docs AS MATERIALIZED (SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE w[1:a] || list_transform(
    range(0, n - a), lambda i: w[a + 1 + i % (1 + (n - a) // (3 + (h // 10) % 8))]) END AS w FROM planned),
places AS MATERIALIZED (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM docs),
matches AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM places a JOIN places b
  ON a.doc_id = b.doc_id AND a.word = b.word AND a.i < b.i AND {copies} * (b.i - a.i) <= a.n),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches),
spans AS MATERIALIZED (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM numbered
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest({least}, {copies} * q)),
runs AS MATERIALIZED (SELECT * FROM spans s WHERE NOT EXISTS (SELECT 1 FROM spans p
  WHERE p.doc_id = s.doc_id AND p.q < s.q AND s.q % p.q = 0 AND p.start <= s.start
    AND p.start + p.length >= s.start + s.length)),
summed AS (SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines,
    min(struct_pack(l := -length, s := start, q := q)) AS best FROM runs GROUP BY doc_id),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM places w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.q
    AND w.i < r.start + r.length) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.q AS period,
  1000 * -best.l // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(rest, '')) AS collapsed_sha256
FROM docs d LEFT JOIN summed s ON d.doc_id = s.doc_id LEFT JOIN left_over l ON d.doc_id = l.doc_id"""
