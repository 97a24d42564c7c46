"""Manifest, fingerprints and trie as SQL for a second engine. Levels of the manifest are unrolled: 16 ** 7 rows of a source
at most."""

from __future__ import annotations

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_LEVELS = 7


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text: per byte one step that takes it in and eight that shift."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x::BIGINT) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, x: {step}), 4294967295::BIGINT)"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _tower(name: str, base: str) -> str:
    """{name}_n0..: grp, r, node, c of each level; {name}_r0..: the runs of 16; {name}_roots: grp, node."""
    parts = [f"{name}_n0 AS ({base})"]
    for i in range(_LEVELS):
        parts.append(f"{name}_r{i} AS (SELECT grp, r // 16 AS q, c, string_agg(node, '' ORDER BY r) AS run "
                     f"FROM {name}_n{i} WHERE c > 1 GROUP BY grp, r // 16, c)")
        parts.append(f"{name}_n{i + 1} AS (SELECT grp, q AS r, sha256(run) AS node, (c + 15) // 16 AS c FROM {name}_r{i})")
    roots = " UNION ALL ".join(f"SELECT grp, node FROM {name}_n{i} WHERE c = 1" for i in range(_LEVELS + 1))
    return ", ".join(parts) + f", {name}_roots AS ({roots})"


def _climb(name: str, start: str, keep: str) -> str:
    """{name}_up: ``start`` (grp, r, folded, proof and ``keep``) after all levels of the tower."""
    parts, last = [], start
    for i in range(_LEVELS):
        l, r = "coalesce(substr(run, 1, 64 * (d.r % 16)), '')", "coalesce(substr(run, 64 * (d.r % 16) + 65), '')"
        parts.append(
            f"{name}_d{i} AS (SELECT d.grp, d.r // 16 AS r, {keep}, proof || {l} || {r} AS proof, "
            f"CASE WHEN run IS NULL THEN folded ELSE sha256({l} || folded || {r}) END AS folded "
            f"FROM {last} d LEFT JOIN {name}_r{i} t ON d.grp IS NOT DISTINCT FROM t.grp AND d.r // 16 = t.q)")
        last = f"{name}_d{i}"
    return ", ".join(parts) + f", {name}_up AS (SELECT * FROM {last})"


MANIFEST_SQL = f"""
WITH leaves AS (
  SELECT doc_id, source AS grp, {_leaf('text')} AS node,
         CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0
              THEN {_leaf(f'translate(text, {_UPPER}, {_LOWER})')} ELSE {_leaf('text')} END AS shown
  FROM documents
), lined AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, node, shown) - 1 AS r,
         count(*) OVER (PARTITION BY grp) AS c FROM leaves
), {_tower('s', 'SELECT grp, r, node, c FROM lined')}, tops AS (
  SELECT 0 AS grp, grp AS source, node, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS r, count(*) OVER () AS c
  FROM s_roots
), {_tower('t', 'SELECT grp, r, node, c FROM tops')}, first AS (
  SELECT grp, r, doc_id, node AS leaf, '' AS proof, shown AS folded FROM lined
), {_climb('s', 'first', 'd.doc_id, d.leaf')}, second AS (
  SELECT t.grp, t.r, s.grp AS source, s.doc_id, s.leaf, s.proof, s.folded, t.node AS subroot
  FROM s_up s JOIN tops t ON s.grp IS NOT DISTINCT FROM t.source
), {_climb('t', 'second', 'd.source, d.doc_id, d.leaf, d.subroot')}
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = node AS verified
FROM t_up CROSS JOIN (SELECT node FROM t_roots)
"""

_TOLD = "sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"

TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, {_TOLD} AS told, length(coalesce(text, '')) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TOLD}) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS lender, {crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, pos, told, n FROM convs c JOIN turns t ON t.conv_id = c.lender AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, pos, told, n FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), path AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, n,
         sha256(string_agg(told, '') OVER (PARTITION BY conv_id ORDER BY part, pos)) AS node
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT node, depth, n, min(conv_id) AS conv_id, count(*) AS n_convs FROM path GROUP BY node, depth, n
), linked AS (
  SELECT x.*, p.node AS parent FROM nodes x LEFT JOIN path p ON p.conv_id = x.conv_id AND p.depth = x.depth - 1
), born AS (
  SELECT parent, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
  SELECT a.node, sum((x.n_convs - 1) * x.n) AS saved_tokens, count(*) FILTER (b.parent IS NULL) AS n_leaves
  FROM nodes x JOIN path a ON a.conv_id = x.conv_id AND a.depth <= x.depth LEFT JOIN born b ON b.parent = x.node
  GROUP BY a.node
), ends AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM path GROUP BY conv_id) GROUP BY node
)
SELECT x.conv_id, x.depth, o.conv_id AS parent_conv_id, x.n_convs, coalesce(b.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM linked x JOIN sums s ON s.node = x.node LEFT JOIN nodes o ON o.node = x.parent
LEFT JOIN born b ON b.parent = x.node LEFT JOIN ends e ON e.node = x.node
"""

_PHRASE = r"([^\n]{12,80}? +|\n)"


def _fingerprint(text: str) -> str:
    digests = f"list_transform(string_split({text}, chr(10)), lambda p: sha256(p))"
    grouped = f"array_to_string(list_transform({digests}, lambda d: d || CASE WHEN d < '4' THEN '/' ELSE '.' END), '')"
    runs = f"list_filter(string_split({grouped}, '/'), lambda s: s <> '')"
    sections = f"list_transform({runs}, lambda s: sha256(s))"
    inner = "list_transform(list_filter(string_split(s, '.'), lambda d: d <> ''), lambda d: substr(d, 1, 16))"
    phrases = f"string_split(regexp_replace({text}, '{_PHRASE}', '\\1' || chr(31), 'g'), chr(31))"
    names = f"list_sort(list_distinct(list_transform({phrases}, lambda p: substr(md5(p), 1, 6))))"
    return (f"sha256(array_to_string({sections}, '')) || '|' || "
            f"array_to_string(list_transform({sections}, lambda d: substr(d, 1, 16)), '.') || '|' || "
            f"array_to_string(list_transform({runs}, lambda s: array_to_string({inner}, '.')), '/') || '|' || "
            f"array_to_string({names}, '')")


def _likeness(a: str, b: str) -> str:
    left, right = (f"regexp_extract_all(string_split({x}, '|')[4], '.{{6}}')" for x in (a, b))
    return f"len(list_intersect({left}, {right})) * 2.0::DOUBLE / (len({left}) + len({right}))"


FINGERPRINT_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), lined AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id NULLS FIRST), first_value(text) OVER (ORDER BY doc_id NULLS FIRST)) AS next
  FROM texts
), edits AS (
  SELECT doc_id, n, text, next, substr(text, 1, n - n // 4) || substr(next, 1, n // 4) AS edited FROM lined
), prints AS (
  SELECT doc_id, n, edited, {_fingerprint('text')} AS p, {_fingerprint('edited')} AS e, {_fingerprint('next')} AS x FROM edits
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, p AS fingerprint, e AS edited_fingerprint,
       {_likeness('p', 'e')} AS near_edited, {_likeness('p', 'x')} AS near_next
FROM prints
"""
