"""The registered queries in SQL (DuckDB), where SQL can express them."""

from __future__ import annotations

from spanloom.llm import codes, secret_scan

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORDS = (
    rf"list_filter(string_split_regex({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {ITEM_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {ITEM_WORDS} AS w FROM benchmark),
iw AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
       FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, w[p:p + n - 1] AS words FROM iw),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
       FROM d, (SELECT DISTINCT n FROM win)),
hit AS (SELECT dw.doc_id, dw.p, dw.n, win.item FROM dw JOIN win ON dw.n = win.n AND dw.w[dw.p:dw.p + dw.n - 1] = win.words),
pos AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM hit),
cov AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def _mix() -> str:
    rounds, last = [], "r0"
    for k in (1, 2, 3):
        rounds.append(f"""
c{k} AS (SELECT *, sum(size) OVER (PARTITION BY s ORDER BY u ROWS UNBOUNDED PRECEDING) AS upto
         FROM {last} WHERE NOT extra AND size > 0 AND size <= gap),
t{k} AS (SELECT doc_id, s, size FROM c{k} WHERE upto <= gap),
r{k} AS (SELECT r.doc_id, r.s, r.size, r.source_size, r.target, r.passes, r.u,
                r.extra OR t.doc_id IS NOT NULL AS extra, r.gap - coalesce(g.used, 0) AS gap
         FROM {last} r LEFT JOIN t{k} t USING (doc_id)
         LEFT JOIN (SELECT s, sum(size) AS used FROM t{k} GROUP BY s) g ON g.s = r.s)""")
        last = f"r{k}"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, chr(1114111)) AS s, md5('7:' || doc_id || ':1') AS u,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
p AS (SELECT s, sum(size) AS source_size, row_number() OVER (ORDER BY s) - 1 AS i FROM d GROUP BY s),
w AS (SELECT *, CAST([5, 2, 1][CAST(i % 3 AS INTEGER) + 1] AS DOUBLE) AS weight,
             CAST(source_size AS DOUBLE) * 3 AS cap FROM p),
l AS (SELECT *, row_number() OVER (ORDER BY cap / weight, i) AS k,
             ((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER (
                ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
f AS (SELECT min(k) AS k, arg_min(level, k) AS level FROM l WHERE level * weight <= cap),
t AS (SELECT l.s, l.source_size,
             CASE WHEN l.k < f.k THEN l.cap ELSE least(l.cap, f.level * l.weight) END AS target FROM l, f),
r0 AS (SELECT d.*, t.source_size, t.target, false AS extra,
              CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes,
              target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END) * source_size AS gap
       FROM d JOIN t USING (s)),{",".join(rounds)}
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (passes + CAST(extra AS INTEGER)) AS BIGINT) AS taken
FROM r3
"""


def _merkle() -> str:
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    # CRC-32 bit by bit: a byte is mixed in, then eight shifts.
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""

    def tree(name: str, leaves: str) -> str:
        return f"""
{name} AS (
  SELECT 0 AS lvl, g, pos, n, h FROM {leaves}
  UNION ALL
  SELECT lvl + 1, g, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY lvl, g, pos // 3),
{name}_runs AS (SELECT lvl, g, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM {name} WHERE n > 1 GROUP BY ALL)"""

    def walk(name: str, runs: str, start: str) -> str:
        left, right = "array_to_string(hs[:pos % 3], '')", "array_to_string(hs[pos % 3 + 2:], '')"
        return f"""
{name} AS (
  SELECT rid, 0 AS lvl, g, pos, n, folded, proof FROM {start}
  UNION ALL
  SELECT rid, w.lvl + 1, w.g, pos // 3, (n + 2) // 3, sha256({left} || folded || {right}), proof || {left} || {right}
  FROM {name} w JOIN {runs} r ON r.lvl = w.lvl AND r.g = w.g AND r.run = w.pos // 3 WHERE n > 1)"""

    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, sha256({head} || {field("text")}) AS h,
         CASE WHEN ({crc}) % 2 = 0 THEN sha256({head} || {field("replace(text, chr(10), '')")})
              ELSE sha256({head} || {field("text")}) END AS got FROM documents),
l AS (SELECT *, row_number() OVER () AS rid, count(*) OVER (PARTITION BY g) AS n,
             row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d),
{tree("t", "l")},
s AS (SELECT t.g AS name, '' AS g, h, count(*) OVER () AS n, row_number() OVER (ORDER BY t.g) - 1 AS pos FROM t WHERE n = 1),
{tree("u", "s")},
{walk("w", "t_runs", "(SELECT rid, g, pos, n, got AS folded, '' AS proof FROM l)")},
{walk("v", "u_runs", "(SELECT rid, s.g, s.pos, s.n, folded, proof FROM w JOIN s ON s.name = w.g WHERE w.n = 1)")}
SELECT doc_id, l.h AS leaf, s.h AS subroot, u.h AS root, sha256(v.proof) AS proof_sha256, v.folded AS folded_root,
       v.folded = u.h AS verified
FROM l JOIN s ON s.name = l.g JOIN v ON v.rid = l.rid AND v.n = 1, (SELECT h FROM u WHERE n = 1) u
"""


def _secrets() -> str:
    def quoted(rule: str) -> str:
        # Groups without numbers.
        return rule.replace("(", "(?:").replace("'", "''")

    kinds = []
    for k, r in enumerate(secret_scan.RULES):
        whole = f"'{quoted(r.head + r.value)}'"
        kinds.append(f"""
SELECT rid, {k} AS k, '{r.kind}' AS kind, m[i] AS hit, list_sum(list_transform(gaps[:i], lambda x: length(x)))
       + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS lo,
       length(m[i]) - length(regexp_extract(m[i], '^(?:{quoted(r.head)})')) AS value
FROM (SELECT rid, m, string_split_regex(text, {whole}) AS gaps, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT *, regexp_extract_all(text, {whole}) AS m FROM d))
WHERE value >= {r.least}""")
    base = ", ".join(f"'{r.kind}'" for r in secret_scan.BASE)
    counts = "".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}, " for r in secret_scan.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
f AS (SELECT *, kind || ':' || CAST(lo AS BIGINT) || ':' || CAST(lo + length(hit) AS BIGINT) AS span
      FROM ({" UNION ALL ".join(kinds)}))
SELECT doc_id, {counts}
       sha256(coalesce(string_agg(span, ',' ORDER BY lo, k) FILTER (WHERE kind IN ({base})), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY lo, k), '') AS spans
FROM d LEFT JOIN f USING (rid) GROUP BY rid, doc_id
"""


def _codes() -> str:
    """Rounds of assignment and re-centring one after the other; a nearest entry is the least of distance * 256 + index."""
    apart = "list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - e.x[i]) * (p.x[i] - e.x[i])))"

    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (SELECT r, part, x, m % 256 AS entry, m // 256 AS far FROM (
  SELECT r, p.part, any_value(p.x) AS x, min(CAST({apart} AS HUGEINT) * 256 + e.entry) AS m
  FROM p JOIN e{k} e ON e.part = p.part GROUP BY r, p.part))"""

    rounds = []
    for k in range(codes.ROUNDS):
        rounds.append(f"""{assigned(k)},
e{k + 1} AS MATERIALIZED (SELECT e.part, e.entry, coalesce(c.x, e.x) AS x FROM e{k} e LEFT JOIN (
  SELECT part, entry, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
    SELECT part, entry, i, sum(x[i]) AS s, count(*) AS n
    FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY part, entry, i) GROUP BY part, entry) c
  ON c.part = e.part AND c.entry = e.entry)""")
    last = codes.ROUNDS
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, w, row_number() OVER (ORDER BY vec_id NULLS LAST, w) - 1 AS r FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS w
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
p AS MATERIALIZED (SELECT r, part, w[part * (len(w) // {codes.PARTS}) + 1 : (part + 1) * (len(w) // {codes.PARTS})] AS x
                   FROM v, (SELECT unnest(range({codes.PARTS})) AS part)),
e0 AS MATERIALIZED (SELECT part, r AS entry, x FROM p WHERE r < {codes.ENTRIES}),{",".join(rounds)},{assigned(last)},
f AS (SELECT r, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
      FROM a{last} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM e{last}) AS codebooks_sha256
FROM v JOIN f USING (r)
"""


ORACLES = {
    "op3_decontaminate": DECONTAMINATE,
    "op10_mixing": _mix(),
    "op11_manifest": _merkle(),
    "op12_secrets": _secrets(),
    "op13_codes": _codes(),
}
