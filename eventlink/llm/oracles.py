"""Registered queries of this package in SQL, by brute force over the views of the tables."""

from __future__ import annotations

from eventlink.llm.licenses import BASE, SHARE, TEMPLATES
from eventlink.llm.secrets import BASE_RULES, RULES

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"list_filter(regexp_split_to_array({LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
DOC = f"doc AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents)"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    """Places of the matches of each rule: the texts between them and the matches, laid end to end."""
    parts = []
    for k, rule in enumerate(RULES):
        # a run has to be cut into whole runs before its length is judged
        pattern = _quoted(rule.pattern.replace("{16,}", "+").replace("(?i:", "(?i)(?:"))
        value = _quoted(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?")
        counted = f"length(regexp_replace(m, {value}, ''))" if rule.value_only else "length(m)"
        parts.append(
            f"""SELECT rid, {k} AS k, {_quoted(rule.kind)} AS kind, s, s + length(m) AS e FROM (
              SELECT rid, m, unnest_at, list_sum(list_transform(gaps[:unnest_at], lambda x: length(x)))
                + coalesce(list_sum(list_transform(found[:unnest_at - 1], lambda x: length(x))), 0) AS s
              FROM (SELECT rid, gaps, found, unnest(found) AS m, generate_subscripts(found, 1) AS unnest_at FROM (
                SELECT rid, regexp_split_to_array(text, {pattern}) AS gaps, regexp_extract_all(text, {pattern}, 0) AS found
                FROM doc))) WHERE {counted} >= {rule.least}"""
        )
    base = ", ".join(_quoted(r.kind) for r in BASE_RULES)
    line = "string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k)"
    counts = ", ".join(f"count(*) FILTER (kind = {_quoted(r.kind)}) AS n_{r.kind}" for r in BASE_RULES)
    return f"""
    WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    span AS ({" UNION ALL ".join(parts)}),
    per AS (SELECT rid, {counts}, {line} FILTER (kind IN ({base})) AS base, {line} AS spans FROM span GROUP BY rid)
    SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM doc LEFT JOIN per USING (rid)"""


NEAR_DUPLICATES = f"""
    WITH RECURSIVE {DOC},
    gram AS (
      SELECT rid, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g FROM (
        SELECT rid, w, least(len(w), 5) AS n, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS s FROM doc WHERE len(w) > 0)),
    unit AS (SELECT rid, g, row_number() OVER (PARTITION BY rid, g) AS nth FROM gram),
    size AS (SELECT rid, count(*) AS n FROM unit GROUP BY rid),
    pair AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM unit a JOIN unit b USING (g, nth) WHERE a.rid < b.rid GROUP BY ALL),
    link AS (
      SELECT x, y FROM pair JOIN size a ON a.rid = x JOIN size b ON b.rid = y WHERE c >= 0.8 * (a.n + b.n - c)),
    way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
    reach(rid, root) AS (SELECT rid, rid FROM doc UNION SELECT way.y, reach.root FROM reach JOIN way ON way.x = reach.rid)
    SELECT d.doc_id, min(t.doc_id) AS class_id FROM reach JOIN doc d USING (rid) JOIN doc t ON t.rid = reach.root
    GROUP BY d.rid, d.doc_id"""


def _licenses() -> str:
    rows = ", ".join(
        f"({k}, {_quoted(t.label)}, string_split({_quoted(t.text)}, ' '), string_split({_quoted(t.key)}, ' '), {t in BASE})"
        for k, t in enumerate([*BASE, *TEMPLATES])
    )
    return f"""
    WITH {DOC},
    t(k, label, words, key, base) AS (VALUES {rows}),
    seen AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT rid, unnest(w) AS word FROM doc) GROUP BY word),
    tw AS (
      SELECT k, base, j, word, ln(1 + ((SELECT count(*) FROM doc) + 1) / (coalesce(n, 0) + 0.5)) AS idf
      FROM (SELECT k, base, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS j FROM t) LEFT JOIN seen USING (word)),
    hit AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM doc),
    cand AS (SELECT DISTINCT rid, k, i - j AS s FROM hit JOIN tw USING (word)),
    shared AS (
      SELECT rid, cand.k, s, sum(CASE WHEN s + j >= 0 AND w[s + j + 1] = word THEN idf ELSE 0 END) / sum(idf) AS share
      FROM cand JOIN tw ON tw.k = cand.k JOIN doc USING (rid) GROUP BY ALL),
    place AS (
      SELECT rid, label, s, base, CASE WHEN base THEN 1.0 ELSE least(share, 1.0) END AS share
      FROM shared JOIN t USING (k) JOIN doc USING (rid)
      WHERE (base AND s >= 0 AND w[s + 1:s + len(words)] = words) OR (NOT base AND share >= {SHARE} AND len(list_filter(
        range(greatest(s, 0), greatest(s, 0) + len(words) - len(key) + 1), lambda p: w[p + 1:p + len(key)] = key)) > 0)),
    per AS (
      SELECT rid, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share
      FROM place GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
      CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
      CAST(round(coalesce(share, 0), 6) AS DOUBLE) AS score
    FROM doc LEFT JOIN per USING (rid)"""


#: Every 400-byte string of every text by a 64-bit hash; what is left is put together in hexadecimal.
REPEATS = """
    WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
    place AS (SELECT rid, b, unnest(range(1, greatest(octet_length(b) - 398, 1))) AS i FROM doc),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY h) AS k FROM (
      SELECT rid, i, hash(b[i:i + 399]) AS h FROM place)) WHERE k > 1),
    run AS (
      SELECT rid, min(i) AS a, max(i) + 400 AS z FROM (
        SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS r FROM (
          SELECT rid, i, CASE WHEN i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 400 THEN 1 ELSE 0 END AS fresh FROM twice))
      GROUP BY rid, r),
    piece AS (
      SELECT rid, a, z, substr(hex(b), 2 * lag(z, 1, 1) OVER (PARTITION BY rid ORDER BY a) - 1,
        2 * (a - lag(z, 1, 1) OVER (PARTITION BY rid ORDER BY a))) AS kept
      FROM run JOIN doc USING (rid)),
    cut AS (
      SELECT rid, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(z) AS z, string_agg(kept, '' ORDER BY a) AS kept
      FROM piece GROUP BY rid)
    SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
      sha256(CASE WHEN z IS NULL THEN b ELSE unhex(kept || substr(hex(b), 2 * z - 1)) END) AS kept_sha256
    FROM doc LEFT JOIN cut USING (rid)"""

SECRETS = _secrets()
LICENSES = _licenses()
