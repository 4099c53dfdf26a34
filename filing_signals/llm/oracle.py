"""DuckDB twins of this package's queries, where SQL can express them on whole tables."""

from __future__ import annotations

from filing_signals.llm import license_scan as L

ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(table: str) -> str:
    return f"""SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {table})"""


def _key(line: str) -> str:
    return f"translate(trim({line}, E' \\t\\n\\x0b\\x0c\\r'), '{_UPPER}', '{_LOWER}')"


ORACLE["op9_line_dedup"] = f"""
WITH keys AS (SELECT *, {_key("line")} AS key FROM ({_lines("documents")})),
common AS (
    SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
    SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS dropped
    FROM keys k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _stated(x: str) -> str:
    """Twin of `license_scan.STATED`, whose look-ahead is a second condition here."""
    has = lambda p: f"regexp_matches({x}, {_quoted(p)})"
    goes_on = rf"^copyright(\W*$|{L._GOES_ON})"
    others = r"^(copyright notice\W*$|\(c\)\s*(copyright|©|[<\[{]|[0-9]{4})|©|all rights reserved\W*$)"
    return f"(({has('^copyright' + chr(92) + 'b')} AND NOT {has(goes_on)}) OR {has(others)})"


def _canonical(text: str) -> str:
    """Twin of `license_scan.canonical`."""
    lines = f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: {_key('x')}), lambda x: NOT {_stated('x')})"
    c = f"' ' || trim(regexp_replace(array_to_string({lines}, chr(10)), {_quoted(L._OTHER_ASCII)}, ' ', 'g')) || ' '"
    for a, b in L.SPELLINGS.items():
        c = f"replace({c}, ' {a} ', ' {b} ')"
    return f"trim({c})"


def _known(texts: dict[str, list[str]]) -> str:
    rows = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, ts in texts.items() for t in ts)
    return f"SELECT DISTINCT license_id, sha256({_canonical('text')}) AS digest FROM (VALUES {rows}) AS t(license_id, text)"


ORACLE["op10_license_scan"] = f"""
WITH texts AS ({_known({k: [v] for k, v in L.TEXTS.items()})}),
notices AS ({_known(L.NOTICES)})
SELECT d.doc_id, 'text' AS scope, CAST(NULL AS INTEGER) AS line, k.license_id, k.digest
FROM (SELECT doc_id, sha256({_canonical("text")}) AS digest FROM documents WHERE text IS NOT NULL) d
JOIN texts k ON d.digest = k.digest
UNION ALL
SELECT d.doc_id, 'line', CAST(d.pos AS INTEGER), k.license_id, k.digest
FROM (SELECT doc_id, pos, sha256({_canonical("line")}) AS digest FROM ({_lines("documents")})) d
JOIN notices k ON d.digest = k.digest
"""


#: CRC-32 in SQL: the table of its 256 steps, and a fold of a word's UTF-8 bytes over it.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"""
_WORDS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE["op13_resampling"] = f"""
WITH words AS (
    SELECT doc_id, row, unnest(ws) AS word FROM (
        SELECT doc_id, row_number() OVER () AS row, {_WORDS} AS ws FROM documents)
),
targets AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
steps AS (SELECT {_CRC_TABLE} AS steps),
hashed AS (
    SELECT word, {_CRC} % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM (SELECT word FROM words UNION ALL SELECT word FROM targets)), steps
),
corpus AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM targets JOIN hashed USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM words) + 10000)
        / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM targets) + 10000)))) AS BIGINT) AS gain
    FROM corpus LEFT JOIN target USING (bucket)
),
weights AS (
    SELECT row, sum(gain)::BIGINT AS weight, count(*) AS n FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row
),
scored AS (
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT)
            + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM (SELECT doc_id, row_number() OVER () AS row FROM documents) d LEFT JOIN weights USING (row)
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    10 * count(*) FILTER (WHERE n_features >= 20) OVER () // 100 AS drawn FROM scored)
"""

ORACLE["op12_hard_negatives"] = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
        CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
