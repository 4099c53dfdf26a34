"""The same queries in DuckDB SQL, written apart from the Spark expressions.

Shared with the package are only fixed values: patterns' character classes, the phonetic rules
and the inline themes.
"""

from __future__ import annotations

from contract.fixtures import PRIORITIES, THEMES
from filing_signals import fixed
from filing_signals.functions.phonetic import RULES

WS = f"[{fixed.WHITE_SPACE}]"


def lit(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def clean(x: str) -> str:
    junk = f"regexp_replace(coalesce({x}, ''), {lit('[^' + fixed.KEPT + fixed.WHITE_SPACE + ']')}, ' ', 'g')"
    return f"trim(regexp_replace({junk}, '{WS}+', ' ', 'g'))"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def share(x: str, char_class: str) -> str:
    dense = f"regexp_replace({x}, '{WS}', '', 'g')"
    hits = f"len(regexp_extract_all({dense}, {lit(char_class)}))"
    return f"CASE WHEN length({dense}) = 0 THEN 1.0::DOUBLE ELSE {hits}::DOUBLE / length({dense})::DOUBLE END"


def pieces(source: str, key: str, text: str, keep: str) -> str:
    """(doc_id, sentence_id, text) of the cleaned pieces for which `keep` holds, in text order."""
    parts = (
        f"list_filter(list_transform(list_filter(list_transform("
        f"regexp_split_to_array({text}, '[.!?;]+|\\n+'), lambda p: {collapse('p')}), lambda p: p <> ''), "
        f"lambda p: {clean('p')}), lambda p: {keep})"
    )
    return (
        f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS sentence_id, parts[i] AS text FROM ("
        f"SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM ("
        f"SELECT CAST({key} AS VARCHAR) AS doc_id, {parts} AS parts FROM {source}))"
    )


def extract(min_len: int) -> str:
    return pieces("documents", "doc_id", "text", f"length(p) >= {min_len}")


SENTS = f"sents AS MATERIALIZED ({extract(20)})"
DOCS = """docs AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, source AS company_id, upper(source) AS ticker,
  CAST(doc_id AS VARCHAR) AS cik, lang AS source_type,
  DATE '2024-01-01' + CAST(doc_id % 7 AS INTEGER) AS date,
  'filings/' || source || '/' || doc_id AS file_path FROM documents)"""
LABELLED = "labelled AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, quality FROM labels)"

HTML = "regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g')"
for _tag in ("script", "style", "noscript"):
    HTML = f"regexp_replace({HTML}, '(?is)<{_tag}\\b[^>]*>.*?</{_tag}\\s*>', ' ', 'g')"
HTML = f"regexp_replace({HTML}, '<[^>]*>', ' ', 'g')"
for _name, _char in (
    ("&copy", "©"), ("&middot", "·"), ("&quot", '"'), ("&lt", "<"), ("&gt", ">"), ("&amp", "&"),
):
    HTML = f"regexp_replace({HTML}, '{_name};?', '{_char}', 'g')"
HTML = collapse(HTML)

STRAY = f"""{SENTS}, {LABELLED}, stray AS MATERIALIZED (
  SELECT * FROM sents
  UNION ALL SELECT * FROM sents WHERE doc_id IN (SELECT doc_id FROM labelled)
  UNION ALL SELECT 'DOC_ID', NULL, 'text' FROM labelled
  UNION ALL SELECT doc_id, NULL, NULL FROM labelled
  UNION ALL SELECT doc_id, NULL, 'a sentence without number in ' || doc_id FROM labelled),
usable AS (SELECT * FROM stray WHERE doc_id IS NOT NULL AND text IS NOT NULL AND lower(doc_id) <> 'doc_id'),
dist AS (SELECT DISTINCT * FROM usable)"""

NUMBERED = """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id
  ORDER BY sentence_id ASC NULLS LAST, md5(text), text) - 1 AS INTEGER) AS sentence_id, text"""


def first_texts(source: str) -> str:
    return (
        f"SELECT doc_id, sentence_id, text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, text "
        f"ORDER BY sentence_id ASC NULLS LAST) AS place FROM {source}) WHERE place = 1"
    )


def chain(digit: float) -> str:
    return f"""{STRAY},
cleaned AS (SELECT doc_id, sentence_id, {clean('text')} AS text FROM dist),
ratios AS MATERIALIZED (SELECT * FROM cleaned WHERE length(text) > 0
  AND {share('text', '[^A-Za-z0-9,.]')} <= 0.7 AND {share('text', '[0-9]')} <= {digit}),
trimmed AS MATERIALIZED (SELECT * FROM ratios WHERE length(text)
  BETWEEN (SELECT quantile_cont(length(text), 0.01) FROM ratios)
  AND (SELECT quantile_cont(length(text), 0.99) FROM ratios)),
firsts AS ({first_texts('trimmed')})"""


FILINGS = """filings AS (SELECT o_custkey AS cik_num, o_orderpriority AS form,
  strftime(o_orderdate, '%Y-%m-%d') AS "filingDate",
  format('{:010d}-{:02d}', o_orderkey, o_orderkey % 100) AS "accessionNumber",
  'doc' || o_orderkey || '.htm' AS "primaryDocument" FROM orders)"""


def latest(forms: list[str]) -> str:
    wanted = ", ".join(lit(f) for f in forms)
    return (
        f"SELECT cik_num, form, \"filingDate\", \"accessionNumber\", \"primaryDocument\" FROM (SELECT *, "
        f"row_number() OVER (PARTITION BY cik_num, form ORDER BY \"filingDate\" DESC, \"accessionNumber\" DESC) "
        f"AS place FROM filings WHERE form IN ({wanted})) WHERE place = 1"
    )


MAPPED = """listing AS (SELECT CAST(s_suppkey AS INTEGER) AS position,
  replace(replace(s_name, '#', '.'), '.', '-') AS ticker, s_name AS name FROM supplier),
tmap AS (SELECT replace(s_name, '#', '-') AS ticker, s_suppkey AS cik_num FROM supplier WHERE s_acctbal > 0
  UNION ALL SELECT replace(s_name, '#', '-'), s_suppkey + 1000000 FROM supplier WHERE s_acctbal > 5000),
mapped AS (SELECT position, listing.ticker, name, cik_num FROM listing LEFT JOIN tmap ON listing.ticker = tmap.ticker)"""

# Themes with keyword text, and per keyword text the positions of each letter as bits.
_ROWS = ", ".join(f"({lit(i)}, {lit(t)}, {lit(k)})" for i, t, k in THEMES)
_KW = (
    "array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce(keywords, ''), '[,;|]'), "
    "lambda k: trim(k)), lambda k: k <> ''), ' ')"
)
THEME = f"""themes AS MATERIALIZED (SELECT *, trim(theme || ' ' || kw_text) AS theme_text FROM (
  SELECT theme_id, theme, keywords, {_KW} AS kw_text FROM (VALUES {_ROWS}) v(theme_id, theme, keywords)))"""


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


CODE = "token"
for _p, _r in RULES:
    CODE = f"regexp_replace({CODE}, {lit(_p)}, {lit(_r)}, 'g')"


def masks(x: str) -> str:
    """Map from each letter of a string of at most 60 letters to its positions as bits."""
    bits = (
        f"CAST(list_sum(list_transform(range(length({x})), lambda i: "
        f"CASE WHEN {x}[i + 1] = c THEN 1::BIGINT << i ELSE 0 END)) AS BIGINT)"
    )
    return (
        f"map_from_entries(list_transform(list_distinct(string_split({x}, '')), "
        f"lambda c: struct_pack(k := c, v := {bits})))"
    )


def ratio(long: str, short: str, mask: str) -> str:
    """2 * LCS / total length; `short` has at most 60 letters."""
    full = f"((1::BIGINT << length({short})) - 1)"
    steps = f"list_transform(string_split({long}, ''), lambda c: coalesce({mask}[c], 0))"
    row = (
        f"list_reduce(list_prepend({full}, {steps}), "
        f"lambda v, k: ((v + (v & k)) | (v - (v & k))) & {full})"
    )
    lcs = f"(length({short}) - bit_count({row}))"
    return f"2.0::DOUBLE * {lcs} / (length({long}) + length({short}))"


CODES = f"""{THEME},
said AS MATERIALIZED (SELECT doc_id, sentence_id, {words('lower(text)')} AS words FROM sents
  UNION ALL SELECT 'theme', -1 - CAST(substr(theme_id, 2) AS INTEGER), {words('lower(kw_text)')} FROM themes),
spoken AS MATERIALIZED (SELECT doc_id, sentence_id, i, words[i] AS token FROM (
  SELECT doc_id, sentence_id, words, unnest(range(1, len(words) + 1)) AS i FROM said)),
vocabulary AS MATERIALIZED (SELECT token, {CODE} AS code FROM (SELECT DISTINCT token FROM spoken)),
codes AS MATERIALIZED (SELECT doc_id, sentence_id, trim(string_agg(code, ' ' ORDER BY i), ' ') AS code
  FROM spoken JOIN vocabulary USING (token) GROUP BY doc_id, sentence_id),
theme_codes AS MATERIALIZED (SELECT *, {masks('kw_code')} AS bits FROM (
  SELECT themes.*, coalesce(code, '') AS kw_code FROM themes LEFT JOIN codes
  ON codes.doc_id = 'theme' AND codes.sentence_id = -1 - CAST(substr(theme_id, 2) AS INTEGER)))"""

# Term counts: dot product through a join on tokens, lengths from the counts.
TERMS = f"""terms AS MATERIALIZED (SELECT doc_id, sentence_id, token, count(*) AS n FROM spoken
  WHERE doc_id <> 'theme' GROUP BY ALL),
term_norms AS (SELECT doc_id, sentence_id, sqrt(sum(n * n)::DOUBLE) AS norm FROM terms GROUP BY ALL),
theme_terms AS (SELECT theme_id, token, count(*) AS n FROM (
  SELECT theme_id, unnest({words('lower(theme_text)')}) AS token FROM themes) GROUP BY ALL),
theme_norms AS (SELECT theme_id, sqrt(sum(n * n)::DOUBLE) AS norm FROM theme_terms GROUP BY ALL),
dots AS (SELECT doc_id, sentence_id, theme_id, sum(t.n * h.n)::DOUBLE AS dot
  FROM terms t JOIN theme_terms h USING (token) GROUP BY ALL)"""

PAIRS = f"""{SENTS}, {CODES}, {TERMS},
pairs AS MATERIALIZED (SELECT s.doc_id, s.sentence_id, t.theme_id,
  coalesce(d.dot / (a.norm * b.norm), 0.0::DOUBLE) AS semantic_sim,
  CASE WHEN coalesce(c.code, '') = '' OR t.kw_code = '' THEN 0.0::DOUBLE
    ELSE {ratio('c.code', 't.kw_code', 't.bits')} END AS phonetic_sim
  FROM sents s CROSS JOIN theme_codes t
  LEFT JOIN codes c ON c.doc_id = s.doc_id AND c.sentence_id = s.sentence_id
  LEFT JOIN dots d ON d.doc_id = s.doc_id AND d.sentence_id = s.sentence_id AND d.theme_id = t.theme_id
  LEFT JOIN term_norms a ON a.doc_id = s.doc_id AND a.sentence_id = s.sentence_id
  LEFT JOIN theme_norms b ON b.theme_id = t.theme_id)"""

TONES = """tones AS (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
  CASE l.quality WHEN 1 THEN 0.9::DOUBLE WHEN 0 THEN -0.8::DOUBLE ELSE 0.0::DOUBLE END AS signed,
  CASE l.quality WHEN 1 THEN 0.9::DOUBLE WHEN 0 THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END AS confidence
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def score_rows(name: str, alpha: float, beta: float, where: str = "TRUE") -> str:
    return f"""{name} AS MATERIALIZED (SELECT *, greatest(-100.0::DOUBLE, least(100.0::DOUBLE,
    100.0::DOUBLE * raw_base * time_weight)) AS final_score_100, raw_base AS theme_score FROM (
  SELECT p.doc_id, p.sentence_id, d.company_id, p.theme_id, p.semantic_sim, p.phonetic_sim,
    trunc(signed)::DOUBLE AS polarity, confidence, {alpha}::DOUBLE AS alpha, {beta}::DOUBLE AS beta,
    ({alpha}::DOUBLE * p.semantic_sim + {beta}::DOUBLE * p.phonetic_sim)
      * CASE WHEN signed >= 0 THEN 1 ELSE -1 END AS raw_base,
    CASE WHEN d.date = (SELECT max(date) FROM docs) THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END AS time_weight
  FROM pairs p JOIN docs d USING (doc_id) JOIN tones USING (doc_id) WHERE {where}))"""


SCORED = f"{PAIRS}, {DOCS}, {TONES}, {score_rows('scored', 0.8, 0.2)}"
ROLLUP = """rollup_rows AS MATERIALIZED (SELECT company_id, theme_id, avg(theme_score) AS avg_score,
  CAST(count(*) AS INTEGER) AS n_sentences, avg(final_score_100) AS avg_final_100 FROM {0} GROUP BY ALL)"""
COMPANIES = f"{SCORED}, {ROLLUP.format('scored')}"
STORED = f"""{SCORED}, {LABELLED},
{score_rows('again', 0.5, 0.5, 'doc_id IN (SELECT doc_id FROM labelled)')},
stored AS MATERIALIZED (SELECT * FROM again UNION ALL SELECT * FROM scored s WHERE NOT EXISTS (
  SELECT 1 FROM again a WHERE a.doc_id = s.doc_id AND a.sentence_id = s.sentence_id AND a.theme_id = s.theme_id))"""

MEASURES = (
    "semantic_sim phonetic_sim polarity confidence alpha beta raw_base time_weight final_score_100 theme_score"
).split()


def score_columns(source: str) -> str:
    measures = ", ".join(f"round({m}, 6) AS {m}" for m in MEASURES)
    return f"SELECT doc_id, sentence_id, company_id, theme_id, {measures} FROM {source}"


COMPANY_COLUMNS = """SELECT company_id, theme_id, round(avg_score, 6) AS avg_score, n_sentences,
  round(avg_final_100, 6) AS avg_final_100 FROM rollup_rows"""

TOP_THEMES = """best AS (SELECT * FROM (SELECT c.*, theme, row_number() OVER (PARTITION BY company_id
  ORDER BY avg_final_100 DESC NULLS FIRST, theme_id) AS rank FROM rollup_rows c JOIN themes USING (theme_id))
  WHERE rank <= 3)"""
TOP_EVIDENCE = """evidence AS (SELECT * FROM (SELECT company_id, theme_id, row_number() OVER (
    PARTITION BY company_id, theme_id ORDER BY final_score_100 DESC NULLS FIRST, doc_id, sentence_id) AS rank,
    doc_id, sentence_id, s.text, final_score_100 FROM scored JOIN sents s USING (doc_id, sentence_id))
  WHERE rank <= 5)"""

_CENTROIDS = """means AS (SELECT label, i, round(avg(x::DOUBLE), 6) AS x FROM (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM embeddings) GROUP BY ALL),
centroids AS (SELECT 'L' || label AS theme_id, list(x ORDER BY i) AS vector FROM means GROUP BY label)"""

_ORDER_INDEX = """idx AS (SELECT o_custkey AS cik_num, o_orderkey AS k, o_orderpriority AS p, o_orderstatus AS s,
  o_orderdate AS d,
  o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AS corrupt FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW'))"""

_FORMS = "CASE form " + " ".join(f"WHEN {lit(f)} THEN {i}" for i, f in enumerate(PRIORITIES)) + " END"

ORACLE: dict[str, str] = {
    "sentences_extract": extract(20),
    "sentences_extract_all": pieces("documents", "doc_id", "text", "TRUE"),
    "html_text": f"SELECT page_id, {HTML} AS text FROM pages",
    "html_entities": "SELECT page_id, "
    + HTML.replace(
        "regexp_replace(html,",
        "regexp_replace(replace(html, '</p>', chr(39) || 'AB' || chr(160) || 'x·</p>'),",
        1,
    )
    + " AS text FROM pages",
    "html_sentences": pieces(f"(SELECT page_id, {HTML} AS text FROM pages)", "page_id", "text", "length(p) >= 20"),
    "text_ratios": f"""SELECT conv_id, turn, CAST(length({clean('text')}) AS INTEGER) AS clean_length,
  round({share('text', fixed.DIGIT)}, 6) AS digit_share,
  round({share('text', '[^A-Za-z0-9,.]')}, 6) AS symbol_share FROM conversations""",
    "clean_dedupe_exact": f"WITH {STRAY} SELECT * FROM dist",
    "clean_ratio_filters": f"""WITH both_kinds AS (
  SELECT 'c' || conv_id AS doc_id, CAST(turn AS INTEGER) AS sentence_id, text FROM conversations
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 0, text FROM documents),
measured AS (SELECT doc_id, sentence_id, {clean('text')} AS text,
  {share('text', '[^A-Za-z0-9,.]')} AS symbols FROM both_kinds)
SELECT doc_id, sentence_id, text FROM measured
WHERE length(text) > 0 AND symbols <= 0.05 AND {share('text', '[0-9]')} <= 0.02""",
    "clean_length_bounds": f"""WITH {SENTS} SELECT round(quantile_cont(length(text), 0.01), 6) AS low,
  round(quantile_cont(length(text), 0.99), 6) AS high FROM sents""",
    "clean_length_trim": f"""WITH {SENTS} SELECT * FROM sents WHERE length(text)
  BETWEEN (SELECT quantile_cont(length(text), 0.01) FROM sents)
  AND (SELECT quantile_cont(length(text), 0.99) FROM sents)""",
    "clean_dedupe_first": f"WITH {SENTS} {first_texts('sents')}",
    "clean_renumber": f"WITH {STRAY}, firsts AS ({first_texts('usable')}) {NUMBERED} FROM firsts",
    "clean_full": f"WITH {chain(0.7)} {NUMBERED} FROM firsts",
    "clean_full_strict": f"WITH {chain(0.05)} {NUMBERED} FROM firsts",
    "clean_keep_copies": f"WITH {chain(0.7)} {NUMBERED} FROM trimmed",
    "stage_counts": f"""WITH {chain(0.05)} SELECT '1 read' AS stage, count(*) AS n FROM stray
  UNION ALL SELECT '2 usable', count(*) FROM usable UNION ALL SELECT '3 distinct', count(*) FROM dist
  UNION ALL SELECT '4 ratios', count(*) FROM ratios UNION ALL SELECT '5 trimmed', count(*) FROM trimmed
  UNION ALL SELECT '6 first', count(*) FROM firsts""",
    "companies_mapped": f"WITH {MAPPED} SELECT position, ticker, name, cik_num FROM mapped",
    "companies_valid": f"""WITH {MAPPED} SELECT ticker, name, lpad(CAST(cik_num AS VARCHAR), 10, '0') AS cik10
  FROM mapped WHERE ticker <> '' AND cik_num IS NOT NULL""",
    "filing_index_rows": f"""WITH {_ORDER_INDEX} SELECT cik_num, p AS form, strftime(d, '%Y-%m-%d') AS "filingDate",
  CAST(k AS VARCHAR) AS "accessionNumber", k || '.htm' AS "primaryDocument" FROM idx WHERE s <> 'P' AND NOT corrupt
  UNION ALL SELECT cik_num, s, strftime(d + INTERVAL 30 DAY, '%Y-%m-%d'), k || '-2', k || '-2.htm'
  FROM idx WHERE s <> 'P' AND NOT corrupt""",
    "filing_index_rejects": f"WITH {_ORDER_INDEX} SELECT cik_num, count(*) AS n_rejects FROM idx WHERE s = 'P' OR corrupt GROUP BY ALL",
    "ticker_map_rows": """SELECT c_name AS ticker, c_custkey AS cik_num FROM customer
  UNION ALL SELECT c_name || '-B', c_custkey FROM customer""",
    "latest_filing": f"WITH {FILINGS} {latest(PRIORITIES)}",
    "latest_filing_two_forms": f"WITH {FILINGS} {latest(['1-URGENT', '5-LOW'])}",
    "manifest_ids": f"""WITH {FILINGS}, latest AS ({latest(PRIORITIES)}), numbered AS (
  SELECT *, replace(c_name, '#', '-') AS ticker,
    row_number() OVER (ORDER BY c_custkey, {_FORMS}) AS k
  FROM customer JOIN latest ON c_custkey = cik_num)
SELECT 'D' || CASE WHEN k < 1000 THEN lpad(CAST(k AS VARCHAR), 3, '0') ELSE CAST(k AS VARCHAR) END AS doc_id,
  CAST(cik_num AS VARCHAR) AS company_id, ticker, CAST(cik_num AS VARCHAR) AS cik, form AS source_type,
  CAST("filingDate" AS DATE) AS date,
  'data/filings/' || ticker || '/' || form || '/' || replace("accessionNumber", '-', '') || '/' || "primaryDocument"
    AS file_path FROM numbered""",
    "manifest_keys": f"""WITH {FILINGS}, latest AS ({latest(PRIORITIES)}) SELECT CAST(cik_num AS VARCHAR) AS cik,
  form AS source_type, lpad(CAST(cik_num AS VARCHAR), 10, '0') || '/' || replace("accessionNumber", '-', '') || '/'
  || "primaryDocument" AS filing_key FROM customer JOIN latest ON c_custkey = cik_num""",
    "filing_names": f"""WITH {FILINGS} SELECT "accessionNumber" AS accession,
  lpad(CAST(cik_num AS VARCHAR), 10, '0') AS cik10,
  '{fixed.ARCHIVE_ROOT}/' || cik_num || '/' || replace("accessionNumber", '-', '') || '/' || "primaryDocument" AS url,
  'base/TICK/' || form || '/' || replace("accessionNumber", '-', '') || '/' || "primaryDocument" AS path,
  replace("accessionNumber", '-', '') AS path_accession, "primaryDocument" AS path_file FROM filings""",
    "first_documents": f"WITH {DOCS} SELECT company_id, doc_id, source_type FROM docs ORDER BY company_id, doc_id LIMIT 100",
    "csv_roundtrip": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, length(text) AS sentence_id, text FROM documents",
    "landed_files": f"SELECT 'p' || page_id AS doc_id, {HTML} AS text FROM pages",
    "missing_files": "SELECT 'd' || doc_id AS doc_id FROM documents",
    "upsert_documents": f"""WITH {DOCS}, {LABELLED}, incoming AS (
  SELECT doc_id, company_id, ticker, cik, 'quality ' || quality AS source_type, date, file_path
  FROM docs JOIN labelled USING (doc_id)
  UNION ALL SELECT 'B' || item_id, 'benchmark', NULL, NULL, 'item', NULL, 'B' || item_id FROM benchmark)
SELECT * FROM incoming UNION ALL SELECT * FROM docs d WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.doc_id = d.doc_id)""",
    "upsert_sentences": f"""WITH {SENTS}, incoming AS ({extract(60)})
SELECT * FROM incoming UNION ALL SELECT * FROM sents s WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.doc_id = s.doc_id AND i.sentence_id = s.sentence_id)""",
    "upsert_sentences_replaced": f"""WITH {SENTS}, incoming AS ({extract(60)})
SELECT * FROM incoming UNION ALL SELECT * FROM sents s WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.doc_id = s.doc_id)""",
    "upsert_scores": f"WITH {STORED} {score_columns('stored')}",
    "upsert_company": f"WITH {STORED}, {ROLLUP.format('stored')} {COMPANY_COLUMNS}",
    "constraint_report": f"""WITH {STRAY} SELECT 'sentences' AS relation, rule, violations FROM (
  SELECT 'key:doc_id,sentence_id' AS rule, count(*) AS violations FROM (
    SELECT 1 FROM stray GROUP BY doc_id, sentence_id HAVING count(*) > 1)
  UNION ALL SELECT 'not_null:doc_id', count(*) FILTER (WHERE doc_id IS NULL) FROM stray
  UNION ALL SELECT 'not_null:sentence_id', count(*) FILTER (WHERE sentence_id IS NULL) FROM stray
  UNION ALL SELECT 'not_null:text', count(*) FILTER (WHERE text IS NULL) FROM stray
  UNION ALL SELECT 'reference:doc_id', count(*) FROM stray WHERE doc_id NOT IN (SELECT doc_id FROM labelled))""",
    "cascade_delete": f"WITH {SENTS}, {LABELLED} SELECT * FROM sents WHERE doc_id NOT IN (SELECT doc_id FROM labelled)",
    "sentence_document_join": f"""WITH {SENTS}, {DOCS} SELECT doc_id, sentence_id, text, company_id, date
  FROM sents JOIN docs USING (doc_id)""",
    "newest_date": f"WITH {DOCS} SELECT max(date) AS newest FROM docs",
    "time_weight": f"""WITH {DOCS} SELECT doc_id, date, CASE WHEN date = (SELECT max(date) FROM docs)
  THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END AS time_weight FROM docs""",
    "semantic_cosine": f"""WITH {_CENTROIDS} SELECT vec_id, theme_id, round(greatest(0.0::DOUBLE,
  list_cosine_similarity(embedding::DOUBLE[], vector)), 6) AS semantic_sim FROM embeddings CROSS JOIN centroids""",
    "semantic_cosine_shuffled": f"""WITH {_CENTROIDS} SELECT vec_id, theme_id, CASE WHEN vec_id % 7 = 0 THEN 0.0::DOUBLE
  ELSE round(greatest(0.0::DOUBLE, list_cosine_similarity(embedding::DOUBLE[], vector)), 6) END AS semantic_sim
  FROM embeddings CROSS JOIN centroids""",
    "vector_normalise": """SELECT vec_id, CAST(i AS INTEGER) AS i, round(x / norm, 6) AS x FROM (
  SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS x,
    sqrt(list_sum(list_transform(embedding, lambda e: e::DOUBLE * e::DOUBLE))) AS norm FROM embeddings)""",
    "semantic_terms": f"WITH {PAIRS} SELECT doc_id, sentence_id, theme_id, round(semantic_sim, 6) AS semantic_sim FROM pairs",
    "polarity_labels": f"""WITH {TONES} SELECT doc_id, signed AS signed_confidence, trunc(signed)::DOUBLE AS polarity
  FROM tones""",
    "indel_ratio": f"""WITH {SENTS}, {THEME}, kw AS (SELECT theme_id, kw_text, {masks('kw_text')} AS bits FROM themes)
SELECT doc_id, sentence_id, theme_id, round({ratio('lower(text)', 'kw_text', 'bits')}, 6) AS ratio
FROM sents CROSS JOIN kw""",
    "metaphone_vocabulary": f"""WITH {SENTS} SELECT token, {CODE} AS code FROM (
  SELECT DISTINCT unnest({words('lower(text)')}) AS token FROM sents)""",
    "phonetic_similarity": f"WITH {PAIRS} SELECT doc_id, sentence_id, theme_id, round(phonetic_sim, 6) AS phonetic_sim FROM pairs",
    "sentence_theme_scores": f"WITH {SCORED} {score_columns('scored')}",
    "sentence_theme_scores_shuffled": f"WITH {SCORED} {score_columns('scored')}",
    "dry_run_scores": f"WITH {SCORED} {score_columns('scored')}",
    "company_theme_scores": f"WITH {COMPANIES} {COMPANY_COLUMNS}",
    "report_counts": f"WITH {SENTS} SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT count(*) FROM sents) AS n_sents",
    "scores_page": f"""WITH {SENTS}, {DOCS} SELECT doc_id, sentence_id, text, company_id, date
  FROM sents JOIN docs USING (doc_id) ORDER BY doc_id, sentence_id LIMIT 1000 OFFSET 4500""",
    "scores_page_deep": f"""WITH {SENTS}, {DOCS} SELECT doc_id, sentence_id, text, company_id, date
  FROM sents JOIN docs USING (doc_id) ORDER BY doc_id, sentence_id LIMIT 1000 OFFSET 4500""",
    "top_themes": f"""WITH {COMPANIES}, {TOP_THEMES} SELECT company_id, CAST(rank AS INTEGER) AS rank, theme_id, theme,
  round(avg_final_100, 6) AS avg_final_100, n_sentences FROM best""",
    "top_themes_of_company": f"""WITH {COMPANIES} SELECT theme_id, theme, round(avg_final_100, 6) AS avg_final_100, n_sentences
  FROM rollup_rows JOIN themes USING (theme_id) WHERE company_id = 'src3'
  ORDER BY rollup_rows.avg_final_100 DESC NULLS FIRST, theme_id LIMIT 10""",
    "top_evidence": f"""WITH {SCORED}, {TOP_EVIDENCE} SELECT company_id, theme_id, CAST(rank AS INTEGER) AS rank, doc_id,
  sentence_id, text, round(final_score_100, 6) AS final_score_100 FROM evidence""",
    "top_evidence_of_pair": f"""WITH {SCORED} SELECT doc_id, sentence_id, s.text, round(final_score_100, 6) AS final_score_100
  FROM scored JOIN sents s USING (doc_id, sentence_id) WHERE company_id = 'src3' AND theme_id = 'T1'
  ORDER BY scored.final_score_100 DESC NULLS FIRST, doc_id, sentence_id LIMIT 20""",
    "evidence_report": f"""WITH {COMPANIES}, {TOP_THEMES}, {TOP_EVIDENCE}, lists AS (
  SELECT company_id, theme_id, string_agg(text, ' | ' ORDER BY rank) AS evidence,
    CAST(count(*) AS INTEGER) AS n_evidence FROM evidence GROUP BY ALL)
SELECT company_id, theme_id, theme, CAST(rank AS INTEGER) AS rank, round(avg_final_100, 6) AS avg_final_100,
  n_sentences, n_evidence, evidence FROM best LEFT JOIN lists USING (company_id, theme_id)""",
}
