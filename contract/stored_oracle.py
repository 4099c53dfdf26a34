"""DuckDB twins of `stored_queries`: what the stored tables must hold, computed in one go."""

from __future__ import annotations

from contract.fixtures import PRIORITIES
from contract.oracle import (
    CODES,
    COMPANY_COLUMNS,
    DOCS,
    FILINGS,
    LABELLED,
    ORACLE,
    ROLLUP,
    SCORED,
    SENTS,
    STORED,
    chain,
    extract,
    latest,
    lit,
)
from contract.stored_queries import BUCKETS

LISTED = "listed AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS doc_id FROM benchmark)"
RELOADED = f"""{SENTS}, {LISTED}, incoming AS (SELECT * FROM ({extract(60)}) WHERE doc_id IN (SELECT doc_id FROM listed)),
reloaded AS (SELECT * FROM incoming UNION ALL SELECT * FROM sents WHERE doc_id NOT IN (SELECT doc_id FROM incoming))"""
BUCKET = f"CAST('0x' || substr(md5(doc_id), 1, 8) AS BIGINT) % {BUCKETS}"

_URGENT = ["1-URGENT", "5-LOW"]


def _keyed(forms: list[str]) -> str:
    place = "CASE form " + " ".join(f"WHEN {lit(f)} THEN {i + 1}" for i, f in enumerate(forms)) + " END"
    return f"""SELECT lpad(CAST(cik_num AS VARCHAR), 10, '0') || '/' || replace("accessionNumber", '-', '') || '/'
  || "primaryDocument" AS filing_key, cik_num * {len(forms)} + {place} AS place FROM ({latest(forms)})"""


_STRAY = chain(0.05)


def _marked(parents: str) -> str:
    return f"""{_STRAY}, marked AS (SELECT *, concat_ws(';',
  CASE WHEN count(*) OVER (PARTITION BY doc_id, sentence_id) > 1 THEN 'key:doc_id,sentence_id' END,
  CASE WHEN doc_id IS NULL THEN 'not_null:doc_id' END,
  CASE WHEN sentence_id IS NULL THEN 'not_null:sentence_id' END,
  CASE WHEN text IS NULL THEN 'not_null:text' END,
  CASE WHEN doc_id NOT IN (SELECT doc_id FROM {parents}) THEN 'reference:doc_id' END) AS broken FROM stray)"""



_HEX = " || ' ' || ".join(
    f"CAST(CAST(CAST('0x' || substr(md5(text), {2 * i + 1}, 2) AS INTEGER) / 4.0 AS DOUBLE) AS VARCHAR)" for i in range(8)
)

STORED_ORACLE: dict[str, str] = {
    "upsert_touched_buckets": f"WITH {RELOADED} SELECT * FROM reloaded",
    "upsert_rewritten_buckets": f"""WITH {RELOADED}, placed AS (SELECT CAST({BUCKET} AS INTEGER) AS bucket, doc_id FROM reloaded)
SELECT bucket, count(*) AS n_rows FROM placed
WHERE bucket IN (SELECT {BUCKET} FROM incoming) GROUP BY bucket""",
    "rollup_after_batches": f"WITH {STORED}, {ROLLUP.format('stored')} {COMPANY_COLUMNS}",
    "stage_counts_observed": ORACLE["stage_counts"],
    "clean_counted": ORACLE["clean_full_strict"],
    "copartitioned_scores": f"""WITH {SCORED} SELECT doc_id, sentence_id, theme_id, scored.company_id, s.text, d.date,
  round(final_score_100, 6) AS final_score_100 FROM scored JOIN sents s USING (doc_id, sentence_id) JOIN docs d USING (doc_id)""",
    "constraint_rejects": f"WITH {_marked('labelled')} SELECT * FROM marked WHERE broken <> ''",
    "constraint_accepted": f"WITH {DOCS}, {_marked('docs')} SELECT doc_id, sentence_id, text FROM marked WHERE broken = ''",
    "length_bounds_merged": ORACLE["clean_length_bounds"],
    "registry_second_run": f"""WITH {FILINGS}, one AS ({_keyed(_URGENT)}), two AS ({_keyed(PRIORITIES)}),
firsts AS (SELECT filing_key, row_number() OVER (ORDER BY place, md5(filing_key), filing_key) AS number FROM one),
seconds AS (SELECT filing_key, (SELECT max(number) FROM firsts) + row_number() OVER (ORDER BY place, md5(filing_key), filing_key) AS number
  FROM two WHERE filing_key NOT IN (SELECT filing_key FROM firsts)),
every AS (SELECT * FROM firsts UNION ALL SELECT * FROM seconds)
SELECT filing_key, number, 'D' || CASE WHEN number < 1000 THEN lpad(CAST(number AS VARCHAR), 3, '0') ELSE CAST(number AS VARCHAR) END AS doc_id
FROM two JOIN every USING (filing_key)""",
    "landed_changes": """SELECT 'd' || doc_id AS name, 'new' AS change FROM documents
UNION ALL SELECT 'p' || page_id, 'gone' FROM pages WHERE page_id IN (SELECT item_id FROM benchmark)
UNION ALL SELECT 'p' || page_id, 'changed' FROM pages
  WHERE page_id IN (SELECT doc_id FROM labels) AND page_id NOT IN (SELECT item_id FROM benchmark)""",
    "encoded_once": f"WITH {SENTS} SELECT doc_id, sentence_id, {_HEX} AS vector FROM sents",
    "tones_by_model": f"""WITH {SENTS}, toned AS (SELECT doc_id, sentence_id, CAST(
  CAST('0x' || substr(md5(text), 2, 1) AS INTEGER) / 16.0 * CASE CAST('0x' || substr(md5(text), 1, 1) AS INTEGER) % 3
    WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END AS DOUBLE) AS signed_confidence FROM sents)
SELECT *, trunc(signed_confidence)::DOUBLE AS polarity FROM toned""",
    "scores_page_after": f"""WITH {SENTS}, {DOCS} SELECT doc_id, sentence_id, text, company_id, date
FROM sents JOIN docs USING (doc_id) ORDER BY doc_id, sentence_id LIMIT 1000 OFFSET 2000""",
    "scores_after_key": f"""WITH {SENTS} SELECT * FROM sents WHERE (doc_id, sentence_id) > ('5', 3)
ORDER BY doc_id, sentence_id LIMIT 500""",
    "scores_of_pair_stored": f"""WITH {SCORED} SELECT doc_id, sentence_id, round(final_score_100, 6) AS final_score_100
FROM scored WHERE company_id = 'src3' AND theme_id = 'T1'""",
    "sentence_codes": f"""WITH {SENTS}, {CODES} SELECT doc_id, sentence_id, coalesce(code, '') AS code
FROM sents LEFT JOIN codes USING (doc_id, sentence_id)""",
    "inputs_missing_columns": """SELECT 'documents' AS "table", count(*) AS n_rows, '' AS missing FROM documents
UNION ALL SELECT 'conversations', count(*), 'doc_id' FROM conversations
UNION ALL SELECT 'labels', count(*), 'text' FROM labels""",
    "created_with_defaults": f"""WITH {SCORED} SELECT theme_id, count(*) AS n, 0.8::DOUBLE AS alpha, 0.2::DOUBLE AS beta,
count(*) AS n_stamped FROM scored GROUP BY theme_id""",
}
