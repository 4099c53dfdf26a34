"""One Spark query per operator; each reads whole tables and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import fixtures as X
from filing_signals.functions import phonetic, scores, text, vectors
from filing_signals.operators import pairing, ranking, upsert
from filing_signals.plans import manifest as M
from filing_signals.plans import reports as R
from filing_signals.plans import scoring as C
from filing_signals.plans import sentences as S
from filing_signals.schemas import DOCUMENTS, SENTENCES, SENTENCES_CSV
from filing_signals.session import ship
from filing_signals.sources import landed
from filing_signals.sources.snapshots import SnapshotTable, staged, staging_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def rounded(name: str, c: Column | None = None) -> Column:
    return F.round(F.col(name) if c is None else c, 6).alias(name)


# -- extraction --------------------------------------------------------------------------------


@query
def sentences_extract(spark, sf):
    return X.sentences(spark, sf)


@query
def sentences_extract_all(spark, sf):
    """No minimum length: pieces that cleaning empties stay and are numbered."""
    return X.sentences(spark, sf, min_len=0)


@query
def html_text(spark, sf):
    pages = X.spread(X.table(spark, sf, "pages", "page_id", "html"), "page_id")
    return pages.select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query
def html_entities(spark, sf):
    """Pages with HTML 5 names, long numbers and names without ';' added to each paragraph."""
    pages = X.spread(X.table(spark, sf, "pages", "page_id", "html"), "page_id")
    more = F.replace(
        F.col("html"), F.lit("</p>"), F.lit("&apos;&#00000065;&#x000042;&nbspx&middot</p>")
    )
    return pages.select("page_id", text.html_to_text(more).alias("text"))


@query
def html_sentences(spark, sf):
    pages = X.spread(X.table(spark, sf, "pages", "page_id", "html"), "page_id")
    return S.extract_html(pages.select(F.col("page_id").cast("string").alias("doc_id"), "html"))


@query
def text_ratios(spark, sf):
    turns = X.table(spark, sf, "conversations", "conv_id", "turn", "text")
    t = F.col("text")
    return turns.select(
        "conv_id",
        "turn",
        F.length(text.clean_sentence(t)).alias("clean_length"),
        rounded("digit_share", text.digit_ratio(t)),
        rounded("symbol_share", text.symbol_ratio(t)),
    )


# -- cleaning ----------------------------------------------------------------------------------


def stray(spark, sf) -> DataFrame:
    """Extracted sentences with labelled documents' sentences repeated, and per label a header
    line, a row without text and a row without number."""
    s = X.sentences(spark, sf)
    labelled = X.table(spark, sf, "labels", "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id")
    )
    none = F.lit(None).cast("int").alias("sentence_id")
    return (
        s.unionByName(s.join(labelled, "doc_id", "left_semi"))
        .unionByName(labelled.select(F.lit("DOC_ID").alias("doc_id"), none, F.lit("text").alias("text")))
        .unionByName(labelled.select("doc_id", none, F.lit(None).cast("string").alias("text")))
        .unionByName(
            labelled.select(
                "doc_id", none, F.concat(F.lit("a sentence without number in "), "doc_id").alias("text")
            )
        )
    )


@query
def clean_dedupe_exact(spark, sf):
    return S.drop_exact_copies(S.usable(stray(spark, sf)))


@query
def clean_ratio_filters(spark, sf):
    """Conversation turns and whole documents with shares measured on the text as it came."""
    turns = X.table(spark, sf, "conversations", "conv_id", "turn", "text").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("doc_id"),
        F.col("turn").cast("int").alias("sentence_id"),
        "text",
    )
    docs = X.texts(spark, sf).select("doc_id", F.lit(0).alias("sentence_id"), "text")
    return S.ratio_filters(turns.unionByName(docs), 0.05, 0.02, symbol_on="raw")


@query
def clean_length_bounds(spark, sf):
    b = S.length_bounds(X.sentences(spark, sf))
    return b.select(
        F.round(F.col("bounds")[0], 6).alias("low"), F.round(F.col("bounds")[1], 6).alias("high")
    )


@query
def clean_length_trim(spark, sf):
    return S.trim_lengths(X.sentences(spark, sf))


@query
def clean_dedupe_first(spark, sf):
    return S.keep_first_texts(X.sentences(spark, sf))


@query
def clean_renumber(spark, sf):
    return S.renumber(S.keep_first_texts(S.usable(stray(spark, sf))))


@query
def clean_full(spark, sf):
    return S.clean(stray(spark, sf))


@query
def clean_full_strict(spark, sf):
    return S.clean(stray(spark, sf), digit_thresh=0.05)


@query
def clean_keep_copies(spark, sf):
    return S.clean(stray(spark, sf), keep_copies=True)


@query
def stage_counts(spark, sf):
    """Rows after each cleaning stage. What several stages start from is staged, so that it is made once."""
    raw = staged(stray(spark, sf))
    distinct = staged(S.drop_exact_copies(S.usable(raw)))
    kept = staged(S.ratio_filters(distinct, digit_thresh=0.05))
    trimmed = S.trim_lengths(kept)
    stages = {
        "1 read": raw,
        "2 usable": S.usable(raw),
        "3 distinct": distinct,
        "4 ratios": kept,
        "5 trimmed": trimmed,
        "6 first": S.keep_first_texts(trimmed),
    }
    out = None
    for name, df in stages.items():
        n = df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("n"))
        out = n if out is None else out.unionByName(n)
    return out


# -- manifest ----------------------------------------------------------------------------------


def supplier_companies(spark, sf) -> DataFrame:
    """Suppliers as the listing; those with a positive balance are in the ticker map, those above
    5,000 under a second CIK too."""
    raw = X.table(spark, sf, "supplier", "s_suppkey", "s_name", "s_acctbal")
    symbol = F.replace(F.col("s_name"), F.lit("#"), F.lit("."))
    listing = raw.select("s_suppkey", symbol.alias("Symbol"), F.col("s_name").alias("Security"))
    ticker = F.replace(F.col("s_name"), F.lit("#"), F.lit("-")).alias("ticker")
    first = raw.filter("s_acctbal > 0").select(ticker, F.col("s_suppkey").alias("cik_num"))
    second = raw.filter("s_acctbal > 5000").select(
        ticker, (F.col("s_suppkey") + 1000000).alias("cik_num")
    )
    return M.map_companies(M.constituents(listing, "s_suppkey"), first.unionByName(second))


@query
def companies_mapped(spark, sf):
    return supplier_companies(spark, sf).select("position", "ticker", "name", "cik_num")


@query
def companies_valid(spark, sf):
    mapped = M.valid_companies(supplier_companies(spark, sf))
    return mapped.select("ticker", "name", text.padded_cik(F.col("cik_num")).alias("cik10"))


def index_documents(spark, sf) -> DataFrame:
    """One index document per order: two filings in parallel arrays; an order with status 'P' has
    a ragged one; of those with low priority, status 'F' has none and 'O' an error page instead."""
    o = X.table(
        spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )
    key = F.col("o_orderkey").cast("string")
    dates = F.array(
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd"),
    )
    ragged = F.when(F.col("o_orderstatus") == "P", F.slice(dates, 1, 1)).otherwise(dates)
    recent = F.struct(
        F.array("o_orderpriority", "o_orderstatus").alias("form"),
        ragged.alias("filingDate"),
        F.array(key, F.concat(key, F.lit("-2"))).alias("accessionNumber"),
        F.array(F.concat(key, F.lit(".htm")), F.concat(key, F.lit("-2.htm"))).alias("primaryDocument"),
    )
    body = F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings")))
    low = F.col("o_orderpriority") == "5-LOW"
    empty, corrupt = (low & (F.col("o_orderstatus") == s) for s in ("F", "O"))
    return o.select(
        F.col("o_custkey").alias("cik_num"),
        F.when(empty, F.lit("{}"))
        .when(corrupt, F.concat(F.lit("<p>Busy"), body))
        .otherwise(body)
        .alias("json"),
    )


@query
def filing_index_rows(spark, sf):
    return landed.filing_index_rows(index_documents(spark, sf))[0]


@query
def filing_index_rejects(spark, sf):
    rejects = landed.filing_index_rows(index_documents(spark, sf))[1]
    return rejects.groupBy("cik_num").agg(F.count(F.lit(1)).alias("n_rejects"))


@query
def ticker_map_rows(spark, sf):
    c = X.table(spark, sf, "customer", "c_custkey", "c_name")
    entry = F.struct(F.col("c_custkey").alias("cik_str"), F.col("c_name").alias("ticker"))
    share = F.struct(
        F.col("c_custkey").alias("cik_str"), F.concat("c_name", F.lit("-B")).alias("ticker")
    )
    docs = c.select(F.to_json(F.create_map(F.lit("0"), entry, F.lit("1"), share)).alias("json"))
    return landed.ticker_map_rows(docs)


@query
def latest_filing(spark, sf):
    return M.latest_filings(X.filings(spark, sf), X.PRIORITIES)


@query
def latest_filing_two_forms(spark, sf):
    return M.latest_filings(X.filings(spark, sf), M.form_list(" 1-URGENT, ,5-LOW"))


@query
def manifest_ids(spark, sf):
    """Customers as listed companies; those without orders get no rows and no ids."""
    listing = X.table(spark, sf, "customer", "c_custkey", "c_name").select(
        "c_custkey",
        F.replace(F.col("c_name"), F.lit("#"), F.lit(".")).alias("Symbol"),
        F.col("c_name").alias("Security"),
    )
    companies = M.constituents(listing, "c_custkey").withColumn("cik_num", F.col("position").cast("long"))
    latest = M.latest_filings(X.filings(spark, sf), X.PRIORITIES)
    return M.manifest(companies, latest, "data/filings", X.PRIORITIES)


@query
def manifest_keys(spark, sf):
    """The key of each filing that stays when the listing, and so its id, changes."""
    key = F.col("c_custkey")
    companies = X.table(spark, sf, "customer", "c_custkey").select(
        key.cast("int").alias("position"), key.cast("string").alias("ticker"), key.cast("long").alias("cik_num")
    )
    latest = M.latest_filings(X.filings(spark, sf), X.PRIORITIES)
    keyed = M.manifest(companies, latest, "data/filings", X.PRIORITIES, keyed=True)
    return keyed.select("cik", "source_type", "filing_key")


@query
def filing_names(spark, sf):
    f = X.filings(spark, sf)
    cik, acc, doc = F.col("cik_num"), F.col("accessionNumber"), F.col("primaryDocument")
    path = text.storage_path("base/", F.lit("TICK"), F.col("form"), acc, doc)
    return f.select(
        acc.alias("accession"),
        text.padded_cik(cik).alias("cik10"),
        text.archive_url(cik, acc, doc).alias("url"),
        path.alias("path"),
        text.path_accession(path).alias("path_accession"),
        text.path_file_name(path).alias("path_file"),
    )


# -- sources and sinks -------------------------------------------------------------------------


@query
def first_documents(spark, sf):
    """The first 100 documents in (company, document) order."""
    docs = X.documents(spark, sf).select("company_id", "doc_id", "source_type")
    return ranking.first_rows(docs, ["company_id", "doc_id"], 100)


@query
def csv_roundtrip(spark, sf):
    docs = X.texts(spark, sf).select("doc_id", F.length("text").cast("long").alias("sentence_id"), "text")
    folder = staging_folder(spark)
    landed.write_csv(docs, folder)
    return landed.read_csv(spark, folder, SENTENCES_CSV)


def landed_pages(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Pages written as one file each; a manifest that lists pages and documents; the match."""
    folder = landed.plain_path(F.lit(staging := staging_folder(spark)))
    pages = X.table(spark, sf, "pages", "page_id", "html")
    landed.land(pages, staging, "page_id", "html")
    files = landed.landed_files(spark, staging, "*.txt").select(
        F.regexp_replace("file_path", "/[^/]*$", "").alias("file_path"),
        text.html_to_text(F.col("text")).alias("text"),
    )
    listed = pages.select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("doc_id"),
        F.concat(
            folder, F.lit("/"), landed.shard_of(F.col("page_id")), F.lit("/page_id="), F.col("page_id").cast("string")
        ).alias("file_path"),
    ).unionByName(
        X.table(spark, sf, "documents", "doc_id").select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"),
            F.concat(folder, F.lit("/doc_id="), F.col("doc_id").cast("string")).alias("file_path"),
        )
    )
    return landed.match_manifest(listed, files)


@query
def landed_files(spark, sf):
    return landed_pages(spark, sf)[0].select("doc_id", "text")


@query
def missing_files(spark, sf):
    return landed_pages(spark, sf)[1].select("doc_id")


@query
def upsert_documents(spark, sf):
    """Stored: all documents. Incoming: labelled documents under a new source type, and every
    benchmark item as a new document, with columns in another order."""
    table = SnapshotTable(spark, staging_folder(spark), DOCUMENTS)
    docs = X.documents(spark, sf)
    table.upsert(docs)
    labels = X.table(spark, sf, "labels", "doc_id", "quality").select(
        F.col("doc_id").cast("string").alias("doc_id"), "quality"
    )
    changed = docs.join(labels, "doc_id").withColumn(
        "source_type", F.concat(F.lit("quality "), F.col("quality").cast("string"))
    )
    item = F.concat(F.lit("B"), F.col("item_id").cast("string"))
    none = F.lit(None).cast("string")
    added = X.table(spark, sf, "benchmark", "item_id").select(
        item.alias("doc_id"),
        F.lit("benchmark").alias("company_id"),
        none.alias("ticker"),
        none.alias("cik"),
        F.lit("item").alias("source_type"),
        F.lit(None).cast("date").alias("date"),
        item.alias("file_path"),
    )
    incoming = changed.drop("quality").unionByName(added).select(
        "file_path", "date", "source_type", "cik", "ticker", "company_id", "doc_id"
    )
    return table.upsert(incoming)


def reloaded_sentences(spark, sf, replace_by: str | None) -> DataFrame:
    """Stored: sentences of at least 20 characters; incoming: those of at least 60, so documents
    come back shorter."""
    table = SnapshotTable(spark, staging_folder(spark), SENTENCES)
    table.upsert(X.sentences(spark, sf))
    return table.upsert(X.sentences(spark, sf, min_len=60), replace_by)


@query
def upsert_sentences(spark, sf):
    return reloaded_sentences(spark, sf, None)


@query
def upsert_sentences_replaced(spark, sf):
    return reloaded_sentences(spark, sf, "doc_id")


def stored_scores(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Scores of every sentence stored, then those of labelled documents again under other
    weights; company scores refreshed each time."""
    folder = staging_folder(spark)
    s, docs, themes = X.toned_sentences(spark, sf), X.documents(spark, sf), X.themes(spark)
    C.store(spark, folder, C.score(s, docs, themes))
    labelled = X.table(spark, sf, "labels", "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id")
    )
    again = C.score(s.join(labelled, "doc_id", "left_semi"), docs, themes, C.Weights(0.5, 0.5))
    return C.store(spark, folder, again)


@query
def upsert_scores(spark, sf):
    stored, _ = stored_scores(spark, sf)
    return score_columns(stored)


@query
def upsert_company(spark, sf):
    _, companies = stored_scores(spark, sf)
    return company_columns(companies)


@query
def constraint_report(spark, sf):
    """Violations in sentences that repeat, lack a text or point at unlabelled documents."""
    parents = X.table(spark, sf, "labels", "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id")
    )
    return upsert.constraint_report(SENTENCES, stray(spark, sf), {"doc_id": parents})


@query
def cascade_delete(spark, sf):
    """Sentences left once the labelled documents are deleted."""
    deleted = X.table(spark, sf, "labels", "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id")
    )
    return upsert.cascade_delete(X.sentences(spark, sf), deleted, "doc_id")


# -- joins, dates, similarity ------------------------------------------------------------------


@query
def sentence_document_join(spark, sf):
    rows = C.with_documents(X.sentences(spark, sf), X.documents(spark, sf))
    return rows.select("doc_id", "sentence_id", "text", "company_id", "date")


@query
def newest_date(spark, sf):
    return C.newest_date(X.documents(spark, sf))


@query
def time_weight(spark, sf):
    docs = X.documents(spark, sf)
    return C.with_time_weight(docs, docs).select("doc_id", "date", "time_weight")


def cosines_by_shuffle(v: DataFrame, centroids: DataFrame) -> DataFrame:
    pairs = pairing.with_each_by_shuffle(v, ["vec_id"], centroids, "t")
    sim = vectors.semantic_similarity(F.col("embedding"), F.col("t.vector"))
    return pairs.select("vec_id", F.col("t.theme_id").alias("theme_id"), rounded("semantic_sim", sim))


@query
def semantic_cosine(spark, sf):
    """Every vector with every label's mean vector: one matrix product while these are few."""
    centroids = staged(X.label_centroids(spark, sf))
    v = X.spread(X.vectors(spark, sf).select("vec_id", "embedding"), "vec_id")
    if not pairing.is_small(centroids):
        return cosines_by_shuffle(v, centroids)
    small = sorted(centroids.collect(), key=lambda r: r["theme_id"])
    v = v.withColumn(
        "_sims", vectors.semantic_similarities(F.col("embedding"), [r["vector"] for r in small])
    )
    ids = [(r["theme_id"],) for r in small]
    pairs = pairing.with_each(v, ids, centroids.select("theme_id").schema, "t")
    return pairs.select(
        "vec_id",
        F.col("t.theme_id").alias("theme_id"),
        rounded("semantic_sim", F.element_at("_sims", F.col("t_pos") + 1)),
    )


@query
def semantic_cosine_shuffled(spark, sf):
    """The same for vectors of which some are missing, by a join; a missing one is like nothing."""
    v = X.vectors(spark, sf).select(
        "vec_id", F.when(F.col("vec_id") % 7 != 0, F.col("embedding")).alias("embedding")
    )
    return cosines_by_shuffle(v, X.label_centroids(spark, sf))


@query
def vector_normalise(spark, sf):
    unit = X.vectors(spark, sf).select(
        "vec_id", F.posexplode(vectors.l2_normalise(F.col("embedding"))).alias("i", "x")
    )
    return unit.select("vec_id", "i", rounded("x"))


@query
def semantic_terms(spark, sf):
    pairs = C.pair_similarities(X.sentences(spark, sf), X.themes(spark))
    return pairs.select("doc_id", "sentence_id", "theme_id", rounded("semantic_sim"))


@query
def polarity_labels(spark, sf):
    signed = scores.signed_confidence(F.col("label"), F.col("confidence"))
    return X.tones(spark, sf).select(
        "doc_id",
        signed.alias("signed_confidence"),
        scores.stored_polarity(signed).alias("polarity"),
    )


@query
def indel_ratio(spark, sf):
    """Lower-case sentences against each theme's keyword text, letter by letter."""
    feats = X.themes(spark).select(
        "theme_id", scores.keyword_text(F.col("keywords")).alias("kw_text")
    )
    s = X.sentences(spark, sf).withColumn("text", F.lower("text"))
    if pairing.is_small(feats):
        pairs = pairing.with_each(s, feats.collect(), feats.schema, "t")
    else:
        pairs = pairing.with_each_by_shuffle(s, ["doc_id", "sentence_id"], feats, "t")
    return pairs.select(
        "doc_id",
        "sentence_id",
        F.col("t.theme_id").alias("theme_id"),
        rounded("ratio", phonetic.indel_ratio("text", "t.kw_text")),
    )


@query
def metaphone_vocabulary(spark, sf):
    return phonetic.vocabulary(X.sentences(spark, sf))


@query
def phonetic_similarity(spark, sf):
    pairs = C.pair_similarities(X.sentences(spark, sf), X.themes(spark))
    return pairs.select("doc_id", "sentence_id", "theme_id", rounded("phonetic_sim"))


# -- scores and reports ------------------------------------------------------------------------


def scored(spark, sf) -> DataFrame:
    return C.score(X.toned_sentences(spark, sf), X.documents(spark, sf), X.themes(spark))


def scored_of(spark, sf, sentences: DataFrame) -> DataFrame:
    """Scores of sentences that are stored, and so not extracted again."""
    toned = pairing.join_dimension(sentences, X.tones(spark, sf), ["doc_id"])
    return C.score(toned, X.documents(spark, sf), X.themes(spark))


def score_columns(df: DataFrame) -> DataFrame:
    measures = [
        "semantic_sim",
        "phonetic_sim",
        "polarity",
        "confidence",
        "alpha",
        "beta",
        "raw_base",
        "time_weight",
        "final_score_100",
        "theme_score",
    ]
    return df.select(
        "doc_id", "sentence_id", "company_id", "theme_id", *[scores.rounded(F.col(m)).alias(m) for m in measures]
    )


def company_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "company_id", "theme_id", rounded("avg_score"), "n_sentences", rounded("avg_final_100")
    )


@query
def sentence_theme_scores(spark, sf):
    return score_columns(scored(spark, sf))


@query
def sentence_theme_scores_shuffled(spark, sf):
    """The same scores when themes are too many to hand to every task."""
    s, docs = X.toned_sentences(spark, sf), X.documents(spark, sf)
    return score_columns(C.score(s, docs, X.themes(spark), small_bytes=0))


@query
def dry_run_scores(spark, sf):
    """What a run would store, without storing it."""
    s, docs = X.toned_sentences(spark, sf), X.documents(spark, sf)
    scores = C.score(s, docs, X.themes(spark))
    return score_columns(C.store(spark, staging_folder(spark), scores, dry_run=True)[0])


@query
def company_theme_scores(spark, sf):
    return company_columns(C.roll_up(scored(spark, sf)))


@query
def report_counts(spark, sf):
    return R.counts(X.documents(spark, sf), X.sentences(spark, sf))


@query
def scores_page(spark, sf):
    """Rows 4,500 to 5,500 of the sentences in key order."""
    page = R.scores_page(X.sentences(spark, sf), X.documents(spark, sf), 4500, 1000)
    return page.select("doc_id", "sentence_id", "text", "company_id", "date")


@query
def scores_page_deep(spark, sf):
    """The same page by the way that serves pages of any depth."""
    rows = C.with_documents(X.sentences(spark, sf), X.documents(spark, sf))
    page = ranking.ordered_page(rows, ["doc_id", "sentence_id"], 4500, 1000, top_rows=0)
    return page.select("doc_id", "sentence_id", "text", "company_id", "date")


@query
def top_themes(spark, sf):
    return R.top_themes(C.roll_up(scored(spark, sf)), X.themes(spark), k=3).select(
        "company_id", "rank", "theme_id", "theme", rounded("avg_final_100"), "n_sentences"
    )


@query
def top_themes_of_company(spark, sf):
    best = R.top_themes(C.roll_up(scored(spark, sf)), X.themes(spark), "src3")
    return best.select("theme_id", "theme", rounded("avg_final_100"), "n_sentences")


@query
def top_evidence(spark, sf):
    s = staged(X.sentences(spark, sf))
    best = R.top_evidence(scored_of(spark, sf, s), s, k=5)
    return best.select(
        "company_id", "theme_id", "rank", "doc_id", "sentence_id", "text", rounded("final_score_100")
    )


@query
def top_evidence_of_pair(spark, sf):
    best = R.top_evidence(scored(spark, sf), X.sentences(spark, sf), "src3", "T1")
    return best.select("doc_id", "sentence_id", "text", rounded("final_score_100"))


@query
def evidence_report(spark, sf):
    sentences = staged(X.sentences(spark, sf))
    s = staged(scored_of(spark, sf, sentences))
    report = R.evidence_report(C.roll_up(s), X.themes(spark), s, sentences, 3, 5)
    return report.select(
        "company_id",
        "theme_id",
        "theme",
        "rank",
        rounded("avg_final_100"),
        "n_sentences",
        "n_evidence",
        "evidence",
    )
