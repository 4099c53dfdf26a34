"""Reports over stored scores: counts, top themes, top evidence, pages and the evidence report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_signals import fixed
from filing_signals.operators.pairing import join_dimension
from filing_signals.operators.ranking import ordered_page, top_per_group
from filing_signals.plans.scoring import with_documents
from filing_signals.sources.snapshots import staged


def _best(score: str, *keys: str):
    """Highest first, missing scores ahead as the stored queries have it, then by key."""
    return [F.col(score).desc_nulls_first(), *[F.col(k) for k in keys]]


def counts(documents: DataFrame, sentences: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return documents.agg(n.alias("n_docs")).select(
        "n_docs", sentences.agg(n).scalar().alias("n_sents")
    )


def top_themes(
    company_scores: DataFrame,
    themes: DataFrame,
    company_id: str | None = None,
    k: int = fixed.TOP_THEMES,
) -> DataFrame:
    """Top themes of one company, or of every company with a rank."""
    cols = ["theme_id", "theme", "avg_final_100", "n_sentences"]
    named = join_dimension(company_scores, themes.select("theme_id", "theme"), ["theme_id"])
    order = _best("avg_final_100", "theme_id")
    if company_id is not None:
        return named.filter(F.col("company_id") == company_id).orderBy(*order).limit(k).select(*cols)
    return top_per_group(named, ["company_id"], order, k).select("company_id", "rank", *cols)


def top_evidence(
    sentence_scores: DataFrame,
    sentences: DataFrame,
    company_id: str | None = None,
    theme_id: str | None = None,
    k: int = fixed.TOP_EVIDENCE,
) -> DataFrame:
    """Top sentences of one (company, theme), or of every such pair with a rank.

    Scores whose sentence is gone are dropped by key first and ranked without their texts. The
    ranked rows are staged, so that their size is known before they fetch their texts: while
    they are few the sentences are read in place, without a shuffle.
    """
    keys = ["doc_id", "sentence_id"]
    order = _best("final_score_100", *keys)
    rows = sentence_scores
    if company_id is not None:
        rows = rows.filter(F.col("company_id") == company_id)
    if theme_id is not None:
        rows = rows.filter(F.col("theme_id") == theme_id)
    rows = rows.select("company_id", "theme_id", *keys, "final_score_100")
    rows = rows.join(sentences.select(*keys), keys, "left_semi")
    if company_id is not None and theme_id is not None:
        best = rows.orderBy(*order).limit(k).select(*keys, "final_score_100")
        return (
            join_dimension(sentences, staged(best), keys)
            .orderBy(*order)
            .select(*keys, "text", "final_score_100")
        )
    best = staged(top_per_group(rows, ["company_id", "theme_id"], order, k))
    return join_dimension(sentences, best, keys).select(
        "company_id", "theme_id", "rank", *keys, "text", "final_score_100"
    )


def evidence_report(
    company_scores: DataFrame,
    themes: DataFrame,
    sentence_scores: DataFrame,
    sentences: DataFrame,
    k_themes: int = fixed.TOP_THEMES,
    k_sentences: int = fixed.TOP_EVIDENCE,
) -> DataFrame:
    """Top themes of each company with their top sentences in one text column, best first.

    Each list holds at most `k_sentences` texts, so no group grows with the data.
    """
    best = top_themes(company_scores, themes, k=k_themes)
    evidence = top_evidence(sentence_scores, sentences, k=k_sentences).withColumnRenamed(
        "rank", "place"
    )
    texts = F.array_sort(F.collect_list(F.struct("place", "text")))
    lists = evidence.groupBy("company_id", "theme_id").agg(
        F.array_join(F.transform(texts, lambda e: e["text"]), " | ").alias("evidence"),
        F.count(F.lit(1)).cast("int").alias("n_evidence"),
    )
    return best.join(lists, ["company_id", "theme_id"], "left").select(
        "company_id", "theme_id", "theme", "rank", "avg_final_100", "n_sentences", "n_evidence", "evidence"
    )


def scores_page(
    sentences: DataFrame, documents: DataFrame, offset: int, limit: int = fixed.PAGE_ROWS
) -> DataFrame:
    """One page of sentences with company and date, in key order."""
    return ordered_page(with_documents(sentences, documents), ["doc_id", "sentence_id"], offset, limit)
