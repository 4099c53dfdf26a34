"""Scores of every (sentence, theme) pair and their rollup per company and theme."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_signals import fixed
from filing_signals.functions import phonetic, scores, vectors
from filing_signals.operators import pairing
from filing_signals.plans.rollup import RolledScores
from filing_signals.schemas import COMPANY_SCORES, SENTENCE_SCORES
from filing_signals.sources.snapshots import SnapshotTable


@dataclass(frozen=True)
class Weights:
    alpha: float = fixed.ALPHA
    beta: float = fixed.BETA
    newest: float = fixed.WEIGHT_NEWEST
    older: float = fixed.WEIGHT_OLDER


def newest_date(documents: DataFrame) -> DataFrame:
    """The newest date over all documents, with or without sentences; null if there is none."""
    return documents.agg(F.max("date").alias("newest"))


def with_documents(sentences: DataFrame, documents: DataFrame) -> DataFrame:
    """Sentences with their document's company and date."""
    wanted = documents.select("doc_id", "company_id", "date")
    return pairing.join_dimension(sentences, wanted, ["doc_id"])


def with_time_weight(rows: DataFrame, documents: DataFrame, weights: Weights = Weights()) -> DataFrame:
    newest = newest_date(documents).scalar()
    return rows.withColumn(
        "time_weight", scores.time_weight(F.col("date"), newest, weights.newest, weights.older)
    )


def theme_features(themes: DataFrame, dense: bool = False) -> DataFrame:
    """Per theme what scoring needs: keyword code, and its vector or its term counts."""
    kw = scores.keyword_text(F.col("keywords"))
    words = vectors.lower_tokens(scores.theme_text(F.col("theme"), F.col("keywords")))
    meaning = (
        [F.col("vector")]
        if dense
        else [vectors.term_counts(words).alias("terms"), vectors.term_norm(words).alias("norm")]
    )
    return themes.select("theme_id", phonetic.phonetic_code(kw).alias("kw_code"), *meaning)


def pair_similarities(
    rows: DataFrame, themes: DataFrame, small_bytes: int = pairing.SMALL_BYTES
) -> DataFrame:
    """Every sentence with every theme: theme_id, semantic_sim and phonetic_sim.

    With a `vector` column on both sides meaning is their cosine, else the cosine of lower-case
    term counts. Themes under the size limit are handed to every task, and a sentence is compared with
    all of them before pairing, so that pairs carry numbers only; beyond it pairs come from a salted
    shuffle join. Both give the same rows.
    """
    dense = "vector" in rows.columns and "vector" in themes.columns
    feats = theme_features(themes, dense)
    made = ["_code", "_lower", "_t", "_t_pos", "_sem", "_phon"]
    lowered = F.lower("text")

    if pairing.is_small(themes, small_bytes):
        small = sorted(feats.collect(), key=lambda r: r["theme_id"])
        if dense:
            meaning = vectors.semantic_similarities(F.col("vector"), [r["vector"] for r in small])
        else:
            meaning = vectors.term_similarities(lowered, small)
        sound = phonetic.phonetic_similarities(lowered, [r["kw_code"] for r in small])
        base = rows.withColumns({"_sem": meaning, "_phon": sound})
        pairs = pairing.with_each(base, [(r["theme_id"],) for r in small], feats.select("theme_id").schema, "_t")
        phon = F.element_at("_phon", F.col("_t_pos") + 1)
        sem = F.element_at("_sem", F.col("_t_pos") + 1)
    else:
        base = rows.withColumn("_code", phonetic.phonetic_code("text"))
        base = base if dense else base.withColumn("_lower", lowered)
        pairs = pairing.with_each_by_shuffle(base, ["doc_id", "sentence_id"], feats, "_t")
        phon = phonetic.phonetic_similarity(F.col("_code"), F.col("_t.kw_code"))
        if dense:
            sem = vectors.semantic_similarity(F.col("vector"), F.col("_t.vector"))
        else:
            sem = vectors.term_similarity_of_text(F.col("_lower"), F.col("_t.terms"), F.col("_t.norm"))
    return (
        pairs.withColumn("theme_id", F.col("_t.theme_id"))
        .withColumn("semantic_sim", sem)
        .withColumn("phonetic_sim", phon)
        .drop(*made)
    )


def score(
    sentences: DataFrame,
    documents: DataFrame,
    themes: DataFrame,
    weights: Weights = Weights(),
    small_bytes: int = pairing.SMALL_BYTES,
    keep_signed: bool = False,
) -> DataFrame:
    """Score rows of every (sentence, theme) pair.

    `sentences` carries a tone `label` and its `confidence` (from a table, or `scores.classify`)
    and, for dense meaning, a `vector` (from a table, or `vectors.encode`). Only the sign of the
    tone enters the score. `keep_signed` adds the signed confidence, which is not stored.
    """
    rows = with_time_weight(with_documents(sentences, documents), documents, weights)
    rows = rows.withColumn(
        "_signed", scores.signed_confidence(F.col("label"), F.col("confidence"))
    )
    pairs = pair_similarities(rows, themes, small_bytes)
    raw = scores.raw_base(
        F.col("semantic_sim"), F.col("phonetic_sim"), F.col("_signed"), weights.alpha, weights.beta
    )
    extra: list[Column] = [F.col("_signed").alias("signed_confidence")] if keep_signed else []
    return pairs.withColumn("raw_base", raw).select(
        "doc_id",
        "sentence_id",
        "company_id",
        "theme_id",
        "semantic_sim",
        "phonetic_sim",
        scores.stored_polarity(F.col("_signed")).alias("polarity"),
        "confidence",
        F.lit(weights.alpha).alias("alpha"),
        F.lit(weights.beta).alias("beta"),
        "raw_base",
        "time_weight",
        scores.final_score(F.col("raw_base"), F.col("time_weight")).alias("final_score_100"),
        F.col("raw_base").alias("theme_score"),
        *extra,
    )


def roll_up(sentence_scores: DataFrame) -> DataFrame:
    """Averages and counts per company and theme; partial sums keep a hot company cheap."""
    return sentence_scores.groupBy("company_id", "theme_id").agg(
        F.avg("theme_score").alias("avg_score"),
        F.count(F.lit(1)).cast("int").alias("n_sentences"),
        F.avg("final_score_100").alias("avg_final_100"),
    )


def store(
    spark,
    root: str,
    scored: DataFrame,
    dry_run: bool = False,
    replace_documents: bool = False,
    buckets: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Merge scores into the stored table, then refresh every company score from all of it.

    With `buckets` both go by batch (`rollup.RolledScores`): a batch reads and writes the buckets of its
    documents and groups, and company scores come from sums that it is added to.

    A key that comes twice (a tone or label table with two rows for a document, say) raises and
    leaves the stored table as it was. The rollup reads the new snapshot, so scoring itself runs once. A dry run writes nothing and
    returns both results unwritten.
    """
    if dry_run:
        return scored, roll_up(scored)
    if buckets is not None:
        rolled = RolledScores(spark, root, buckets)
        companies = rolled.add(scored, replace_documents)
        return rolled.scores.read(), companies
    replace_by = "doc_id" if replace_documents else None
    stored = SnapshotTable(spark, root, SENTENCE_SCORES).upsert(scored, replace_by)
    companies = SnapshotTable(spark, root, COMPANY_SCORES).upsert(roll_up(stored), unique=True)
    return stored, companies
