"""Loading landed CSV tables into the stored documents and sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_signals.operators.upsert import ConstraintError, orphans
from filing_signals.schemas import (
    COMPANY_SCORES,
    DOCUMENTS,
    MANIFEST_CSV,
    SENTENCE_SCORES,
    SENTENCES,
    SENTENCES_CSV,
    THEMES,
    Relation,
)
from filing_signals.sources.buckets import BucketTable
from filing_signals.sources.landed import read_csv
from filing_signals.sources.snapshots import SnapshotTable


def create_tables(spark: SparkSession, root: str) -> None:
    """Create the stored tables that are missing, empty and with their fixed schemas."""
    for relation in (DOCUMENTS, SENTENCES, THEMES, SENTENCE_SCORES, COMPANY_SCORES):
        SnapshotTable(spark, root, relation).create_if_missing()


def stored_table(spark: SparkSession, root: str, relation: Relation, buckets: int | None = None) -> SnapshotTable | BucketTable:
    """A stored relation keyed by document: in whole snapshots, or in so many buckets of `doc_id`, where a load
    reads and writes the buckets of its documents only. A root holds one kind."""
    if buckets is None:
        return SnapshotTable(spark, root, relation)
    return BucketTable(spark, root, relation, buckets, by=["doc_id"])


def load_documents(
    spark: SparkSession, root: str, manifest_csv: str, multi_line: bool = True, buckets: int | None = None
) -> DataFrame:
    """Merge a manifest by document id; rows without an id are skipped."""
    rows = read_csv(spark, manifest_csv, MANIFEST_CSV, multi_line)
    rows = rows.dropna(subset=["doc_id"]).withColumn("date", F.try_to_date("date"))
    return stored_table(spark, root, DOCUMENTS, buckets).upsert(rows)


def load_sentences(
    spark: SparkSession,
    root: str,
    sentences_csv: str,
    replace_documents: bool = False,
    multi_line: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """Merge cleaned sentences by (document, number); rows without id or text are skipped.

    A sentence of an unknown document raises before anything is written. `multi_line=False` lets
    Spark split files, for texts known to hold no line break.
    """
    rows = read_csv(spark, sentences_csv, SENTENCES_CSV, multi_line)
    rows = rows.dropna(subset=["doc_id", "text"])
    lost = orphans(rows, stored_table(spark, root, DOCUMENTS, buckets).read(), "doc_id").head(1)
    if lost:
        raise ConstraintError(f"sentences of a document that is not stored: {lost[0].asDict()}")
    replace_by = "doc_id" if replace_documents else None
    return stored_table(spark, root, SENTENCES, buckets).upsert(rows, replace_by)


def delete_documents(spark: SparkSession, root: str, ids: DataFrame, buckets: int | None = None) -> None:
    """Drop stored documents, and with them their sentences, by the `doc_id` of `ids`.

    Sentences go first: a job that fails in between leaves no sentence without its document, and
    can be run again.
    """
    for relation in (SENTENCES, DOCUMENTS):
        stored_table(spark, root, relation, buckets).delete(ids.select("doc_id").distinct(), "doc_id")
