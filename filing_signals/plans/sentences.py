"""Sentences: extraction from texts or HTML, and strict cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_signals import fixed
from filing_signals.functions import text as tx
from filing_signals.operators.numbering import number_rows
from filing_signals.operators.pairing import is_small
from filing_signals.operators.ranking import first_rows
from filing_signals.sources.landed import landed_files, match_manifest, require_columns
from filing_signals.sources.snapshots import staged


def extract(
    docs: DataFrame, text: str = "text", min_len: int = fixed.MIN_SENTENCE_LENGTH, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per kept sentence, numbered from 0 in text order inside its document.

    A narrow projection: the number is the position in the already filtered array. `keep` names columns of the
    document that its sentences carry, so that they need not be joined to it.
    """
    sentences = tx.sentence_array(F.col(text), min_len)
    return docs.select("doc_id", F.posexplode(sentences).alias("sentence_id", "text"), *keep)


def extract_html(
    pages: DataFrame, html: str = "html", min_len: int = fixed.MIN_SENTENCE_LENGTH
) -> DataFrame:
    plain = pages.select("doc_id", tx.html_to_text(F.col(html)).alias("text"))
    return extract(plain, "text", min_len)


def extract_landed(
    manifest: DataFrame,
    root: str,
    pattern: str = "*",
    min_len: int = fixed.MIN_SENTENCE_LENGTH,
    limit: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Sentences of the manifest's landed HTML files, and the manifest rows without a file.

    A manifest whose measured size allows is handed to the tasks that read the files, and only files
    that it lists are decoded and parsed. For a larger one HTML is reduced to text first, so that the
    join that has to shuffle carries texts only. `limit` keeps the first documents by the number in
    their id; 0 keeps all.
    """
    listed = require_columns(manifest, ["doc_id", "file_path"], "manifest")
    order = [tx.display_number(F.col("doc_id")), F.col("doc_id")]
    docs = first_rows(listed, order, limit)
    files = landed_files(manifest.sparkSession, root, pattern)
    plain = tx.html_to_text(F.col("text")).alias("text")
    if is_small(docs):
        found, missing = match_manifest(docs, files, broadcast=True)
        found = found.select(*docs.columns, plain)
    else:
        found, missing = match_manifest(docs, files.select("file_path", plain))
    return extract(found, "text", min_len), missing


def usable(sentences: DataFrame) -> DataFrame:
    """Rows with an id and a text that are not stray header lines."""
    df = require_columns(sentences, ["doc_id", "sentence_id", "text"], "sentences")
    return df.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("sentence_id").cast("int").alias("sentence_id"),
        "text",
    ).filter(
        F.col("doc_id").isNotNull()
        & F.col("text").isNotNull()
        & (F.lower("doc_id") != "doc_id")
    )


def drop_exact_copies(sentences: DataFrame) -> DataFrame:
    """Distinct rows, nulls equal; copies combine on the map side before the shuffle."""
    return sentences.dropDuplicates()


def ratio_filters(
    sentences: DataFrame,
    symbol_thresh: float = fixed.SYMBOL_THRESHOLD,
    digit_thresh: float = fixed.DIGIT_THRESHOLD,
    symbol_on: str = "clean",
) -> DataFrame:
    """Clean the text, drop emptied rows, then rows over the symbol or digit share.

    Cleaned text holds no symbols, so their share is 0 at any threshold; `symbol_on="raw"`
    measures the text as it came.

    The cleaned text goes through a one-element array, so it is computed once per row rather
    than once per condition, and later conditions on it stay above the steps before it.
    """
    raw = tx.symbol_ratio(F.col("text")) if symbol_on == "raw" else F.lit(0.0)
    kept = F.filter(
        F.array(tx.clean_sentence(F.col("text"))),
        lambda t: (F.length(t) > 0) & (tx.clean_digit_ratio(t) <= digit_thresh),
    )
    return sentences.filter(raw <= symbol_thresh).select(
        "doc_id", "sentence_id", F.explode(kept).alias("text")
    )


def length_bounds(sentences: DataFrame, share: float = fixed.TRIM_SHARE) -> DataFrame:
    """One row: exact interpolated quantiles of text length at `share` and 1 - share, as `bounds`.

    Lengths are counted first, so the quantile step sees one row per distinct length.
    """
    histogram = sentences.groupBy(F.length("text").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    ends = F.array(F.lit(share), F.lit(1.0 - share))
    return histogram.agg(F.percentile("len", ends, F.col("n")).alias("bounds"))


def trim_lengths(sentences: DataFrame, share: float = fixed.TRIM_SHARE) -> DataFrame:
    """Rows between the two length quantiles, both ends kept; no trimming for share <= 0."""
    if share <= 0:
        return sentences
    bounds = length_bounds(sentences, share).scalar()
    return sentences.filter((F.length("text") >= bounds[0]) & (F.length("text") <= bounds[1]))


def keep_first_texts(sentences: DataFrame) -> DataFrame:
    """One row per (document, text), with its lowest sentence number, null only if all are.

    A minimum, not a window: it combines on the map side, so a text copied millions of times
    reaches the shuffle once per task.
    """
    first = sentences.groupBy("doc_id", "text").agg(F.min("sentence_id").alias("sentence_id"))
    return first.select("doc_id", "sentence_id", "text")


def renumber(sentences: DataFrame) -> DataFrame:
    """Number each document's rows 0 … n-1 by (sentence number, nulls last)."""
    numbered = number_rows(sentences, ["doc_id"], F.col("sentence_id"), F.col("text"), "_number")
    return numbered.select("doc_id", F.col("_number").cast("int").alias("sentence_id"), "text")


def clean(
    sentences: DataFrame,
    symbol_thresh: float = fixed.SYMBOL_THRESHOLD,
    digit_thresh: float = fixed.DIGIT_THRESHOLD,
    trim_share: float = fixed.TRIM_SHARE,
    keep_copies: bool = False,
    symbol_on: str = "clean",
) -> DataFrame:
    """The strict cleaning chain. Length quantiles see distinct rows after the ratio filters and
    before texts are deduplicated; filtered rows are staged, so that texts are cleaned once for the
    quantiles and for the rest of the chain."""
    rows = drop_exact_copies(usable(sentences))
    rows = ratio_filters(rows, symbol_thresh, digit_thresh, symbol_on)
    rows = trim_lengths(staged(rows) if trim_share > 0 else rows, trim_share)
    return renumber(rows if keep_copies else keep_first_texts(rows))


def observed(df: DataFrame, stage: str) -> DataFrame:
    """`df` with its row count reported under `stage` to query listeners when it runs."""
    return df.observe(stage, F.count(F.lit(1)).alias("rows"))
