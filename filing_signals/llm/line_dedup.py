"""Line dedup: drop lines whose normalised form occurs in many documents, keep one copy.

Lines are exploded and hashed, distinct documents are counted per hash, and lines over the
threshold are dropped by position. Counting combines on the map side, so a line that every document
holds costs one row per task; only positions of dropped lines travel back to the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_signals.functions.text import bind

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def text_lines(text: Column) -> Column:
    """Lines of a text; a null or empty one is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc, row, pos, h1, h2) of each line with a long enough key.

    128 bits tell keys apart. `row` tells apart different texts that come under one id.
    """
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"),
        F.xxhash64("text").alias("row"),
        F.posexplode(text_lines(F.col("text"))).alias("pos", "line"),
    )
    key = line_key(F.col("line"))
    return (
        lines.withColumn("key", key)
        .where(F.char_length("key") >= least_chars)
        .select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))
    )


def dropped_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """(doc, row, drops): positions of the lines that each text loses."""
    keyed = _keyed_lines(docs, least_chars)
    common = (
        keyed.groupBy("h1", "h2", "doc")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
        .where(F.col("n") >= least_docs)
        .drop("n")
    )
    return (
        keyed.join(common, ["h1", "h2"])
        .where(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "row")
        .agg(F.collect_set("pos").alias("drops"))  # a text's own lines
    )


def line_dedup(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """`row`, `n_lines`, `n_dropped`: each row of `docs` as a struct, its `text` less common lines.

    Keys of at least `least_chars` code points found in at least `least_docs` documents stay only
    in the largest `doc_id` that holds them, where all their lines stay. Documents are told apart by
    id: rows that repeat an id count once. Rows without an id keep all lines and count for none. A
    null or empty text is one empty line and comes back empty. All other columns are kept.
    """
    drops = dropped_lines(docs, least_chars, least_docs).select(
        F.struct("doc", "row").alias("_of"), F.col("drops").alias("_drops")
    )
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_in"))
    of = F.struct(F.col("_in.doc_id").cast("long").alias("doc"), F.xxhash64("_in.text").alias("row"))
    joined = given.join(drops.hint("shuffle_hash"), of == F.col("_of"), "left")

    def kept(b: Column) -> Column:
        lines, none = b["lines"], F.array().cast("array<int>")
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(b["drops"], none))
        text = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
        return F.struct(
            text.alias("text"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(stay)).cast("long").alias("n_dropped"),
        )

    both = F.struct(text_lines(F.col("_in.text")).alias("lines"), F.col("_drops").alias("drops"))
    out = joined.select("_in", bind(both, kept).alias("_kept"))
    columns = [
        (F.col("_kept.text") if c == "text" else F.col(f"_in.`{c}`")).alias(c) for c in docs.columns
    ]
    return out.select(F.struct(*columns).alias("row"), "_kept.n_lines", "_kept.n_dropped")
