"""Dense numbering of rows that stays spread out when one group holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.operators.pairing import join_dimension
from filing_signals.sources.snapshots import staged

# Majors per chunk (2^8), rows that one task may rank, and hex digits of the tie hash per slot of
# larger chunks: they bound every window below.
CHUNK_BITS = 8
CHUNK_ROWS = 1 << 20
SLOT_DIGITS = 4
NULL_MAJOR = 2**62


def _before(partition: list[str], order: list[str], n: str) -> Column:
    """Sum of `n` over the rows that come before."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def number_rows(
    df: DataFrame,
    group: list[str],
    major: Column,
    tie: Column,
    out: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Number the rows of each group 0, 1, 2, … by (major, nulls last), ties by md5 of `tie`.

    `major` is a whole number, 32 bits wide in the stored tables. A plain `row_number` would sort a
    whole group in one task, so a group is cut into chunks of 256 majors. Their sizes are counted
    with map-side combining, which is a job of its own, and give each chunk its first number; rows
    are ranked inside their chunk. The count of chunks is at most 2^31 / 256 a group.

    Where a chunk has more than `chunk_rows` rows (a major that repeats, or is missing, in most
    rows), chunks are cut further by major and four hex digits of the tie hash, and these slots
    are ranked and counted the same way. Both ways give the same numbers, which depend on the data
    alone, so retried tasks agree.
    """
    keyed = df.withColumn(
        "_major", F.coalesce(major.cast("long"), F.lit(NULL_MAJOR).cast("long"))
    ).withColumn("_chunk", F.shiftright("_major", CHUNK_BITS))
    keyed = staged(keyed)  # read by the counts and by the ranks: what makes the rows runs once
    hashed = keyed.withColumn("_hash", F.coalesce(F.md5(tie.cast("binary")), F.lit("")))
    chunk = [*group, "_chunk"]
    counts = staged(keyed.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_n")))
    firsts = counts.select(*chunk, _before(group, ["_chunk"], "_n").alias("_first"))
    parts, order = chunk, ["_major", "_hash"]
    if not counts.filter(F.col("_n") > chunk_rows).isEmpty():
        hashed = hashed.withColumn("_slot", F.substring("_hash", 1, SLOT_DIGITS))
        parts, order = [*chunk, "_major", "_slot"], ["_hash"]
        slots = hashed.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
        inside = slots.withColumn("_inside", _before(chunk, ["_major", "_slot"], "_n"))
        firsts = inside.join(firsts, chunk).select(*parts, (F.col("_first") + F.col("_inside")).alias("_first"))
    rank = F.row_number().over(Window.partitionBy(*parts).orderBy(*order, tie))
    numbered = join_dimension(hashed.withColumn("_rank", rank), firsts, parts)
    return numbered.withColumn(out, F.col("_first") + F.col("_rank") - 1).drop(
        "_major", "_chunk", "_hash", "_slot", "_rank", "_first"
    )
