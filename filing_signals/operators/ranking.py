"""Top rows per group, ordered pages and first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.sources.snapshots import staged

# Pages that end beyond this many rows are cut from a sorted table instead of a top-n.
TOP_ROWS = 100_000


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first k rows of each group.

    Spark limits each task's groups to k rows before the shuffle (WindowGroupLimit), so a hot
    group sends at most k rows per task. It does so up to a set k; beyond it the groups are
    first cut into salted parts, of which each keeps its first k rows.
    """

    def first_k(rows: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)

    conf = df.sparkSession.conf
    if k > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        parts = int(conf.get("spark.sql.shuffle.partitions"))
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
        df = first_k(salted, [*group, "_salt"]).drop("_salt", rank)
    return first_k(df, group)


def ordered_page(
    df: DataFrame, keys: list[str | Column], offset: int, limit: int, top_rows: int = TOP_ROWS
) -> DataFrame:
    """Rows offset … offset + limit - 1 in the order of `keys`, nulls first.

    Rows with equal keys are ordered by a hash of all their columns, so both ways below cut the same
    sequence. A page within the first `top_rows` rows is a top-n. A deeper one is cut from a table
    sorted over the cluster and staged: its files are in order, so the rows of the files before
    one and a row's place in its file give its number.
    """
    order = [*keys, F.xxhash64(*df.columns)]
    if offset + limit <= top_rows:
        return df.orderBy(*order).offset(offset).limit(limit)
    rows = staged(df.orderBy(*order)).select("*", "_metadata.file_name", "_metadata.row_index")
    files = rows.groupBy("file_name").agg(F.count("*").alias("_n"))  # one row per task of the sort
    before = Window.orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    firsts = files.select("file_name", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    number = F.col("_first") + F.col("row_index")
    page = rows.join(F.broadcast(firsts), "file_name").filter(
        (number >= offset) & (number < offset + limit)
    )
    return page.orderBy(number).select(*df.columns)


def first_rows(df: DataFrame, keys: list[str | Column], limit: int) -> DataFrame:
    """The first `limit` rows in key order; 0 keeps every row."""
    return ordered_page(df, keys, 0, limit) if limit > 0 else df
