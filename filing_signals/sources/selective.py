"""Scores stored so that an equality filter skips most of them.

Rows are dealt by the filtered columns and sorted by them, so a value's rows are close together in few files, and each
file has Parquet statistics and a Bloom filter of them. A filter on a company then reads the row groups that can
hold it, whatever the order of the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_signals.sources.snapshots import remove, staged, staging_folder

# Parts that values are dealt to, for each shuffle partition: so many that a part that is split for one large value
# holds few others. Small parts are put together again.
PARTS_PER_TASK = 8


def store_selective(
    df: DataFrame,
    path: str,
    columns: list[str],
    distinct: int = 100_000,
    group_bytes: int = 8 << 20,
    files: int | None = None,
) -> DataFrame:
    """Write `df` for filters on `columns`, the first of them before all.

    A value that holds many rows is spread over several files. `distinct` is the number of values in a file that its
    Bloom filters are made for.

    Rows go straight from what makes them (scoring, say) to their files, dealt by the hash of the columns; AQE
    splits the parts that a value makes large and joins small ones. For a given number of `files`, or without AQE,
    ranges go by the columns and then by a hash of the row. They are found from a sample of all rows, so rows are
    staged then: what makes them runs once.
    """
    spark = df.sparkSession
    if files is None and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        parts = PARTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
        _write(df.hint("rebalance", parts, *columns), path, columns, distinct, group_bytes)
        return spark.read.schema(df.schema).parquet(path)
    ranges = [*[F.col(c) for c in columns], F.xxhash64(*df.columns)]
    folder = staging_folder(spark)
    try:
        rows = staged(df, folder)
        dealt = rows.repartitionByRange(files, *ranges) if files else rows.repartitionByRange(*ranges)
        _write(dealt, path, columns, distinct, group_bytes)
    finally:
        remove(spark, folder)
    return spark.read.schema(df.schema).parquet(path)


def _write(dealt: DataFrame, path: str, columns: list[str], distinct: int, group_bytes: int) -> None:
    writer = dealt.sortWithinPartitions(*columns).write.option("parquet.block.size", str(group_bytes))
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct))
    writer.parquet(path)


def read_selective(spark: SparkSession, path: str, **values: object) -> DataFrame:
    """Rows with the given values. Comparisons are of plain columns, so that they reach the scan."""
    rows = spark.read.parquet(path)
    for c, v in values.items():
        rows = rows.where(F.col(c) == F.lit(v))
    return rows
