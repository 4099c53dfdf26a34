"""Exact length quantiles of a growing table, from a stored histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals import fixed
from filing_signals.schemas import Relation
from filing_signals.sources.buckets import BucketTable

LENGTHS = Relation(
    "text_lengths",
    T.StructType([T.StructField("length", T.IntegerType(), False), T.StructField("n", T.LongType(), False)]),
    ["length"],
)


class LengthHistogram:
    """How many texts have each length; a batch is counted once and merged, and none is read again.

    The table has a row per distinct length, so it stays small however many texts it stands for.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        self.table = BucketTable(spark, root, LENGTHS, buckets)

    def add(self, batch: DataFrame, sign: int = 1) -> DataFrame:
        """Count a batch in (1) or, for rows that were deleted or replaced, out (-1)."""
        fresh = batch.where(F.col("text").isNotNull()).groupBy(F.length("text").alias("length"))
        fresh = fresh.agg((F.count(F.lit(1)) * sign).alias("n"))
        both = self.table.read().join(fresh.select("length"), "length", "left_semi").unionByName(fresh)
        return self.table.upsert(both.groupBy("length").agg(F.sum("n").alias("n")), unique=True)

    def bounds(self, share: float = fixed.TRIM_SHARE) -> DataFrame:
        """One row: exact interpolated quantiles at `share` and 1 - share as `bounds`; null where
        nothing is counted."""
        ends = F.array(F.lit(share), F.lit(1.0 - share))
        return self.table.read().where("n > 0").agg(F.percentile("length", ends, F.col("n")).alias("bounds"))
