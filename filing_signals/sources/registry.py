"""Lasting numbers for filing keys: an old key keeps its number, new ones get the next in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.functions.text import display_id
from filing_signals.operators.numbering import number_rows
from filing_signals.schemas import Relation
from filing_signals.sources.buckets import BucketTable

REGISTRY = Relation(
    "filing_numbers",
    T.StructType([T.StructField("filing_key", T.StringType(), False), T.StructField("number", T.LongType(), False)]),
    ["filing_key"],
)


class IdRegistry:
    """The stored (filing_key, number) table. One run at a time may register."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.table = BucketTable(spark, root, REGISTRY, buckets)

    def register(self, rows: DataFrame, order: Column) -> DataFrame:
        """`rows` with `number` and `doc_id`. New keys are numbered after the highest number given so far,
        by `order` (a whole number, missing ones last) and then by a hash of the key.

        Only new keys are numbered, in chunks as `number_rows` does, so no task sorts them all, and only
        the buckets that they fall into are written. A key that comes several times counts by its least
        order; rows without a key get no number.
        """
        known = self.table.read()
        last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        named = rows.where(F.col("filing_key").isNotNull())
        fresh = named.groupBy("filing_key").agg(F.min(order.cast("long")).alias("_order"))
        fresh = fresh.join(known, "filing_key", "left_anti")
        numbered = number_rows(fresh, [], F.col("_order"), F.col("filing_key"), "_place")
        every = self.table.upsert(numbered.select("filing_key", (F.col("_place") + 1 + last).alias("number")), unique=True)
        return rows.join(every, "filing_key", "left").withColumn("doc_id", display_id(F.col("number")))
