"""Results of a caller's model, kept by the digest of the text, so that no text is encoded twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals import fixed
from filing_signals.functions.vectors import encode
from filing_signals.schemas import Relation
from filing_signals.sources.buckets import BucketTable
from filing_signals.sources.snapshots import staged

ENCODED = Relation(
    "encoded_texts",
    T.StructType(
        [
            T.StructField("digest", T.StringType(), False),
            T.StructField("vector", T.ArrayType(T.FloatType()), False),
        ]
    ),
    ["digest"],
)
Model = Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]]


class EncodedTexts:
    """Stored vectors by digest. Texts that are already there, or come several times, cost no model call."""

    def __init__(self, spark: SparkSession, root: str, model: Model, buckets: int = 64, batch: int = fixed.MODEL_BATCH):
        self.table = BucketTable(spark, root, ENCODED, buckets)
        self.model, self.batch = model, batch

    def missing(self, texts: DataFrame) -> DataFrame:
        """(digest, text) of distinct texts without a stored vector. One text per digest crosses the
        exchange; repeats combine on the map side. Digests are moved as bytes, at half their length."""
        keyed = texts.where(F.col("text").isNotNull()).select(F.unhex(F.sha2("text", 256)).alias("_key"), "text")
        first = keyed.groupBy("_key").agg(F.first("text").alias("text"))
        fresh = first.join(self.table.read().select(F.unhex("digest").alias("_key")), "_key", "left_anti")
        return fresh.select(F.lower(F.hex("_key")).alias("digest"), "text")

    def encode(self, texts: DataFrame, partitions: int | None = None) -> DataFrame:
        """`texts` with `vector`, null for a null text; new results are stored first.

        New texts come dealt by digest, so that no task gets all long ones (`partitions` deals them anew), and are
        sorted by length inside, so that the texts of a model's batch are of about one length and need little
        padding.
        """
        fresh = staged(self.missing(texts))
        if not fresh.isEmpty():
            dealt = fresh.repartition(partitions, "digest") if partitions else fresh
            ordered = dealt.sortWithinPartitions(F.length("text"), "digest")
            self.table.upsert(ordered.select("digest", encode(F.col("text"), self.model, self.batch).alias("vector")), unique=True)
        stored = self.table.read().select(F.unhex("digest").alias("_key"), "vector")
        return texts.withColumn("_key", F.unhex(F.sha2("text", 256))).join(stored, "_key", "left").drop("_key")
