"""Relations stored in Spark's own buckets, so that joins on the bucket key need no exchange.

All relations of one store are cut by the same key into the same number of buckets and sorted by their
own key inside. Spark reads a bucket per task, so sentences, documents and scores of a document meet where they
are read: neither side is shuffled, and each bucket is one sorted file, so neither is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filing_signals.operators.upsert import conform
from filing_signals.schemas import Relation

#: Lets a scan of one sorted file per bucket report its order, so that merge joins do not sort again.
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
#: Without it the planner drops buckets where it sees no use for them below an outer plan.
_AUTO = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
#: Off, joins on the bucket key and further keys use the buckets too; on, both sides are shuffled by all keys.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: Drops what a statement shuffled when it ends, rather than when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Copartitioned:
    """Relations under one folder, all in `buckets` buckets of `key`, named `prefix_relation` in the catalog.

    A hot key makes a large bucket; AQE cannot split it, since nothing is shuffled. `buckets` should give
    files of some hundred MB.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "doc_id", buckets: int = 64, prefix: str = "by_doc"):
        self.spark, self.root, self.key, self.buckets, self.prefix = spark, root.rstrip("/"), key, buckets, prefix

    def name(self, relation: Relation) -> str:
        return f"{self.prefix}_{relation.name}"

    def store(self, df: DataFrame, relation: Relation, dealt: bool = False) -> DataFrame:
        """Replace a relation. One exchange deals rows to buckets, and a bucket is written as one file.

        `dealt` says that the rows come from a relation of this store by steps that leave a row in its bucket's task:
        they are not dealt again. Rows that lie elsewhere still go to their bucket, which then has several files.
        """
        order = [self.key, *[k for k in relation.keys if k != self.key]]
        rows = conform(df, relation)
        rows = rows if dealt else rows.repartition(self.buckets, self.key)
        before = self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            (
                rows.write.mode("overwrite").format("parquet")
                .bucketBy(self.buckets, self.key).sortBy(*order)
                .option("path", f"{self.root}/{relation.name}")
                .saveAsTable(self.name(relation))
            )
        finally:
            self.spark.conf.set(_CLEANUP, before)
        return self.read(relation)

    def open(self, relation: Relation) -> DataFrame:
        """Declare a relation that an earlier session stored, and read it."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in relation.schema)
        order = ", ".join([self.key, *[k for k in relation.keys if k != self.key]])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(relation)} ({columns}) USING parquet "
            f"CLUSTERED BY ({self.key}) SORTED BY ({order}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.root}/{relation.name}'"
        )
        return self.read(relation)

    def read(self, relation: Relation) -> DataFrame:
        for name, value in ((_ORDERED, "true"), (_AUTO, "false"), (_ALL_KEYS, "false")):
            self.spark.conf.set(name, value)
        return self.spark.table(self.name(relation))

    def joined(self, left: Relation, right: Relation, how: str = "inner") -> DataFrame:
        """Rows of two relations with equal values in the keys they have in common, the bucket key first."""
        keys = [self.key, *[k for k in left.keys if k in right.keys and k != self.key]]
        return self.read(left).join(self.read(right).hint("merge"), keys, how)
