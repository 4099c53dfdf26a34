"""Stored tables in hash buckets of their key, where a change writes only the buckets it touches.

`version=00000003/bucket=17/*.parquet` holds all rows of bucket 17 as of version 3. The current table is
the newest finished folder of every bucket, so a batch costs the buckets its keys fall into, whatever
the size of the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_signals.operators.upsert import cascade_delete, conform, require_unique, upsert
from filing_signals.schemas import Relation
from filing_signals.sources.snapshots import staged, staging_folder

BUCKET = "bucket"


def bucket_of(columns: list[str], buckets: int) -> Column:
    """The bucket of a row, from the md5 of its key columns as text, so that any engine can follow it."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    digits = F.substring(F.md5(text.cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % buckets).cast("int")


class BucketTable:
    """A keyed relation in `buckets` buckets of `by`, some of its key columns (all by default).

    Versions are finished by their `_SUCCESS` file. A job that fails leaves a version that is never
    read, and no version that is being read is changed. One writer at a time, as for any keyed merge.
    """

    def __init__(
        self, spark: SparkSession, root: str, relation: Relation, buckets: int = 64, by: list[str] | None = None
    ):
        self.spark, self.relation, self.buckets = spark, relation, buckets
        self.by = by or relation.keys
        if not set(self.by) <= set(relation.keys):
            raise ValueError(f"buckets of {relation.name} must go by its key columns")
        self.root = f"{root.rstrip('/')}/{relation.name}"

    # -- folders -------------------------------------------------------------------------------

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, folder: str, prefix: str) -> list[int]:
        fs, p = self._path(folder)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))

    def _version(self, version: int) -> str:
        return f"{self.root}/version={version:08d}"

    def _folder(self, version: int, bucket: int) -> str:
        return f"{self._version(version)}/{BUCKET}={bucket}"

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        found = self._children(self.root, "version=")
        fs, _ = self._path(self.root)
        return [v for v in found if fs.exists(self._path(f"{self._version(v)}/_SUCCESS")[1])]

    def rewritten(self, version: int) -> list[int]:
        """The buckets that a version wrote."""
        return self._children(self._version(version), f"{BUCKET}=")

    def layout(self, upto: int | None = None) -> dict[int, int]:
        """The version that holds each bucket, as of version `upto`."""
        out: dict[int, int] = {}
        for v in self.versions():
            if upto is None or v <= upto:
                out |= dict.fromkeys(self.rewritten(v), v)
        return out

    # -- reading and writing -------------------------------------------------------------------

    def read(self, only: Iterable[int] | None = None, upto: int | None = None) -> DataFrame:
        """All rows, or those of some buckets; a table never written is empty."""
        layout = self.layout(upto)
        wanted = sorted(set(layout) if only is None else set(layout) & set(only))
        paths = [self._folder(layout[b], b) for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.relation.schema)
        return self.spark.read.schema(self.relation.schema).parquet(*paths)

    def find(self, *key: str) -> DataFrame:
        """Rows of one value of the bucket columns: one bucket is read."""
        row = self.spark.range(1).select(*[F.lit(k).alias(c) for c, k in zip(self.by, key)])
        bucket = row.select(bucket_of(self.by, self.buckets)).first()[0]
        rows = self.read([bucket])
        for c, k in zip(self.by, key):
            rows = rows.where(F.col(c) == k)
        return rows

    def write(self, rows: DataFrame, touched: Iterable[int], version: int | None = None) -> DataFrame:
        """Store `rows` as the whole content of the touched buckets, in a new version.

        A bucket is written by one task, or by several where it is large. One that lost all its rows
        is kept as an empty folder, so that its earlier rows do not come back.
        """
        version = version or max(self._children(self.root, "version="), default=0) + 1
        placed = rows.withColumn(BUCKET, bucket_of(self.by, self.buckets)).hint("rebalance", BUCKET)
        fs, folder = self._path(self._version(version))
        placed.write.partitionBy(BUCKET).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
            self._version(version)
        )
        for bucket in set(touched) - set(self.rewritten(version)):
            fs.mkdirs(self._path(self._folder(version, bucket))[1])
        fs.create(self._path(f"{self._version(version)}/_SUCCESS")[1]).close()
        return self.read()

    def upsert(
        self,
        incoming: DataFrame,
        replace_by: str | None = None,
        unique: bool = False,
        before: Callable[[DataFrame, DataFrame], None] | None = None,
        version: int | None = None,
    ) -> DataFrame:
        """Merge rows by key, reading and writing the buckets of incoming keys only.

        `replace_by` drops every stored row of an incoming value and must be a bucket column. A key that
        comes twice raises before any change; `unique=True` skips that check. `before` is handed the
        staged incoming rows and the stored rows that they replace, before anything is written. An empty
        batch writes no version.
        """
        if replace_by is not None and [replace_by] != self.by:
            raise ValueError(f"rows of one {replace_by} lie in several buckets")
        folder = staging_folder(self.spark)
        try:
            rows = staged(conform(incoming, self.relation), folder)
            touched = [r[0] for r in rows.select(bucket_of(self.by, self.buckets)).distinct().collect()]
            if not touched:
                return self.read()
            if not unique:
                require_unique(rows, self.relation.keys)
            stored = self.read(touched)
            if before is not None:
                keys = [replace_by] if replace_by else self.relation.keys
                before(rows, stored.join(rows.select(*keys).distinct(), keys, "left_semi"))
            return self.write(upsert(stored, rows, self.relation.keys, replace_by), touched, version)
        finally:
            fs, path = self._path(folder)
            fs.delete(path, True)

    def delete(self, keys: DataFrame, key: str) -> DataFrame:
        """Drop the rows whose `key` is among those of `keys`; only their buckets are written anew when
        `key` is the bucket column, else all."""
        gone = staged(keys.select(key).distinct())
        own = [key] == self.by
        touched = [r[0] for r in gone.select(bucket_of([key], self.buckets)).distinct().collect()] if own else list(self.layout())
        return self.write(cascade_delete(self.read(touched), gone, key), touched) if touched else self.read()

    def keep_last(self, n: int) -> int:
        """Remove what no one of the last `n` versions reads, and unfinished older ones; the number of
        folders removed. A version that still holds a bucket's newest rows stays for that bucket."""
        done = self.versions()
        if n < 1 or not done:
            return 0
        used = {(v, b) for upto in done[-n:] for b, v in self.layout(upto).items()}
        removed = 0
        for v in self._children(self.root, "version="):
            if v > done[-1]:
                continue
            held = self.rewritten(v)
            drop = [b for b in held if (v, b) not in used or v not in done]
            paths = [self._version(v)] if len(drop) == len(held) and v not in done[-n:] else [self._folder(v, b) for b in drop]
            for path in paths:
                fs, p = self._path(path)
                fs.delete(p, True)
            removed += len(drop)
        return removed
