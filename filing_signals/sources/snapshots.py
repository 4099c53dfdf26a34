"""Tables as snapshot folders of parquet files, and the shared folder for staged results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from filing_signals.operators.upsert import cascade_delete, conform, require_unique, upsert
from filing_signals.schemas import Relation


def staging_folder(spark: SparkSession) -> str:
    """A new folder name under the cluster's `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/filing-signals-{uuid.uuid4().hex}"


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a result to the shared folder and read it back, which cuts its lineage.

    Used where a Python step or a long plan would otherwise run once per use.
    """
    folder = folder or staging_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a staged result that nothing reads again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class SnapshotTable:
    """A keyed relation stored as numbered snapshot folders, the highest finished one current.

    A change writes a new folder and never touches the one being read; a failed job leaves a
    folder without `_SUCCESS`, which is never read.
    """

    def __init__(self, spark: SparkSession, root: str, relation: Relation):
        self.spark, self.relation = spark, relation
        self.root = f"{root.rstrip('/')}/{relation.name}"

    def _files(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self) -> list[tuple[int, bool]]:
        fs, root = self._files(self.root)
        if not fs.exists(root):
            return []
        out = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("snapshot="):
                done = fs.exists(self._files(f"{self.root}/{name}/_SUCCESS")[1])
                out.append((int(name.split("=")[1]), bool(done)))
        return sorted(out)

    def _folder(self, version: int) -> str:
        return f"{self.root}/snapshot={version:08d}"

    def write(self, df: DataFrame) -> DataFrame:
        """Store `df` as the new current snapshot."""
        version = max((v for v, _ in self._versions()), default=0) + 1
        conform(df, self.relation).write.parquet(self._folder(version))
        return self.read()

    def create_if_missing(self) -> "SnapshotTable":
        if not any(done for _, done in self._versions()):
            self.write(self.spark.createDataFrame([], self.relation.schema))
        return self

    def read(self) -> DataFrame:
        done = [v for v, ok in self._versions() if ok]
        if not done:
            raise FileNotFoundError(f"no snapshot of {self.relation.name} under {self.root}")
        return self.spark.read.schema(self.relation.schema).parquet(self._folder(done[-1]))

    def upsert(
        self, incoming: DataFrame, replace_by: str | None = None, unique: bool = False
    ) -> DataFrame:
        """Merge rows by the relation's key; a key that comes twice raises before any change.

        Incoming rows are needed more than once, so they are staged: what makes them (scoring,
        say) runs once, and joins are planned from their true size. `unique=True` skips the key
        check where rows are unique by how they were made (a group-by on the key, a join of
        keyed tables). The first load has nothing to merge with and is written in place.
        """
        rows = conform(incoming, self.relation)
        if not any(done for _, done in self._versions()):
            return self.write(rows) if unique else self._first(rows)
        folder = staging_folder(self.spark)
        try:
            rows = staged(rows, folder)
            if not unique:
                require_unique(rows, self.relation.keys)
            return self.write(upsert(self.read(), rows, self.relation.keys, replace_by))
        finally:
            fs, path = self._files(folder)
            fs.delete(path, True)

    def _first(self, rows: DataFrame) -> DataFrame:
        """Store the first rows: written once, checked where they lie, and only then a finished snapshot."""
        folder = self._folder(max((v for v, _ in self._versions()), default=0) + 1)
        fs, path = self._files(folder)
        try:
            rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)
            require_unique(self.spark.read.schema(self.relation.schema).parquet(folder), self.relation.keys)
        except Exception:
            fs.delete(path, True)
            raise
        fs.create(self._files(f"{folder}/_SUCCESS")[1]).close()
        return self.read()

    def delete(self, keys: DataFrame, key: str) -> DataFrame:
        """Drop the rows whose `key` is among those of `keys`; the rest is a new snapshot."""
        return self.write(cascade_delete(self.read(), keys, key))
