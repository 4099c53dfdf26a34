"""What has landed since last time: a stored inventory of files, and its difference from a new listing."""

from __future__ import annotations

import errno
import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.schemas import Relation
from filing_signals.sources.landed import gathered, plain_path
from filing_signals.sources.snapshots import SnapshotTable, staged, staging_folder

INVENTORY = Relation(
    "landed_inventory",
    T.StructType(
        [
            T.StructField("file_path", T.StringType(), False),
            T.StructField("length", T.LongType(), False),
            T.StructField("modified", T.TimestampType(), False),
        ]
    ),
    ["file_path"],
)
NEW, CHANGED, GONE = "new", "changed", "gone"


#: Entries that a task follows below one folder; folders still to be seen then are dealt out again.
WALK = 20_000
_ENTRY = "file_path string, is_folder boolean, length long, modified long"


def _local_folders(spark: SparkSession, root: str) -> list[str]:
    """Plain paths of the folders that `root` names, if all it names are folders of the local file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        return []
    named = list(fs.globStatus(path) or [])
    return [s.getPath().toUri().getPath() for s in named] if all(s.isDirectory() for s in named) else []


def _walked(spark: SparkSession, folders: list[str], pattern: str) -> DataFrame:
    """Files under `folders`, seen by the tasks in rounds: what Spark's file sources would list, with the same
    hidden names left out."""
    glob, most = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern(), WALK

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = re.compile(glob, re.DOTALL).fullmatch

        def below(top: str) -> Iterator[tuple]:
            left, n = [top], 0
            while left:
                at = left.pop()
                if n >= most:
                    yield at, True, None, None
                    continue
                with os.scandir(at) as entries:
                    for entry in entries:
                        n, name = n + 1, entry.name
                        hidden = name[0] == "." or name.endswith("._COPYING_") or name[0] == "_" and "=" not in name
                        if hidden and not name.startswith(("_metadata", "_common_metadata")):
                            continue
                        try:
                            is_folder = entry.is_dir()
                            is_ = None if is_folder else entry.stat()
                        except OSError as e:  # gone meanwhile, or a link to nothing
                            if e.errno not in (errno.ENOENT, errno.ELOOP):
                                raise
                            continue
                        if is_folder and n < most:
                            left.append(entry.path)
                        elif is_folder:
                            yield entry.path, True, None, None
                        elif not hidden and is_.st_size and wanted(name):
                            yield entry.path, False, is_.st_size, is_.st_mtime_ns // 10**6 * 1000

        found = (row for batch in batches for top in batch.column(0).to_pylist() for row in below(top))
        while rows := list(itertools.islice(found, 4096)):
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
            names = ["file_path", "is_folder", "length", "modified"]
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

    folder, rounds = staging_folder(spark), []
    left = spark.createDataFrame([(f,) for f in folders], "file_path string").coalesce(1)
    while not rounds or not left.isEmpty():
        rounds.append(f"{folder}/{len(rounds)}")
        left = staged(left.mapInArrow(walk, _ENTRY), rounds[-1]).where("is_folder").select("file_path")
        left = left.repartition(4 * spark.sparkContext.defaultParallelism, "file_path")
    files = spark.read.schema(_ENTRY).parquet(*rounds).where("NOT is_folder")
    return files.select("file_path", "length", F.timestamp_micros("modified").alias("modified"))


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(file_path, length, modified) of the files under `root`. Contents are not read; empty files are left out.

    Folders that tasks can reach as a path are walked by the tasks, and what they saw is staged: the driver holds
    no status of a file, and every use of the listing has the same rows. Elsewhere Spark's file source lists,
    which holds the status of every file in the driver.
    """
    if folders := _local_folders(spark, root):
        return _walked(spark, folders, pattern)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    )
    seen = files.select(plain_path(F.col("path")).alias("file_path"), "length", F.col("modificationTime").alias("modified"))
    return gathered(seen, 512)


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(file_path, change) of files that are new, changed (another length or time) or gone; one join by path."""
    b, n = before.alias("b"), now.alias("n")
    both = b.join(n, F.col("b.file_path") == F.col("n.file_path"), "full")
    differs = (F.col("b.length") != F.col("n.length")) | (F.col("b.modified") != F.col("n.modified"))
    change = (
        F.when(F.col("b.file_path").isNull(), NEW).when(F.col("n.file_path").isNull(), GONE).when(differs, CHANGED)
    )
    return both.select(F.coalesce("n.file_path", "b.file_path").alias("file_path"), change.alias("change")).where(
        "change IS NOT NULL"
    )


class Inventory:
    """The stored listing. `look` says what changed; `accept` stores the listing that `look` saw, once the
    work on the changes is done, so that a failed job finds them again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = SnapshotTable(spark, root, INVENTORY).create_if_missing()

    def look(self, now: DataFrame) -> DataFrame:
        return changes(self.table.read(), now)

    def accept(self, now: DataFrame) -> DataFrame:
        return self.table.write(now)
