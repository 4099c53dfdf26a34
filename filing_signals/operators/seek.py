"""Seek pages: the rows after a key, from the few sorted files that can hold them.

A page by offset costs what lies before it. Here a page token is the last key of the page before, and a
small index of each file's first and last key and its rows says which files hold the next rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



class SortedTable:
    """Rows in order of `keys` (whole numbers or strings, none missing) over files in `root`."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys

    def store(self, df: DataFrame, files: int | None = None) -> SortedTable:
        """Write `df` in order, with its index. A file is one range of keys; equal keys are together."""
        ordered = df.repartitionByRange(files, *self.keys) if files else df.repartitionByRange(*self.keys)
        ordered.sortWithinPartitions(*self.keys).write.parquet(f"{self.root}/rows")
        rows = self.spark.read.parquet(f"{self.root}/rows")
        key = F.struct(*self.keys)
        index = rows.groupBy(F.input_file_name().alias("file")).agg(
            F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n")
        )
        index.coalesce(1).write.parquet(f"{self.root}/index")
        return self

    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/index")

    def _after(self, token: str | None, prefix: str = "") -> Column:
        """Whether the key comes after the token's; all do without one."""
        out = F.lit(token is None)
        if token is not None:
            same = F.lit(True)
            for k, v in zip(self.keys, json.loads(token)):
                out, same = out | same & (F.col(prefix + k) > F.lit(v)), same & (F.col(prefix + k) == F.lit(v))
        return out

    def files_for(self, token: str | None, limit: int) -> list[str]:
        """Files that can hold the next `limit` rows: those that end after the token, in order, until the
        rows of all but the first of them suffice."""
        found = self.index().where(self._after(token, "last.")).orderBy("first", "file")
        out, rows = [], 0
        # as many as can be needed at most: each file but the first adds its rows
        for r in found.limit(limit + 1).collect():
            out.append(r["file"])
            rows += r["n"] if len(out) > 1 else 0
            if rows >= limit:
                break
        return out

    def page(self, token: str | None = None, limit: int = 1000) -> DataFrame:
        """The next `limit` rows in order of the keys, from the files that can hold them.

        The filter on the first key reaches the scan, which skips the row groups before it.
        """
        files = self.files_for(token, limit)
        rows = self.spark.read.parquet(f"{self.root}/rows") if not files else self.spark.read.parquet(*files)
        at_least = F.lit(True) if token is None else F.col(self.keys[0]) >= F.lit(json.loads(token)[0])
        found = rows.where(at_least & self._after(token)) if files else rows.where("false")
        return found.orderBy(*self.keys).limit(limit)

    def token(self, page: DataFrame) -> str | None:
        """The token of the page after this one; None after an empty page."""
        last = page.agg(F.max(F.struct(*self.keys)).alias("k")).first()["k"]
        return None if last is None else json.dumps([last[k] for k in self.keys])


