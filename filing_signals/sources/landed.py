"""Landed inputs: CSV tables, filing-index JSON, ticker-map JSON and filing files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.functions.text import decode_tolerant
from filing_signals.schemas import FILING_INDEX, TICKER_MAP


_CORRUPT = "_corrupt_record"


class MissingColumns(ValueError):
    """An input lacks columns a stage needs."""


def require_columns(df: DataFrame, needed: list[str], where: str = "input") -> DataFrame:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise MissingColumns(f"{where} lacks columns: {missing}")
    return df


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """CSV with a header and doubled quotes, under declared types.

    Only an empty field reads as null: words such as NA or null stay texts. The header is
    checked against the schema, as Spark binds CSV columns by position. A file
    with line breaks inside quotes cannot be split, so each is one task; pass
    `multi_line=False` for tables whose texts hold none (cleaned sentences, manifests).
    """
    options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    header = spark.read.options(**options).csv(path)
    require_columns(header, schema.fieldNames(), path)
    by_name = {f.name: f for f in schema}
    ordered = T.StructType([by_name.get(c, T.StructField(c, T.StringType())) for c in header.columns])
    df = spark.read.options(**options, multiLine=multi_line).schema(ordered).csv(path)
    return df.select(*schema.fieldNames())


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, minimal quoting, doubled quotes and '\\n' line ends; one file per task."""
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def filing_index_rows(df: DataFrame, json: str = "json") -> tuple[DataFrame, DataFrame]:
    """One row per filing from index documents that hold parallel arrays; and the rejects.

    A document without filings, a null or an empty one gives no rows. One that is not JSON, and one
    whose arrays differ in length and so cannot be lined up, go to the rejects whole.
    """
    schema = f"{FILING_INDEX}, {_CORRUPT} string"
    read = F.from_json(F.col(json), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    names = ["form", "filingDate", "accessionNumber", "primaryDocument"]
    # Through a one-element array, so that each document is parsed once.
    parsed = df.select("*", F.explode(F.array(read)).alias("_read"))
    recent = F.col("_read")["filings"]["recent"]
    sizes = F.array(*[F.coalesce(F.size(recent[n]), F.lit(-1)) for n in names])
    ragged = recent.isNotNull() & (F.array_min(sizes) != F.array_max(sizes))
    filled = F.coalesce(F.trim(F.col(json)) != "", F.lit(False))
    rejected = filled & (F.col("_read")[_CORRUPT].isNotNull() | ragged)
    rest = [c for c in df.columns if c != json]
    rows = parsed.filter(~rejected).select(
        *rest, F.inline(F.arrays_zip(*[recent[n].alias(n) for n in names])).alias(*names)
    )
    return rows, parsed.filter(rejected).drop("_read")


def ticker_map_rows(df: DataFrame, json: str = "json") -> DataFrame:
    """(ticker, cik_num) rows from ticker-map documents, objects of {ticker, cik_str}."""
    entries = df.select(F.explode(F.map_values(F.from_json(F.col(json), TICKER_MAP))).alias("e"))
    return entries.select("e.ticker", F.col("e.cik_str").cast("long").alias("cik_num"))


#: Folders over which files of their own are dealt, so that they are listed in as many tasks.
SHARDS = 256
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def shard_of(name: Column) -> Column:
    """The folder of a name, from its checksum; null for a null name."""
    return F.concat(F.lit("shard="), (F.crc32(name.cast("string").cast("binary")) % SHARDS).cast("string"))


def land(df: DataFrame, folder: str, name: str, text: str, overwrite: bool = False) -> None:
    """Write each row's text and a line end to `folder/shard=…/name=…/`, one file per name and task.

    `overwrite` drops what lies there under the incoming names first. Tasks write plain files where they
    can reach the folder as a path: a committer's temporary folders and renames cost many times the
    file itself, and its last step is one loop over all of them. Elsewhere Spark's writer is used.
    """
    named = F.coalesce(F.col(name).cast("string"), F.lit(_NO_NAME))
    rows = df.select(shard_of(named).alias("shard"), named.alias("name"), F.col(text).alias("text"))
    where = urlparse(folder)
    if where.scheme not in ("", "file"):
        plain = rows.select(F.regexp_replace("shard", "^shard=", "").alias("shard"), F.col("name").alias(name), "text")
        writer = plain.write.mode("overwrite" if overwrite else "append").partitionBy("shard", name)
        writer.option("partitionOverwriteMode", "dynamic").text(folder)
        return
    root = unquote(where.path) if where.scheme else folder

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = pafs.LocalFileSystem()
        for batch in batches:
            for shard, key in zip(*(c.to_pylist() for c in batch.columns)):
                if fs.get_file_info(at := f"{root}/{shard}/{name}={key}").type != pafs.FileType.NotFound:
                    fs.delete_dir(at)
            yield pa.record_batch({"n": [batch.num_rows]})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, part, made = pafs.LocalFileSystem(), TaskContext.get().partitionId(), ""
        for batch in batches:
            for shard, key, said in zip(*(c.to_pylist() for c in batch.columns)):
                at = f"{root}/{shard}/{name}={key}"
                path = f"{at}/part-{run}-{part:05d}.txt"
                if at != made:  # rows are sorted, so this is the first of its name
                    fs.create_dir(made := at)
                    stream = fs.open_output_stream(path)
                else:
                    stream = fs.open_append_stream(path)
                with stream:
                    stream.write(f"{said or ''}\n".encode())
            yield pa.record_batch({"n": [batch.num_rows]})

    if overwrite:
        # Names are small, so that a number of tasks of its own keeps AQE from putting them all into one.
        names = rows.select("shard", "name").repartition(4 * df.sparkSession.sparkContext.defaultParallelism, "shard", "name")
        names.distinct().mapInArrow(drop, "n long").agg(F.sum("n")).collect()
    run = uuid.uuid4().hex[:8]
    rows.sortWithinPartitions("shard", "name").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def plain_path(path):
    """Path without its URI scheme and authority, as a manifest writes it."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")


def gathered(files: DataFrame, splits: int = 64) -> DataFrame:
    """A scan of many small files with `splits` of its splits in a task. Spark counts some MB for opening a
    file, so its own splits hold a few each, and tasks cost more than what they do. A cluster's cores stay busy
    where there are fewer files."""
    least = 4 * files.sparkSession.sparkContext.defaultParallelism
    return files.coalesce(max(least, files.rdd.getNumPartitions() // splits))


def landed_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """One row per file under `root`: file_path and its text, invalid UTF-8 bytes dropped.

    `content` is read only if the text is used: a path-only scan lists files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return gathered(files).select(
        plain_path(F.col("path")).alias("file_path"), decode_tolerant(F.col("content")).alias("text")
    )


def match_manifest(
    manifest: DataFrame, files: DataFrame, broadcast: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Manifest rows with their file's columns, and the manifest rows without a file.

    `broadcast` hands a manifest of checked size to the scan of the files. Without it, reduce `files`
    to what is needed (text taken from HTML, say) before the call: what it holds is what a large
    manifest makes the join shuffle.
    """
    keyed = manifest.withColumn("file_path", plain_path(F.col("file_path")))
    found = files.join(F.broadcast(keyed) if broadcast else keyed, "file_path")
    missing = keyed.join(files.select("file_path"), "file_path", "left_anti")
    return found, missing
