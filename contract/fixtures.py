"""The driver's tables in the shape of the package's relations, as Spark frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_signals.operators.pairing import join_dimension
from filing_signals.plans import sentences as S
from filing_signals.session import ship

THEMES = [
    ("T1", "the and", " there with tion"),
    ("T2", "de la", "que, pour"),
    ("T3", "der die", "und, nicht"),
    ("T4", "in", None),
]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Shuffle a table only if its files give fewer splits than there are cores: text work is
    bound by the processor. A table of many files keeps its own splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def texts(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """(doc_id, text) of every document, `dealt` to all cores or as the files are split."""
    raw = table(spark, sf_dir, "documents", "doc_id", "text")
    raw = spread(raw, "doc_id") if dealt else raw
    return raw.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document rows: the source as company, dates spread over a week."""
    key = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents", "doc_id", "lang", "source").select(
        key.alias("doc_id"),
        F.col("source").alias("company_id"),
        F.upper("source").alias("ticker"),
        key.alias("cik"),
        F.col("lang").alias("source_type"),
        F.expr("date_add(DATE '2024-01-01', CAST(doc_id % 7 AS INT))").alias("date"),
        F.concat_ws("/", F.lit("filings"), "source", key).alias("file_path"),
    )


def sentences(spark: SparkSession, sf_dir: str, min_len: int = 20) -> DataFrame:
    return S.extract(texts(spark, sf_dir), min_len=min_len)


def themes(spark: SparkSession) -> DataFrame:
    ship(spark)
    return spark.createDataFrame(THEMES, "theme_id string, theme string, keywords string").coalesce(1)


def tones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, confidence): quality 1 positive, 0 negative, unlabelled neutral."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    quality = table(spark, sf_dir, "labels", "doc_id", "quality")
    q = F.col("quality")
    return docs.join(quality, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(q == 1, "POSITIVE").when(q == 0, "NEGATIVE").otherwise("NEUTRAL").alias("label"),
        F.when(q == 1, F.lit(0.9)).when(q == 0, F.lit(0.8)).otherwise(F.lit(0.5)).alias("confidence"),
    )


def toned_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with their document's tone, joined as long as a document is one row."""
    undealt = texts(spark, sf_dir, dealt=False)
    toned = join_dimension(texts(spark, sf_dir), tones(spark, sf_dir), ["doc_id"], undealt=undealt)
    return S.extract(toned, keep=["label", "confidence"])


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings: customer = company, priority = form, order key = accession."""
    key = F.format_string("%010d-%02d", "o_orderkey", F.expr("CAST(o_orderkey % 100 AS INT)"))
    return table(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"
    ).select(
        F.col("o_custkey").alias("cik_num"),
        F.col("o_orderpriority").alias("form"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("filingDate"),
        key.alias("accessionNumber"),
        F.concat(F.lit("doc"), F.col("o_orderkey").cast("string"), F.lit(".htm")).alias("primaryDocument"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector of each label, as theme vectors. Sums combine on the map side."""
    flat = vectors(spark, sf_dir).select("label", F.posexplode("embedding").alias("i", "x"))
    means = flat.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    packed = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy("label").agg(F.transform(packed, lambda e: e["x"]).alias("vector")).select(
        F.concat(F.lit("L"), F.col("label").cast("string")).alias("theme_id"), "vector"
    )
