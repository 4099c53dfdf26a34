"""One query per operator of this package, over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_signals.functions.text import bind
from filing_signals.llm import (
    chunk_dedup,
    decontamination,
    fingerprints,
    hard_negatives,
    html_extraction,
    jaccard_join,
    license_scan,
    line_dedup,
    packing,
    repetition,
    resampling,
    secret_scan,
    toxicity,
)
from filing_signals.llm.staging import Stage
from filing_signals.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pieces(read(spark, sf_dir, "documents"), word_tokenizer())
    digests = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.numbered(Stage(spark, "packing").keep(digests, "pieces"))


@query
def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judged(repetition.repetition(read(spark, sf_dir, "documents")))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(read(spark, sf_dir, "documents"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("row.text", 256).alias("kept_sha256"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir, "documents"))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(read(spark, sf_dir, "documents"))

    def outputs(spans: Column) -> Column:
        base = F.filter(spans, lambda s: s["kind"] < 3)
        count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
        return F.struct(
            *(count(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS[:3])),
            F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
            secret_scan.written(spans).alias("spans"),
        )

    return found.select("doc_id", bind(F.col("secrets"), outputs).alias("out")).select("doc_id", "out.*")


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.extract(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(read(spark, sf_dir, "documents"))


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(read(spark, sf_dir, "documents"))
