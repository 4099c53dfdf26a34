"""Importance resampling of documents towards a target distribution, on Arrow kernels.

Texts are put in lower case, split and flattened by Arrow, and words dictionary-encoded; n-grams are
pairs of dictionary indices, shifted against each other, so that only distinct n-grams of a batch are
spelled out and hashed to buckets. Two passes run over the documents: one counts buckets in the corpus
and in the target, the other takes each feature's gain, the log ratio of its bucket's shares, and sums
gains per document. Gumbel noise that follows from the id alone turns the top scores into a sample
without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.llm.staging import Stage
from filing_signals.llm.words import byte_slices, sums

#: What stands between words, which are runs of letters and digits after lower-casing, and of all
#: characters outside ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

COUNTS = "bucket int, n long"
WEIGHTS = "doc_id long, n_words long, n_features long, weight long"
#: `monotonically_increasing_id` holds the partition above this many bits.
_PLACE_BITS = 33


@dataclass(frozen=True)
class Settings:
    longest: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


@dataclass
class Features:
    """buckets[offsets[i]:offsets[i+1]] are the buckets of row i's n-grams, for each length of them."""

    n_words: np.ndarray
    by_length: list[tuple[np.ndarray, np.ndarray]]


def _crc_buckets(grams: pa.Array, buckets: int) -> np.ndarray:
    values = grams.cast(pa.binary()).to_pylist()
    return np.fromiter((zlib.crc32(v) % buckets for v in values), np.int64, len(values))


def hashed(texts: pa.Array, s: Settings) -> Features:
    """Buckets of all n-grams of texts without nulls."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    flat = pc.list_flatten(lists)
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets -= offsets[0]
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # '' at an end, or an empty text
    kept = np.concatenate([[0], np.cumsum(filled)])
    offsets, flat = kept[offsets], flat.filter(pa.array(filled))
    words = flat.dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    n_words = np.diff(offsets)
    row_end = np.repeat(offsets[1:], n_words)
    grams, at, dictionary = codes, np.arange(len(codes)), words.dictionary
    found = [(_crc_buckets(dictionary, s.buckets)[grams], offsets)]
    for n in range(2, s.longest + 1):
        fits = at + n <= row_end[at]  # the n-gram from here ends in its text
        at, grams = at[fits], grams[fits]
        pair, grams = np.unique(grams * max(len(words.dictionary), 1) + codes[at + n - 1], return_inverse=True)
        first, second = np.divmod(pair, max(len(words.dictionary), 1))
        dictionary = pc.binary_join_element_wise(
            dictionary.take(pa.array(first)), words.dictionary.take(pa.array(second)), " "
        )
        ends = np.concatenate([[0], np.cumsum(np.maximum(n_words - n + 1, 0))])
        found.append((_crc_buckets(dictionary, s.buckets)[grams], ends))
    return Features(n_words, found)


def bucket_counts(texts: DataFrame, s: Settings) -> np.ndarray:
    """Features per bucket over all rows of `texts`: as many numbers as there are buckets, at any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for batch in batches:
            for _, part in byte_slices(batch.column(0)):
                for buckets, _ in hashed(part, s).by_length:
                    total += np.bincount(buckets, minlength=s.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(s.buckets, np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares in target and corpus, each count plus one."""
    size = len(corpus)
    all_corpus, all_target = float(corpus.sum() + size), float(target.sum() + size)
    ratio = ((t + 1.0) * all_corpus / ((c + 1.0) * all_target) for c, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, s: Settings) -> DataFrame:
    """Words, features and summed gains of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in byte_slices(batch.column(1)):
                f = hashed(part, s)
                n = sum(np.diff(offsets) for _, offsets in f.by_length)
                weight = sum(sums(gain.take(buckets), offsets) for buckets, offsets in f.by_length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(n)), pa.array(f.n_words), pa.array(n), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, WEIGHTS)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 8 hex digits of a digest of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def ranked(scored: DataFrame, stage: Stage, percent: int) -> DataFrame:
    """Add `rank` to a written table: 1, 2, 3... by score, for the best `percent` of its rows.

    Rows are range-partitioned on all of their order, so a task takes a share of them whatever the
    scores, equal rows included, and a partition's size, one number each, gives the next its first rank.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    rows = scored.withColumn("_row", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    placed = stage.keep(placed.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", _PLACE_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    drawn = percent * placed.count() // 100
    rank = F.col("_first") + F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1) + 1
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(firsts), "_part")
        .withColumn("rank", F.when(rank <= drawn, rank).cast("long"))
        .drop("_at", "_part", "_first")
    )


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of `docs`.

    `rank` is null for rows not drawn: those of fewer than `least_words` words, and all but the best
    `percent` of the rest. Equal scores go by smaller id, then by any order among rows of one id, each of
    which is a document of its own. A null or empty text has no features and weighs 0. A row without
    an id is scored like the empty id and comes after equal scores. With an empty target, or a target of
    null texts, each bucket counts as seen once. Only `doc_id` and `text` are read, so no other name can
    clash; a text is worked on whole, however long. Jobs run, and two narrow tables are written to the
    shared folder, when this is called.
    """
    s = settings
    stage = Stage(docs.sparkSession, "resampling")
    gain = gains(bucket_counts(docs, s), bucket_counts(target, s))
    scored = weights(docs, gain, s).withColumn("score", F.col("weight") + noise(F.col("doc_id"), s.seed))
    scored = stage.keep(scored, "scored")
    enough = F.col("n_words") >= s.least_words
    drawn = ranked(scored.where(enough), stage, s.percent)
    return drawn.union(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
