"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashed single words, pairs of neighbours and pairs with one word between
them, each once. FTRL-proximal keeps a rate per coordinate and its L1 term leaves most weights at
exactly zero; those that stay are few, and are broadcast to score all texts in one narrow step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from filing_signals.llm.staging import Stage
from filing_signals.llm.words import byte_slices, mixed, split_words

#: Log-odds are held between this and its negative.
CERTAIN = 35.0
#: Bits of one of Spark's bitmaps.
_BITMAP = 1 << 15
FEATURES = "sample_key long, doc_id long, label int, features array<int>"


@dataclass(frozen=True)
class Settings:
    """`sample_rows` bounds the labelled rows that training reads; all else is independent of size.

    Hash buckets are 2^bits. `alpha`, `beta`, `l1` and `l2` are FTRL's rate and penalties. `epochs`, `alpha` and
    `l1` are those with most toxic rows found and no clean one rejected on two folds of labelled rows, those whose
    remainder is 1 and 2 (of epochs 2, 4, 8; alpha 0.5, 1; l1 4, 8, 12, 16): 139 of 178, and 0 of 1,392.
    """

    sample_rows: int = 24_576
    bits: int = 22
    epochs: int = 8
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 0.5
    #: A feature found in fewer sampled texts has nothing to say about others.
    least_texts: int = 5


def text_features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every feature of texts without nulls; a repeated one comes repeatedly.

    Words are runs of letters and digits, in lower case.
    """
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN\pM\s]+", " ")
    words = split_words(plain)
    h, rows = words.hashes(), words.rows
    at = [np.arange(len(h)), words.windows(2), words.windows(3)]
    keys = [
        mixed(h),
        mixed(h[at[1]] * np.uint64(0x9E3779B97F4A7C15) + h[at[1] + 1]) if len(at[1]) else h[:0],
        mixed(h[at[2]] * np.uint64(0xC2B2AE3D27D4EB4F) + h[at[2] + 2]) if len(at[2]) else h[:0],
    ]
    bucket = (np.concatenate(keys) >> np.uint64(64 - bits)).astype(np.int64)
    return np.concatenate([rows[a] for a in at]), bucket


def labelled_sample(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """Features of the sampled labelled texts, a row each; at most `s.sample_rows` rows.

    The sample is the distinct (id, text) with the smallest hashes of their id, so it does not depend on how the
    tables are stored, and an id that fills the table counts by its distinct texts. Labels of one document that
    differ count as toxic; null labels are no labels.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .where(~held_out("doc_id"))
        .select(F.xxhash64("doc_id").alias("sample_key"), "doc_id", "label")
        .orderBy("sample_key", "doc_id")
        .limit(s.sample_rows)
    )
    key = ["sample_key", "doc_id", "digest"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(known), "doc_id").withColumn("digest", F.xxhash64("text"))  # at most sample_rows small rows
    # equal rows combine on the map side, and the bound is on what is left, by keys alone
    chosen = rows.select(*key).distinct().orderBy(*key).limit(s.sample_rows)
    rows = rows.join(F.broadcast(chosen), key, "left_semi").groupBy(*key).agg(F.first("label").alias("label"), F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in byte_slices(batch.column(3)):
                owner, bucket = text_features(part, s.bits)
                pairs = np.unique((owner << s.bits) | bucket)
                offsets = np.searchsorted(pairs >> s.bits, np.arange(len(part) + 1))
                buckets = (pairs & ((1 << s.bits) - 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(buckets))
                here = [batch.column(i).slice(row, len(part)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*here, lists], names=["sample_key", "doc_id", "label", "features"])

    return rows.select("sample_key", "doc_id", "label", "text").mapInArrow(run, FEATURES)


def frequent(sample: DataFrame, s: Settings) -> np.ndarray:
    """Whether each bucket is found in enough rows of the sample: one bit each comes to the driver."""
    found = sample.select(F.explode("features").alias("bucket"))  # a row has each of its features once
    found = found.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") >= s.least_texts)
    # 2^15 buckets a row; the function counts numbers from 1
    number, place = F.bitmap_bucket_number(F.col("bucket") + 1), F.bitmap_bit_position(F.col("bucket") + 1)
    bits = np.zeros((-(-(1 << s.bits) // _BITMAP), _BITMAP), bool)
    for r in found.groupBy(number.alias("i")).agg(F.bitmap_construct_agg(place).alias("b")).collect():
        bits[r.i - 1] = np.unpackbits(np.frombuffer(r.b, np.uint8), bitorder="little")
    return bits.ravel()[: 1 << s.bits]


def with_frequent(sample: DataFrame, s: Settings) -> DataFrame:
    """(sample_key, doc_id, label, features) of a written sample with its frequent features alone."""
    sent = sample.sparkSession.sparkContext.broadcast(frequent(sample, s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            for a, b in row_runs(lists.offsets.to_numpy().astype(np.int64)):
                part = lists.slice(a, b - a)
                buckets = part.flatten().to_numpy()
                offsets = part.offsets.to_numpy().astype(np.int64)
                kept = sent.value[buckets]
                ends = np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]]
                fewer = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(buckets[kept]))
                here = [batch.column(i).slice(a, b - a) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*here, fewer], names=["sample_key", "doc_id", "label", "features"])

    return sample.mapInArrow(run, FEATURES)


def row_runs(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows with about `most` features, at least one row each."""
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end
        row = end


def compacted(parts: list[tuple[np.ndarray, np.ndarray]], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, offsets, used): all rows' features as places in `used`, the buckets found in enough rows.

    `parts` are (buckets, offsets) of some rows each; they are taken out one by one, and looked at some rows
    at a time, so that the sample is held once.
    """
    texts = np.zeros(1 << s.bits, np.int32)
    for buckets, _ in parts:
        for a in range(0, len(buckets), 1 << s.bits):
            texts += np.bincount(buckets[a : a + (1 << s.bits)], minlength=1 << s.bits).astype(np.int32)  # a row has each of its features once
    used = np.flatnonzero(texts >= s.least_texts)
    place = np.full(1 << s.bits, -1, np.int32)
    place[used] = np.arange(len(used))
    found, ends = np.zeros(int(texts[used].sum(dtype=np.int64)), np.int32), [np.zeros(1, np.int64)]
    while parts:
        buckets, offsets = parts.pop(0)
        for a, b in row_runs(offsets):
            at = place[buckets[offsets[a] : offsets[b]]]
            kept = at >= 0
            before = np.concatenate([[0], np.cumsum(kept)]) + ends[-1][-1]
            found[before[0] : before[-1]] = at[kept]
            ends.append(before[offsets[a + 1 : b + 1] - offsets[a]])
    return found, np.concatenate(ends), used


def ftrl(parts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) with all weights that are not zero. One pass per epoch, in order."""
    if not len(labels):
        return np.zeros(0, np.int64), np.zeros(0), -CERTAIN  # nothing is known to be toxic
    places, offsets, used = compacted(parts, s)
    rows = [places[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    z, n = np.zeros(len(used) + 1), np.zeros(len(used) + 1)  # the last place is the bias
    rate = lambda n: (s.beta + np.sqrt(n)) / s.alpha

    def weights(z, n):
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / (rate(n) + s.l2))

    for _ in range(s.epochs):
        for x, y in zip(rows, labels):
            at = np.append(x, len(used))
            zx, nx = z[at], n[at]
            w = weights(zx, nx)
            w[-1] = -zx[-1] / (rate(nx[-1]) + s.l2)  # the bias has no L1 term
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -CERTAIN, CERTAIN))) - y
            after = nx + g * g
            z[at] = zx + g - (rate(after) - rate(nx)) * w
            n[at] = after
    w = weights(z, n)[:-1]
    kept = np.flatnonzero(w)
    return used[kept].astype(np.int64), w[kept], float(-z[-1] / (rate(n[-1]) + s.l2))


def train(sample: DataFrame, s: Settings) -> list[tuple[int, float]]:
    """(bucket, weight) pairs, the bias under bucket -1.

    FTRL is a sequential method, so the bounded sample's frequent features meet in one task, in the order of
    the sample key. They are counted and the others left out before, in many tasks, from the written sample.
    """
    stage = Stage(sample.sparkSession, "toxicity")
    sample = with_frequent(stage.keep(sample, "sample"), s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        labels: list[np.ndarray] = []
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            parts.append((lists.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]))
            labels.append(batch.column(0).to_numpy(zero_copy_only=False))
        bucket, weight, bias = ftrl(parts, np.concatenate([np.zeros(0), *labels]), s)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(bucket, -1)), pa.array(np.append(weight, bias))], names=["bucket", "weight"]
        )

    one = sample.repartition(1).sortWithinPartitions("sample_key", "doc_id", F.xxhash64("features"))
    fitted = one.select("label", "features").mapInArrow(run, "bucket long, weight double")
    found = [(r.bucket, r.weight) for r in fitted.collect()]  # at most one row per bucket of the table
    stage.drop("sample")
    return found


def score(docs: DataFrame, fitted: list[tuple[int, float]], bits: int, carry: bool = False) -> DataFrame:
    """Every row's `doc_id` and `score`; a null or empty text has the score of the bias alone.

    With `carry`, the whole input row comes along as the struct `row`.
    """
    bias = sum(w for b, w in fitted if b < 0) if fitted else -CERTAIN  # nothing was learnt
    ordered = sorted((b, w) for b, w in fitted if b >= 0)
    sent = docs.sparkSession.sparkContext.broadcast(  # at most 2^bits pairs, whatever the corpus
        (np.array([b for b, _ in ordered], np.int64), np.array([w for _, w in ordered], float))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, weights = sent.value
        has_weight = np.zeros(1 << bits, bool)
        has_weight[buckets] = True
        for batch in batches:
            whole = batch.column(1)
            for row, part in byte_slices(whole.field("text") if carry else whole):
                owner, bucket = text_features(part, bits)
                hit = has_weight[bucket]
                pairs = np.unique((owner[hit] << bits) | bucket[hit])
                found = weights[np.searchsorted(buckets, pairs & ((1 << bits) - 1))] if len(pairs) else np.zeros(0)
                total = bias + np.bincount(pairs >> bits, found, len(part))
                p = 1.0 / (1.0 + np.exp(-np.clip(total, -CERTAIN, CERTAIN)))
                out = {"doc_id": batch.column(0).slice(row, len(part)), "score": pa.array(p)}
                if carry:
                    out["row"] = whole.slice(row, len(part))
                yield pa.RecordBatch.from_pydict(out)

    second = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row") if carry else F.col("text")
    given = docs.select(F.col("doc_id").cast("long"), second)
    schema = StructType().add("doc_id", "long").add("score", "double")
    return given.mapInArrow(run, schema.add(given.schema["row"]) if carry else schema)


def held_out(doc_id: str):
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), carry: bool = False) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` of every row of `docs`, and `row` with `carry`.

    Learns from `labels.toxic` of rows that are not held out, at most `s.sample_rows` of them; the
    label table is read at once, when this is called. Without labels no text is
    toxic, and every score is next to 0. A null or
    empty text has the score of the bias alone; a row without an id is scored and never learnt from. Rows that repeat
    are scored alike and learnt from once; long texts are read whole; an empty table gives no rows. Only
    `doc_id` and `text` of the documents are read, unless they are carried, and only the text makes the score.
    """
    fitted = train(labelled_sample(docs, labels, s), s)
    return (
        score(docs, fitted, s.bits, carry)
        .withColumn("held_out", held_out("doc_id"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
