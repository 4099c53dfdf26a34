"""A stored dictionary of token codes: each token of the corpus is coded once, ever.

Sentences meet their tokens' codes by a join. Tokens follow a steep law, so one shuffle of all of them would
put the commonest into one task: sentences lie in chunks of some MB, and a token is looked up once
for each chunk that has it, so the commonest is as many rows as there are chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.functions.phonetic import phonetic_code
from filing_signals.functions.words import split_words
from filing_signals.schemas import Relation
from filing_signals.sources.buckets import BucketTable
from filing_signals.sources.snapshots import staged

DICTIONARY = Relation(
    "token_codes",
    T.StructType([T.StructField("token", T.StringType(), False), T.StructField("code", T.StringType(), False)]),
    ["token"],
)
#: Bytes of text in a chunk, of which a task holds one at a time, and bytes that a row counts besides.
CHUNK_BYTES = 2 << 20
ROW_BYTES = 16


class CodeDictionary:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, heavy_share: float | None = None):
        """`heavy_share` is taken from earlier callers and has no effect: no token needs a way of its own."""
        self.table = BucketTable(spark, root, DICTIONARY, buckets)

    def learn(self, tokens: DataFrame) -> DataFrame:
        """Code those of distinct `tokens` that are not in the dictionary, and store them."""
        fresh = staged(tokens.select("token").join(self.table.read(), "token", "left_anti"))
        if not fresh.isEmpty():
            self.table.upsert(fresh.select("token", phonetic_code("token").alias("code")), unique=True)
        return self.table.read()

    def codes(self, sentences: DataFrame) -> DataFrame:
        """(doc_id, sentence_id, code): the codes of each sentence's tokens in order, joined by a blank, as
        `phonetic_code` gives them; '' for a sentence without any, or without an id or a number.

        Each distinct token of a chunk is looked up once, and its code goes back to the chunk, where the
        sentences are spelled: no token of a sentence is a row of its own.
        """
        said = staged(_in_chunks(sentences.select("doc_id", "sentence_id", F.lower("text").alias("lowered"))))
        pairs = staged(said.select("chunk", "lowered").mapInArrow(_distinct_tokens, "chunk long, token string"))
        known = self.learn(staged(pairs.select("token").distinct()))
        schema = T.StructType([*said.select("doc_id", "sentence_id").schema, T.StructField("code", T.StringType())])
        looked_up = pairs.join(known, "token").select("chunk", "token", "code")
        found = said.groupBy("chunk").cogroup(looked_up.groupBy("chunk")).applyInArrow(_spelled, schema)
        keyed = F.col("doc_id").isNotNull() & F.col("sentence_id").isNotNull()
        return found.select("doc_id", "sentence_id", F.when(keyed, F.col("code")).otherwise("").alias("code"))


def _in_chunks(texts: DataFrame) -> DataFrame:
    """`texts` with the number of the chunk that a row lies in: about `CHUNK_BYTES` of one task's rows."""
    schema = T.StructType([*texts.schema, T.StructField("chunk", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            *columns, part = batch.columns
            sizes = pc.fill_null(pc.binary_length(columns[-1]), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
            ends = seen + np.cumsum(sizes)
            chunk = (part.to_numpy().astype(np.int64) << 32) + (ends - sizes) // CHUNK_BYTES
            seen = int(ends[-1]) if len(ends) else seen
            yield pa.RecordBatch.from_arrays([*columns, pa.array(chunk)], names=schema.names)

    return texts.select("*", F.spark_partition_id().alias("part")).mapInArrow(run, schema)


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, token): the tokens of each chunk, whose rows come together; once, or once for each task that reads some."""
    names = ["chunk", "token"]

    def tokens_of(chunk: int, texts: list[pa.Array]) -> pa.RecordBatch:
        found = split_words(pa.concat_arrays(texts))[1].dictionary
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), chunk, np.int64)), found], names=names)

    now, held = None, []
    for batch in batches:
        chunks = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.diff(chunks, prepend=chunks[:1] - 1))
        for a, b in zip(starts, [*starts[1:], len(chunks)]):
            if held and chunks[a] != now:
                yield tokens_of(now, held)
                held = []
            now = chunks[a]
            held.append(batch.column(1).slice(a, b - a))
    if held:
        yield tokens_of(now, held)


def _spelled(said: pa.Table, codes: pa.Table) -> pa.Table:
    """Sentences of a chunk with the codes of their tokens."""
    texts = pa.concat_arrays([pa.array([], pa.string()), *said.column("lowered").chunks])
    sizes, words = split_words(texts)
    at = pc.index_in(words.dictionary, value_set=pa.concat_arrays([pa.array([], pa.string()), *codes.column("token").chunks]))
    code = codes.column("code").combine_chunks().take(at).take(words.indices)
    ends = np.zeros(len(texts) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    code = pa.concat_arrays([pa.array([], pa.string()), *code.chunks]) if isinstance(code, pa.ChunkedArray) else code
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), code), " ")
    return said.select(["doc_id", "sentence_id"]).append_column("code", pc.utf8_trim(joined, " "))
