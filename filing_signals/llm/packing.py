"""Packing by powers of two: documents become pieces of 2^k tokens, each a sequence of its own.

A document of n tokens is cut into full sequences of the longest length and then by the binary
digits of the rest, longest first. A sequence is one piece, so none crosses documents and none is
padded; sequences of equal length are numbered together and so form the buckets a trainer reads.

Tokens come from the given tokenizer. White space and a letter before an ASCII sign other than
the apostrophe always end one of this tokenizer's pre-tokens, so each distinct word of a batch is
coded once, and words that come often are kept between batches.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.llm.staging import Stage
from filing_signals.llm.words import byte_slices, split_words

#: Words kept between batches in a Python worker; others are coded again.
MEMO_WORDS = 400_000
#: Plain words coded in one call.
_JOINED = 400
_PLAIN = r"^[a-zÀ-ÖØ-öø-ÿ]+$"
# a letter, but not the one whose lower case ends in a mark, to which a sign would be joined
_SIGN_AFTER_LETTER = r"([^\PL\x{130}])([!-&(-/:-@\[-`{-~])"
#: Counts of pieces by length and part are broadcast up to this many (24 bytes each), and joined by
#: shuffle beyond.
BROADCAST_COUNTS = 500_000

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, part int, nth long"


class WordCoder:
    """Token ids of texts by way of their distinct words.

    The ids equal those of the tokenizer on the whole text. Texts that spell a special token go to
    the tokenizer whole, since it looks for those before it splits.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(MEMO_WORDS + 1, np.int64)

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in coded]

    def _code(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word. Plain words are one pre-token, so a joined run of them can be cut
        again after each id that ends a word."""
        out: list[np.ndarray | None] = [None] * len(words)
        plain = pc.match_substring_regex(pa.array(words, pa.string()), _PLAIN).to_numpy(zero_copy_only=False)
        runs = np.flatnonzero(plain)
        runs = [runs[i : i + _JOINED] for i in range(0, len(runs), _JOINED)]
        single = list(np.flatnonzero(~plain))
        for run, ids in zip(runs, self._encode([" ".join(words[i] for i in r) for r in runs])):
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(run) and cuts[-1] == len(ids):
                for i, part in zip(run, np.split(ids, cuts[:-1])):
                    out[i] = part
            else:
                single.extend(run)
        for i, ids in zip(single, self._encode([words[i] for i in single])):
            out[i] = ids
        return out

    def _remember(self, words: list[str], ids: list[np.ndarray]) -> None:
        n = len(self.memo)
        words, ids = words[: MEMO_WORDS - n], ids[: MEMO_WORDS - n]
        if not words:
            return
        ends = self.starts[n] + np.cumsum([len(x) for x in ids])
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.starts[n] : ends[-1]] = np.concatenate(ids)
        self.starts[n + 1 : n + 1 + len(ends)] = ends
        self.memo.update(zip(words, range(n, n + len(words))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): ids[offsets[i]:offsets[i+1]] belong to text i."""
        if any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special):
            parts = self._encode(texts.to_pylist())
            lengths = np.array([len(p) for p in parts], np.int64)
            return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts), _SIGN_AFTER_LETTER, r"\1 \2")
        words = split_words(spaced)
        values = words.dictionary.to_pylist()
        at = np.fromiter((self.memo.get(w, -1) for w in values), np.int64, len(values))
        new = np.flatnonzero(at < 0)
        known = len(self.memo)
        fresh = self._code([values[i] for i in new])
        # ids of this batch's words: the remembered ones, then the new ones
        pool_start = int(self.starts[known])
        lengths = np.zeros(len(values), np.int64)
        begins = np.zeros(len(values), np.int64)
        old = at >= 0
        begins[old] = self.starts[at[old]]
        lengths[old] = self.starts[at[old] + 1] - begins[old]
        new_lengths = np.array([len(x) for x in fresh], np.int64)
        lengths[new] = new_lengths
        begins[new] = pool_start + np.cumsum(new_lengths) - new_lengths
        pool = np.concatenate([self.ids[:pool_start], *fresh]) if fresh else self.ids[:pool_start]
        self._remember([values[i] for i in new], fresh)
        per_word = lengths[words.codes]
        ends = np.cumsum(per_word)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(begins[words.codes] - (ends - per_word), per_word) + np.arange(total)
        return pool[place], np.concatenate([[0], ends])[words.offsets]


@lru_cache(maxsize=2)
def _coder(path: str) -> WordCoder:
    return WordCoder(path)


def binary_lengths(n: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, length) of all pieces of documents with n tokens, in order within each."""
    powers = longest >> np.arange(longest.bit_length())
    times = np.concatenate([(n // longest)[:, None], (n[:, None] & powers[1:]) > 0], axis=1).astype(np.int64)
    lengths = np.repeat(np.tile(powers, len(n)), times.ravel())
    return np.repeat(np.arange(len(n)), times.sum(axis=1)), lengths


def pieces(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1) -> DataFrame:
    """The pieces of every text, with `ids` as little-endian unsigned 32-bit integers.

    `part` and `nth` say which task made a piece, and which of its length it is there, from 0. A null
    text is an empty one; it and an empty text have the end id alone. Other columns than
    `doc_id` and `text` are not read. Rows that repeat a document are packed as often as they come.
    `longest` is a power of two. One narrow step without a shuffle.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        made = np.zeros(longest.bit_length(), np.int64)
        for batch in batches:
            doc_ids, parts = batch.column(0), batch.column(2)
            for row, texts in byte_slices(batch.column(1)):
                ids, offsets = coder.encode(texts)
                n = np.diff(offsets) + 1
                ids = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
                doc, length = binary_lengths(n, longest)
                ends = np.cumsum(length)
                start = (ends - length) - (np.cumsum(n) - n)[doc]
                sizes = np.concatenate([[0], ends * 4]).astype(np.int32)
                binary = pa.Array.from_buffers(
                    pa.binary(), len(length), [None, pa.py_buffer(sizes), pa.py_buffer(ids)]
                )
                at = pa.array(doc + row)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(at), pa.array(start), pa.array(length), binary, pa.array(n[doc]), parts.take(at), pa.array(nth(length, made))],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "part", "nth"],
                )

    given = docs.select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("part"))
    return given.mapInArrow(run, PIECES)


def nth(length: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Which piece of its length each is, after the `made` ones of each power of two, which go on counting."""
    power = np.frexp(length.astype(np.float64))[1] - 1
    out = np.zeros(len(length), np.int64)
    for p in np.unique(power):
        mine = np.flatnonzero(power == p)
        out[mine] = made[p] + np.arange(len(mine))
        made[p] += len(mine)
    return out


def numbered(written: DataFrame) -> DataFrame:
    """Turn `part` and `nth` of a written table of pieces into `sequence_id`, counted from 0 over all
    sequences, equal lengths together (longest first).

    A task has numbered its pieces, so only the counts of tasks are added up, and no piece is moved.
    """
    counts = written.groupBy("length", "part").agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.desc("length"), "part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    few = counts.count() <= BROADCAST_COUNTS
    return (
        written.join(F.broadcast(firsts) if few else firsts, ["length", "part"])
        .withColumn("sequence_id", (F.col("_first") + F.col("nth")).cast("long"))
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("part", "nth", "_first")
    )


def pack(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1) -> DataFrame:
    """All sequences with their ids: `pieces`, written once and numbered, each at offset 0 of its sequence.

    A job runs, and a table is written to the shared folder, when this is called.
    """
    stage = Stage(docs.sparkSession, "packing")
    return numbered(stage.keep(pieces(docs, tokenizer, longest, end_id), "pieces"))
