"""Quality rules on repetition: how much of a text lies inside duplicated n-grams and lines.

Rolling hashes of several n-gram lengths are made in numpy over the words of a batch, each window from two
prefix sums. A word counts
as covered at length n when it lies in an n-word window that came earlier in its text; coverage is
the share of word characters that is covered, so overlapping windows count a character once and
the first of equal windows not at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_signals.llm.words import RollingHash, byte_slices, mixed, raw_bytes, repeated, split_words, sums

# The largest share of characters inside duplicated n-grams, and inside lines that
# equal an earlier line, of published rules for web text.
MOST_COVERED = {5: 0.15, 7: 0.13, 10: 0.10}
MOST_LINE_CHARS = 0.20
#: Shorter texts have too few windows for shares to say anything, and are judged by the base alone.
FEWEST_WORDS = 50

#: Words in windows of this length that repeat are counted apart from the shares.
BASE_WINDOW = 3
SYMBOLS = b"#*$%&|<>"
_BLANKS = bytes([9, 10, 11, 12, 13, 32])

_STARTS_CHARACTER = np.array([(b & 0xC0) != 0x80 for b in range(256)])
_IN_WORD = _STARTS_CHARACTER & ~np.isin(np.arange(256), list(_BLANKS))
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")


def _covered_words(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Whether each of `size` words lies in one of the n-word windows that start at `at`."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + n, -1)
    return np.cumsum(edges[:-1]) > 0


def _line_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word that equal an earlier line, and the word characters in them."""
    lists = pc.split_pattern(texts, "\n")
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    place, data = raw_bytes(flat)
    chars = sums(_IN_WORD[data], place)
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    first = np.zeros(len(codes), bool)
    first[np.unique(rows * (codes.max(initial=0) + 1) + codes, return_index=True)[1]] = True
    again = ~first & (chars > 0)
    return sums(again, offsets), sums(np.where(again, chars, 0), offsets)


def measure(texts: pa.Array, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts per text, and covered characters per n-gram length as `covered_<n>`."""
    place, data = raw_bytes(texts)
    words = split_words(texts)
    rolling, rows = RollingHash(words.hashes()), words.rows.astype(np.uint64)
    in_row = mixed(rows + np.uint64(1))
    word_chars = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
    out = {
        "n_words": words.counts,
        "word_chars": sums(_IN_WORD[data], place),
        "n_symbols": sums(_SYMBOL[data], place),
    }
    out["n_dup_lines"], out["dup_line_chars"] = _line_counts(texts)
    for n in sorted({BASE_WINDOW, *lengths}):
        starts = words.windows(n)
        keys = mixed(rolling.windows(starts, n) ^ in_row[starts])
        again = np.flatnonzero(repeated(keys))
        if n == BASE_WINDOW:
            covered = _covered_words(starts[again], n, len(words.codes))
            out["n_repeat_words"] = sums(covered, words.offsets)
        if n in lengths:
            later = np.delete(again, np.unique(keys[again], return_index=True)[1])
            covered = _covered_words(starts[later], n, len(words.codes))
            out[f"covered_{n}"] = sums(np.where(covered, word_chars, 0), words.offsets)
    return out


def repetition(docs: DataFrame, lengths: tuple[int, ...] = tuple(MOST_COVERED)) -> DataFrame:
    """Every row's `doc_id` and its counts, in one narrow step.

    A null or empty text has zeros. Rows without an id, and rows that repeat one, are counted each by
    itself; long texts are counted whole; an empty table gives no rows. Only `doc_id` and `text` are read, so no
    other name can clash.
    """
    names = [*COUNTS, *(f"covered_{n}" for n in lengths)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in byte_slices(batch.column(1)):
                found = measure(texts, lengths)
                columns = [pa.array(found[c].astype(np.int64)) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(texts)), *columns], names=["doc_id", *names]
                )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def judged(
    counts: DataFrame,
    most_covered: dict[int, float] = MOST_COVERED,
    most_line_chars: float = MOST_LINE_CHARS,
) -> DataFrame:
    """Add `base_failed` and `kept` to the counts of `repetition`."""
    n = F.col("n_words")
    base = (n < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    fine = F.col("dup_line_chars") <= most_line_chars * chars
    for length, most in most_covered.items():
        fine = fine & (F.col(f"covered_{length}") <= most * chars)
    return counts.withColumn("base_failed", base).withColumn("kept", ~base & fine)
