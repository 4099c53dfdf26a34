"""Substring dedup by content-defined chunks.

A gear rolling hash over the bytes cuts texts where the content says so: after a cut the next one
depends on the bytes near it alone, so an insertion moves only the chunks around it. A chunk may be a
few bytes that unrelated texts share by chance, so it is never looked up alone: runs of chunks that
just reach the least length of a passage are digested, and the rows of a digest meet in one exchange,
where those that one document alone holds are left out. Digests that hold a notable share of all runs,
found on a sample, are salted, and their few partial results joined. What shared runs cover is reported
as repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from filing_signals.functions.text import bind
from filing_signals.llm.staging import Stage
from filing_signals.llm.words import byte_slices, mixed, raw_bytes

#: The gear hash of a place covers so many bytes before it.
GEAR_BYTES = 16
#: A cut is made where this many bits of the hash are 0, so chunks have about 2^bits bytes and are
#: small against the shortest passage.
CUT_BITS = 5
#: Longer stretches without a cut are cut at this many bytes after the last.
LONGEST_CHUNK = 1024
#: Digests with this share of a sample's runs are salted, so there are at most 1 / HEAVY of them. The
#: sample decides on that alone.
HEAVY, LEAST_HEAVY, SAMPLED = 1 / 4096, 16, 1 / 64
SALTS = 256

CHUNKS = "doc_id long, row long, start long, length int, h1 long, h2 long"
#: `low` and `high` are the ends of a run: characters before it << 32 | chunks before it, and
#: `TEXT_END` where the text ends.
RUNS = "doc_id long, row long, low long, high long, h1 long, h2 long"
TEXT_END = 1 << 31
PASSAGES = "doc_id long, start long, end long, n_chunks long, first_doc_id long"

_GEAR = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASES = (np.uint64(0x100000001B3), np.uint64(0xC2B2AE3D27D4EB4F))
# odd, so that each has an inverse among 64-bit numbers
_RADIXES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_STARTS_CHARACTER = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def gear_cuts(data: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """Whether a chunk ends after each byte, by content alone; never inside a character."""
    gear = _GEAR[data]
    h = gear.copy()
    for k in range(1, min(GEAR_BYTES, len(data))):
        h[k:] += gear[:-k] << np.uint64(k)
    # low bits would see only the last few bytes
    cut = (h >> np.uint64(GEAR_BYTES - bits)) & np.uint64((1 << bits) - 1) == 0
    cut[:-1] &= _STARTS_CHARACTER[data[1:]]
    return cut


def _digests(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit digests of each chunk: sums of byte values by place, mixed."""
    place = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64)
    out = []
    for base in _BASES:
        each = mixed((place << np.uint64(8) | data.astype(np.uint64)) * base + base)
        out.append(mixed(np.add.reduceat(each, starts) + lengths.astype(np.uint64)))
    return out


def chunked(texts: pa.Array, bits: int = CUT_BITS) -> dict[str, np.ndarray]:
    """Chunks of texts without nulls: row, start and length in characters, h1, h2."""
    offsets, data = raw_bytes(texts)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return {c: np.zeros(0, np.int64) for c in ("row", "start", "length", "h1", "h2")}
    filled = np.flatnonzero(np.diff(offsets))
    first = offsets[:-1][filled]
    cut = gear_cuts(data, bits)
    # the window of a place near a text's start reaches into the text before it: not content of this one
    near = (first[:, None] + np.arange(GEAR_BYTES - 1)).ravel()
    cut[near[near < len(data)]] = False
    cut[offsets[1:][filled] - 1] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate([[0], ends[:-1]])
    for i in np.flatnonzero(ends - starts > LONGEST_CHUNK):
        forced = np.arange(starts[i] + LONGEST_CHUNK, ends[i], LONGEST_CHUNK)
        while len(forced) and not _STARTS_CHARACTER[data[forced]].all():
            forced = forced - ~_STARTS_CHARACTER[data[forced]]
        ends = np.append(ends, forced)
    ends = np.unique(ends)
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    characters = np.concatenate([[0], np.cumsum(_STARTS_CHARACTER[data])])
    row = np.searchsorted(offsets, starts, "right") - 1
    h1, h2 = _digests(data, starts, lengths)
    begin = characters[starts]
    return {
        "row": row,
        "start": begin - characters[offsets[row]],
        "length": characters[ends] - begin,
        "h1": h1.view(np.int64),
        "h2": h2.view(np.int64),
    }


def _given(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), "text"
    )


def chunks(docs: DataFrame, bits: int = CUT_BITS) -> DataFrame:
    """All chunks of all texts. `row` tells apart different texts that come under one id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in byte_slices(batch.column(2), 2 << 20):
                c = chunked(texts, bits)
                at = pa.array(c["row"] + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), batch.column(1).take(at), pa.array(c["start"]),
                        pa.array(c["length"].astype(np.int32)), pa.array(c["h1"]), pa.array(c["h2"]),
                    ],
                    names=["doc_id", "row", "start", "length", "h1", "h2"],
                )

    return _given(docs).mapInArrow(run, CHUNKS)


def _powers(radix: int, n: int) -> np.ndarray:
    out = np.full(n, radix, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def least_runs(c: dict[str, np.ndarray], least_chars: int) -> dict[str, np.ndarray]:
    """Runs of chunks of one text that have `least_chars` characters, but less without their last or first.

    From each chunk on, and up to each chunk. Two texts that share chunks of so many characters in
    a row share such runs, and these cover all of them. A text of fewer characters is one run.
    """
    n = len(c["row"])
    ends = np.cumsum(c["length"])
    starts = ends - c["length"]
    each = np.arange(n)
    last = np.searchsorted(ends, starts + least_chars)
    first = np.searchsorted(starts, ends - least_chars, "right") - 1
    whole = np.flatnonzero((last < n) & (c["row"][np.minimum(last, n - 1)] == c["row"]))
    back = np.flatnonzero((first >= 0) & (c["row"][np.maximum(first, 0)] == c["row"]))
    # a run up to a chunk where one from another chunk ends is among those already
    back = np.setdiff1d(back, last[whole])
    of_row = np.searchsorted(c["row"], c["row"])  # first chunk of the text
    closing = np.flatnonzero(np.concatenate([c["row"][1:] != c["row"][:-1], [True]])[:n])
    short = closing[ends[closing] - starts[of_row[closing]] < least_chars]
    i = np.concatenate([each[whole], first[back], of_row[short]])
    j = np.concatenate([last[whole], each[back], short])
    text_end = np.concatenate([c["row"][1:] != c["row"][:-1], [True]])[:n] * TEXT_END
    out = {"row": c["row"][i]}
    out["low"] = c["start"][i] << 32 | (i - of_row[i])
    out["high"] = (c["start"][j] + c["length"][j]) << 32 | (j + 1 - of_row[j]) | text_end[j]
    for name, radix in zip(("h1", "h2"), _RADIXES):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(c[name].view(np.uint64) * _powers(radix, n), out=sums[1:])
        value = (sums[j + 1] - sums[i]) * _powers(pow(radix, -1, 1 << 64), n)[i]
        out[name] = mixed(value + (j - i).astype(np.uint64)).view(np.int64)
    return out


def digested_runs(docs: DataFrame, least_chars: int, bits: int = CUT_BITS) -> DataFrame:
    """`least_runs` of all texts. `row` tells apart different texts that come under one id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in byte_slices(batch.column(2), 2 << 20):
                r = least_runs(chunked(texts, bits), least_chars)
                at = pa.array(r["row"] + row)
                values = [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(r[k]) for k in ("low", "high", "h1", "h2"))]
                yield pa.RecordBatch.from_arrays(values, names=["doc_id", "row", "low", "high", "h1", "h2"])

    return _given(docs).mapInArrow(run, RUNS)


def _passages(doc: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Columns of PASSAGES from runs of whole texts, in order of text, low and high."""
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])])
    text = np.cumsum(new) - 1
    base = text << 32
    # later runs of a text neither start nor end before earlier ones, so those over a place are neighbours
    begin, end = base + (low >> 32), base + (high >> 32)
    points, at = np.unique(np.concatenate([begin, end]), return_index=True)
    number = (np.concatenate([low, high]) & 0xFFFFFFFF)[at]
    lo, hi = np.searchsorted(end, points, "right"), np.searchsorted(begin, points, "right") - 1
    covered = lo <= hi
    holder = first[np.minimum(lo, len(first) - 1)]
    for k in range(1, int((hi - lo).max(initial=0)) + 1):
        holder = np.minimum(holder, first[np.maximum(np.minimum(lo + k, hi), 0)], where=lo + k <= hi, out=holder)
    goes_on = np.concatenate([[False], covered[:-1] & covered[1:] & (holder[:-1] == holder[1:])])
    opens = np.flatnonzero(covered & ~goes_on)
    closes = np.flatnonzero(covered & ~np.concatenate([goes_on[1:], [False]])) + 1
    upto = number & (TEXT_END - 1)
    n_chunks, holders = upto[closes] - upto[opens], holder[opens]
    # the chunk at an end of a text has no cut there, so it may go on the passage of an earlier holder beside it
    after = np.concatenate([[False], (closes[:-1] == opens[1:]) & (holders[:-1] < holders[1:])])[: len(opens)]
    before = np.concatenate([(opens[1:] == closes[:-1]) & (holders[1:] < holders[:-1]), [False]])[: len(opens)]
    open_end = (n_chunks == 1) & ((after & (number[closes] >= TEXT_END)) | (before & (upto[opens] == 0)))
    opens, closes, n_chunks, holders = (x[~open_end] for x in (opens, closes, n_chunks, holders))
    start = points & 0xFFFFFFFF
    return [doc[new][points[opens] >> 32], start[opens], start[closes], n_chunks, holders]


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PASSAGES of runs that come in order of doc_id, row, low and high; one text's runs are held."""
    names = ["doc_id", "start", "end", "n_chunks", "first_doc_id"]
    held = [np.zeros(0, np.int64) for _ in range(5)]
    for batch in batches:
        c = [np.concatenate([h, b.to_numpy(zero_copy_only=False)]) for h, b in zip(held, batch.columns)]
        if not len(c[0]):
            continue
        # rows of one document with the same text
        once = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in c[:4]], axis=0)])
        c = [x[once] for x in c]
        last = int(np.argmax((c[0] == c[0][-1]) & (c[1] == c[1][-1])))  # from here on one text
        held = [x[last:] for x in c]
        if last:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _passages(*(x[:last] for x in c))], names=names)
    if len(held[0]):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _passages(*held)], names=names)


def repeated_passages(docs: DataFrame, least_chars: int = 150, bits: int = CUT_BITS) -> DataFrame:
    """(doc_id, start, end, n_chunks, first_doc_id, kept) of passages found in several documents.

    Repeated is what lies in a run of chunks, of at least `least_chars` characters, that another
    document has in a row too, and a text of fewer characters that is the whole text of another document;
    `start` and `end` are in characters, end exclusive. The first holder of a
    place is the smallest document that has such a run over it. A passage is repeated text in a row
    with one first holder, `first_doc_id`, and is `kept` in the document where that is the document
    itself: each place is kept in one document, and a passage may be shorter than `least_chars` where a
    part of a repeated run has an earlier holder. Where that part reaches to the first or last chunk of a
    text, that chunk, which ends with the text and not at a cut, is left out. Both ends fall on cuts, so up to a chunk at either end
    of what two documents share may lie outside, and a passage that only repeats a few bytes has no cut
    and is not found when the texts around it differ. Exact copies are covered from end to end but for
    that. A null or empty text has no chunks; rows without an id are left out;
    rows that repeat an id are one document, whose texts are told apart. Long texts are cut whole, and an
    empty table has no passages. Other columns are not read. Jobs run, and a table is written to the
    shared folder, when this is called.
    """
    stage = Stage(docs.sparkSession, "passages")
    every = digested_runs(docs, least_chars, bits)
    heavy = heavy_digests(docs, least_chars, bits)
    is_heavy = F.col("h1").isin(heavy) if heavy else F.lit(False)
    salt = F.when(is_heavy, F.pmod(F.xxhash64("doc_id", "row"), F.lit(SALTS))).otherwise(0)
    holders = Window.partitionBy("h1", "h2", "salt")
    met = every.withColumn("salt", salt.cast("int")).withColumns(
        {"first_doc_id": F.min("doc_id").over(holders), "last": F.max("doc_id").over(holders)}
    )
    met = stage.keep(met.where(is_heavy | (F.col("first_doc_id") != F.col("last"))).drop("salt"), "met")
    hits = met
    if heavy:
        whole = met.where(is_heavy).groupBy("h1", "h2").agg(F.min("first_doc_id").alias("_first"), F.max("last").alias("_last"))
        # at most one row for each heavy digest, but for chance ones that agree in half of their bits
        hits = met.join(F.broadcast(whole), ["h1", "h2"], "left").withColumns(
            {"first_doc_id": F.coalesce("_first", "first_doc_id"), "last": F.coalesce("_last", "last")}
        )
    hits = hits.where("first_doc_id != last").select("doc_id", "row", "low", "high", "first_doc_id")
    ordered = hits.repartition("doc_id", "row").sortWithinPartitions("doc_id", "row", "low", "high")
    return ordered.mapInArrow(_swept, PASSAGES).withColumn("kept", F.col("first_doc_id") == F.col("doc_id"))


def heavy_digests(docs: DataFrame, least_chars: int, bits: int) -> list[int]:
    """`h1` of digests that hold at least HEAVY of the runs in a sample of the rows."""
    seen = Observation()
    counts = digested_runs(docs.sample(SAMPLED, seed=1), least_chars, bits).groupBy("h1").agg(F.count("*").alias("n"))
    most = counts.observe(seen, F.sum("n").alias("runs")).orderBy(F.desc("n")).limit(int(1 / HEAVY)).collect()
    return [r.h1 for r in most if r.n >= max(LEAST_HEAVY, HEAVY * seen.get["runs"])]


def without(text: Column, spans: Column) -> Column:
    """The text less the spans (start, end), an array in order without overlaps."""

    def rest(s: Column) -> Column:
        starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(s, lambda x: x["end"]))
        ends = F.concat(F.transform(s, lambda x: x["start"]), F.array(F.char_length(text).cast("long")))
        piece = lambda a, i: F.substr(text, (a + 1).cast("int"), (F.get(ends, i) - a).cast("int"))
        return F.array_join(F.transform(starts, piece), "")

    return F.when(F.size(spans) > 0, bind(spans, rest)).otherwise(text)
