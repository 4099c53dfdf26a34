"""Document fingerprints by improbable features, in chained Bloom filters.

A feature is a window of bytes. Its entropy, kept as a whole number, says how it is made up; entropies that are rare
in the corpus rank first. In each stretch of neighbouring windows the rarest is picked, and windows that
are picked often enough become features of the text: few, spread over it, and found again wherever the
bytes around them are the same. They are put into Bloom filters of fixed size, a new one chained where one
is full. Two fingerprints are alike by the bits that their filters share beyond chance.

Neighbours by id come from one range partitioning of the texts. The last row of a partition and the first
of the next are joined afterwards, one row per partition.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.llm.staging import Stage
from filing_signals.llm.words import byte_slices, mixed, raw_bytes

#: Bytes that are worked on at once, so that they stay in the processor's cache.
BLOCK = 1 << 17
#: Entropies are kept in so many steps.
STEPS = 1000
_UNIT = 1 << 20

NEAR = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, part int, edge int, text string"
)


@dataclass(frozen=True)
class Settings:
    """Windows of `window` bytes compete within `stretch` neighbours, and need `picked` of those picks.

    A filter of `bits` bits, a power of two, takes up to `most` features of `hashes` bits each.
    """

    window: int = 12
    stretch: int = 16
    picked: int = 4
    bits: int = 2048
    most: int = 160
    hashes: int = 5

    @property
    def words(self) -> int:
        return self.bits // 64


def entropies(data: np.ndarray, window: int) -> np.ndarray:
    """Entropy of the window from each byte but the last few, in STEPS of the greatest possible.

    Counts move by one byte on either side, so the sum of count * log(count) follows from how often the
    byte that comes or goes occurs in the window, in whole numbers that do not drift.
    """
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    c = np.arange(window + 1, dtype=np.float64)
    cost = np.round(_UNIT * c * np.log2(np.maximum(c, 1))).astype(np.int64)
    step = np.diff(cost)
    moves = np.zeros(len(data) + 1, np.int64)
    for begin in range(0, len(data), BLOCK):
        # each byte's equals among the window - 1 before and after it
        low, high = max(begin - window + 1, 0), min(begin + BLOCK + window - 1, len(data))
        part = data[low:high]
        before, after = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for k in range(1, min(window, len(part))):
            same = (part[k:] == part[:-k]).view(np.uint8)
            before[k:] += same
            after[:-k] += same
        own = slice(begin - low, min(begin + BLOCK, len(data)) - low)
        own_end = min(begin + BLOCK, len(data))
        moves[begin + 1 : own_end + 1] += step[before[own]]
        left = np.arange(begin, own_end)
        left = left[left + window < len(data)]
        # the byte leaves as the window moves on, before the next one comes
        moves[left + window + 1] -= step[after[left - low]]
    total = np.cumsum(moves)[window:]
    most = np.log2(window) if window > 1 else 1.0
    bits = np.log2(window) - total / (window * _UNIT)
    return np.clip((STEPS * bits / most).astype(np.int16), 0, STEPS)


def _valid(offsets: np.ndarray, window: int, n: int) -> np.ndarray:
    """Whether the window from each place lies in one text."""
    lengths = np.diff(offsets)
    end = np.repeat(offsets[1:], lengths)[:n]
    return np.arange(n) + window <= end


def entropy_counts(docs: DataFrame, s: Settings) -> np.ndarray:
    """How often each entropy occurs over all windows of all texts: STEPS + 1 numbers at any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STEPS + 1, np.int64)
        for batch in batches:
            for _, texts in byte_slices(batch.column(0)):
                offsets, data = raw_bytes(texts)
                e = entropies(data[offsets[0] : offsets[-1]], s.window)
                total += np.bincount(e[_valid(offsets - offsets[0], s.window, len(e))], minlength=STEPS + 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["entropy", "n"])

    counted = docs.select("text").mapInArrow(run, "entropy int, n long").groupBy("entropy").agg(F.sum("n").alias("n"))
    out = np.zeros(STEPS + 1, np.int64)
    for row in counted.collect():
        out[row.entropy] = row.n
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, the rarest first; equally rare ones by greater entropy."""
    order = np.lexsort((-np.arange(len(counts)), counts))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    return rank


def features(texts: pa.Array, rank: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each feature, row it belongs to) in order, of texts without nulls.

    A text shorter than a window is one feature as it is.
    """
    offsets, data = raw_bytes(texts)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    lengths = np.diff(offsets)
    odd = mixed(np.arange(1, s.window + 1, dtype=np.uint64)) | np.uint64(1)
    short = np.flatnonzero((lengths > 0) & (lengths < s.window))
    padded = np.zeros((len(short), s.window), np.uint64)
    for i, row in enumerate(short):
        padded[i, : lengths[row]] = data[offsets[row] : offsets[row + 1]]
    found = [(padded * odd).sum(axis=1, dtype=np.uint64) + lengths[short].astype(np.uint64)]
    rows = [short]
    e = entropies(data, s.window)
    at = np.flatnonzero(_valid(offsets, s.window, len(e)))
    if len(at):
        row = np.searchsorted(offsets, at, "right") - 1
        places = np.maximum(lengths - s.window + 1, 0)
        stretch = np.minimum(s.stretch, places)
        # rank first and place second: the smallest of a stretch is its leftmost rarest window
        key = rank[e[at]] << 32 | np.arange(len(at))
        pick = np.zeros(len(at), np.int64)
        for size in np.unique(stretch[places > 0]):
            mine = np.flatnonzero(stretch[row] == size)
            least = sliding_least(key[mine], int(size))
            whole = row[mine][: len(least)] == row[mine][size - 1 :]
            pick += np.bincount(least[whole] & 0xFFFFFFFF, minlength=len(at))
        picks = places - stretch + 1  # of a text's stretches
        chosen = np.flatnonzero(pick >= np.minimum(s.picked, -(-picks // 4))[row])
        windows = data[at[chosen][:, None] + np.arange(s.window)].astype(np.uint64)
        found.append((windows * odd).sum(axis=1, dtype=np.uint64))
        rows.append(row[chosen])
    hashes, rows = np.concatenate(found), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return mixed(hashes[order]), rows[order]


def sliding_least(key: np.ndarray, size: int) -> np.ndarray:
    """The least of each `size` neighbours, by doubling."""
    least, span = key, 1
    while span * 2 <= size:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    rest = size - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


@dataclass
class Filters:
    """filters[offsets[i]:offsets[i+1]] are row i's Bloom filters as 64-bit words."""

    filters: np.ndarray
    offsets: np.ndarray

    def raw(self) -> list[bytes]:
        raw = self.filters.tobytes()
        size = self.filters.shape[1] * 8
        return [raw[a * size : b * size] for a, b in zip(self.offsets[:-1], self.offsets[1:])]

    def texts(self) -> list[str]:
        return [base64.b64encode(r).decode() for r in self.raw()]

    def take(self, rows: np.ndarray) -> Filters:
        n = np.diff(self.offsets)[rows]
        ends = np.cumsum(n)
        at = np.repeat(self.offsets[rows] - (ends - n), n) + np.arange(int(n.sum()))
        return Filters(self.filters[at], np.concatenate([[0], ends]))


def fingerprints(texts: pa.Array, rank: np.ndarray, s: Settings) -> Filters:
    """Chained filters of texts without nulls; a text without bytes has none."""
    hashes, rows = features(texts, rank, s)
    n = np.bincount(rows, minlength=len(texts)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(-(-n // s.most))])
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    which = offsets[rows] + nth // s.most
    width = s.bits.bit_length() - 1
    bits = np.zeros((int(offsets[-1]), s.bits), bool)
    for k in range(s.hashes):
        bits[which, (hashes >> np.uint64(k * width)).astype(np.int64) & (s.bits - 1)] = True
    return Filters(np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1, s.words), offsets)


def read_fingerprint(texts: list[str], s: Settings = Settings()) -> Filters:
    """Filters of written fingerprints."""
    raw = [base64.b64decode(t) for t in texts]
    n = np.array([len(r) // (s.bits // 8) for r in raw], np.int64)
    return Filters(np.frombuffer(b"".join(raw), np.uint64).reshape(-1, s.words), np.concatenate([[0], np.cumsum(n)]))


def likeness(a: Filters, b: Filters, s: Settings, pairs_at_once: int = 1 << 15) -> np.ndarray:
    """How alike row i of both is, from 0 to 1.

    Each filter of the fingerprint with fewer is held against all of the other's; its best overlap, as a
    share of what lies between chance and the fewer bits of both, counts with the bits it has. Equal ones
    are alike by 1, and one without filters is alike by 0 to one that has some.
    """
    na, nb = np.diff(a.offsets), np.diff(b.offsets)
    swap = na > nb
    out = np.where((na == 0) & (nb == 0), 1.0, 0.0)
    ones_a, ones_b = (np.bitwise_count(x.filters).sum(axis=1, dtype=np.int64) for x in (a, b))
    weight, total = np.zeros(len(na)), np.zeros(len(na))
    few, many = np.minimum(na, nb), np.maximum(na, nb)
    # one entry per filter of the shorter fingerprint that has a partner
    owner = np.repeat(np.arange(len(na)), np.where(few > 0, few, 0))
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(few) - few, few)
    spans = many[owner]
    begin = 0
    while begin < len(owner):
        reach = np.cumsum(spans[begin : begin + pairs_at_once])
        end = begin + max(1, int(np.searchsorted(reach, pairs_at_once, "right")))
        o, k, span = owner[begin:end], nth[begin:end], spans[begin:end]
        starts = np.cumsum(span) - span
        pair = np.repeat(np.arange(len(o)), span)
        other = np.arange(len(pair)) - starts[pair]
        flip, po = swap[o][pair], o[pair]
        i = a.offsets[po] + np.where(flip, other, k[pair])
        j = b.offsets[po] + np.where(flip, k[pair], other)
        x, y = ones_a[i], ones_b[j]
        both = np.bitwise_count(a.filters[i] & b.filters[j]).sum(axis=1, dtype=np.int64)
        chance, most = x * y / s.bits, np.minimum(x, y)
        score = np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1)
        # fewer bits than one feature sets are chance
        score = np.where(both == most, 1.0, np.where(both < s.hashes, 0.0, score))
        best = np.maximum.reduceat(score, starts)
        own = np.where(swap[o], ones_b[b.offsets[o] + np.where(swap[o], k, 0)], ones_a[a.offsets[o] + np.where(swap[o], 0, k)])
        np.add.at(weight, o, own)
        np.add.at(total, o, own * best)
        begin = end
    held = weight > 0
    out[held] = total[held] / weight[held]
    return out


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _columns(ids: list, texts: list[str], following: list[str], rank: np.ndarray, s: Settings) -> list[list]:
    """Columns of NEAR up to `near_next`; `following` are the texts of the next rows."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    own, other, after = (fingerprints(pa.array(t, pa.string()), rank, s) for t in (texts, changed, following))
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    near_edited, near_next = likeness(own, other, s).tolist(), likeness(own, after, s).tolist()
    return [ids, [len(t) for t in texts], digests, own.raw(), other.raw(), near_edited, near_next]


def _batch(columns: list[list], part: int, edge: int, texts: list) -> pa.RecordBatch:
    n = len(columns[0])
    given = [*columns, [part] * n, [edge] * n, texts]
    kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * 2, *[pa.float64()] * 2, pa.int32(), pa.int32(), pa.string()]
    names = [c.split()[0] for c in NEAR.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(given, kinds)], names=names)


_INNER, _FIRST, _LAST = 0, 1, 2


def compared(docs: DataFrame, rank: np.ndarray, s: Settings, stage: Stage) -> DataFrame:
    """Fingerprints of each row, of its edited text, and how alike both and the next row's are."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            packed = pa.array([codec.compress(t, asbytes=True) for t in raw], pa.binary())
            size = pa.array([len(t) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, size, *batch.columns[2:]], names=["doc_id", "packed", "size", "_text", "_row"])

    def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[str]]]:
        """Rows of about 2 MB of text at once."""
        codec = pa.Codec("zstd")
        ids, sizes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        held, begin = 0, 0
        for i, n in enumerate(sizes):
            held += n
            if held > 2 << 20 or i + 1 == len(sizes):
                raw = batch.column(1).slice(begin, i + 1 - begin).to_pylist()
                yield ids[begin : i + 1], [codec.decompress(t, m, asbytes=True).decode() for t, m in zip(raw, sizes[begin : i + 1])]
                held, begin = 0, i + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, part = [], [], None
        for batch in batches:
            for more_ids, more in unpacked(batch):
                if part is None:
                    part = batch.column(3)[0].as_py()
                    yield _batch([[None]] * 7, part, _FIRST, more[:1])
                ids += more_ids
                texts += more
                if len(ids) > 1:
                    yield _batch(_columns(ids[:-1], texts[:-1], texts[1:], rank, s), part, _INNER, [None] * (len(ids) - 1))
                    ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield _batch([ids, *[[None]] * 6], part, _LAST, texts)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("doc_id", "text", "following")}
                yield _batch(_columns([row["doc_id"]], [row["text"]], [row["following"]], rank, s), 0, _INNER, [None])

    order = [F.asc_nulls_last("doc_id"), F.asc("_text"), F.asc("_row")]
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    given = given.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    # texts are the bulk of what the exchange moves, and the codec of shuffles does little to prose
    packed = given.select("doc_id", "text", "_text", "_row").mapInArrow(pack, "doc_id long, packed binary, size long, _text long, _row long")
    dealt = packed.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = dealt.select("doc_id", "packed", "size", F.spark_partition_id().alias("part"))
    # filters are mostly noise to a fast codec, but have far fewer ones than zeros
    found = stage.keep(rows.mapInArrow(run, NEAR), "found", compression="zstd")
    # one first and one last row of each partition that has rows
    firsts = found.where(F.col("edge") == _FIRST).select("part", "text")
    around = Window.orderBy("part")
    after = F.coalesce(F.lead("part").over(around), F.min("part").over(around))
    following = firsts.select("part").select("part", after.alias("next"))
    texts = firsts.select(F.col("part").alias("next"), F.col("text").alias("following"))
    lasts = found.where(F.col("edge") == _LAST).select("part", "doc_id", "text").join(following, "part").join(texts, "next")
    closed = lasts.select("doc_id", "text", "following").mapInArrow(close, NEAR)
    written = [F.translate(F.base64(c), "\r\n", "").alias(c) for c in ("fingerprint", "edited_fingerprint")]
    every = found.where(F.col("edge") == _INNER).union(closed)
    return every.select("doc_id", "n_chars", "edited_sha256", *written, "near_edited", "near_next")


def fingerprinted(docs: DataFrame, settings: Settings = Settings(), rank: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next row is that with the next `doc_id`, after the last the first. Rows without an id come last;
    rows of one id follow each other by a hash of their text, and repeated rows in any order, which is
    all the same. A null or empty text has the empty fingerprint, alike by 1 to another empty one and by
    0 to any other. A text shorter than a window is one feature. Long texts are fingerprinted whole, with
    as many filters as their features fill. `rank` is the rarity of entropies, STEPS + 1 numbers; without it
    it comes from all windows of `docs`, and fingerprints of other runs can be compared only where it
    is handed on. An empty table gives no rows. Only `doc_id` and `text` are read, so no other name can
    clash. Jobs run, and a table is written to the shared folder, when this is called.
    """
    if rank is None:
        rank = rarity(entropy_counts(docs, settings))
    return compared(docs, rank, settings, Stage(docs.sparkSession, "fingerprints"))
