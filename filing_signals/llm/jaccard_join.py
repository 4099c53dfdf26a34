"""N-gram Jaccard join by partitioning the universe of tokens, exact at any size.

Linked sets of sizes s <= t differ in at most H = (100 - p) * (s + t) / (100 + p) tokens, p being
the percentage asked for. Tokens are hashed into segments, whose number depends on the band of sizes;
by the pigeonhole principle, if segments are allotted thresholds with sum(threshold + 1) > H, the two
sets agree on some segment up to its threshold: 0 asks for equal subsets, 1 for subsets that differ
in one token, found by the neighbourhood of one deletion, and -1 leaves the segment out.

1. Copies are collapsed by a digest of the set. Each set of a class's first document emits its subsets,
   and those found once are left out. Those who share one are held against the smallest of them, links are
   verified on whole sets, and components formed. So a group of thousands of near copies costs a
   comparison each, not one per pair.
2. Thresholds are allotted by cost, which is how many sets hold a subset: a set that fills F segments
   agrees with any link of it on F - H of them, so it leaves out its F - H - 1 most frequent subsets
   (threshold -1), and the rarest one that two linked sets share is left in by both. Subsets of common
   passages go this way. Where sets of several components still hold a subset, those outside its
   largest component are compared with all, by sizes and sketches within the join, and what is left is verified.

Sets of so few tokens that H is 1 are one segment with threshold 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.llm.components import components
from filing_signals.llm.staging import Stage
from filing_signals.llm.words import byte_slices, mixed, split_words, window_hashes

#: Sizes of a band grow by this factor.
BAND_GROWTH = 1.6
#: Segments per unit of the largest H of a band: some segments stay empty.
SPARE = 1.25
#: Bytes of text whose sets are held at once, so that a Python worker stays small.
SLICE_BYTES = 1 << 20
#: Sets that share a subset from which on pairs are told apart from those of the sets' other such subsets.
HOT_ROWS = 16
#: Comparisons of the sets of one subset that a task makes; more are dealt to further tasks.
COMPARED_AT_ONCE = 1_000_000
#: Ids (of texts to fetch, of copies) are broadcast up to this many (at most 32 bytes each), and joined by
#: shuffle beyond.
BROADCAST_IDS = 500_000

_SEGMENT = np.uint64(0x5851F42D4C957F2D)
_SECOND = np.uint64(0xD1342543DE82EF95)

SETS = (
    "doc_id long, n long, d1 long, d2 long, subsets array<long>, shares array<int>, whole long, less_one array<long>, "
    "band int, sketch array<long>, next_sketch array<long>"
)
SKETCHES = "doc_id long, n long, parity int, bits array<long>"


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least percent / 100, and what follows from it for sizes."""

    percent: int = 80

    def most_differing(self, s: int) -> int:
        """The largest H of a set of s tokens with any partner it can have."""
        return (100 - self.percent) * (s + self.largest_partner(s)) // (100 + self.percent)

    def largest_partner(self, s: int) -> int:
        return 100 * s // self.percent

    def tiny(self) -> int:
        """The largest size at which H is at most 1."""
        s = 1
        while self.most_differing(s + 1) <= 1:
            s += 1
        return s

    def bands(self, largest: int) -> list[tuple[int, int]]:
        """(smallest size, segments) of the bands from the first above the tiny sets."""
        out, low = [], self.tiny() + 1
        while low <= self.largest_partner(largest):
            high = max(int(low * BAND_GROWTH), self.largest_partner(low))  # partners reach one band up
            out.append((low, int(self.most_differing(high) * SPARE) + 3))
            low = high + 1
        return out


@dataclass
class Sets:
    """tokens[offsets[i]:offsets[i+1]] is row i's set."""

    tokens: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def row(self, i: int) -> slice:
        return slice(self.offsets[i], self.offsets[i + 1])


def shingle_sets(texts: pa.Array, k: int) -> Sets:
    """Distinct k-word shingles of each text, A-Z in lower case; with fewer words, all as one."""
    words = split_words(pc.ascii_lower(texts))
    h = words.hashes()
    starts = words.windows(k)
    hashes = window_hashes(h, starts, k)
    at = np.searchsorted(starts, words.offsets)
    parts = []
    for i, n in enumerate(words.counts):
        if n >= k:
            parts.append(np.unique(hashes[at[i] : at[i + 1]]))
        elif n:
            whole = window_hashes(h[words.offsets[i] : words.offsets[i + 1]], np.array([0]), int(n))
            parts.append(mixed(whole + np.uint64(n)))
        else:
            parts.append(np.zeros(0, np.uint64))
    lengths = np.array([len(p) for p in parts], np.int64)
    return Sets(np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(lengths)]))


class Segments:
    """Subsets of sets by segment. A subset's key comes from the sum of its tokens' values, so that
    taking a token away is a subtraction."""

    def __init__(self, sets: Sets, threshold: Threshold):
        self.sets, self.threshold = sets, threshold
        self.values = mixed(sets.tokens + _SECOND)
        self.places = mixed(sets.tokens ^ _SEGMENT)
        largest = int(np.diff(sets.offsets).max(initial=1))
        self.bands = threshold.bands(largest)
        self.lows = np.array([low for low, _ in self.bands])
        self.tiny = threshold.tiny()

    def schemes(self, s: int) -> list[int]:
        """Bands in which a set of s tokens can meet a partner that is at least as large."""
        first, last = (int(np.searchsorted(self.lows, n, "right")) - 1 for n in (s, self.threshold.largest_partner(s)))
        return [b for b in dict.fromkeys((first, last)) if b >= 0]

    def key(self, sums: np.ndarray, scheme: int, segment: np.ndarray) -> np.ndarray:
        """Keys of subsets; the lowest bit tells the two schemes of a set apart, which follow each other."""
        found = mixed(sums ^ mixed(segment.astype(np.uint64) + np.uint64((scheme + 1) << 32)))
        return found & ~np.uint64(1) | np.uint64(scheme & 1)

    def split(self, i: int, scheme: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment of each token, sum and number of tokens of each segment)."""
        m = self.bands[scheme][1]
        segment = (self.places[self.sets.row(i)] % np.uint64(m)).astype(np.int64)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, segment, self.values[self.sets.row(i)])
        return segment, sums, np.bincount(segment, minlength=m)

    def subsets(self, i: int) -> tuple[np.ndarray, list[int]]:
        """Keys of the filled segments in each scheme, and how many of them any linked set shares at
        least, by the scheme's lowest bit.

        Of F filled segments at most H differ, so F - H are shared, for either of two linked sets. A set
        that fills no more than H emits all segments, empty ones too: a partner that fills more
        shares its F - H with it, and two such sets share one at least.
        """
        out, shares = [np.zeros(0, np.uint64)], [1, 1]
        s = int(self.sets.offsets[i + 1] - self.sets.offsets[i])
        for scheme in self.schemes(s):
            _, sums, counts = self.split(i, scheme)
            filled = np.flatnonzero(counts)
            shared = len(filled) - self.threshold.most_differing(s)
            chosen = filled if shared > 0 else np.arange(len(counts))
            shares[scheme & 1] = max(shared, 1)
            out.append(self.key(sums[chosen], scheme, chosen))
        return np.concatenate(out), shares

    def sketch(self, i: int, scheme: int, per_word: int = 48) -> np.ndarray:
        """Parities of how many tokens fall on each of some bits, a 64-bit word for so many tokens.

        Every bit in which two sketches differ stands for a token that only one of the sets has.
        """
        bits = 64 * (self.bands[scheme][0] // per_word + 1)
        on = np.bincount((self.values[self.sets.row(i)] % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return np.packbits(on.astype(np.uint8)).view(np.uint64)

    def whole(self, i: int) -> tuple[int, np.ndarray]:
        """Key of a tiny set and of it less each token."""
        values = self.values[self.sets.row(i)]
        total = np.array([values.sum(dtype=np.uint64)])
        at = np.zeros(1, np.int64)
        return self.key(total, -1, at)[0], self.key(total - values, -1, np.zeros(len(values), np.int64))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([len(p) for p in parts]) if parts else np.zeros(0)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat, kind))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def described(docs: DataFrame, k: int, threshold: Threshold) -> DataFrame:
    """Size, digest and subsets of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in byte_slices(batch.column(1), SLICE_BYTES):
                sets = shingle_sets(texts, k)
                segments = Segments(sets, threshold)
                n = np.diff(sets.offsets)
                total = lambda v: np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)])
                digests = [
                    _signed(t[sets.offsets[1:]] - t[sets.offsets[:-1]])
                    for t in (total(segments.values), total(mixed(sets.tokens ^ _SECOND)))
                ]
                subsets, shares, whole, less_one, band, sketches = [], [], [], [], [], ([], [])
                for i in range(len(sets)):
                    keys, shared = segments.subsets(i)
                    subsets.append(_signed(keys))
                    shares.append(np.array(shared, np.int32))
                    tiny = 0 < n[i] <= segments.tiny
                    own, less = segments.whole(i) if tiny else (0, np.zeros(0, np.uint64))
                    whole.append(int(np.uint64(own).view(np.int64)) if tiny else None)
                    less_one.append(_signed(less))
                    band.append(int(np.searchsorted(segments.lows, n[i], "right")) - 1)
                    schemes = segments.schemes(int(n[i]))
                    for at, column in enumerate(sketches):
                        known = band[-1] + at in schemes
                        column.append(_signed(segments.sketch(i, band[-1] + at)) if known else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)), pa.array(n), *map(pa.array, digests),
                        _lists(subsets, pa.int64()), _lists(shares, pa.int32()), pa.array(whole, pa.int64()), _lists(less_one, pa.int64()),
                        pa.array(band, pa.int32()), *(_lists(s, pa.int64()) for s in sketches),
                    ],
                    names=["doc_id", "n", "d1", "d2", "subsets", "shares", "whole", "less_one", "band", "sketch", "next_sketch"],
                )

    return docs.mapInArrow(run, SETS)


def tokens(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, tokens) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in byte_slices(batch.column(1), SLICE_BYTES):
                sets = shingle_sets(texts, k)
                lists = pa.ListArray.from_arrays(pa.array(sets.offsets.astype(np.int32)), pa.array(_signed(sets.tokens)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), lists], names=["doc_id", "tokens"])

    return docs.mapInArrow(run, "doc_id long, tokens array<long>")


def sketches(docs: DataFrame, k: int, threshold: Threshold, per_word: int = 8) -> DataFrame:
    """SKETCHES of each text's set, one row for each of its schemes, at eight bits a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in byte_slices(batch.column(1), SLICE_BYTES):
                sets = shingle_sets(texts, k)
                segments = Segments(sets, threshold)
                n = np.diff(sets.offsets)
                found = [(i, b, _signed(segments.sketch(i, b, per_word))) for i in range(len(sets)) for b in segments.schemes(int(n[i]))]
                owner = np.array([i for i, _, _ in found], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner + row)), pa.array(n[owner]),
                        pa.array([b & 1 for _, b, _ in found], pa.int32()), _lists([x for _, _, x in found], pa.int64()),
                    ],
                    names=["doc_id", "n", "parity", "bits"],
                )

    return docs.mapInArrow(run, SKETCHES)


def differing(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ."""
    each = F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(each, F.lit(0), lambda s, n: s + F.coalesce(n, F.lit(64)))


class JaccardJoin:
    """The join of one run; `stage` holds its intermediate tables."""

    def __init__(self, docs: DataFrame, k: int, threshold: Threshold, stage: Stage):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull())
        self.k, self.threshold, self.stage = k, threshold, stage

    def texts_of(self, ids: DataFrame) -> DataFrame:
        """doc_id, text and the other columns of `ids`, a written table with unique ids."""
        few = ids.count() <= BROADCAST_IDS
        return self.docs.join(F.broadcast(ids) if few else ids, "doc_id")

    def sized(self, a: str, b: str) -> Column:
        """Whether two sizes allow the similarity."""
        return 100 * F.least(f"{a}.n", f"{b}.n") >= self.threshold.percent * F.greatest(f"{a}.n", f"{b}.n")

    def most(self, a: str, b: str) -> Column:
        """How many tokens of linked sets of these sizes differ at most."""
        p = self.threshold.percent
        return F.floor((100 - p) * (F.col(f"{a}.n") + F.col(f"{b}.n")) / (100 + p))

    def possible(self, a: str, b: str) -> Column:
        """Whether sizes and sketches allow the similarity: no more bits differ than tokens may.

        Both sets have a sketch of the larger one's band; tiny sets have none and are let through.
        """
        band = F.greatest(f"{a}.band", f"{b}.band")
        of = lambda c: F.when(F.col(f"{c}.band") == band, F.col(f"{c}.sketch")).otherwise(F.col(f"{c}.next_sketch"))
        return self.sized(a, b) & ((band < 0) | (differing(of(a), of(b)) <= self.most(a, b)))

    def verified(self, pairs: DataFrame, base: DataFrame, name: str) -> DataFrame:
        """Those of the pairs (a, b) whose whole sets are similar enough.

        Most pairs that only share a passage go by their sketches, before any set is moved.
        """
        brief = base.select("doc_id", "n", "band", "sketch", "next_sketch")
        x, y = brief.alias("x"), brief.alias("y")
        both = pairs.distinct().join(x, F.col("a") == F.col("x.doc_id")).join(y, F.col("b") == F.col("y.doc_id"))
        pairs = self.stage.keep(both.where(self.possible("x", "y")).select("a", "b").distinct(), f"{name}-pairs")
        ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        ids = self.stage.keep(ids, f"{name}-ids")
        sets = self.stage.keep(tokens(self.texts_of(ids), self.k), f"{name}-sets")
        of = lambda c: sets.select(F.col("doc_id").alias(c), F.col("tokens").alias(f"t{c}"))
        both = pairs.join(of("b"), "b").join(of("a"), "a")
        shared = F.size(F.array_intersect("ta", "tb"))
        union = F.size("ta") + F.size("tb") - shared
        similar = (shared > 0) & (100 * shared.cast("long") >= self.threshold.percent * union)
        links = self.stage.keep(both.where(similar).select("a", "b").distinct(), f"{name}-links")
        for part in ("pairs", "ids", "sets"):
            self.stage.drop(f"{name}-{part}")
        return links

    def across(self, members: DataFrame, comps: DataFrame, base: DataFrame) -> DataFrame | None:
        """Pairs of different components that share a subset which both have left in, and may link."""
        parity = F.col("subset").bitwiseAND(1).cast("int")
        shares = base.groupBy("doc_id").agg(*(F.min(F.get("shares", F.lit(k))).alias(f"share{k}") for k in (0, 1)))
        by_cost = Window.partitionBy("doc_id", "parity").orderBy(F.desc("rows"), F.desc("subset"))
        left_in = (
            members.withColumn("parity", parity)
            .withColumn("nth", F.row_number().over(by_cost))
            .join(shares, "doc_id")
            .where(F.col("nth") >= F.when(F.col("parity") == 0, F.col("share0")).otherwise(F.col("share1")))
        )
        left_in = left_in.join(comps, F.col("doc_id") == comps.node, "left").select(
            "subset", "parity", "doc_id", F.coalesce("component", "doc_id").alias("comp")
        )
        left_in = self.stage.keep(left_in, "left-in")
        each = left_in.groupBy("subset", "comp").agg(F.count("*").alias("n"))
        groups = each.groupBy("subset").agg(
            F.count("*").alias("comps"), F.sum("n").alias("rows"), F.max(F.struct("n", "comp")).alias("most")
        )
        groups = groups.where("comps > 1").select(
            "subset", "rows", F.col("most.comp").alias("largest"),
            F.ceil(F.col("rows") * (F.col("rows") - F.col("most.n")) / COMPARED_AT_ONCE).cast("int").alias("deals"),
        )
        # sets that nearly link share many subsets; of those that many hold, the rarest gives the pair
        hot = F.when(F.col("rows") >= HOT_ROWS, F.col("subset"))
        rarer = Window.partitionBy("doc_id", "parity").orderBy("rows", "subset").rowsBetween(Window.unboundedPreceding, -1)
        opened = left_in.join(groups, "subset").withColumn("earlier", F.when(hot.isNotNull(), F.collect_list(hot).over(rarer)))
        opened = self.stage.keep(opened.drop("rows"), "open")
        if opened.isEmpty():
            return None
        ids = self.stage.keep(opened.select("doc_id").distinct(), "open-ids")
        known = self.stage.keep(sketches(self.texts_of(ids).select("doc_id", "text"), self.k, self.threshold), "sketches")
        rows = opened.join(known, ["doc_id", "parity"])
        x = rows.where("comp != largest").withColumn("deal", F.pmod(F.xxhash64("doc_id"), "deals").cast("int")).alias("x")
        y = rows.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).alias("y")
        once = (F.col("x.comp") != F.col("y.comp")) & (
            (F.col("y.comp") == F.col("y.largest")) | (F.col("x.doc_id") < F.col("y.doc_id"))
        )
        may_link = self.sized("x", "y") & (differing(F.col("x.bits"), F.col("y.bits")) <= self.most("x", "y"))
        may_link = may_link & ~F.coalesce(F.arrays_overlap("x.earlier", "y.earlier"), F.lit(False))
        same = (F.col("x.subset") == F.col("y.subset")) & (F.col("x.deal") == F.col("y.deal"))
        return x.join(y, same & once & may_link).select(
            F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")
        )

    def run(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) of every row with an id."""
        stage = self.stage
        base = stage.keep(described(self.docs, self.k, self.threshold), "described")
        same = ["n", "d1", "d2"]
        classes = (
            base.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
        )
        copies = stage.keep(base.select("doc_id", *same).join(classes, same).where("doc_id != first").distinct(), "copies")
        # beyond the bound the join moves each set's subsets once
        gone = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
        firsts = base.join(gone.select("doc_id", *same), ["doc_id", *same], "left_anti")
        subsets = firsts.select("doc_id", F.explode("subsets").alias("subset"))
        together = Window.partitionBy("subset")
        members = subsets.withColumn("rows", F.count("*").over(together)).withColumn("center", F.min("doc_id").over(together))
        members = stage.keep(members.where("rows > 1"), "members")
        star = members.where("doc_id != center").select(F.col("center").alias("a"), F.col("doc_id").alias("b"))
        tiny = firsts.where("whole IS NOT NULL")
        less = tiny.select(F.col("doc_id").alias("b"), F.explode("less_one").alias("whole"))
        nearly = tiny.select(F.col("doc_id").alias("a"), "whole").join(less, "whole").select("a", "b").where("a != b")
        links = self.verified(star.union(nearly), base, "star")
        comps = stage.keep(components(links, stage, "first"), "comps")
        more = self.across(members.drop("center"), comps, base)
        edges = comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(
            copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
        )
        if more is not None:
            edges = edges.union(self.verified(more, base, "across"))
        found = stage.keep(components(edges, stage, "all"), "found")
        for part in ("copies", "members", "left-in", "open", "open-ids", "sketches", "comps"):
            stage.drop(part)
        labelled = base.select("doc_id", "n").join(found, base.doc_id == found.node, "left")
        return labelled.select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
        )


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id`, `n_shingles` and `component_id` of every row of `docs`, by exact similarity.

    Two texts link when 100 * shared >= percent * union of their distinct k-word shingles, told apart
    by 64-bit hashes. A text of fewer words has its whole sequence as its only shingle; one without
    words, or a null one, has none and links to nothing. `component_id` is the smallest id reachable
    by links. Rows that repeat an id are one node, which links through any of its texts. A row without
    an id comes back with its size and a null component. Other columns are not read. Jobs run, and
    tables are written to the shared folder, when this is called.
    """
    join = JaccardJoin(docs, k, Threshold(percent), Stage(docs.sparkSession, "jaccard"))
    without = docs.where(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = described(without, k, Threshold(percent)).select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return join.run().union(sizes)
