"""Hard-negative mining over STR-packed R-trees.

Rows are ordered by label and by slabs of their most spread coordinates, and written in shards of
bounded size. A task packs the rows it reads into an R-tree by sort-tile-recursive: each coordinate in
turn is sorted and cut into slabs, so that leaves are full and boxes small. A query's inner product with
any row in a box lies between sums of per-coordinate least and greatest products. A best-first queue
opens boxes by their greatest possible score, leaves out those outside the windows asked for, and ends
at a box strictly below the k-th score found. What a task finds for a query is k rows a window, and
those of all tasks are merged by a ranking that combines on the map side.

Anchors come in slices of bounded size, each held against all shards: first for their positives, whose
scores then are the windows for negatives.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.llm.staging import Stage

#: Rows of a leaf, and nodes under an inner node.
LEAF_ROWS, FANOUT = 128, 16
#: Rows of one tree: about 130 MB at 64 coordinates.
SHARD_ROWS = 1 << 17
#: Shards are not made smaller than this to have work for all cores.
LEAST_SHARD = 2048
#: Anchors that are sent to all tasks at once: about 12 MB at 64 coordinates.
SLICE_ANCHORS = 20_000
#: Coordinates by which rows are placed before they are written, each cut at its median.
PLACED_BY = 4

_NO_ID = np.iinfo(np.int64).max
FOUND = "anchor_id long, anchor_key long, window long, vec_id long, score long"


@dataclass(frozen=True)
class Settings:
    """Components are floor(scale * x). A negative's score is `low` to `high` percent of the positive's."""

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def str_leaves(x: np.ndarray, labels: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows of each leaf, by sort-tile-recursive; labels come before the coordinates."""
    out: list[np.ndarray] = []
    dims = np.argsort(-x.var(axis=0), kind="stable") if len(x) else np.zeros(0, np.int64)

    def tile(rows: np.ndarray, depth: int) -> None:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or depth >= len(dims):
            out.extend(rows[i : i + leaf] for i in range(0, len(rows), leaf))
            return
        slabs = math.ceil(pages ** (1 / (len(dims) - depth)))
        size = leaf * -(-pages // slabs)
        rows = rows[np.argsort(x[rows, dims[depth]], kind="stable")]
        for i in range(0, len(rows), size):
            tile(rows[i : i + size], depth + 1)

    by_label = np.argsort(labels, kind="stable")
    changes = np.flatnonzero(np.diff(labels[by_label])) + 1
    begin = 0
    for end in [*changes, len(by_label)]:
        if end - begin >= leaf or end == len(by_label):  # rare labels share a leaf
            tile(by_label[begin:end], 0)
            begin = end
    return out


class RTree:
    """Rows in leaves, and the boxes of each level over them, the root's level last."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = LEAF_ROWS, fanout: int = FANOUT):
        leaves = [rows for rows in str_leaves(x, labels, leaf) if len(rows)]
        order = np.concatenate(leaves)
        self.ids, self.labels, self.x, self.fanout = ids[order], labels[order], x[order], fanout
        starts = np.concatenate([[0], np.cumsum([len(rows) for rows in leaves])])
        self.rows = starts
        boxes = [self.x, self.x, self.labels, self.labels]
        self.levels = []
        starts = starts[:-1]
        while True:
            boxes = [f.reduceat(b, starts, axis=0) for f, b in zip((np.minimum, np.maximum) * 2, boxes)]
            self.levels.append(boxes)
            if len(boxes[0]) == 1:
                return
            starts = np.arange(0, len(boxes[0]), fanout)


@dataclass
class Best:
    """The first k rows found so far for each window of one query: higher scores, then smaller ids."""

    low: np.ndarray
    high: np.ndarray
    scores: np.ndarray  # windows x k, in order; -inf where there is none yet
    ids: np.ndarray

    def merge(self, w: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[w], scores]), np.concatenate([self.ids[w], ids])
        first = np.lexsort((ids, -scores))[: self.scores.shape[1]]
        self.scores[w], self.ids[w] = scores[first], ids[first]


def search(tree: RTree, q: np.ndarray, label: int, same: bool, own: int, best: Best) -> None:
    """Put into `best` what the tree holds: rows of the label except `own`, or rows of other labels."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)

    def push(level: int, begin: int, end: int) -> None:
        lo, hi, label_lo, label_hi = (b[begin:end] for b in tree.levels[level])
        most, least = hi @ up + lo @ down, lo @ up + hi @ down
        fits = (label_lo <= label) & (label <= label_hi) if same else (label_lo != label) | (label_hi != label)
        for i in np.flatnonzero(fits):
            heapq.heappush(heap, (-most[i], level, begin + int(i), least[i]))

    heap: list[tuple] = []
    push(len(tree.levels) - 1, 0, 1)
    while heap:
        most, level, node, least = heapq.heappop(heap)
        # a window is done when all that is left is below it, or strictly below its k-th score
        still = np.flatnonzero((-most >= best.low) & (-most >= best.scores[:, -1]))
        if not len(still):
            return
        still = still[least <= best.high[still]]
        if not len(still):
            continue
        if level:
            push(level - 1, node * tree.fanout, min((node + 1) * tree.fanout, len(tree.levels[level - 1][0])))
            continue
        rows = slice(tree.rows[node], tree.rows[node + 1])
        scores, ids, labels = tree.x[rows] @ q, tree.ids[rows], tree.labels[rows]
        fits = (labels == label) & (ids != own) if same else labels != label
        for w in still:
            at = np.flatnonzero(fits & (scores >= max(best.low[w], best.scores[w, -1])) & (scores <= best.high[w]))
            if len(at):
                best.merge(w, scores[at], ids[at])


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """A list array as rows of `width`; shorter ones end in zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


@dataclass
class Queries:
    """A slice of anchors. Windows are numbered per anchor; those that an anchor lacks ask for nothing."""

    ids: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    low: np.ndarray
    high: np.ndarray
    names: np.ndarray
    same: bool
    k: int

    def answer(self, shard: DataFrame) -> DataFrame:
        """FOUND of one slice against all rows of the written table `shard`."""
        queries, width = self, self.x.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, windows = queries.low.shape
            scores = np.full((n, windows, queries.k), -np.inf, queries.x.dtype)
            ids = np.full((n, windows, queries.k), _NO_ID, np.int64)
            for table in chunks(batches):
                tree = RTree(
                    table.column(0).to_numpy(), table.column(1).to_numpy(),
                    matrix(table.column(2).combine_chunks(), width).astype(queries.x.dtype),
                )
                for i in range(n):
                    best = Best(queries.low[i], queries.high[i], scores[i], ids[i])
                    search(tree, queries.x[i], queries.labels[i], queries.same, queries.ids[i], best)
            i, w, place = np.nonzero(ids != _NO_ID)
            for at in range(0, len(i), 1 << 16):
                part = slice(at, at + (1 << 16))
                one, win, pos = i[part], w[part], place[part]
                columns = (queries.ids[one], queries.keys[one], queries.names[one, win], ids[one, win, pos])
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(scores[one, win, pos].astype(np.int64))],
                    names=["anchor_id", "anchor_key", "window", "vec_id", "score"],
                )

        return shard.select("vec_id", "label", "vector").mapInArrow(run, FOUND)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task as tables of at most SHARD_ROWS and one batch."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= SHARD_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


class Miner:
    """One run over written rows; `stage` holds its tables."""

    def __init__(self, vectors: DataFrame, is_anchor: Column, s: Settings, stage: Stage):
        self.s, self.stage, self.spark = s, stage, vectors.sparkSession
        finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
        given = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)
        # in the narrowest type that holds them, since rows cross two exchanges
        extent = F.greatest(F.abs(F.array_max("embedding").cast("double")), F.abs(F.array_min("embedding").cast("double")))
        largest = (given.agg(F.max(extent)).first()[0] or 0.0) * s.scale + 1
        kind = "smallint" if largest < 1 << 15 else "int" if largest < 1 << 31 else "double"
        whole = F.transform("embedding", lambda x: F.floor(s.scale * x.cast("double")).cast(kind))
        rows = given.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
            whole.alias("vector"), is_anchor.alias("is_anchor"),
        )
        rows = rows.withColumn("key", F.xxhash64("label", "vector")).dropDuplicates(["vec_id", "key"])
        self.rows = self.stage.keep(rows, "rows")
        found = self.rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"))
        (self.n, self.width), self.largest = found.first(), largest

    def placed(self) -> DataFrame:
        """Rows in order of label and of the halves of the most spread coordinates, in shards."""
        spread = self.rows.select(F.posexplode("vector")).groupBy("pos").agg(F.var_pop("col").alias("v"))
        dims = [r.pos for r in spread.orderBy(F.desc("v"), "pos").limit(PLACED_BY).collect()]
        order: list[Column] = [F.col("label")]
        if dims:
            at = [F.coalesce(F.get("vector", F.lit(d)).cast("double"), F.lit(0.0)) for d in dims]
            middles = self.rows.agg(*(F.percentile_approx(c, 0.5).alias(f"m{i}") for i, c in enumerate(at))).first()
            order += [c > m for c, m in zip(at, middles)]
        cores = self.spark.sparkContext.defaultParallelism
        shards = max(-(-self.n // SHARD_ROWS), min(2 * cores, -(-self.n // LEAST_SHARD)))
        dealt = self.rows.repartitionByRange(shards, *order, F.col("vec_id"), F.col("key"))
        return self.stage.keep(dealt.select("vec_id", "label", "vector"), "shards")

    def queries(self, table: DataFrame, k: int, same: bool) -> Iterator[Queries]:
        """Slices of `table`: vec_id, key, label, vector and an array of window names, low and high ends."""
        slices = -(-table.count() // SLICE_ANCHORS)
        # scores of whole numbers are exact below 2^53, and with 64 bits of mantissa as long as they fit a long
        kind = np.float64 if self.largest**2 * self.width < 2**53 else np.longdouble
        if self.largest**2 * self.width >= 2**63:
            raise ValueError("scores of these components do not fit 64 bits")
        for at in range(slices):
            rows = table.where(F.pmod(F.xxhash64("vec_id", "key"), F.lit(slices)) == at)
            t = rows.select("vec_id", "key", "label", "vector", "windows").toArrow()
            if not t.num_rows:
                continue
            windows = [[(x["name"], x["low"], x["high"]) for x in w] for w in t["windows"].to_pylist()]
            most = max(map(len, windows))
            filled = np.array([w + [(0, np.inf, -np.inf)] * (most - len(w)) for w in windows], kind)
            names = np.array([[x[0] for x in w] + [0] * (most - len(w)) for w in windows], np.int64)
            yield Queries(
                *(t[c].to_numpy() for c in ("vec_id", "key", "label")),
                matrix(t["vector"].combine_chunks(), self.width).astype(kind),
                filled[:, :, 1], filled[:, :, 2], names, same, k,
            )

    def answered(self, table: DataFrame, shards: DataFrame, k: int, same: bool, name: str) -> DataFrame | None:
        """The first k of all shards for each window, as FOUND with `rank`."""
        parts = [self.stage.keep(q.answer(shards), f"{name}-{i}") for i, q in enumerate(self.queries(table, k, same))]
        if not parts:
            return None
        order = Window.partitionBy("anchor_id", "anchor_key", "window").orderBy(F.desc("score"), "vec_id")
        found = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return self.stage.keep(found, name)

    def run(self) -> DataFrame | None:
        s = self.s
        if not self.n:
            return None
        shards = self.placed()
        anchors = self.rows.where("is_anchor").drop("is_anchor")
        inf = F.lit(float("inf"))
        every = F.array(F.struct(F.lit(0).cast("long").alias("name"), (-inf).alias("low"), inf.alias("high")))
        positives = self.answered(anchors.withColumn("windows", every), shards, s.positives, True, "positives")
        if positives is None:
            return None
        p = F.col("score")
        # in whole numbers: the least and the greatest score with low * p <= 100 * score <= high * p
        low, high = F.ceil(s.low * p / F.lit(100).cast("decimal(3,0)")), F.floor(s.high * p / F.lit(100).cast("decimal(3,0)"))
        window = F.struct(p.alias("name"), low.cast("double").alias("low"), high.cast("double").alias("high"))
        wanted = positives.where(low <= high).groupBy("anchor_id", "anchor_key")
        wanted = wanted.agg(F.sort_array(F.collect_set(window), asc=False).alias("windows"))
        same = (anchors.vec_id == wanted.anchor_id) & (anchors.key == wanted.anchor_key)
        asked = self.stage.keep(anchors.join(wanted, same).drop("anchor_id", "anchor_key"), "asked")
        negatives = self.answered(asked, shards, s.negatives, False, "negatives")
        if negatives is None:
            return None
        of = positives.select("anchor_id", "anchor_key", F.col("score").alias("window"), F.col("vec_id").alias("positive_id"))
        return of.join(negatives, ["anchor_id", "anchor_key", "window"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            F.col("window").alias("positive_score"), F.col("score").alias("negative_score"),
        )


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(vectors: DataFrame, is_anchor: Column, settings: Settings = Settings()) -> DataFrame:
    """MINED rows: for each anchor and each of its positives, the first rows of other labels within the
    positive's window, ranked from 1.

    Scores are whole inner products of floor(scale * x), exact; equal scores go by smaller `vec_id`.
    An anchor's positives are its best-scored rows of the same label under another id. Rows with a null id
    or label, a null vector, or a null or non-finite component take no part. Rows repeated in full are one
    row; rows that share an id but not label and vector are all rows. Shorter vectors count as ending in
    zeros, and one without components scores 0 with all. A negative positive score has no window when
    `low` < `high`. No anchors, or an empty table, give no rows. `is_anchor` is a condition on the columns
    of `vectors`, of which only `vec_id`, `label` and `embedding` are read otherwise. Components so large
    that scores would not fit 64 bits raise. Jobs run, and tables are written to the shared folder, when
    this is called.
    """
    found = Miner(vectors, is_anchor, settings, Stage(vectors.sparkSession, "negatives")).run()
    return vectors.sparkSession.createDataFrame([], MINED) if found is None else found
