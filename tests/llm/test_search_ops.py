"""Fingerprints, hard negatives and resampling against plain versions and on awkward rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filing_signals.llm import fingerprints as fp
from filing_signals.llm import hard_negatives as hn
from filing_signals.llm import resampling
from filing_signals.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


# fingerprints


def plain_entropy(window: bytes) -> int:
    w = len(window)
    total = sum(round(2**20 * c * math.log2(c)) for c in Counter(window).values())
    return int(1000 * (math.log2(w) - total / (w * 2**20)) / math.log2(w))


def plain_rarity(texts, s):
    counts = Counter(plain_entropy(b[i : i + s.window]) for b in texts for i in range(len(b) - s.window + 1))
    order = sorted(range(1001), key=lambda e: (counts[e], -e))
    return {e: k for k, e in enumerate(order)}


def plain_features(b: bytes, rank, s):
    """The byte strings of a text's features, in order."""
    if len(b) < s.window:
        return [b] if b else []
    ranks = [rank[plain_entropy(b[i : i + s.window])] for i in range(len(b) - s.window + 1)]
    stretch = min(s.stretch, len(ranks))
    picks = Counter(
        min(range(i, i + stretch), key=lambda j: (ranks[j], j)) for i in range(len(ranks) - stretch + 1)
    )
    least = min(s.picked, -(-(len(ranks) - stretch + 1) // 4))
    return [b[i : i + s.window] for i in sorted(picks) if picks[i] >= least]


@pytest.mark.parametrize("settings", [fp.Settings(), fp.Settings(window=64, stretch=64, picked=16)])
def test_features_equal_a_plain_version(settings):
    r = random.Random(4)
    texts = ["", "a", "é" * 40, "x" * 300] + [
        " ".join(r.choice(["alpha", "beta", "γάμμα", "12.5%", "and", "of"]) for _ in range(n)) for n in (1, 2, 5, 20, 60)
    ]
    raw = [t.encode() for t in texts]
    rank = plain_rarity(raw, settings)
    known = np.array([rank[e] for e in range(1001)])
    hashes, rows = fp.features(pa.array(texts), known, settings)
    counts = np.zeros(1001, np.int64)
    for b in raw:
        for i in range(len(b) - settings.window + 1):
            counts[plain_entropy(b[i : i + settings.window])] += 1
    assert (fp.rarity(counts) == known).all()
    for i, b in enumerate(raw):
        wanted = plain_features(b, rank, settings)
        assert (rows == i).sum() == len(wanted)
        # equal features, and no others, have equal hashes
        got = hashes[rows == i].tolist()
        assert len(set(zip(got, wanted))) == len(set(got)) == len(set(wanted))


def test_entropies_across_blocks(monkeypatch):
    data = np.random.default_rng(1).integers(0, 6, 1000).astype(np.uint8)
    whole = fp.entropies(data, 12)
    monkeypatch.setattr(fp, "BLOCK", 70)
    assert (fp.entropies(data, 12) == whole).all()
    assert whole.tolist() == [plain_entropy(data[i : i + 12].tobytes()) for i in range(989)]


def test_filters_chain_and_compare():
    s = fp.Settings(most=10)
    r = random.Random(0)
    text = lambda n: " ".join(f"{r.choice('abcdefgh')}{r.randrange(10**6)}" for _ in range(n))
    base = text(300)
    texts = [base, base, base[: len(base) // 2] + text(150), text(300), "", "tiny", base[:40]]
    own = fp.fingerprints(pa.array(texts), np.arange(1001), s)
    assert np.diff(own.offsets)[0] > 10 and np.diff(own.offsets)[4] == 0 and np.diff(own.offsets)[5] == 1
    back = fp.read_fingerprint(own.texts(), s)
    assert (back.filters == own.filters).all() and (back.offsets == own.offsets).all()
    against = lambda i: fp.likeness(own.take(np.full(7, i)), own, s)
    assert against(0)[0] == against(0)[1] == 1 and 0.3 < against(0)[2] < 0.8 and against(0)[3] < 0.25
    assert list(against(4)) == [0, 0, 0, 0, 1, 0, 0]
    # both ways alike, and in parts as at once
    assert against(0)[6] == fp.likeness(own.take(np.array([6])), own.take(np.array([0])), s)[0]
    assert (fp.likeness(own.take(np.full(7, 0)), own, s, pairs_at_once=3) == against(0)).all()


def plain_pairs(rows):
    """[(doc_id, n_chars, sha of the edited text, text, following)] where no id comes twice."""
    rows = sorted(rows)
    out = []
    for (i, t), (_, f) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - half] + f[:half]).encode()).hexdigest(), t, f))
    return out


@pytest.mark.parametrize("partitions", ["1", "8", "61"])
def test_fingerprints_of_a_table(spark, partitions):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(["ä", "bc", "def", "\n", "ghij"]) for _ in range(r.randrange(200)))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {x.doc_id: x for x in fp.fingerprinted(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    s = fp.Settings()
    rank = plain_rarity([t.encode() for _, t in rows], s)
    rank = np.array([rank[e] for e in range(1001)])
    assert len(found) == len(rows)
    for i, n, digest, text, following in plain_pairs(rows):
        x = found[i]
        assert (x.n_chars, x.edited_sha256) == (n, digest)
        own, other, after = (fp.fingerprints(pa.array([t]), rank, s) for t in (text, fp.edited(text, following), following))
        assert (x.fingerprint, x.edited_fingerprint) == (own.texts()[0], other.texts()[0])
        assert x.near_edited == fp.likeness(own, other, s)[0] and x.near_next == fp.likeness(own, after, s)[0]


def test_fingerprints_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    rows = fp.fingerprinted(docs).collect()
    assert len(rows) == docs.count()
    empty = [x for x in rows if not x.n_chars]
    assert {x.fingerprint for x in empty} == {""} and {x.edited_sha256 for x in empty} == {brute.sha("")}
    six = [x for x in rows if x.doc_id == 6]
    assert len({x.fingerprint for x in six}) == 1 and 1.0 in {x.near_next for x in six}
    assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in rows)
    assert fp.fingerprinted(docs.limit(0)).count() == 0
    one = fp.fingerprinted(spark.createDataFrame([(1, "only one text")], "doc_id long, text string")).first()
    assert one.near_next == 1 and one.edited_sha256 == brute.sha("only ononly o")


def test_fingerprints_tell_edited_texts_from_others(spark):
    rows = QUERIES["op11_fingerprints"](spark, SF).where("n_chars >= 300").collect()
    assert len(rows) > 50
    assert sum(x.near_edited > x.near_next for x in rows) / len(rows) > 0.95
    base64.b64decode(rows[0].fingerprint, validate=True)


# hard negatives


def plain_negatives(rows, is_anchor, s=hn.Settings()):
    """MINED rows of distinct (vec_id, label, components)."""
    seen = set()
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            seen.add((i, label, tuple(math.floor(s.scale * x) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in seen:
        if not is_anchor(i):
            continue
        scored = sorted((-dot(v, w), j, other == label) for j, other, w in seen)
        for p, j, _ in [x for x in scored if x[2] and x[1] != i][: s.positives]:
            fits = [x for x in scored if not x[2] and s.low * -p <= 100 * -x[0] <= s.high * -p]
            out += [(i, j, k + 1, x[1], -p, -x[0]) for k, x in enumerate(fits[: s.negatives])]
    return sorted(out)


def vectors(seed, n=400, width=5, labels=4):
    r = random.Random(seed)
    component = lambda: r.choice([0.0, 0.5, -0.25, r.uniform(-1, 1)])
    rows = [(i, r.randrange(labels), [component() for _ in range(width)]) for i in range(n)]
    # ties: copies of rows under other ids and labels
    rows += [(n + k, r.randrange(labels), rows[r.randrange(n)][2]) for k in range(n // 4)]
    return rows


@pytest.mark.parametrize("seed,width,labels", [(0, 5, 4), (1, 1, 2), (2, 12, 40), (3, 3, 1)])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, seed, width, labels):
    monkeypatch.setattr(hn, "LEAST_SHARD", 100)
    monkeypatch.setattr(hn, "SLICE_ANCHORS", 30)
    rows = vectors(seed, width=width, labels=labels)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = hn.hard_negatives(df, F.col("vec_id") % 5 == 0).collect()
    assert sorted(map(tuple, found)) == plain_negatives(rows, lambda i: i % 5 == 0)


def test_hard_negatives_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(7, n=60, width=3) + [
        (None, 1, [1.0, 0.0, 0.0]), (900, None, [1.0, 0.0, 0.0]), (901, 1, None), (902, 1, [nan, 0.0, 0.0]),
        (903, 1, [0.0, inf, 0.0]), (904, 1, [0.5, None, 0.0]), (905, 1, []), (906, 2, [0.5]), (910, 0, [0.0, 0.0, 0.0]),
        (920, 1, [0.5, 0.5, 0.5]), (920, 1, [0.5, 0.5, 0.5]), (930, 3, [1e5, 1e5, 1e5]), (931, 3, [1e5, 1e5, 1e5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    df = df.withColumns({c: F.lit("x") for c in ("rank", "score", "window", "key", "vector", "anchor_id", "windows", "n")})
    wanted = plain_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, hn.hard_negatives(df, F.col("vec_id") % 10 == 0).collect())) == wanted
    assert hn.hard_negatives(df.limit(0), F.lit(True)).count() == 0
    assert hn.hard_negatives(df, F.lit(False)).count() == 0
    assert hn.hard_negatives(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_tree_prunes_and_stays_exact():
    r = np.random.default_rng(0)
    centres = r.normal(size=(20, 4)) * 1000
    x = np.floor(centres[r.integers(0, 20, 5000)] + r.normal(size=(5000, 4)) * 20)
    labels = r.integers(0, 3, 5000)
    tree = hn.RTree(np.arange(5000), labels, x, leaf=32, fanout=4)
    assert sorted(tree.ids) == list(range(5000)) and np.diff(tree.rows).max() <= 32 and len(tree.levels[-1][0]) == 1
    opened = []
    real = hn.Best.merge
    q, label = x[17], labels[17]
    best = hn.Best(np.array([-np.inf]), np.array([np.inf]), np.full((1, 5), -np.inf), np.full((1, 5), hn._NO_ID))
    hn.Best.merge = lambda self, w, s, i: (opened.append(len(s)), real(self, w, s, i))
    try:
        hn.search(tree, q, label, True, 17, best)
    finally:
        hn.Best.merge = real
    score = x @ q
    rows = [i for i in np.lexsort((np.arange(5000), -score)) if labels[i] == label and i != 17][:5]
    assert best.ids[0].tolist() == rows and best.scores[0].tolist() == score[rows].tolist()
    assert len(opened) < len(tree.rows) // 4


# resampling


def plain_resample(docs, target, s):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(brute.LOWER))
    grams = lambda w: [" ".join(w[i : i + n]) for n in range(1, s.longest + 1) for i in range(len(w) - n + 1)]
    bucket = lambda g: zlib.crc32(g.encode()) % s.buckets
    words = [split(t) for _, t in docs]
    corpus, aim = (Counter(bucket(g) for w in part for g in grams(w)) for part in (words, map(split, target)))
    total = {id(c): sum(c.values()) + s.buckets for c in (corpus, aim)}
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * total[id(corpus)] / ((corpus[b] + 1) * total[id(aim)])))
    out = []
    for (i, _), w in zip(docs, words):
        weight = sum(gain(bucket(g)) for g in grams(w))
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(w), len(grams(w)), weight, score, None])
    able = sorted((x for x in out if x[1] >= s.least_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    for k, x in enumerate(able[: s.percent * len(able) // 100]):
        x[5] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_a_plain_version(spark, longest):
    r = random.Random(longest)
    vocabulary = ["alpha", "Beta", "été", "x1", "the", "THE", "naïve", "中文", "a-b", "\x00z"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    docs = [(i, text(r.randrange(0, 60))) for i in range(150)] + [(1000, None), (1001, ""), (1002, " ?! "), (None, text(30))]
    target = [text(5) for _ in range(6)] + [None, "", "alpha beta"]
    s = resampling.Settings(longest=longest, buckets=50, percent=30)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(df, aim, s).collect()
    assert sorted(map(tuple, found), key=repr) == plain_resample(docs, target, s)


def test_resampling_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    aim = spark.createDataFrame([("plain words",)], "text string")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    s = resampling.Settings(least_words=1, percent=60)
    assert sorted(map(tuple, resampling.resample(docs, aim, s).collect()), key=repr) == plain_resample(given, ["plain words"], s)
    assert resampling.resample(docs.limit(0), aim).count() == 0
    assert resampling.resample(docs, aim.limit(0), s).count() == len(given)


def test_ranks_of_one_id_with_most_rows(spark):
    """Rows that are equal in all of their order still get every rank once."""
    docs = spark.createDataFrame([(7, "same words " * 15)] * 300 + [(i, "other words " * 15) for i in range(50)], "doc_id long, text string")
    aim = spark.createDataFrame([("same",)], "text string")
    ranks = [r.rank for r in resampling.resample(docs, aim).collect() if r.rank is not None]
    assert sorted(ranks) == list(range(1, 36))
