"""Packing, repetition and toxicity against plain versions."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filing_signals.llm import packing, repetition, toxicity
from filing_signals.llm.queries import QUERIES, word_tokenizer
from filing_signals.llm.words import byte_slices, split_words
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_words_are_split_at_ascii_blanks_only():
    texts = pa.array(["a\x0bb\x0cc  d", "", " \n", "x y z\x1cq", None, "end "])
    for row, part in byte_slices(texts):
        w = split_words(part)
        found = [w.dictionary.take(pa.array(w.codes[a:b])).to_pylist() for a, b in zip(w.offsets[:-1], w.offsets[1:])]
        assert row == 0 and found == [brute.words(t) for t in texts.to_pylist()]


def test_slices_keep_all_rows():
    texts = pa.array(["x" * 50, None, "y" * 200, "z"] * 5)
    parts = list(byte_slices(texts, 100))
    assert [t for _, p in parts for t in p.to_pylist()] == [t or "" for t in texts.to_pylist()]
    assert [r for r, _ in parts] == [sum(len(p) for _, p in parts[:i]) for i in range(len(parts))]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer())


def check_pieces(rows, docs, tokenizer):
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == sorted(
        brute.token_pieces(tokenizer, docs)
    )
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_id = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.length for r in by_id] == sorted((r.length for r in rows), reverse=True)


def test_op5_equals_the_tokenizer_on_whole_texts(spark, tokenizer):
    rows = QUERIES["op5_packing"](spark, SF).collect()
    check_pieces(rows, pairs(spark.read.parquet(f"{SF}/documents.parquet")), tokenizer)


def test_packing_of_awkward_rows(spark, tokenizer):
    docs = brute.awkward(spark).where("doc_id IS NOT NULL")
    rows = packing.pack(docs, word_tokenizer()).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, pairs(docs), tokenizer)
    nameless = packing.pack(brute.awkward(spark).where("doc_id IS NULL"), word_tokenizer())
    assert {r.doc_id for r in nameless.collect()} == {None}
    assert packing.pack(docs.limit(0), word_tokenizer()).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(docs, word_tokenizer(), longest=1000)


@pytest.mark.parametrize("text", ["AB.C-d é'S we're <|endoftext|> x", "ʼn İstanbul Σας ß…!", "éá. 1.2 ½", "it's, o'clock'll", "Bİ.", "TÜRKİ, ANKARA İ! aİ<\u0338 Ab<\u0338"])
def test_word_coder_on_odd_text(tokenizer, text):
    coder = packing.WordCoder(word_tokenizer())
    for _ in range(2):  # the second time from memory
        ids, offsets = coder.encode(pa.array([text, "plain words, here"]))
        for k, t in enumerate([text, "plain words, here"]):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_op6_equals_plain_counts(spark):
    docs = dict(pairs(spark.read.parquet(f"{SF}/documents.parquet")))
    rows = QUERIES["op6_repetition"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        for name, n in brute.repetition(docs[r.doc_id], tuple(repetition.MOST_COVERED)).items():
            assert r[name] == n, (r.doc_id, name)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repetition_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    lengths = (2, 3, 5)
    found = sorted(repetition.repetition(docs, lengths).collect(), key=lambda r: (r.doc_id or 0, r.word_chars))
    expected = [(i, brute.repetition(t, lengths)) for i, t in pairs(docs)]
    expected.sort(key=lambda x: (x[0] or 0, x[1]["word_chars"]))
    for r, (i, want) in zip(found, expected, strict=True):
        assert r.doc_id == i and {c: r[c] for c in want} == want
    assert repetition.repetition(docs.limit(0)).count() == 0


def test_repeated_text_is_not_kept(spark):
    clean = " ".join(f"word{i}" for i in range(300))
    passage = " ".join(f"copy{i}" for i in range(40))
    rows = [(1, clean), (2, f"{clean} {passage} {passage} {passage}"), (3, "\n".join(["the same line again"] * 30 + [clean]))]
    out = {r.doc_id: r for r in repetition.judged(repetition.repetition(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert [out[i].kept for i in (1, 2, 3)] == [True, False, False]
    assert not out[2].base_failed


def test_op2_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES["op2_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    wrong = sum(r.predicted and not r.toxic for r in rows)
    assert hit >= 0.7 * sum(r.toxic for r in rows) and wrong <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_and_storage_change_nothing(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.toxicity(docs, labels)
    b = toxicity.toxicity(docs.repartition(5).withColumn("lang", F.lit("x")), other.repartition(3))
    assert {(r.doc_id, r.score) for r in a.collect()} == {(r.doc_id, r.score) for r in b.collect()}


def test_toxicity_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, 1, 1), (6, None, None), (77, 1, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, labels, carry=True)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert sorted(rows[0].row.asDict().keys()) == sorted(docs.columns)
    assert all(r.row.label == "label" for r in rows)
    assert len({r.score for r in rows if not r.row.text}) == 1
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1 and {r.predicted for r in none} == {0} and none[0].score < 1e-9
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_ftrl_equals_a_plain_version():
    r = np.random.default_rng(5)
    s = toxicity.Settings(bits=10, epochs=3, l1=0.7, least_texts=2)
    rows = [np.unique(r.choice(200, r.integers(0, 40), p=np.arange(1, 201) / 20100)).astype(np.int32) for _ in range(150)]
    labels = np.array([float(7 in x or r.random() < 0.1) for x in rows])
    ends = lambda part: np.cumsum([0, *(len(x) for x in part)])
    parts = [(np.concatenate(part), ends(part)) for part in (rows[:60], rows[60:])]
    buckets, weights, bias = toxicity.ftrl(parts, labels, s)
    plain, plain_bias = brute.ftrl([x.tolist() for x in rows], labels.tolist(), s)
    assert set(buckets.tolist()) == set(plain) and 0 < len(plain) < 200
    assert all(abs(plain[b] - w) < 1e-9 for b, w in zip(buckets.tolist(), weights)) and abs(bias - plain_bias) < 1e-9


def test_repeated_rows_do_not_fill_the_sample(spark):
    rows = [(1, "the same text")] * 500 + [(1, "another text of it")] + [(i, f"text number {i}") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 60)], "doc_id long, quality int, toxic int")
    s = toxicity.Settings(sample_rows=20)
    sample = toxicity.labelled_sample(docs, labels, s).collect()
    known = [r.doc_id for r in labels.where(~toxicity.held_out("doc_id")).orderBy(F.xxhash64("doc_id")).collect()]
    assert len(sample) == 20 and {r.doc_id for r in sample} <= set(known[:20])
    assert sum(r.doc_id == 1 for r in toxicity.labelled_sample(docs, labels, toxicity.Settings()).collect()) <= 2


def test_rare_features_are_left_out_before_training(spark, monkeypatch):
    s = toxicity.Settings(bits=16, least_texts=3)
    rows = [(i, i, i % 2, sorted({5, 40_000 + i % 7, 60_000 + i})) for i in range(12)] + [(12, 12, 0, [])]
    sample = spark.createDataFrame(rows, toxicity.FEATURES).repartition(3)
    often = {b for b in range(1 << 16) if sum(b in r[3] for r in rows) >= 3}
    assert set(np.flatnonzero(toxicity.frequent(sample, s)).tolist()) == often
    reached = []
    plain = toxicity.with_frequent
    monkeypatch.setattr(toxicity, "with_frequent", lambda *a: reached.append(plain(*a).collect()) or plain(*a))
    toxicity.train(sample, s)
    assert sorted(tuple(r) for r in reached[0]) == [(*r[:3], [b for b in r[3] if b in often]) for r in rows]


def test_runs_of_rows_cover_all():
    offsets = np.array([0, 3, 3, 20, 21, 22])
    assert list(toxicity.row_runs(offsets, 4)) == [(0, 2), (2, 3), (3, 5)]
    assert list(toxicity.row_runs(np.zeros(1, int))) == []
