"""CSV, landed files, snapshots, upserts, constraints, pages and reports."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.operators import ranking, upsert
from filing_signals.plans import load
from filing_signals.plans import reports as R
from filing_signals.plans import scoring as C
from filing_signals.plans.sentences import observed
from filing_signals.schemas import COMPANY_SCORES, DOCUMENTS, SENTENCE_SCORES, SENTENCES, SENTENCES_CSV
from filing_signals.sources import landed
from filing_signals.sources.snapshots import SnapshotTable, staged

ROWS = "doc_id string, sentence_id int, text string"


def test_csv_roundtrip_of_awkward_texts(spark, tmp_path):
    rows = [("a", 1, 'say "hi", twice'), ("b", 2, "line\nbreak"), ("c", None, "  padded  "), ("d", 4, "back\\slash \\\""), ("e", 5, None), ("f", 6, "")]
    path = str(tmp_path / "csv")
    landed.write_csv(spark.createDataFrame(rows, "doc_id string, sentence_id long, text string"), path)
    want = rows[:-1] + [("f", 6, None)]  # an empty field reads as missing
    assert sorted(map(tuple, landed.read_csv(spark, path, SENTENCES_CSV).collect())) == want
    first = next((tmp_path / "csv").glob("part-*")).read_text(encoding="utf-8")
    assert first.startswith("doc_id,sentence_id,text\n")


def test_csv_columns_bind_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text('text,extra,doc_id,sentence_id\nNA,1,d,7\n', encoding="utf-8")
    got = landed.read_csv(spark, str(tmp_path / "x.csv"), SENTENCES_CSV, multi_line=False).collect()
    assert [tuple(r) for r in got] == [("d", 7, "NA")]


def test_csv_checks(spark, tmp_path):
    (tmp_path / "x.csv").write_text("doc_id,words\nd,x\n", encoding="utf-8")
    with pytest.raises(landed.MissingColumns, match="sentence_id"):
        landed.read_csv(spark, str(tmp_path / "x.csv"), SENTENCES_CSV)
    with pytest.raises(AnalysisException):
        landed.read_csv(spark, str(tmp_path / "none.csv"), SENTENCES_CSV)


def test_landed_files(spark, tmp_path):
    folder = tmp_path / "base" / "T" / "10-K" / "0001"
    folder.mkdir(parents=True)
    (folder / "a b.htm").write_bytes(b"<p>ok\xff</p>")
    manifest = spark.createDataFrame(
        [("D001", str(folder / "a b.htm")), ("D002", str(folder / "gone.htm"))], "doc_id string, file_path string"
    )
    found, missing = landed.match_manifest(manifest, landed.landed_files(spark, str(tmp_path / "base"), "*.htm"))
    assert [(r["doc_id"], r["text"]) for r in found.collect()] == [("D001", "<p>ok</p>")]
    assert [r["doc_id"] for r in missing.collect()] == ["D002"]
    assert "content" not in missing._jdf.queryExecution().executedPlan().toString()


def test_snapshot_upsert(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), SENTENCES).create_if_missing()
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")], ROWS))
    batch = spark.createDataFrame([("new", 0, "a"), ("short", 0, "a")], "text string, sentence_id int, doc_id string").limit(1)
    want = [("a", 0, "new"), ("a", 1, "y"), ("b", 0, "z")]
    for _ in range(2):
        assert sorted(map(tuple, table.upsert(batch).collect())) == want
    assert sorted(map(tuple, table.upsert(batch, replace_by="doc_id").collect())) == [("a", 0, "new"), ("b", 0, "z")]


def test_snapshot_rejects_bad_batches_and_keeps_the_old_one(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), SENTENCES)
    table.upsert(spark.createDataFrame([("a", 0, "x")], ROWS))
    with pytest.raises(upsert.ConstraintError, match="more than once"):
        table.upsert(spark.createDataFrame([("b", 0, "x"), ("b", 0, "y")], ROWS))
    with pytest.raises(Exception, match="sentences.text is null"):
        table.upsert(spark.createDataFrame([("b", 0, None)], ROWS))
    with pytest.raises(upsert.ConstraintError, match="lacks"):
        table.upsert(spark.createDataFrame([("b", 0)], "doc_id string, sentence_id int"))
    assert [tuple(r) for r in table.read().collect()] == [("a", 0, "x")]


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), SENTENCES)
    table.upsert(spark.createDataFrame([("a", 0, "x")], ROWS))
    (tmp_path / "sentences" / "snapshot=00000009").mkdir()
    assert table.read().count() == 1
    table.upsert(spark.createDataFrame([("b", 0, "x")], ROWS))
    assert table.read().count() == 2


def test_defaults_and_types(spark, tmp_path):
    row = spark.createDataFrame([("c", "t", 0.5, 3)], "company_id string, theme_id string, avg_score double, n_sentences long")
    stored = SnapshotTable(spark, str(tmp_path), COMPANY_SCORES).upsert(row.withColumn("avg_final_100", F.lit(1.0)))
    assert stored.schema.simpleString() == COMPANY_SCORES.schema.simpleString()
    assert stored.first()["updated_at"] is not None


def test_constraints(spark):
    rows = [("a", 0, "x"), ("a", 0, "y"), (None, 1, "z"), ("b", 2, None), ("q", 3, "w"), ("q", 4, "w")]
    parents = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    report = upsert.constraint_report(SENTENCES, spark.createDataFrame(rows, ROWS), {"doc_id": parents})
    assert {r["rule"]: r["violations"] for r in report.collect()} == {
        "key:doc_id,sentence_id": 1,
        "not_null:doc_id": 1,
        "not_null:sentence_id": 0,
        "not_null:text": 1,
        "reference:doc_id": 2,
    }
    left = upsert.cascade_delete(spark.createDataFrame(rows, ROWS), parents, "doc_id")
    assert sorted(r["sentence_id"] for r in left.collect()) == [1, 3, 4]


@pytest.mark.parametrize("top_rows", [100_000, 0])
def test_pages(spark, top_rows):
    rows = [(f"d{i % 7}", i, "t") for i in range(500)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = ranking.ordered_page(df, ["doc_id", "sentence_id"], 130, 40, top_rows).collect()
    assert [tuple(r) for r in got] == sorted(rows)[130:170]
    assert ranking.first_rows(df, ["doc_id", "sentence_id"], 0).count() == 500


def test_pages_keep_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "n"), ("a", "x"), ("a", "y"), ("b", "z"), (None, None)], "k string, v string")
    shallow, deep = ([tuple(r) for r in ranking.ordered_page(df, ["k"], 1, 3, n).collect()] for n in (100, 0))
    assert shallow == deep and [k for k, _ in deep] == [None, "a", "a"]
    assert ranking.ordered_page(df.limit(0), ["k"], 0, 3, 0).count() == 0


def test_repeated_score_keys_raise_and_change_nothing(spark, tmp_path):
    one = [("d", 0, "T1", "c", 0.5, 0.5, 1.0, 0.9, 0.8, 0.2, 0.5, 1.0, 50.0, 0.5)]
    names = [c for c in SENTENCE_SCORES.columns if c != "scored_at"]
    fields = T.StructType([f for f in SENTENCE_SCORES.schema if f.name in names])
    order = "doc_id sentence_id theme_id company_id semantic_sim phonetic_sim polarity confidence alpha beta raw_base time_weight final_score_100 theme_score".split()
    frame = lambda rows: spark.createDataFrame([tuple(dict(zip(order, r))[c] for c in fields.fieldNames()) for r in rows], fields)
    root = str(tmp_path)
    C.store(spark, root, frame(one))
    with pytest.raises(upsert.ConstraintError):
        C.store(spark, root, frame(one + one))
    assert SnapshotTable(spark, root, SENTENCE_SCORES).read().count() == 1


def test_delete_documents_takes_their_sentences(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([(d, "c", None, None, "10-K", None, None) for d in "ab"], DOCUMENTS.schema)
    SnapshotTable(spark, root, DOCUMENTS).upsert(docs)
    SnapshotTable(spark, root, SENTENCES).upsert(spark.createDataFrame([("a", 0, "x"), ("b", 0, "y"), ("b", 1, "z")], ROWS))
    load.delete_documents(spark, root, spark.createDataFrame([("b",)], "doc_id string"))
    assert [r.doc_id for r in SnapshotTable(spark, root, DOCUMENTS).read().collect()] == ["a"]
    assert [r.text for r in SnapshotTable(spark, root, SENTENCES).read().collect()] == ["x"]


def test_reports(spark):
    scores = spark.createDataFrame(
        [("A", "t1", "d", i, float(i % 5) if i else None) for i in range(30)] + [("A", "t1", "gone", 0, 99.0), ("B", "t2", "d", 3, 1.0)],
        "company_id string, theme_id string, doc_id string, sentence_id int, final_score_100 double",
    )
    sents = spark.createDataFrame([("d", i, f"s{i}") for i in range(30)], ROWS)
    themes = spark.createDataFrame([("t1", "one"), ("t2", "two"), ("t3", "three")], "theme_id string, theme string")
    best = R.top_evidence(scores, sents, "A", "t1", k=3).collect()
    assert [(r["sentence_id"], r["final_score_100"]) for r in best] == [(0, None), (4, 4.0), (9, 4.0)]
    ranked = R.top_evidence(scores, sents, k=3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    top = ranking.top_per_group(scores, ["company_id"], [F.col("sentence_id")], 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["company_id"], r["rank"], r["sentence_id"]) for r in ranked.collect()) == [
        ("A", 1, 0), ("A", 2, 4), ("A", 3, 9), ("B", 1, 3)
    ]
    companies = spark.createDataFrame(
        [("A", "t1", 5.0, 3), ("A", "t2", None, 1), ("A", "t3", 7.0, 2), ("B", "t2", 1.0, 1)],
        "company_id string, theme_id string, avg_final_100 double, n_sentences int",
    )
    assert [r["theme_id"] for r in R.top_themes(companies, themes, "A", 2).collect()] == ["t2", "t3"]
    report = {(r["company_id"], r["theme_id"]): r for r in R.evidence_report(companies, themes, scores, sents, 3, 3).collect()}
    assert report[("A", "t1")]["evidence"] == "s0 | s4 | s9" and report[("A", "t1")]["n_evidence"] == 3
    assert report[("A", "t3")]["evidence"] is None
    assert tuple(R.counts(sents, scores).first()) == (30, 32)


def test_top_per_group_beyond_the_plan_limit(spark):
    rows = spark.range(6000).selectExpr("id % 2 AS g", "id")
    got = ranking.top_per_group(rows, ["g"], [F.col("id").desc()], 2500)
    assert got.groupBy("g").count().collect()[0]["count"] == 2500


def test_staged_and_observed(spark):
    df = observed(staged(spark.range(10).toDF("id")), "loaded")
    assert df.count() == 10
    assert DOCUMENTS.columns[0] == "doc_id"


def test_loaded_texts_keep_quoted_line_breaks(spark, tmp_path):
    root = str(tmp_path / "store")
    docs = spark.createDataFrame([("a", "c", None, None, "10-K", None, None)], DOCUMENTS.schema)
    SnapshotTable(spark, root, DOCUMENTS).upsert(docs)
    path = str(tmp_path / "sentences")
    landed.write_csv(spark.createDataFrame([("a", 0, "first line\nsecond line"), ("a", 1, "x")], ROWS), path)
    load.load_sentences(spark, root, path)
    stored = SnapshotTable(spark, root, SENTENCES).read()
    assert {r.text for r in stored.collect()} == {"first line\nsecond line", "x"}


@pytest.mark.parametrize("small", [True, False])
def test_landed_extraction_by_manifest_order(spark, tmp_path, monkeypatch, small):
    from filing_signals.plans import sentences as S

    monkeypatch.setattr(S, "is_small", lambda df: small)
    names = [f"D{i:03d}" for i in (2, 999, 1000, 1001)]
    for n in [*names, "D555"]:
        (tmp_path / f"{n}.htm").write_text(f"<p>The sentence of document {n} is long enough</p>")
    rows = [(n, f"{tmp_path}/{n}.htm") for n in reversed(names)] + [("D001", "gone.htm")]
    manifest = spark.createDataFrame(rows, "doc_id string, file_path string")
    found, missing = S.extract_landed(manifest, str(tmp_path), "*.htm", limit=4)
    assert sorted(r.doc_id for r in found.collect()) == ["D002", "D1000", "D999"]
    assert [r.doc_id for r in missing.collect()] == ["D001"]
