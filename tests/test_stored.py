"""Stored tables that grow batch by batch: what they hold, and what a batch reads and writes."""

import json
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from filing_signals.functions.phonetic import phonetic_code
from filing_signals.operators import rules
from filing_signals.operators.seek import SortedTable
from filing_signals.operators.upsert import ConstraintError
from filing_signals.plans import counted, rollup
from filing_signals.plans.dictionary import CodeDictionary
from filing_signals.plans.encoded import EncodedTexts
from filing_signals.plans.lengths import LengthHistogram
from filing_signals.schemas import DOCUMENTS, SENTENCE_SCORES, SENTENCES
from filing_signals.sources import inventory, selective
from filing_signals.sources.buckets import BucketTable, bucket_of
from filing_signals.sources.copartitioned import Copartitioned
from filing_signals.sources.registry import IdRegistry


def sentences(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, sentence_id int, text string")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df, metric):
    """The sum of a metric over all file scans of a plan that is run here."""
    df.collect()

    def walk(p):
        name = p.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(p.executedPlan())
        if name.endswith("QueryStage"):
            return walk(p.plan())
        own = p.metrics().apply(metric).value() if name.startswith("Scan parquet") else 0
        children = p.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


# -- buckets -----------------------------------------------------------------------------------


def stored(spark, tmp_path, rows, buckets=16, by=("doc_id",)):
    table = BucketTable(spark, str(tmp_path), SENTENCES, buckets, list(by))
    table.upsert(sentences(spark, rows))
    return table


def contents(df):
    return sorted(map(tuple, df.collect()))


def test_a_batch_writes_and_reads_only_its_buckets(spark, tmp_path):
    rows = [(f"d{i}", k, f"text {i} {k}") for i in range(60) for k in range(3)]
    table = stored(spark, tmp_path, rows)
    first = table.layout()
    batch = [("d7", 0, "new"), ("d7", 9, "added"), ("x1", 0, "other")]
    table.upsert(sentences(spark, batch))
    wanted = {(d, k): t for d, k, t in rows} | {(d, k): t for d, k, t in batch}
    assert contents(table.read()) == sorted((d, k, t) for (d, k), t in wanted.items())
    touched = {r[0] for r in sentences(spark, batch).select(bucket_of(["doc_id"], 16)).collect()}
    assert set(table.rewritten(2)) == touched and len(touched) <= 2
    assert {b: v for b, v in table.layout().items() if v == 1} == {b: v for b, v in first.items() if b not in touched}
    assert contents(table.read(upto=1)) == sorted(rows)
    assert contents(table.find("d7")) == [("d7", 0, "new"), ("d7", 1, "text 7 1"), ("d7", 2, "text 7 2"), ("d7", 9, "added")]
    assert len(table.find("d7").inputFiles()) == 1
    assert table.upsert(sentences(spark, [])).count() == len(wanted) and len(table.versions()) == 2


def test_replaced_documents_deletes_and_emptied_buckets(spark, tmp_path):
    rows = [(f"d{i}", k, "t") for i in range(10) for k in range(4)]
    table = stored(spark, tmp_path, rows, buckets=64)
    table.upsert(sentences(spark, [("d3", 0, "only")]), "doc_id")
    assert contents(table.read().where("doc_id = 'd3'")) == [("d3", 0, "only")]
    table.delete(spark.createDataFrame([("d3",), ("d4",), ("nowhere",)], "doc_id string"), "doc_id")
    left = sorted(r for r in rows if r[0] not in ("d3", "d4"))
    assert contents(table.read()) == left
    # the emptied buckets do not fall back to their earlier rows, also after old folders are gone
    assert table.keep_last(1) > 0 and contents(table.read()) == left
    table.upsert(sentences(spark, [("d4", 0, "back")]))
    assert contents(table.read().where("doc_id = 'd4'")) == [("d4", 0, "back")]
    with pytest.raises(ValueError):
        table.upsert(sentences(spark, [("d4", 0, "x")]), "sentence_id")
    with pytest.raises(ValueError):
        BucketTable(spark, str(tmp_path), SENTENCES, by=["text"])


def test_unfinished_versions_are_not_read_and_bad_batches_change_nothing(spark, tmp_path):
    rows = [("a", 0, "x"), ("b", 0, "y")]
    table = stored(spark, tmp_path, rows)
    sentences(spark, [("a", 0, "half")]).withColumn("bucket", F.lit(1)).write.partitionBy("bucket").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{tmp_path}/sentences/version=00000002")
    assert contents(table.read()) == rows and table.versions() == [1]
    with pytest.raises(ConstraintError):
        table.upsert(sentences(spark, [("a", 0, "p"), ("a", 0, "q")]))
    with pytest.raises(Exception, match="is null"):
        table.upsert(sentences(spark, [("a", None, "p")]))
    assert contents(table.read()) == rows
    table.upsert(sentences(spark, [("a", 0, "z")]))
    assert table.versions() == [1, 3]
    table.keep_last(5)
    assert contents(table.read()) == [("a", 0, "z"), ("b", 0, "y")] and contents(table.read(upto=1)) == rows


def test_keep_last_leaves_what_older_states_need(spark, tmp_path):
    table = stored(spark, tmp_path, [(f"d{i}", 0, "v1") for i in range(30)])
    for n in range(2, 6):
        table.upsert(sentences(spark, [(f"d{i}", 0, f"v{n}") for i in range(n)]))
    states = {v: contents(table.read(upto=v)) for v in (4, 5)}
    table.keep_last(2)
    assert {v: contents(table.read(upto=v)) for v in (4, 5)} == states
    held = sum(len(table.rewritten(v)) for v in table.versions())
    assert held == len({(v, b) for upto in (4, 5) for b, v in table.layout(upto).items()})


# -- rollup ------------------------------------------------------------------------------------


def scores(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, company_id string, theme_id string, theme_score double, final_score_100 double")
    zero = [F.lit(0.0).alias(c) for c in ("semantic_sim", "phonetic_sim", "polarity", "confidence", "raw_base", "time_weight")]
    return df.select("*", *zero)


def plain_rollup(rows):
    out = {}
    for r in rows:
        out.setdefault((r.company_id, r.theme_id), []).append(r)
    mean = lambda xs: sum(xs) / len(xs) if xs else None
    return {
        g: (mean([r.theme_score for r in rs if r.theme_score is not None]), len(rs), mean([r.final_score_100 for r in rs if r.final_score_100 is not None]))
        for g, rs in out.items()
    }


def same_rollup(rolled, table):
    mine = {(r.company_id, r.theme_id): (r.avg_score, r.n_sentences, r.avg_final_100) for r in rolled.collect()}
    theirs = plain_rollup(table.read().collect())
    assert set(mine) == set(theirs)
    for g, (a, n, f) in theirs.items():
        assert mine[g][1] == n
        assert mine[g][0] == pytest.approx(a, abs=1e-12) and mine[g][2] == pytest.approx(f, abs=1e-12)


def test_rollup_by_batches_equals_a_full_one(spark, tmp_path):
    r = random.Random(3)
    rolled = rollup.RolledScores(spark, str(tmp_path), buckets=8)
    company = {f"d{i}": f"c{i % 5}" for i in range(40)}

    def batch(docs):
        return [
            (d, k, company[d], t, r.choice([None, r.uniform(-1, 1), 0.1]), r.choice([None, r.uniform(-100, 100)]))
            for d in docs for k in range(3) for t in ("T1", "T2")
        ]

    same_rollup(rolled.add(scores(spark, batch([f"d{i}" for i in range(30)]))), rolled.scores)
    same_rollup(rolled.add(scores(spark, batch(["d3", "d4", "d35"]))), rolled.scores)
    company["d3"] = "c9"  # its rows move to another company, and rows of it go
    same_rollup(rolled.add(scores(spark, batch(["d3"])[:2]), replace_documents=True), rolled.scores)
    # a batch costs its own groups: sums of other buckets were not written again
    assert len(rolled.sums.rewritten(rolled.sums.versions()[-1])) <= 4
    # a job that failed between scores and sums: sums are made anew
    rolled.scores.upsert(scores(spark, batch(["d5"])))
    out = rolled.add(scores(spark, batch(["d6"])))
    same_rollup(out, rolled.scores)
    assert rolled.sums.versions()[-1] == rolled.scores.versions()[-1]


def test_rollup_is_exact_in_any_order(spark, tmp_path):
    values = [1e-9, 1.0, -1.0, 0.1, 0.2, 0.3, -0.6] * 50
    rows = [(f"d{i}", 0, "c", "T", v, v) for i, v in enumerate(values)]
    one = rollup.added(rollup.contributions(scores(spark, rows).repartition(7), 1)).first()
    two = rollup.added(rollup.contributions(scores(spark, rows[::-1]).repartition(3), 1)).first()
    assert one == two and one.n_rows == len(rows)


# -- stage counts ------------------------------------------------------------------------------


def test_stage_counts_come_from_one_scan(spark, tmp_path):
    rows = [("a", 0, "one sentence here"), ("a", 0, "one sentence here"), ("a", 1, None), ("doc_id", 2, "text"), ("b", 0, "one sentence here"), ("b", 3, "one sentence here")]
    sentences(spark, rows).write.parquet(f"{tmp_path}/in")
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    given = spark.read.parquet(f"{tmp_path}/in")
    out, counts = counted.clean_counted(given.mapInPandas(passing, given.schema), trim_share=0.0)
    assert [(r.stage[0], r.n) for r in counts.collect()] == [("1", 6), ("2", 4), ("3", 3), ("4", 3), ("5", 3), ("6", 2)]
    assert contents(out) == [("a", 0, "one sentence here"), ("b", 0, "one sentence here")]
    assert seen.value == len(rows)


# -- co-partitioned tables ---------------------------------------------------------------------


def test_bucketed_joins_have_no_exchange_and_no_sort(spark, tmp_path):
    rows = [(f"d{i % 50}", i, f"t{i}") for i in range(500)]
    store = Copartitioned(spark, f"{tmp_path}/store", buckets=4, prefix="test_by_doc")
    store.store(sentences(spark, rows), SENTENCES)
    docs = spark.createDataFrame([(f"d{i}", f"c{i % 3}") for i in range(50)], "doc_id string, company_id string")
    for c in ("ticker", "cik", "source_type", "file_path"):
        docs = docs.withColumn(c, F.lit("x"))
    store.store(docs.withColumn("date", F.lit(None).cast("date")), DOCUMENTS)
    joined = store.joined(SENTENCES, DOCUMENTS)
    plan = executed(joined)
    assert joined.count() == 500 and "SortMergeJoin" in plan
    assert "Exchange" not in plan and not re.search(r"\bSort \[", plan)
    # another session declares the stored files again
    spark.sql("DROP TABLE test_by_doc_documents")
    again = store.open(DOCUMENTS)
    assert again.count() == 50 and "Exchange" not in executed(store.joined(SENTENCES, DOCUMENTS))
    for relation in (SENTENCES, DOCUMENTS):
        spark.sql(f"DROP TABLE {store.name(relation)}")


def test_rows_made_from_a_bucketed_table_are_neither_dealt_nor_shuffled_again(spark, tmp_path):
    rows = [(f"d{i % 50}", i // 50, f"t{i}") for i in range(500)]
    store = Copartitioned(spark, f"{tmp_path}/store", buckets=4, prefix="test_dealt")
    held = spark.conf.get("spark.local.dir", None) or spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    shuffled = lambda: {p.name for p in Path(held).rglob("shuffle_*.data")}
    before = shuffled()
    kept = store.store(sentences(spark, rows), SENTENCES)
    assert not shuffled() - before  # what was shuffled for the write went with it
    numbers = {f.name: F.lit(0.5) for f in SENTENCE_SCORES.schema if f.dataType.typeName() == "double"}
    themes = F.explode(F.array(F.lit("T1"), F.lit("T2")))
    made = kept.withColumns({"company_id": F.lit("c"), **numbers}).withColumn("theme_id", themes)
    store.store(made, SENTENCE_SCORES, dealt=True)
    assert len(list((tmp_path / "store" / SENTENCE_SCORES.name).glob("*.parquet"))) == 4  # a file for a bucket
    joined = store.joined(SENTENCE_SCORES, SENTENCES).select("doc_id", "sentence_id", "theme_id", "text")
    wanted = sorted((d, k, t, text) for d, k, text in rows for t in ("T1", "T2"))
    assert contents(joined) == wanted
    plan = executed(joined)  # keys are the bucket key and the number of the sentence
    assert "SortMergeJoin" in plan and "Exchange" not in plan and not re.search(r"\bSort \[", plan)
    # rows that lie in other tasks go to their buckets all the same
    store.store(made.repartition(3, "theme_id", "sentence_id"), SENTENCE_SCORES, dealt=True)
    assert contents(store.joined(SENTENCE_SCORES, SENTENCES).select(*joined.columns)) == wanted
    for relation in (SENTENCES, SENTENCE_SCORES):
        spark.sql(f"DROP TABLE {store.name(relation)}")


# -- dictionary, encoded texts -----------------------------------------------------------------


def test_dictionary_codes_each_token_once(spark, tmp_path):
    rows = [("a", i, "the " * 9 + f"word{i % 3}") for i in range(40)] + [("b", 0, "Knight"), ("b", 1, ""), ("b", 2, "the knight 42 the")]
    df = sentences(spark, rows)
    codes = CodeDictionary(spark, str(tmp_path), buckets=4, heavy_share=0.5)  # `the` has most of all tokens
    wanted = {(r.doc_id, r.sentence_id): r.code for r in df.select("doc_id", "sentence_id", phonetic_code("text").alias("code")).collect()}
    found = codes.codes(df)
    assert {(r.doc_id, r.sentence_id): r.code for r in found.collect()} == wanted
    words = {w for _, _, t in rows for w in t.lower().split()}
    assert {r.token for r in codes.table.read().collect()} == words
    before = codes.table.versions()
    assert codes.codes(df).count() == len(rows) and codes.table.versions() == before
    codes.codes(sentences(spark, [("c", 0, "the newest")]))
    assert {r.token for r in codes.table.read().collect()} == words | {"newest"}


def test_only_new_texts_reach_the_model(spark, tmp_path):
    calls, texts = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def model():
        def run(batch):
            calls.add(1)
            texts.add(len(batch))
            assert [len(t) for t in batch] == sorted(len(t) for t in batch)
            return [[float(len(t))] for t in batch]

        return run

    encoded = EncodedTexts(spark, str(tmp_path), model, buckets=4, batch=5)
    first = sentences(spark, [("a", i, "x" * (i % 7)) for i in range(30)] + [("n", 0, None)])
    out = encoded.encode(first, partitions=1).collect()
    assert {(r.sentence_id, tuple(r.vector)) for r in out if r.doc_id == "a"} == {(i, (float(i % 7),)) for i in range(30)}
    assert [r.vector for r in out if r.doc_id == "n"] == [None] and texts.value == 7 and calls.value == 2
    encoded.encode(first.union(sentences(spark, [("b", 0, "x" * 50), ("b", 1, "xx")]))).collect()
    assert texts.value == 8
    assert encoded.encode(first.limit(0)).count() == 0


# -- registry, inventory, lengths, rules -------------------------------------------------------


def test_registered_keys_keep_their_numbers(spark, tmp_path):
    registry = IdRegistry(spark, str(tmp_path), buckets=4)
    rows = lambda keys: spark.createDataFrame(keys, "filing_key string, place long")
    one = registry.register(rows([("k3", 3), ("k1", 1), ("k2", None), ("k1", 9), (None, 0)]), F.col("place")).collect()
    assert {(r.filing_key, r.number) for r in one} == {("k1", 1), ("k3", 2), ("k2", 3), (None, None)} and len(one) == 5
    two = registry.register(rows([("k0", 0), ("k2", 2), ("k9", 9)]), F.col("place")).collect()
    assert {(r.filing_key, r.number, r.doc_id) for r in two} == {("k0", 4, "D004"), ("k2", 3, "D003"), ("k9", 5, "D005")}
    registry.register(rows([("k1", 1)]), F.col("place"))
    assert len(registry.table.versions()) == 2


def test_changes_between_listings(spark, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    for n in "abc":
        (folder / f"{n}.htm").write_text(n)
    (folder / "skip.txt").write_text("x")
    kept = inventory.Inventory(spark, str(tmp_path / "state"))
    look = lambda: {(r.file_path.rsplit("/")[-1], r.change) for r in kept.look(inventory.listing(spark, str(folder), "*.htm")).collect()}
    assert look() == {("a.htm", "new"), ("b.htm", "new"), ("c.htm", "new")}
    kept.accept(inventory.listing(spark, str(folder), "*.htm"))
    assert look() == set()
    (folder / "a.htm").write_text("longer")
    (folder / "b.htm").unlink()
    (folder / "d.htm").write_text("d")
    assert look() == {("a.htm", "changed"), ("b.htm", "gone"), ("d.htm", "new")}
    assert look() == {("a.htm", "changed"), ("b.htm", "gone"), ("d.htm", "new")}
    scan = executed(inventory.listing(spark, str(folder)))
    assert "content" not in scan


def test_length_histogram_of_batches(spark, tmp_path):
    r = random.Random(0)
    texts = ["x" * r.randrange(1, 40) for _ in range(200)]
    lengths = LengthHistogram(spark, str(tmp_path))
    assert lengths.bounds().first().bounds is None
    for i in range(0, 200, 50):
        lengths.add(sentences(spark, [("d", k, t) for k, t in enumerate(texts[i : i + 50])]))
    lengths.add(sentences(spark, [("d", 0, "x" * 500), ("d", 1, None)]))
    lengths.add(sentences(spark, [("d", 0, "x" * 500)]), -1)
    full = spark.createDataFrame([(t,) for t in texts], "t string").agg(F.percentile(F.length("t"), F.array(F.lit(0.1), F.lit(0.9))).alias("b"))
    assert lengths.bounds(0.1).first().bounds == pytest.approx(full.first().b)


def test_rows_with_the_rules_they_break(spark):
    rows = [("a", 0, "fine"), ("a", 1, "twice"), ("a", 1, "twice again"), (None, 0, "x"), (None, 0, "y"), ("b", 0, None), ("b", None, "z")]
    parents = spark.createDataFrame([("a",), ("a",)], "doc_id string")
    good, bad = rules.split_by_rules(sentences(spark, rows), SENTENCES, {"doc_id": parents})
    assert contents(good) == [("a", 0, "fine")]
    key = "key:doc_id,sentence_id"
    wanted = {
        ("a", 1, "twice"): [key], ("a", 1, "twice again"): [key], (None, 0, "x"): [key, "not_null:doc_id"], (None, 0, "y"): [key, "not_null:doc_id"],
        ("b", 0, None): ["not_null:text", "reference:doc_id"], ("b", None, "z"): ["not_null:sentence_id", "reference:doc_id"],
    }
    assert {tuple(r)[:3]: r.broken for r in bad.collect()} == wanted
    empty = rules.split_by_rules(sentences(spark, []), SENTENCES, {"doc_id": parents})
    assert [x.count() for x in empty] == [0, 0]


# -- pages and selective reads -----------------------------------------------------------------


def test_seek_pages_read_few_files(spark, tmp_path):
    rows = [(f"d{i:04d}", k, "t") for i in range(400) for k in range(5)]
    random.Random(1).shuffle(rows)
    table = SortedTable(spark, str(tmp_path / "t"), ["doc_id", "sentence_id"]).store(sentences(spark, rows), files=20)
    token, seen = None, []
    while True:
        page = table.page(token, 300)
        got = page.collect()
        if not got:
            break
        assert len(table.files_for(token, 300)) <= 6
        seen += [tuple(r) for r in got]
        token = table.token(page)
    assert seen == sorted(rows) and table.token(table.page(token, 300)) is None
    assert 1 <= scanned(table.page(json.dumps(["d0200", 2]), 100), "numFiles") <= 3
    empty = SortedTable(spark, str(tmp_path / "e"), ["doc_id", "sentence_id"]).store(sentences(spark, []))
    assert empty.page().count() == 0


def test_filters_skip_stored_rows(spark, tmp_path):
    r = random.Random(2)
    rows = [(f"c{r.randrange(300)}", f"T{r.randrange(4)}", float(i)) for i in range(30_000)]
    rows += [("hot", f"T{i % 4}", float(i)) for i in range(10_000)]
    df = spark.createDataFrame(rows, "company_id string, theme_id string, score double")
    selective.store_selective(df, f"{tmp_path}/s", ["company_id", "theme_id"], files=16, group_bytes=1 << 16)
    for company in ("c17", "hot", "absent"):
        found = selective.read_selective(spark, f"{tmp_path}/s", company_id=company, theme_id="T1")
        wanted = Counter(x for x in rows if x[:2] == (company, "T1"))
        assert Counter(map(tuple, found.collect())) == wanted
        read = scanned(found, "numOutputRows")
        assert read >= sum(wanted.values())
        assert read <= (0.5 if company == "hot" else 0.15) * len(rows)
    # a company that holds a quarter of all rows is not one task's
    sizes = Counter(x.f for x in spark.read.parquet(f"{tmp_path}/s").where("company_id = 'hot'").select(F.input_file_name().alias("f")).collect())
    assert len(sizes) >= 3


# -- landing files and rows that are made once -------------------------------------------------


def test_land_writes_a_file_per_name_without_a_committer(spark, tmp_path):
    from filing_signals.sources import landed

    rows = [("p1", "a\nb"), ("p2", None), ("p1", "again"), (None, "x"), ("p3", "\u00e9")]
    df = spark.createDataFrame(rows, "name string, text string").coalesce(1)
    landed.land(df, f"file://{tmp_path}/f", "name", "text")

    def held():
        files = landed.landed_files(spark, f"{tmp_path}/f", "*.txt")
        key = F.regexp_extract("file_path", "name=([^/]*)/", 1)
        return sorted((r[0], sorted(r[1].splitlines())) for r in files.select(key, "text").collect())

    first = [("__HIVE_DEFAULT_PARTITION__", ["x"]), ("p1", ["a", "again", "b"]), ("p2", [""]), ("p3", ["\u00e9"])]
    assert held() == first
    landed.land(spark.createDataFrame([("p1", "new")], "name string, text string"), f"file://{tmp_path}/f", "name", "text", overwrite=True)
    landed.land(spark.createDataFrame([("p3", "more")], "name string, text string"), f"file://{tmp_path}/f", "name", "text")
    assert held() == [first[0], ("p1", ["new"]), first[2], ("p3", ["more"]), first[3]]
    names = [p.name for p in (tmp_path / "f").rglob("*")]
    assert not [n for n in names if n.endswith(".crc") or n in ("_SUCCESS", "_temporary")]
    shards = [p for p in (tmp_path / "f").iterdir()]
    assert shards and all(p.name.startswith("shard=") for p in shards)


def test_selective_rows_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(i):
        made.add(1)
        return i

    df = spark.range(0, 1000, 1, 4).select(F.concat(F.lit("c"), F.col("id") % 7).alias("company_id"), seen("id").alias("x"))
    assert selective.store_selective(df, f"{tmp_path}/once", ["company_id"], files=4).count() == 1000
    assert made.value == 1000


def test_selective_rows_go_straight_to_their_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(selective, "staged", lambda *_: pytest.fail("rows were staged"))
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(i):
        made.add(1)
        return i

    rows = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 101)).alias("company_id"),
        F.concat(F.lit("T"), F.col("id") % 4).alias("theme_id"),
        seen("id").alias("x"),
    )
    wanted = Counter(map(tuple, rows.collect()))
    before = made.value
    sizes = [f"spark.sql.adaptive.{c}" for c in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]
    for size in sizes:
        spark.conf.set(size, "8k")
    try:
        stored = selective.store_selective(rows, f"{tmp_path}/s", ["company_id", "theme_id"], group_bytes=1 << 16)
    finally:
        for size in sizes:
            spark.conf.unset(size)
    assert made.value - before == 60_000
    assert Counter(map(tuple, stored.collect())) == wanted
    for company in ("c17", "hot", "absent"):
        found = selective.read_selective(spark, f"{tmp_path}/s", company_id=company, theme_id="T1")
        assert Counter(map(tuple, found.collect())) == Counter({r: n for r, n in wanted.items() if r[:2] == (company, "T1")})
        assert scanned(found, "numOutputRows") <= (0.5 if company == "hot" else 0.15) * 60_000
    # a value of many rows is not one task's
    assert stored.where("company_id = 'hot' AND theme_id = 'T1'").select(F.input_file_name()).distinct().count() >= 2


def test_selective_rows_without_adaptive_plans(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).select(F.concat(F.lit("c"), F.col("id") % 7).alias("company_id"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = selective.store_selective(df, f"{tmp_path}/s", ["company_id"])
        assert contents(stored) == contents(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_listing_of_many_files_takes_few_tasks(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"d{i % 40}").mkdir(exist_ok=True)
        (tmp_path / f"d{i % 40}" / f"{i}.txt").write_text("x")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        seen = inventory.listing(spark, str(tmp_path), "*.txt")
        assert seen.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert seen.count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_listing_is_walked_by_the_tasks_and_holds_what_they_saw(spark, tmp_path, monkeypatch):
    folder = tmp_path / "landed"
    shown = ["a.txt", "one/b.txt", "one/two/c.txt", "one/two/three/d e%20.txt", "_k=1/f.txt", "\u00e9/[g].txt", *[f"many/{i}.txt" for i in range(9)]]
    for name in [*shown, "_h.txt", ".h.txt", "_hidden/h.txt", ".hidden/h.txt", "one/h._COPYING_", "one/h.htm"]:
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(name)
    (folder / "empty.txt").write_text("")
    (folder / "nothing.txt").symlink_to(folder / "none")
    (folder / "round.txt").symlink_to(folder / "round.txt")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{txt,md}").load(str(folder))
    wanted = contents(files.select(F.regexp_replace("path", "^file:", "").alias("file_path"), "length", F.col("modificationTime").alias("modified")))
    assert len(wanted) == len(shown)
    for most in (1, 4, 20_000):
        monkeypatch.setattr(inventory, "WALK", most)
        seen = inventory.listing(spark, f"file://{folder}/", "*.{txt,md}")
        assert contents(seen) == wanted
        assert "binaryFile" not in executed(seen)  # whose index holds each file's status in the driver
    (folder / "a.txt").write_text("longer than before")
    (folder / "new.txt").write_text("x")
    assert contents(seen) == wanted
    assert inventory.listing(spark, f"{folder}/one/*", "*.txt").count() == 3
    assert inventory.listing(spark, f"{folder}/{{one,many}}", "*.txt").count() == 12
    assert inventory.listing(spark, f"{folder}/one/b.txt").count() == 1
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        inventory.listing(spark, f"{folder}/none")


def test_encoding_moves_short_digests_once(spark, tmp_path, capsys):
    from filing_signals.plans.encoded import EncodedTexts

    rows = [("a", 0, "one"), ("a", 1, None), ("b", 0, "one"), ("b", 1, "two")]
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, text string")
    encoded = EncodedTexts(spark, str(tmp_path), lambda: lambda texts: [[float(len(t)), 1.0] for t in texts])
    encoded.missing(df).explain()
    assert "hashpartitioning(_key" in capsys.readouterr().out
    got = {(r["doc_id"], r["sentence_id"]): r["vector"] for r in encoded.encode(df).collect()}
    assert got == {("a", 0): [3.0, 1.0], ("a", 1): None, ("b", 0): [3.0, 1.0], ("b", 1): [3.0, 1.0]}
    assert encoded.missing(df).isEmpty() and encoded.table.read().count() == 2


def test_constraint_report_makes_rows_once(spark):
    from filing_signals.operators.upsert import constraint_report
    from filing_signals.schemas import SENTENCES

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(t):
        made.add(1)
        return t

    rows = [("a", 0, "x"), ("a", 0, "y"), ("b", 0, None), (None, 1, "z"), ("c", None, "z")]
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, text string").withColumn("doc_id", seen("doc_id"))
    parents = spark.createDataFrame([("a",), ("c",)], "doc_id string")
    got = {r["rule"]: r["violations"] for r in constraint_report(SENTENCES, df, {"doc_id": parents}).collect()}
    assert got["key:doc_id,sentence_id"] == 1 and got["reference:doc_id"] == 1 and got["not_null:doc_id"] == 1
    assert made.value == len(rows)


def test_tokens_are_looked_up_once_a_chunk(spark, tmp_path, monkeypatch):
    from filing_signals.plans import dictionary

    monkeypatch.setattr(dictionary, "CHUNK_BYTES", 600)
    rows = [("a", i, f"The the Knight {'said ' * (i % 4)}word{i % 5} 42 {i}\tof") for i in range(60)]
    df = sentences(spark, rows + [("b", 0, ""), ("b", 1, "x" * 2000), ("b", 2, None)]).repartition(3, "sentence_id")
    odd = df.unionByName(df.select(F.lit(None).cast("string").alias("doc_id"), "sentence_id", "text").limit(4))
    codes = CodeDictionary(spark, str(tmp_path), buckets=4)
    wanted = df.select("doc_id", "sentence_id", F.coalesce(phonetic_code("text"), F.lit("")).alias("code"))
    joined = []
    plain = codes.learn
    monkeypatch.setattr(codes, "learn", lambda tokens: joined.append(tokens) or plain(tokens))
    found = codes.codes(odd)
    rows_of = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows_of(found.where("doc_id IS NOT NULL")) == rows_of(wanted)
    assert [r.code for r in found.where("doc_id IS NULL").collect()] == [""] * 4
    said = dictionary._in_chunks(df.select("doc_id", "sentence_id", F.lower("text").alias("lowered")))
    held = [(c, set(t.split())) for c, t in said.where("lowered IS NOT NULL").select("chunk", "lowered").collect()]
    chunks = {c: set().union(*(t for d, t in held if d == c)) for c, _ in held}
    pairs = said.select("chunk", "lowered").mapInArrow(dictionary._distinct_tokens, "chunk long, token string")
    assert rows_of(pairs) == sorted((c, t) for c, of in chunks.items() for t in of)
    assert len(chunks) > 3 and "Explode" not in found._jdf.queryExecution().optimizedPlan().toString()
