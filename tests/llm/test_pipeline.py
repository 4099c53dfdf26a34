"""The pipeline against its stages done plainly, and awkward rows through every stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from filing_signals.llm import toxicity
from filing_signals.llm.queries import word_tokenizer
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_run_equals_plain_stages(spark):
    from tokenizers import Tokenizer

    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    kept = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    kept = [(i, t) for i, _, _, t in brute.lines_kept(kept)]
    groups = brute.jaccard(kept, 5, 80)
    kept = [(i, t) for i, t in kept if groups[i] == i]
    items = [r.text.lower() for r in bench.collect()]
    kept = [(i, t) for i, t in kept if not any(q in t.lower() for q in items)]
    expected = brute.token_pieces(Tokenizer.from_file(word_tokenizer()), kept)
    rows = corpus_pipeline.run(spark, SF).withColumn("crc", F.crc32("ids")).collect()
    assert sorted((r.doc_id, r.start, r.length, r.crc, r.doc_tokens) for r in rows) == sorted(expected)
    assert 0 < len(kept) < docs.count() and len(groups) > len(kept)


def test_stages_are_registered_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram jaccard join", "benchmark decontamination", "packing"]
    assert {f"op{n}_" for n in range(1, 14)} <= {q.split("_")[0] + "_" for q in queries()} and "pipeline" in queries()


@pytest.mark.parametrize("k", range(5))
def test_stage_takes_awkward_rows(spark, k):
    docs = brute.awkward(spark)
    step = corpus_pipeline.STAGES[k][1]
    out = step(spark, docs, SF)
    if k < 4:
        assert out.columns == docs.columns
        ids = {r.doc_id for r in out.collect()}
        # clean rows stay; of the near copies 6, 7 and 8 the smallest id stays
        assert {None, 1, 2, 3, 4, 5, 6, 9, 10, 11} <= ids
    else:
        assert out.count() > 0
    assert step(spark, docs.limit(0), SF).count() == 0


def test_nothing_is_toxic_without_labels(spark, tmp_path):
    docs = brute.awkward(spark)
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.without_toxic(spark, docs, str(tmp_path)).count() == docs.count()
