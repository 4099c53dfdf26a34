"""Queries over stored tables that grow batch by batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract import fixtures as X
from contract.queries import company_columns, query, rounded, scored, scored_of, stray
from filing_signals.functions import scores, text
from filing_signals.operators import rules
from filing_signals.operators.seek import SortedTable
from filing_signals.plans import counted
from filing_signals.plans import manifest as M
from filing_signals.plans import scoring as C
from filing_signals.plans.dictionary import CodeDictionary
from filing_signals.plans.encoded import EncodedTexts
from filing_signals.plans.lengths import LengthHistogram
from filing_signals.plans.rollup import RolledScores
from filing_signals.schemas import DOCUMENTS, SENTENCE_SCORES, SENTENCES
from filing_signals.sources import inventory, selective
from filing_signals.sources.buckets import BucketTable
from filing_signals.sources.copartitioned import Copartitioned
from filing_signals.sources.landed import land
from filing_signals.sources.registry import IdRegistry
from filing_signals.sources.snapshots import SnapshotTable, staged, staging_folder

BUCKETS = 256


def labelled(spark, sf) -> DataFrame:
    return X.table(spark, sf, "labels", "doc_id").select(F.col("doc_id").cast("string").alias("doc_id"))


def listed(spark, sf) -> DataFrame:
    """Documents that share a number with a benchmark item: a batch that is small beside the table."""
    return X.table(spark, sf, "benchmark", "item_id").select(F.col("item_id").cast("string").alias("doc_id")).distinct()


def reloaded(spark, sf) -> BucketTable:
    """Stored: sentences of at least 20 characters. Then those of at least 60 of the listed documents."""
    table = BucketTable(spark, staging_folder(spark), SENTENCES, BUCKETS, by=["doc_id"])
    table.upsert(X.sentences(spark, sf), unique=True)
    table.upsert(X.sentences(spark, sf, min_len=60).join(listed(spark, sf), "doc_id", "left_semi"), "doc_id")
    return table


@query
def upsert_touched_buckets(spark, sf):
    return reloaded(spark, sf).read()


@query
def upsert_rewritten_buckets(spark, sf):
    """The buckets that the second batch wrote, with their rows; older folders removed, all else is read as before."""
    table = reloaded(spark, sf)
    last = table.versions()[-1]
    table.keep_last(1)
    rows = table.read(table.rewritten(last))
    bucket = F.regexp_extract(F.input_file_name(), "bucket=([0-9]+)", 1).cast("int")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def rollup_after_batches(spark, sf):
    """Company scores from sums: all sentences, then those of labelled documents again under other weights."""
    s, docs, themes = X.toned_sentences(spark, sf), X.documents(spark, sf), X.themes(spark)
    rolled = RolledScores(spark, staging_folder(spark))
    rolled.add(C.score(s, docs, themes))
    again = C.score(s.join(labelled(spark, sf), "doc_id", "left_semi"), docs, themes, C.Weights(0.5, 0.5))
    return company_columns(rolled.add(again))


@query
def stage_counts_observed(spark, sf):
    return counted.clean_counted(stray(spark, sf), digit_thresh=0.05)[1]


@query
def clean_counted(spark, sf):
    return counted.clean_counted(stray(spark, sf), digit_thresh=0.05)[0]


@query
def copartitioned_scores(spark, sf):
    """Scores with their sentence and document, from tables in buckets of doc_id: no exchange.

    Scores are made from the stored sentences, in the tasks of their buckets, so that they are not dealt either.
    """
    folder = staging_folder(spark)
    store = Copartitioned(spark, folder, buckets=16, prefix=folder.rsplit("-", 1)[-1])
    sentences = store.store(X.sentences(spark, sf), SENTENCES)
    store.store(X.documents(spark, sf), DOCUMENTS)
    store.store(scored_of(spark, sf, sentences), SENTENCE_SCORES, dealt=True)
    documents = store.read(DOCUMENTS).select("doc_id", "date").hint("merge")
    rows = store.joined(SENTENCE_SCORES, SENTENCES).join(documents, "doc_id")
    return rows.select("doc_id", "sentence_id", "theme_id", "company_id", "text", "date", rounded("final_score_100"))


@query
def constraint_rejects(spark, sf):
    """Sentences that repeat, lack a part or point at unlabelled documents, with the rules they break."""
    _, rejected = rules.split_by_rules(stray(spark, sf), SENTENCES, {"doc_id": labelled(spark, sf)})
    return rejected.withColumn("broken", F.array_join("broken", ";"))


@query
def constraint_accepted(spark, sf):
    """Sentences that are whole, come once and have a document."""
    parents = X.documents(spark, sf).select("doc_id")
    return rules.split_by_rules(stray(spark, sf), SENTENCES, {"doc_id": parents})[0]


@query
def length_bounds_merged(spark, sf):
    """The bounds of all sentences from a histogram of two batches, one of which came twice and was taken out."""
    s, known = X.sentences(spark, sf), labelled(spark, sf)
    lengths = LengthHistogram(spark, staging_folder(spark))
    first = s.join(known, "doc_id", "left_semi")
    lengths.add(first)
    lengths.add(s.join(known, "doc_id", "left_anti"))
    lengths.add(first)
    lengths.add(first, -1)
    return lengths.bounds().select(F.round(F.col("bounds")[0], 6).alias("low"), F.round(F.col("bounds")[1], 6).alias("high"))


@query
def registry_second_run(spark, sf):
    """Numbers after two runs: urgent and low filings first, then all forms."""
    registry = IdRegistry(spark, staging_folder(spark))
    filings = X.filings(spark, sf)

    def keyed(forms: list[str]) -> DataFrame:
        latest = M.latest_filings(filings, forms)
        place = F.array_position(F.array(*[F.lit(f) for f in forms]), F.col("form"))
        key = text.filing_key(F.col("cik_num"), F.col("accessionNumber"), F.col("primaryDocument"))
        return latest.select(key.alias("filing_key"), (F.col("cik_num") * len(forms) + place).alias("place"))

    registry.register(keyed(["1-URGENT", "5-LOW"]), F.col("place"))
    return registry.register(keyed(X.PRIORITIES), F.col("place")).select("filing_key", "number", "doc_id")


@query
def landed_changes(spark, sf):
    """Pages landed as files; then listed ones gone, labelled ones written again, and documents landed too."""
    folder, state = staging_folder(spark), staging_folder(spark)
    pages = X.table(spark, sf, "pages", "page_id", "html")
    name = F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name")
    land(pages.select(name, "html"), folder, "name", "html")

    def listing() -> DataFrame:
        files = inventory.listing(spark, folder, "*.txt")
        return files.withColumn("file_path", F.regexp_extract("file_path", "name=([^/]*)/", 1))

    kept = inventory.Inventory(spark, state)
    kept.accept(listing())
    again = pages.join(X.table(spark, sf, "labels", F.col("doc_id").alias("page_id")), "page_id", "left_semi")
    land(again.select(name, F.concat("html", F.lit("<!-- again -->")).alias("html")), folder, "name", "html", overwrite=True)
    more = X.table(spark, sf, "documents", "doc_id", "text").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"), F.coalesce("text", F.lit("")).alias("text")
    )
    land(more, folder, "name", "text")
    listed = X.table(spark, sf, "benchmark", F.concat(F.lit("p"), F.col("item_id").cast("string")).alias("file_path"))
    now = listing().join(listed, "file_path", "left_anti")
    return kept.look(staged(now)).select(F.col("file_path").alias("name"), "change")


def hashing_model():
    """Eight numbers of a text's md5: a model whose results any engine can follow."""
    import hashlib

    return lambda texts: [[int(hashlib.md5(t.encode()).hexdigest()[2 * i : 2 * i + 2], 16) / 4 for i in range(8)] for t in texts]


@query
def encoded_once(spark, sf):
    """Vectors of all sentences, of which those of labelled documents were encoded before."""
    s = X.sentences(spark, sf)
    encoded = EncodedTexts(spark, staging_folder(spark), lambda: hashing_model())
    encoded.encode(s.join(labelled(spark, sf), "doc_id", "left_semi"))
    found = encoded.encode(s)
    return found.select("doc_id", "sentence_id", F.array_join(F.col("vector").cast("array<string>"), " ").alias("vector"))


def tone_model():
    """A tone and its confidence from two digits of a text's md5."""
    import hashlib

    def run(texts: list[str]) -> list[tuple[str, float]]:
        digits = [hashlib.md5(t.encode()).hexdigest() for t in texts]
        return [(("POSITIVE", "negative", "LABEL_1")[int(d[0], 16) % 3], int(d[1], 16) / 16) for d in digits]

    return run


@query
def tones_by_model(spark, sf):
    """Signed confidence and stored polarity of each sentence from a caller's classifier."""
    said = X.sentences(spark, sf).withColumn("tone", scores.classify(F.col("text"), lambda: tone_model()))
    signed = scores.signed_confidence(F.col("tone.label"), F.col("tone.confidence"))
    return said.select("doc_id", "sentence_id", signed.alias("signed_confidence"), scores.stored_polarity(signed).alias("polarity"))


@query
def scores_page_after(spark, sf):
    """The third page of 1,000 sentences, each page asked for by the last key of the one before."""
    rows = C.with_documents(X.sentences(spark, sf), X.documents(spark, sf))
    table = SortedTable(spark, staging_folder(spark), ["doc_id", "sentence_id"]).store(rows)
    token = None
    for _ in range(2):
        token = table.token(table.page(token, 1000))
    return table.page(token, 1000).select("doc_id", "sentence_id", "text", "company_id", "date")


@query
def scores_after_key(spark, sf):
    """A page after a key that a caller kept."""
    table = SortedTable(spark, staging_folder(spark), ["doc_id", "sentence_id"]).store(X.sentences(spark, sf))
    return table.page(json.dumps(["5", 3]), 500)


@query
def scores_of_pair_stored(spark, sf):
    """Scores of one company and theme from the table laid out for such filters."""
    folder = staging_folder(spark)
    selective.store_selective(scored(spark, sf), folder, ["company_id", "theme_id"])
    rows = selective.read_selective(spark, folder, company_id="src3", theme_id="T1")
    return rows.select("doc_id", "sentence_id", rounded("final_score_100"))


@query
def sentence_codes(spark, sf):
    """Codes of all sentences by the stored dictionary, which labelled documents filled in part."""
    s = X.sentences(spark, sf)
    codes = CodeDictionary(spark, staging_folder(spark))
    codes.codes(s.join(labelled(spark, sf), "doc_id", "left_semi"))
    return codes.codes(s)


@query
def inputs_missing_columns(spark, sf):
    """What the required-input check says of each table that is no sentences table."""
    from filing_signals.sources.landed import require_columns

    out = None
    for name in ("documents", "conversations", "labels"):
        df = X.table(spark, sf, name)
        try:
            require_columns(df, ["doc_id", "text"], name)
            said = ""
        except ValueError as e:
            said = str(e)
        n = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_rows"))
        n = n.withColumn("missing", F.concat_ws(",", *[F.lit(c) for c in ("doc_id", "text") if repr(c) in said]))
        out = n if out is None else out.unionByName(n)
    return out


@query
def created_with_defaults(spark, sf):
    """A score table created empty, then filled from rows that leave out what has a default."""
    table = SnapshotTable(spark, staging_folder(spark), SENTENCE_SCORES).create_if_missing()
    assert table.read().isEmpty()
    rows = scored(spark, sf).drop("alpha", "beta")
    stored = table.create_if_missing().upsert(rows)
    return stored.groupBy("theme_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("alpha").alias("alpha"), F.max("beta").alias("beta"),
        F.count("scored_at").alias("n_stamped"),
    )
