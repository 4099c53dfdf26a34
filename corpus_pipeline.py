"""A training corpus from `documents`: five stages, each over all that the one before it kept.

In every stage a null or empty text is a text without words, lines or matches; rows without an id stay; rows that
repeat, or share an id, are judged each by its own text, but for near copies and leaks, which go by id; ties
go to the smaller or larger id as the stage says; long texts are read whole; an empty table gives an empty
one; further columns of any name are carried along unread, and packing leaves them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_signals.llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from filing_signals.llm.queries import read, word_tokenizer
from filing_signals.llm.staging import Stage
from filing_signals.session import ship

#: The toxicity model, the set join and the tokenizer are beyond SQL; tests hold `run` against a
#: brute-force version.
ORACLE_SQL = None

#: Ids to remove are broadcast up to this many (16 bytes each), and joined by shuffle beyond.
BROADCAST_IDS = 500_000


def _without(docs: DataFrame, ids: DataFrame, stage: Stage) -> DataFrame:
    """Rows of `docs` whose id is not among `ids`; rows without an id stay."""
    gone = stage.keep(ids.select(F.col("doc_id").cast("long").alias("_gone")).distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, docs.doc_id == gone["_gone"], "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject, row by row.

    A null or empty text has the score of the model's bias, which is low where few labelled texts are toxic.
    Without labels all rows stay.
    """
    ship(spark)
    found = toxicity.toxicity(docs, read(spark, sf_dir, "labels"), carry=True)
    return found.where(F.col("predicted") == 0).select("row.*")


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines they share with others; `n_chars` follows the text.

    A line in three documents or more stays in the one with the largest id, wherever it holds it. Null
    and empty texts come back empty; rows without an id keep all lines, and rows of one id count once.
    """
    ship(spark)
    kept = line_dedup.line_dedup(docs).select("row.*")
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest `doc_id` of each group of near copies: five-word shingles, 0.8 or more.

    Texts without words are no copies of each other and stay. All rows of an id that goes go, and rows that repeat
    the id that stays, stay.
    """
    ship(spark)
    found = jaccard_join.jaccard_components(docs, k=5, percent=80)
    return _without(docs, found.where("doc_id != component_id"), Stage(spark, "near-copies"))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, copied or re-parameterised.

    An id goes with all its rows. With an empty benchmark, or one of null texts, all stay.
    """
    ship(spark)
    found = decontamination.contaminated(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, found, Stage(spark, "leaks"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as token sequences, with their ids.

    A null or empty text is the end id alone; repeated rows are packed as often as they come.
    """
    ship(spark)
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_common_lines),
    ("n-gram jaccard join", without_near_copies),
    ("benchmark decontamination", without_leaks),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is a table in the shared folder, and goes once the next is written.

    What rows of any kind become is said by the stages. A lost executor costs its tasks: each stage starts
    from a written table.
    """
    stage = Stage(spark, "pipeline")
    docs, before = read(spark, sf_dir, "documents"), None
    for k, (_, step) in enumerate(STAGES):
        docs = stage.keep(step(spark, docs, sf_dir), str(k))
        if before is not None:
            stage.drop(before)
        before = str(k)
    return docs
