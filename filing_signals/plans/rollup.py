"""Company scores kept as sums and counts, so that a batch of scores costs its own size.

A score is a double, and sums of doubles depend on their order. Taken as exact decimals they do not, so
adding a batch and taking out the rows that it replaces gives what a sum over all stored rows would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.schemas import SENTENCE_SCORES, Relation
from filing_signals.sources.buckets import BucketTable
from filing_signals.sources.snapshots import staged

GROUP = ["company_id", "theme_id"]
#: Scores lie between -100 and 100: 18 digits after the point, and room for 10^17 of them.
EXACT = T.DecimalType(38, 18)
_COUNT = T.LongType()

ROLLUP_STATE = Relation(
    "company_theme_sums",
    T.StructType(
        [
            T.StructField("company_id", T.StringType(), False),
            T.StructField("theme_id", T.StringType(), False),
            T.StructField("n_rows", _COUNT, False),
            T.StructField("sum_score", EXACT, False),
            T.StructField("n_score", _COUNT, False),
            T.StructField("sum_final", EXACT, False),
            T.StructField("n_final", _COUNT, False),
        ]
    ),
    GROUP,
)
_SUMS = [f.name for f in ROLLUP_STATE.schema if f.name not in GROUP]


def contributions(scores: DataFrame, sign: int) -> DataFrame:
    """What rows add to (1) or take from (-1) the sums of their group; missing scores count as no score."""

    def exact(name: str) -> list[Column]:
        c = F.col(name).cast(EXACT)
        return [F.coalesce(c, F.lit(0).cast(EXACT)) * sign, F.when(c.isNull(), 0).otherwise(sign).cast("long")]

    score, final = exact("theme_score"), exact("final_score_100")
    columns = [F.lit(sign).cast("long"), *score, *final]
    return scores.select(*GROUP, *[c.alias(n) for c, n in zip(columns, _SUMS)])


def added(parts: DataFrame) -> DataFrame:
    """Sums per group; they combine on the map side. A group without rows goes."""
    summed = parts.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in _SUMS])
    kinds = {f.name: f.dataType for f in ROLLUP_STATE.schema}
    return summed.select(*GROUP, *[F.col(c).cast(kinds[c]).alias(c) for c in _SUMS])


def averages(state: DataFrame) -> DataFrame:
    """Company scores of the sums."""

    def mean(total: str, n: str) -> Column:
        return F.when(F.col(n) > 0, F.col(total).cast("double") / F.col(n))

    return state.where("n_rows > 0").select(
        *GROUP, mean("sum_score", "n_score").alias("avg_score"), F.col("n_rows").cast("int").alias("n_sentences"),
        mean("sum_final", "n_final").alias("avg_final_100"),
    )


class RolledScores:
    """Stored sentence scores and their sums, brought up to date together, batch by batch.

    Sums carry the version number of the scores that they stand for. Where the two differ, because a
    job failed between them, sums are made anew from all scores.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.scores = BucketTable(spark, root, SENTENCE_SCORES, buckets, by=["doc_id"])
        self.sums = BucketTable(spark, root, ROLLUP_STATE, buckets)

    def add(self, scored: DataFrame, replace_documents: bool = False) -> DataFrame:
        """Merge a batch; company scores of all groups come back.

        `replace_documents` drops all stored scores of an incoming document.
        """
        last = max(self.scores.versions(), default=0)
        found: list[DataFrame] = []

        def note(incoming: DataFrame, replaced: DataFrame) -> None:
            # staged: the incoming rows are gone once the batch is stored
            found.append(staged(added(contributions(incoming, 1).unionByName(contributions(replaced, -1)))))

        current = max(self.sums.versions(), default=0) == last
        self.scores.upsert(scored, "doc_id" if replace_documents else None, before=note, version=last + 1)
        if not current:
            return self.rebuild()
        if found:
            self._merge(found[0], last + 1)
        return averages(self.sums.read())

    def _merge(self, change: DataFrame, version: int) -> None:
        # stored sums of changed groups only; groups left without rows stay as rows of zeros, which
        # have no average, and are dropped when sums are made anew
        stored = self.sums.read().join(change.select(*GROUP), GROUP, "left_semi")
        self.sums.upsert(added(stored.unionByName(change)), unique=True, version=version)

    def rebuild(self) -> DataFrame:
        """Sums from all stored scores."""
        every = added(contributions(self.scores.read(), 1))
        self.sums.write(every, range(self.sums.buckets), max(self.scores.versions(), default=1))
        return averages(self.sums.read())
