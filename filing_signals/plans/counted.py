"""Row counts of every stage as a by-product of the run, not as runs of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from filing_signals import fixed
from filing_signals.plans import sentences as S
from filing_signals.sources.snapshots import staged


class StageCounts:
    """Counts rows where a frame passes by; they are known once an action has run the whole plan."""

    def __init__(self):
        self._seen: list[tuple[str, Observation]] = []

    def note(self, df: DataFrame, stage: str) -> DataFrame:
        self._seen.append((stage, seen := Observation()))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def frame(self, spark) -> DataFrame:
        """(stage, n) in the order of the stages. Waits for none: call it after the action."""
        rows = [(stage, seen.get["n"]) for stage, seen in self._seen]
        return spark.createDataFrame(rows, "stage string, n long").coalesce(1)


def clean_counted(
    sentences: DataFrame,
    symbol_thresh: float = fixed.SYMBOL_THRESHOLD,
    digit_thresh: float = fixed.DIGIT_THRESHOLD,
    trim_share: float = fixed.TRIM_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """`sentences.clean`, and the rows that each of its stages let through.

    The input is scanned once: rows after the ratio filters are written, since the length quantiles need
    all of them before any can be trimmed, and numbering reads the written result of the rest.
    """
    counts = StageCounts()
    rows = counts.note(sentences, "1 read")
    rows = counts.note(S.usable(rows), "2 usable")
    rows = counts.note(S.drop_exact_copies(rows), "3 distinct")
    rows = counts.note(S.ratio_filters(rows, symbol_thresh, digit_thresh), "4 ratios")
    rows = staged(rows)
    rows = counts.note(S.trim_lengths(rows, trim_share), "5 trimmed")
    rows = staged(counts.note(S.keep_first_texts(rows), "6 first"))
    return S.renumber(rows), counts.frame(sentences.sparkSession)
