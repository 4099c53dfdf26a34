"""Tone, recency and score arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from filing_signals import fixed


def signed_confidence(label: Column, confidence: Column) -> Column:
    """+confidence for a positive label, -confidence for a negative one, else 0."""
    name = F.upper(F.coalesce(label, F.lit("")))
    return (
        F.when(name.contains("POS"), confidence)
        .when(name.contains("NEG"), -confidence)
        .otherwise(F.lit(0.0))
    )


def stored_polarity(signed: Column) -> Column:
    """Polarity as stored: truncated to a whole number, so 0 below full confidence."""
    return signed.cast("int").cast("double")


def time_weight(
    date: Column,
    newest: Column,
    recent: float = fixed.WEIGHT_NEWEST,
    older: float = fixed.WEIGHT_OLDER,
) -> Column:
    return F.when(date == newest, F.lit(recent)).otherwise(F.lit(older))


def raw_base(
    semantic: Column,
    phonetic: Column,
    signed: Column,
    alpha: float = fixed.ALPHA,
    beta: float = fixed.BETA,
) -> Column:
    sign = F.when(signed >= 0, F.lit(1)).otherwise(F.lit(-1))
    return (F.lit(alpha) * semantic + F.lit(beta) * phonetic) * sign


def final_score(raw: Column, weight: Column) -> Column:
    return F.greatest(F.lit(-100.0), F.least(F.lit(100.0), F.lit(100.0) * raw * weight))


def rounded(c: Column, digits: int = 6) -> Column:
    """`F.round` of a double, which goes through a decimal text only where it has to.

    A value whose place is clear of a half is a whole number divided by a power of ten, and that quotient is
    the double nearest to the rounded decimal. Halves, large values and NaN are left to `F.round`.
    """
    scaled = c * float(10**digits)
    clear = (F.abs(c) < 1e6) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(clear, F.floor(scaled + 0.5) / float(10**digits)).otherwise(F.round(c, digits))


def keyword_text(keywords: Column) -> Column:
    """Keywords split on comma, semicolon or bar, trimmed and joined by one space; null gives ''."""
    parts = F.transform(F.split(F.coalesce(keywords, F.lit("")), "[,;|]"), lambda p: F.trim(p))
    return F.array_join(F.filter(parts, lambda p: p != ""), " ")


def theme_text(theme: Column, keywords: Column) -> Column:
    return F.trim(F.concat(theme, F.lit(" "), keyword_text(keywords)))


def classify(
    text: Column,
    classifier: Callable[[], Callable[[list[str]], list[tuple[str, float]]]],
    batch: int = fixed.MODEL_BATCH,
) -> Column:
    """Struct (label, confidence) from a caller's model, loaded once per task by `classifier()`
    and given lists of at most `batch` texts."""

    @F.arrow_udf("struct<label:string,confidence:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = classifier()
        for texts in batches:
            rows = texts.to_pylist()
            out: list = []
            for i in range(0, len(rows), batch):
                out.extend(model(rows[i : i + batch]))
            yield pa.StructArray.from_arrays(
                [
                    pa.array([str(label) for label, _ in out], pa.string()),
                    pa.array([float(score) for _, score in out], pa.float64()),
                ],
                names=["label", "confidence"],
            )

    return run(text)
