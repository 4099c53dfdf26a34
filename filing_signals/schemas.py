"""Relations: columns, keys, NOT NULL rules and defaults."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals import fixed


@dataclass(frozen=True)
class Relation:
    name: str
    schema: T.StructType
    keys: list[str]
    defaults: dict[str, Callable[[], Column]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def _f(name: str, kind: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable)


DOCUMENTS = Relation(
    "documents",
    T.StructType(
        [
            _f("doc_id", _S, False),
            _f("company_id", _S),
            _f("ticker", _S),
            _f("cik", _S),
            _f("source_type", _S),
            _f("date", T.DateType()),
            _f("file_path", _S),
        ]
    ),
    ["doc_id"],
)

SENTENCES = Relation(
    "sentences",
    T.StructType([_f("doc_id", _S, False), _f("sentence_id", _I, False), _f("text", _S, False)]),
    ["doc_id", "sentence_id"],
)

THEMES = Relation(
    "themes",
    T.StructType([_f("theme_id", _S, False), _f("theme", _S, False), _f("keywords", _S)]),
    ["theme_id"],
)

SENTENCE_SCORES = Relation(
    "sentence_theme_scores",
    T.StructType(
        [
            _f("doc_id", _S, False),
            _f("sentence_id", _I, False),
            _f("company_id", _S, False),
            _f("theme_id", _S, False),
            _f("semantic_sim", _D, False),
            _f("phonetic_sim", _D, False),
            _f("polarity", _D, False),
            _f("confidence", _D, False),
            _f("alpha", _D, False),
            _f("beta", _D, False),
            _f("raw_base", _D),
            _f("time_weight", _D),
            _f("final_score_100", _D),
            _f("theme_score", _D),
            _f("scored_at", T.TimestampType()),
        ]
    ),
    ["doc_id", "sentence_id", "theme_id"],
    {
        "alpha": lambda: F.lit(fixed.ALPHA),
        "beta": lambda: F.lit(fixed.BETA),
        "scored_at": F.current_timestamp,
    },
)

COMPANY_SCORES = Relation(
    "company_theme_scores",
    T.StructType(
        [
            _f("company_id", _S, False),
            _f("theme_id", _S, False),
            _f("avg_score", _D, False),
            _f("n_sentences", _I, False),
            _f("avg_final_100", _D),
            _f("updated_at", T.TimestampType()),
        ]
    ),
    ["company_id", "theme_id"],
    {"updated_at": F.current_timestamp},
)

# Landed inputs.
SENTENCES_CSV = T.StructType([_f("doc_id", _S), _f("sentence_id", T.LongType()), _f("text", _S)])
MANIFEST_CSV = T.StructType(
    [_f(c, _S) for c in ("doc_id", "company_id", "ticker", "cik", "source_type", "date", "file_path")]
)
FILING_INDEX = "filings struct<recent: struct<form: array<string>, filingDate: array<string>, accessionNumber: array<string>, primaryDocument: array<string>>>"
TICKER_MAP = "map<string, struct<ticker: string, cik_str: string>>"
