"""Manifest: the latest filing of each form for each listed company, with ids and paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_signals import fixed
from filing_signals.functions import text
from filing_signals.operators.numbering import number_rows
from filing_signals.operators.pairing import SMALL_BYTES, is_small
from filing_signals.operators.ranking import top_per_group


def form_list(forms: str) -> list[str]:
    """Forms of a comma-separated string, trimmed, blanks dropped."""
    return [f for f in (p.strip() for p in forms.split(",")) if f]


def constituents(listing: DataFrame, position: str) -> DataFrame:
    """(position, ticker, name) from a listing with Symbol and Security columns."""
    renamed = listing.withColumnsRenamed({"Symbol": "ticker", "Security": "name"})
    return renamed.select(
        F.col(position).cast("int").alias("position"),
        text.normalise_ticker(F.col("ticker")).alias("ticker"),
        "name",
    )


def map_companies(listed: DataFrame, ticker_map: DataFrame) -> DataFrame:
    """Listed companies with their CIK, null where the map has none; each match is kept."""
    return listed.join(ticker_map, "ticker", "left")


def valid_companies(companies: DataFrame) -> DataFrame:
    return companies.filter(
        F.col("ticker").isNotNull() & (F.col("ticker") != "") & F.col("cik_num").isNotNull()
    )


def latest_filings(filings: DataFrame, forms: Sequence[str] = fixed.FORMS) -> DataFrame:
    """The newest filing per company and form; on one date the highest accession number."""
    wanted = filings.filter(F.col("form").isin(*forms))
    order = [F.col("filingDate").desc_nulls_last(), F.col("accessionNumber").desc()]
    return top_per_group(wanted, ["cik_num", "form"], order, 1).drop("rank")


def manifest(
    companies: DataFrame,
    latest: DataFrame,
    base_dir: str,
    forms: Sequence[str] = fixed.FORMS,
    one_per_filing: bool = False,
    keyed: bool = False,
) -> DataFrame:
    """Document rows numbered D001, D002, … in (listing position, form) order.

    The number depends on the run; `keyed` adds `filing_key`, which does not: a load that should
    find a filing again under another number can use it as `doc_id`. `one_per_filing` keeps a filing once when two share classes list its company.

    Companies are handed to all tasks only where their measured size, once for each form, allows: Spark's
    estimate leaves out what `posexplode` adds. Otherwise both sides are sorted and merged.
    """
    valid = valid_companies(companies)
    wanted = valid.select("*", F.posexplode(F.array(*[F.lit(f) for f in forms])).alias("form_pos", "form"))
    small = is_small(valid, SMALL_BYTES // max(1, len(forms)))
    rows = (F.broadcast(wanted) if small else wanted.hint("merge")).join(latest, ["cik_num", "form"])
    if one_per_filing:
        rows = top_per_group(
            rows,
            ["cik_num", "form_pos", "accessionNumber"],
            [F.col("position").asc_nulls_last(), F.col("ticker")],
            1,
        ).drop("rank")
    major = F.col("position") * len(forms) + F.col("form_pos")
    tie = F.concat_ws("/", "ticker", F.col("cik_num").cast("string"), "accessionNumber")
    cik = F.col("cik_num").cast("string")
    return number_rows(rows, [], major, tie, "number").select(
        text.display_id(F.col("number") + 1).alias("doc_id"),
        cik.alias("company_id"),
        "ticker",
        cik.alias("cik"),
        F.col("form").alias("source_type"),
        F.try_to_date("filingDate").alias("date"),
        text.storage_path(
            base_dir,
            F.col("ticker"),
            F.col("form"),
            F.col("accessionNumber"),
            F.col("primaryDocument"),
        ).alias("file_path"),
        *([text.filing_key(F.col("cik_num"), F.col("accessionNumber"), F.col("primaryDocument")).alias("filing_key")] if keyed else []),
    )
