"""Listing, index JSON, latest filings and manifest ids."""

import json
import random

from pyspark.sql import functions as F

from filing_signals.plans import manifest as M
from filing_signals.sources import landed


def test_companies(spark):
    listing = spark.createDataFrame(
        [(1, "BRK.B", "B"), (2, "AAPL", "A"), (3, "NONE", "N"), (4, None, "Q"), (5, "", "E")],
        "pos int, Symbol string, Security string",
    )
    tmap = spark.createDataFrame([("BRK-B", 10), ("AAPL", 20), ("AAPL", 21)], "ticker string, cik_num long")
    got = M.valid_companies(M.map_companies(M.constituents(listing, "pos"), tmap)).collect()
    assert sorted((r["position"], r["ticker"], r["cik_num"]) for r in got) == [
        (1, "BRK-B", 10),
        (2, "AAPL", 20),
        (2, "AAPL", 21),
    ]


def recent(**columns):
    return json.dumps({"filings": {"recent": columns}})


def test_filing_index(spark):
    good = recent(form=["10-K", "8-K"], filingDate=["2024-01-01", "2024-02-01"],
                  accessionNumber=["1-1", "1-2"], primaryDocument=["a.htm", "b.htm"], size=[1, 2])
    ragged = recent(form=["10-K"], filingDate=[], accessionNumber=["1"], primaryDocument=["a"])
    empty = recent(form=[], filingDate=[], accessionNumber=[], primaryDocument=[])
    df = spark.createDataFrame(
        [(1, good), (2, ragged), (3, "{}"), (4, empty), (5, '{"filings": {}}'), (6, None),
         (7, "<html>Too many requests</html>"), (8, good[:60]), (9, ""), (10, " ")],
        "cik_num long, json string",
    )
    rows, rejects = landed.filing_index_rows(df)
    assert sorted(tuple(r) for r in rows.collect()) == [
        (1, "10-K", "2024-01-01", "1-1", "a.htm"),
        (1, "8-K", "2024-02-01", "1-2", "b.htm"),
    ]
    assert sorted(r["cik_num"] for r in rejects.collect()) == [2, 7, 8]


def test_ticker_map(spark):
    body = '{"0": {"cik_str": 320193, "ticker": "AAPL", "title": "x"}, "1": {"cik_str": "7", "ticker": "Z"}}'
    df = spark.createDataFrame([(body,), ("{}",)], "json string")
    assert sorted(tuple(r) for r in landed.ticker_map_rows(df).collect()) == [("AAPL", 320193), ("Z", 7)]


def test_latest_and_manifest_equal_brute_force(spark):
    rng = random.Random(3)
    forms = M.form_list("10-K, 10-Q,,")
    assert forms == ["10-K", "10-Q"]
    filings = [
        (rng.randrange(40), rng.choice(["10-K", "10-Q", "8-K"]), f"2024-01-{rng.randrange(1, 9):02d}", f"{i:04d}-1", f"d{i}.htm")
        for i in range(600)
    ]
    f = spark.createDataFrame(
        filings, "cik_num long, form string, filingDate string, accessionNumber string, primaryDocument string"
    )
    best = {}
    for cik, form, date, acc, doc in filings:
        if form in forms and (date, acc) > best.get((cik, form), ("", ""))[:2]:
            best[(cik, form)] = (date, acc, doc)
    latest = M.latest_filings(f, forms)
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()
    assert {(r["cik_num"], r["form"]): (r["filingDate"], r["accessionNumber"], r["primaryDocument"]) for r in latest.collect()} == best

    companies = [(i, f"T{i:03d}", rng.randrange(50)) for i in range(60)]
    c = spark.createDataFrame(companies, "position int, ticker string, cik_num long").withColumn("name", F.lit("n"))
    want, k = [], 1
    for _, ticker, cik in companies:
        for form in forms:
            if (cik, form) in best:
                date, acc, doc = best[(cik, form)]
                path = f"base/{ticker}/{form}/{acc.replace('-', '')}/{doc}"
                want.append((f"D{k:03d}", str(cik), ticker, str(cik), form, date, path))
                k += 1
    got = M.manifest(c, latest, "base", forms).withColumn("date", F.col("date").cast("string"))
    assert sorted(map(tuple, got.collect())) == sorted(want)

    once = M.manifest(c, latest, "base", forms, one_per_filing=True)
    assert once.select("cik", "source_type").distinct().count() == once.count()
    ids = sorted(int(r["doc_id"][1:]) for r in once.collect())
    assert ids == list(range(1, len(ids) + 1))


def test_filing_keys_last(spark):
    companies = spark.createDataFrame([(1, "A", "n", 5), (2, "B", "m", 6)], "position int, ticker string, name string, cik_num long")
    latest = spark.createDataFrame([(5, "10-K", "2024-01-01", "1-2", "a.htm"), (6, "10-K", "2024-01-01", "3-4", "b.htm")], "cik_num long, form string, filingDate string, accessionNumber string, primaryDocument string")
    both = {r.doc_id: r.filing_key for r in M.manifest(companies, latest, "base", ["10-K"], keyed=True).collect()}
    one = {r.doc_id: r.filing_key for r in M.manifest(companies.where("position = 2"), latest, "base", ["10-K"], keyed=True).collect()}
    assert both == {"D001": "0000000005/12/a.htm", "D002": "0000000006/34/b.htm"}
    assert one == {"D001": "0000000006/34/b.htm"}


def test_companies_are_broadcast_by_their_size_with_all_forms(spark, monkeypatch):
    joined = []
    number = M.number_rows
    monkeypatch.setattr(M, "number_rows", lambda df, *a: joined.append(df) or number(df, *a))
    key = F.col("id")
    listed = spark.range(40_000).select(key.cast("int").alias("position"), key.cast("string").alias("ticker"), key.alias("cik_num"))
    few = listed.where("id < 30")
    day, name = F.lit("2024-01-02").alias("filingDate"), F.lit("d.htm").alias("primaryDocument")
    latest = spark.range(60).select(key.alias("cik_num"), F.lit("f7").alias("form"), day, key.cast("string").alias("accessionNumber"), name)
    forms = [f"f{i}" for i in range(40)]
    counts = [M.manifest(c, latest, "x", forms).count() for c in (listed, few)]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in joined]
    assert counts == [60, 30]
    assert "strategy=merge" in plans[0] and "strategy=broadcast" in plans[1]
