"""Golden rows and brute-force checks of the text functions."""

import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from filing_signals.functions import text as tx
from filing_signals.plans import sentences as S

SF = "/root/testdata/sf0.001"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p><b>Rev</b>enue grew</p><script>x()</script>", "Rev enue grew"),
        ("a<!-- x > y <b> -->b", "a b"),
        ("a<!-- <script> -->b<i>c</i>", "a b c"),
        ("<style>p{}</style><noscript>no</noscript>x<br/>y", "x y"),
        ('<a title="x>y" href=z>t</a>', "t"),
        ("R&amp;D &lt;up&gt; &copy;&nbsp;2020", "R&D <up> © 2020"),
        ("&amp;lt;", "&lt;"),
        ("company&apos;s &#00000065;&#x0000000041;", "company's AA"),
        ("a&nbspb &ampx; &notit; &notin; &unknown; &", "a b &x; ¬it; ∉ &unknown; &"),
        ("&#99999999999999999999;x&#xFFFFFFFFF;y &NotEqualTilde;", "xy ≂̸"),
        ("&#65;&#x42;&#8364; &bogus; & co", "AB€ &bogus; & co"),
        ("a < b and 3 > 2", "a < b and 3 > 2"),
        ("<!DOCTYPE html><p>x  y", "x y"),
        ("<script>never closed", ""),
        ("<p " + 'a="b" ' * 20000 + ">long", "long"),
        ('<p class="open>text', "text"),
        ("", ""),
    ],
)
def test_html_to_text(spark, html, expected):
    assert one(spark, html, tx.html_to_text) == expected


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_html_to_text_equals_a_parser_on_all_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pages.select("html", tx.html_to_text(F.col("html")).alias("text")).collect():
        reader = _Reader()
        reader.feed(r["html"])
        reader.close()
        assert r["text"] == re.sub(r"\s+", " ", " ".join(reader.parts)).strip()


def clean_py(s):
    return re.sub(r"\s+", " ", re.sub(r"[^A-Za-z0-9\s,.]", " ", s)).strip()


def pieces_py(text, min_len):
    parts = [re.sub(r"\s+", " ", p).strip() for p in re.split(r"[.!?;]+|\n+", text)]
    return [c for c in (clean_py(p) for p in parts if p) if len(c) >= min_len]


TRICKY = [
    "Costs fell; margins rose to 12.5 percent! Revenue grew strongly in the year",
    "One two three\x1cfour. — !\n\n \n; five—six, seven",
    "  . . ;\n—\n",
    "",
    "Çà et là. naïve café; ½ of ٣٤",
    "tab\tand\r\nline",
]


@pytest.mark.parametrize("min_len", [0, 1, 5, 20])
def test_sentence_array_equals_brute_force(spark, min_len):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    df = docs.union(spark.createDataFrame([(t,) for t in TRICKY], "text string"))
    for r in df.select("text", tx.sentence_array(F.col("text"), min_len).alias("s")).collect():
        assert r["s"] == pieces_py(r["text"], min_len)


def test_golden_extract(spark):
    df = spark.createDataFrame([("d", TRICKY[0])], "doc_id string, text string")
    assert [tuple(r) for r in S.extract(df).collect()] == [("d", 0, "Revenue grew strongly in the year")]


def test_clean_sentence(spark):
    assert one(spark, "R&D   spend — up 5%", tx.clean_sentence) == "R D spend up 5"
    assert one(spark, None, tx.clean_sentence) == ""
    for t in TRICKY:
        once = one(spark, t, tx.clean_sentence)
        assert once == clean_py(t) == one(spark, once, tx.clean_sentence)


def test_ratios(spark):
    assert one(spark, "a1 22", tx.digit_ratio) == 0.75
    assert one(spark, "  ", tx.digit_ratio) == 1.0
    assert one(spark, "a1 22", tx.clean_digit_ratio) == 0.75
    assert one(spark, "", tx.clean_digit_ratio) == 1.0
    assert one(spark, "a-b%", tx.symbol_ratio) == 0.5


def test_names(spark):
    assert one(spark, "BRK.B", tx.normalise_ticker) == "BRK-B"
    assert one(spark, 320193, tx.padded_cik, "long") == "0000320193"
    assert one(spark, 7, tx.display_id, "long") == "D007"
    assert one(spark, 1000, tx.display_id, "long") == "D1000"
    assert one(spark, "b/AAPL/10-K/000032/a.htm", tx.path_accession) == "000032"
    assert one(spark, "b/AAPL/10-K/000032/a.htm", tx.path_file_name) == "a.htm"
    assert one(spark, "a.htm", tx.path_accession) == ""


def test_decode_drops_bad_bytes(spark):
    assert one(spark, bytearray(b"a\xffb\xc3\xa9\xe2\x82"), tx.decode_tolerant, "binary") == "abé"


def test_sentences_cut_at_their_ends_equal_those_cut_first(spark):
    import random

    r = random.Random(6)
    texts = ["".join(r.choice(" ab1,.!?;\n\t\u00a0-\u00e9") for _ in range(r.randrange(60))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(tx.sentence_array(F.col("t"), 2).alias("s"))
    for t, row in zip(texts, df.collect()):
        spaced = re.sub(r"[^A-Za-z0-9,\n]+", " ", re.sub(r"[.!?;\n]+", "\n", t)).strip(" ")
        assert row.s == [x for x in re.split(" ?\n ?", spaced) if len(x) >= 2]
