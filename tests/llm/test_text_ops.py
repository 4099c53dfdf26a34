"""Secret scans and HTML extraction."""

import random
import re

import math

import pytest
from pyspark.sql import functions as F

from filing_signals.llm import html_extraction as H
from filing_signals.llm import secret_scan as S
from filing_signals.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def written(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def plain_spans(text):
    """All spans by brute force: base forms, then candidates whose best window is random enough."""
    base = brute.base_secrets(text)
    out = list(base)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text or ""):
        if len(m[0]) < S.WINDOW or any(a <= m.start() and m.end() <= b for a, _, b in base):
            continue
        if any(re.search(p, m[0]) for p in S.ALLOWED):
            continue
        bits = next(bits for _, p, bits in S.CLASSES if re.search(p, m[0]))
        if brute.window_entropy(m[0], S.WINDOW) >= bits:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def secrets_text(seed):
    r = random.Random(seed)
    key = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    pieces = [
        lambda: "né word 𝄞 ", lambda: f'token = "{key("0123456789abcdef", 40)}" ', lambda: f"API_KEY:{key(mixed, r.choice([3, 5, 6, 30]))} ",
        lambda: "AKIA" + key("ABCDEFGHIJ0123", r.choice([12, 15, 16, 20])) + " ", lambda: key("0123456789abcdef", r.choice([20, 23, 24, 32])) + "\n",
        lambda: key(mixed, r.choice([20, 24, 40, 64])) + " ", lambda: key("ab", 40) + "1Z ", lambda: key("0123456789", 30) + " ",
        lambda: "123e4567-e89b-12d3-a456-426614174000 ", lambda: "src/main/java/org/some/path/file ", lambda: "password=token:abcdefgh ",
        lambda: key("0123456789ABCDEF", 32) + " ", lambda: "EXAMPLE" + key(mixed, 40) + " ", lambda: "secret='" + key(mixed, 9) + "' ",
    ]
    return "".join(r.choice(pieces)() for _ in range(r.randrange(1, 60)))


def test_spans_equal_brute_force(spark):
    texts = [secrets_text(s) for s in range(60)] + ["", None, "token=" + "a" * 6, "token=abc", "AKIA" * 9, "f" * 3000, "a1" * 400]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.s for r in S.secret_scan(rows).select("doc_id", S.written(F.col("secrets")).alias("s")).collect()}
    for i, t in enumerate(texts):
        assert out[i] == written(plain_spans(t)), t
    assert any("entropy" in s for s in out.values())


def test_many_matches_are_placed(spark):
    text = " ".join(f"{i:024x}é" for i in range(700))
    [row] = S.secret_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(s.start, s.kind, s.end) for s in row.secrets] == brute.base_secrets(text)


def test_op8_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op8_secret_scan"](spark, SF).collect():
        base = brute.base_secrets(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r.base_sha256 == brute.sha(written(base)) and r.spans == written(plain_spans(texts[r.doc_id]))


def test_secrets_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    rows = S.secret_scan(docs).collect()
    assert len(rows) == docs.count() and all(r.secrets is not None for r in rows)
    assert S.secret_scan(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a token=abcdef, b")], "doc_id long, text string")
    assert one.select(S.redacted(F.col("text"), S.spans(F.col("text"))).alias("t")).first().t == "a [secret], b"


def test_scan_has_no_python(spark):
    plan = S.secret_scan(brute.awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


W = H.weights({})
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header class="site-header"><h1>Site</h1>
<form><input name=q>Search here</form></header><ul class="menu"><li><a href=a>Home</a><li><a href="b>c">News of the day</a></ul>
<div id="cookie-notice"><p>We use cookies, and other long sentences to tell you about it. Accept?</p></div>{body}
<div class="sidebar"><p>Related: other story of some length here and there</p></div><section id="comments"><h3>Comments</h3>
<p>I disagree with all of this, it is the long and rambling text of a reader.</p></section><footer>&copy; me</footer></body></html>"""
BODY = """<h2>The title &amp; more</h2><p>First \n  paragraph<br>with a <a href=x>link</a> and <b>bold</b> text.</p><div class="ad-banner">Buy now</div>
<p>Second &lt;tag&gt; &eacute;&#33;<ul><li>one item</li><li>two item</li></ul><script>var t="</p>";</script><p>Last paragraph of the text."""
TEXT = "The title & more\n\nFirst paragraph with a link and bold text.\n\nSecond <tag> é!\n\none item\n\ntwo item\n\nLast paragraph of the text."


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "<div class='post-body'>{}</div>", "<nav>never closed <article>{}</article>"])
def test_main_text_of_pages(around):
    assert H.main_text(PAGE.format(body=around.format(BODY)), W) == TEXT


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("just words here", "just words here"), ("<p>a < b and <", "a < b and <"),
        ("<nav><a href=x>only a menu</a></nav>", ""), ("<p>open <b>tags <p>all over", "open tags\n\nall over"),
        ("<!-- <p>hidden</p> --><p>shown text", "shown text"), ("<script>never closed <p>text", ""), ("<p>words</p><a 'x" + "y" * 5000, "words"),
        ("<p>" + "&nbsp; \t" * 3 + "words</p>", "words"), ("</div></p></article><p>stray ends", "stray ends"),
    ],
)
def test_odd_pages(page, text):
    assert H.main_text(page, W) == text


def test_weights_come_from_labelled_pages():
    page = "<article><p>" + "word " * 500 + "</p></article><div><p class=x>" + "noise " * 10 + "</p></div>"
    counts = H.labelled_counts(page)
    assert counts["zone=content", True] == 500 and counts["zone=", False] == 10
    assert H.labelled_counts("<div>no label</div>") == {}
    w = H.weights(counts)
    assert w["zone=content"] == H.LARGEST > w["zone="]


def article(page):
    import html

    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    body = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", body)))
    return "\n\n".join(t for t in (" ".join(html.unescape(x).split()) for x in body.split("\0")) if t)


def test_op1_returns_whole_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op1_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_extraction_of_awkward_rows(spark):
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<article><p>Text of a page"), (2, None, "<p>" + "long word " * 50_000), (2, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    out = H.extract(pages).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in out) == [(0, 14), (1, 0), (1, 0), (2, 0), (2, 499_999)]
    assert H.extract(pages.limit(0)).count() == 0


def test_long_candidates_take_time_in_proportion(spark):
    """A base64 text of 200,000 characters in one word, and the same entropies as by counting each window."""
    import random
    import time

    r = random.Random(3)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    e = S.Entropy()
    short = ["".join(r.choice(signs[: r.choice([2, 5, 64])]) for _ in range(r.randrange(e.window, 90))) for _ in range(40)]
    df = spark.createDataFrame([(v,) for v in short], "v string")
    for row in df.select("v", S.least_sum(F.col("v"), e).alias("s")).collect():
        bits = brute.window_entropy(row.v, e.window)
        assert abs((math.log2(e.window) - bits) * e.window * S._UNIT - row.s) <= e.window + 1
    seconds = []
    for n in (20_000, 200_000):
        blob = "".join(r.choice(signs) for _ in range(n))
        rows = spark.createDataFrame([(1, blob)], "doc_id long, text string")
        start = time.time()
        [found] = S.secret_scan(rows).collect()
        seconds.append(time.time() - start)
        assert [(x.start, x.end) for x in found.secrets] == [(0, n)]
    assert seconds[1] < 30 * max(seconds[0], 0.3)


@pytest.mark.parametrize("around", ["<article>{}</article>", '<div class="content">{}</div>', "<div>{}</div>"])
@pytest.mark.parametrize(
    "end, text",
    [
        ("<ul><li>one</li><li>two</li><li>three</li></ul>", ["one", "two", "three"]),
        ("<div>By A. Writer</div>", ["By A. Writer"]),
        ("<ol><li>a <b>b</b><li>c</ol><div>d</div>", ["a b", "c", "d"]),
    ],
)
def test_short_ends_of_an_article_stay(around, end, text):
    body = "<h2>The title</h2>" + "<p>A paragraph of some more words, as they come in any article of a page.</p>" * 4
    found = H.main_text(PAGE.format(body=around.format(body + end)), W)
    assert found.split("\n\n")[5:] == text and found.startswith("The title\n\nA paragraph")


@pytest.mark.parametrize(
    "change",
    [
        lambda p: p.replace("</head>", ""),
        lambda p: p.replace("<body>", "<body><svg width=1><path d=x>"),
        lambda p: p.replace("<article>", "<article><canvas><object data=x>"),
        lambda p: p.replace("<h2>", "<svg><title>icon</title><text>no text</text></svg><select><option>none</select><h2>"),
        lambda p: p.replace("<body>", '<body class="x"><noscript><p>switch it on, please, to see what is here</p></noscript>'),
        lambda p: p.replace("<body>", "<body><svg/>"),
    ],
)
def test_unclosed_and_left_out_elements(change):
    page = change(PAGE.format(body=f"<article>{BODY}</article>"))
    assert H.main_text(page, W) == TEXT


def test_compound_names_do_not_empty_a_page():
    words = "A long paragraph of the page, with all that it has to say. " * 5
    page = f'<body><div class="post-related-header"><p>{words}</p></div></body>'
    assert H.main_text(page, W) == words.strip()
    nav = f'<div class="main-menu"><a href=x>menu</a></div><div class="text"><p>{words}</p></div>'
    assert H.main_text(nav, W) == words.strip()


def test_unclosed_elements_take_linear_time():
    import time

    start = time.time()
    H.main_text("<svg>" * 20_000 + "<div>" * 20_000 + "<p>text of it" + "</b>" * 20_000, W)
    assert time.time() - start < 20


def test_fitted_weights_decide_on_pages_without_marks(spark):
    """Elements as plain divs without class, id and role: the fit finds the article, priors alone do not."""
    pages = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet")
    fitted = H.train(pages)

    def plain(page):
        page = re.sub(r"<(/?)(?:article|main|nav|header|footer|aside|section)\b[^>]*>", r"<\1div>", page)
        return re.sub(r"""\s(?:class|id|role)=(?:"[^"]*"|'[^']*'|[^\s>]+)""", "", page)

    rows = [r.html for r in pages.collect() if "<article>" in r.html]
    found = [(H.main_text(plain(p), fitted), H.main_text(plain(p), W), article(p)) for p in rows]
    assert len(found) > 200 and sum(f == a for f, _, a in found) >= 0.99 * len(found)
    assert sum(f == a for _, f, a in found) < 0.5 * len(found)
