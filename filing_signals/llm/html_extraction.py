"""Main text of HTML by the maximum-scoring subsequence of its words and tags.

A page is a sequence of words and tags. Words score by where they stand (in a menu, a link, a
paragraph, ...), tags score below zero, and one linear scan finds the contiguous region with the
largest sum. The weights are log-odds of standing inside the main text, counted on labelled pages:
those of a bounded sample that mark it with an article or main element. The region is completed to the
whole of the content element it lies in, so that short items at its ends are not lost. Blocks of the region that
belong to something else (an advert, a form, comments) are left out of the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that training reads, at most; those with the smallest hash of their id.
SAMPLE_PAGES = 2_000
#: Log-odds are held between these, so that no single word outweighs a paragraph.
LARGEST = 3.0
TAG_AT_MOST = -0.05

# Elements whose content HTML reads as raw up to their end tag or the end of the page,
# elements that are skipped where they are closed, elements that end a block, and elements that have no end tag.
RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp"
SKIPPED = frozenset("noscript template svg math object canvas select".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody "
    "tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACES = frozenset("br td th img wbr input".split())
MAIN = ("article", "main")
#: Elements that the next one of their kind ends, so they are not waited for.
ITEMS = ("p", "li", "dt", "dd", "tr")

# What an element's name, role, class or id says about its content.
ZONES = {
    "content": "article main content post entry story articlebody post-content entry-content article-body main-content",
    "menu": "nav navigation menu menubar navbar breadcrumb breadcrumbs toc pagination pager tabs toolbar",
    "header": "header masthead banner topbar page-header site-header",
    "footer": "footer contentinfo copyright colophon site-footer page-footer",
    "sidebar": "aside sidebar complementary related recommended recommendations widget widgets rail teaser teasers trending popular",
    "advert": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted",
    "notice": "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe subscription disclaimer",
    "form": "form search login signup dialog fieldset button",
    "comments": "comment comments comment-list commentlist disqus respond replies reply discussion reader-comments",
    "share": "share sharing social socials",
}
_ZONE_OF = {word: zone for zone, words in ZONES.items() for word in words.split()}
NOISE = frozenset(ZONES) - {"content"}

# Fixed values: (inside, outside) word counts that stand for what is known before any page is read.
PRIOR = {
    **{f"zone={z}": (1, 60) for z in NOISE}, "zone=content": (60, 1), "zone=": (20, 20),
    "link=True": (4, 20), "link=False": (20, 10),
    **{f"block={b}": (30, 8) for b in ("p", "h1", "h2", "h3", "h4", "pre", "blockquote")},
    "block=li": (8, 20),
}
PRIOR_TAGS = {**{f"tag={t}": (20, 10) for t in ("p", "b", "i", "em", "strong", "br", "h1", "h2")}, "tag=a": (5, 20), "tag=li": (6, 20)}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


#: Words that complete a region of an unmarked page, at most: this share of the region's words, and this
#: share of them in links.
COMPLETED, COMPLETED_LINKS = 0.5, 0.34


@dataclass
class Element:
    """An open block element: what encloses it, and where it begins and ends in the page's sequence."""

    tag: str = ""
    parent: Element | None = None
    zone: str = ""
    content: Element | None = None
    begin: int = 0
    end: int | None = None
    depth: int = 0


@dataclass
class Block:
    """Text between block tags, and the element it stands in; `content` is the outermost content element."""

    parts: list[str] = field(default_factory=list)
    zone: str = ""
    element: Element = field(default_factory=Element)
    content: Element | None = None

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())


def zone_of(tag: str, attributes: str, within: str, in_content: bool, compounds: bool = True) -> str:
    """The zone that an element opens, or the one it stands in. Noise inside noise stays the outer.

    `compounds` also takes the parts of names such as `post-header` for names.
    """
    if within in NOISE:
        return within
    names = [tag]
    for m in _NAMED.finditer(attributes):
        whole = (m[1] or m[2] or m[3] or "").lower()
        for name in whole.split():
            names += [name, *re.split(r"[-_]+", name)] if compounds and name not in _ZONE_OF else [name]
    zones = [_ZONE_OF[n] for n in names if n in _ZONE_OF]
    noise = [z for z in zones if z in NOISE and not (z == "header" and in_content)]
    if tag in ("body", "html"):
        return within
    if noise and tag not in MAIN:
        return noise[0]
    return "content" if "content" in zones else within


def sequence(page: str, compounds: bool = True) -> Iterator[tuple[str, str, Block, bool, str]]:
    """('word' or 'tag', text or tag name, block, in a link, block tag) along a page."""
    here = Element()
    in_link, block_tag, count = False, "", 0
    block = Block(element=here)
    open_tags: Counter = Counter()
    never_closed: set[str] = set()
    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            yield "word", page[at : m.start()], block, in_link, block_tag
            count += 1
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
        if tag in SKIPPED and not closing and not attributes.endswith("/") and tag not in never_closed:
            end = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            if end:
                at = end.end()
                continue
            never_closed.add(tag)  # only the tag is skipped
        if tag == "a":
            in_link = not closing
        elif tag in SPACES:
            yield "word", " ", block, in_link, block_tag
            count += 1
        if tag in BLOCKS and closing:
            if open_tags[tag]:
                t = ""
                while t != tag:
                    t = here.tag
                    open_tags[t] -= 1
                    here.end, here = count, here.parent
            block, block_tag, in_link = Block(zone=here.zone, element=here, content=here.content), "", False
        elif tag in BLOCKS:
            if tag in MAIN:
                in_link = False
                if here.zone in NOISE and here.content is None:  # what stands before was never closed
                    open_tags.clear()
                    while here.parent is not None:
                        here.end, here = count, here.parent
            own = zone_of(tag, attributes, here.zone, here.content is not None, compounds)
            content = here.content
            if tag not in ITEMS and tag not in VOID:
                here = Element(tag, here, own, content, count, depth=here.depth + 1)
                if own == "content" and content is None:
                    here.content = content = here
                open_tags[tag] += 1
            block, block_tag = Block(zone=own, element=here, content=content), tag
        yield "tag", tag, block, in_link, block_tag
        count += 1
    if at < len(page):
        yield "word", page[at:], block, in_link, block_tag


def features(block: Block, in_link: bool, block_tag: str) -> tuple[str, str, str]:
    return f"zone={block.zone}", f"link={in_link}", f"block={block_tag}"


def labelled_counts(page: str) -> Counter:
    """(feature, inside) counts of a page that marks its main text; nothing for other pages."""
    if not re.search(r"<(article|main)\b", page, re.I):
        return Counter()
    out: Counter = Counter()
    for kind, text, block, in_link, block_tag in sequence(page):
        inside = block.zone == "content"
        if kind == "tag":
            out[f"tag={text}", inside] += 1
            continue
        n = len(text.split())
        for f in features(block, in_link, block_tag) if n else ():
            out[f, inside] += n
    return out


def weights(counts: dict[tuple[str, bool], float]) -> dict[str, float]:
    """Log-odds of each feature, given how much lies inside and outside in all."""
    total = Counter()
    names = {f for f, _ in counts} | set(PRIOR) | set(PRIOR_TAGS)
    kind = lambda f: f.split("=")[0]
    both = {}
    for f in names:
        a, b = PRIOR.get(f) or PRIOR_TAGS.get(f) or (1, 1)
        both[f] = (counts.get((f, True), 0) + a, counts.get((f, False), 0) + b)
        total[kind(f), True] += both[f][0]
        total[kind(f), False] += both[f][1]
    out = {}
    for f, (inside, outside) in both.items():
        w = math.log(inside / total[kind(f), True]) - math.log(outside / total[kind(f), False])
        out[f] = max(-LARGEST, min(LARGEST, w))
    return out


def enclosing(a: Element, b: Element) -> Element:
    """The innermost element that holds both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a


def completed(span: tuple[int, int], placed: list[tuple[int, Block, str, bool]]) -> tuple[int, int]:
    """The span of a region with the rest of the content element that most of its words lie in.

    On a page that marks none, with the rest of the innermost element around it, unless that is the
    page itself or would add much, or mostly links.
    """
    inside = [(b, len(t.split())) for i, b, t, _ in placed if span[0] <= i < span[1] and b.zone not in NOISE and t.strip()]
    if not inside:
        return span
    n_words = sum(n for _, n in inside)
    of: dict[int, int] = Counter()
    for b, n in inside:
        of[id(b.content)] += n
    around = next((b.content for b, n in inside if b.content is not None and 2 * of[id(b.content)] > n_words), None)
    marked = around is not None
    if not marked:
        around = enclosing(inside[0][0].element, inside[-1][0].element)
        if around.tag in ("", "html", "body"):
            return span
    begin = min(span[0], around.begin)
    end = max(span[1], placed[-1][0] + 1 if around.end is None else around.end)
    more = [(len(t.split()), link) for i, b, t, link in placed if begin <= i < end and not span[0] <= i < span[1] and b.zone not in NOISE]
    added, linked = sum(n for n, _ in more), sum(n for n, link in more if link)
    fits = marked or (added <= COMPLETED * n_words and linked <= COMPLETED_LINKS * added)
    return (begin, end) if fits else span


def main_text(page: str | None, w: dict[str, float], compounds: bool = True) -> str:
    """Blocks of the best region in page order, joined by two line breaks; '' if there is none.

    Where parts of compound names make all of a page noise, only whole names count.
    """
    best, best_span, total, start, i = 0.0, (0, 0), 0.0, 0, 0
    placed: list[tuple[int, Block, str, bool]] = []
    for kind, text, block, in_link, block_tag in sequence(page or "", compounds):
        if kind == "word":
            placed.append((i, block, text, in_link))
            n = len(text.split())
            score = n * (0.2 + sum(w.get(f, 0.0) for f in features(block, in_link, block_tag)))
        else:
            score = min(TAG_AT_MOST, w.get(f"tag={text}", -0.5))
        if total <= 0:
            total, start = 0.0, i
        total += score
        i += 1
        if total > best:
            best, best_span = total, (start, i)
    begin, end = completed(best_span, placed)
    out: list[Block] = []
    for at, block, text, _ in placed:
        if begin <= at < end and block.zone not in NOISE:
            if not out or out[-1] is not block:
                out.append(block)
            block.parts.append(text)
    found = "\n\n".join(t for t in (b.text() for b in out) if t)
    return found if found or not compounds or not page else main_text(page, w, compounds=False)


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from at most `sample_pages` pages; at most one row per tag and zone comes back."""
    ids = (
        pages.select("page_id").where(F.col("page_id").isNotNull()).distinct()
        .orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                for (f, inside), n in labelled_counts(page.as_py() or "").items():
                    known = f[4:] in BLOCKS or f[4:] in VOID or f in PRIOR_TAGS or not f.startswith("tag=")
                    out[f if known else "tag=other", inside] += n
        keys = sorted(out)
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array([f for f, _ in keys], pa.string()),
                "inside": pa.array([x for _, x in keys], pa.bool_()),
                "n": pa.array([out[k] for k in keys], pa.int64()),
            }
        )

    sample = pages.join(F.broadcast(ids), "page_id", "left_semi").select("html")
    counted = sample.mapInArrow(run, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    return weights({(r.feature, r.inside): r.n for r in counted.collect()})


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """`page_id`, `url`, `text` of every row of `pages`.

    A null or empty html, or one without main text, gives an empty text. Rows without an id, and rows
    that repeat one, are extracted like any other; an empty table gives no rows. Long pages are read whole,
    by scans in time in proportion to their length. Other columns are not read. The labelled sample
    is read when this is called; extraction is one narrow step.
    """
    known = train(pages, sample_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), known) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    given = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return given.mapInArrow(run, "page_id long, url string, text string")
