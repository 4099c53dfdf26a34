"""Column functions on text: HTML to text, sentence splitting, cleaning, ratios, ids and paths.

Everything here is a built-in expression, so it stays in the JVM and inside one narrow stage.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5
from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

from filing_signals import fixed

# Written for Java's matcher, which tests one named ASCII class several times faster than a row
# of ranges: visible ASCII is ruled out before the white space ranges are looked at, and the
# letters and digits of the kept set are \p{Alnum}.
WS_RUN = rf"[\P{{Graph}}&&[{fixed.WHITE_SPACE}]]+"
KEPT = fixed.KEPT.replace("A-Za-z0-9", r"\p{Alnum}")
NOT_KEPT = f"[^{KEPT}]"
# Runs outside the kept set, but for a single space, which is what they become.
NOT_KEPT_RUN = f"{NOT_KEPT}{NOT_KEPT}+|[^{KEPT} ]"
SPLIT = rf"[{fixed.SENTENCE_END}]+|\n+"
# Runs of what a text loses before it is cut. With each character named, a class is one table look-up.
_NAMED = ascii_letters + digits
NOT_IN_PIECES = rf"[^{_NAMED},{fixed.SENTENCE_END}\n]+"

# Comments and elements without readable text. One alternation, so whichever opens first wins;
# an element left open runs to the end of the page.
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|<noscript\b[^>]*>.*?(?:</noscript\s*>|\z)"
)
# Tags, where quoted attribute values may hold '>'; then doctype, other declarations and
# whatever tag has an unbalanced quote. The possessive loop keeps Java's stack flat.
TAG = r"""</?[A-Za-z][^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*+>"""
LOOSE_TAG = r"<[/!?A-Za-z][^>]*>"
ENTITY_NAME = r"^([A-Za-z][A-Za-z0-9]*;)"
# Old names count without ';' too; the longest that fits is meant.
_OLD_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
ENTITY_OLD = f"^({'|'.join(_OLD_NAMES)})"
ENTITY_DEC = r"^#0*([0-9]*);?"
ENTITY_HEX = r"^#[xX]0*([0-9A-Fa-f]*);?"
# Looked up before the whole table, which is searched in line.
COMMON_ENTITIES = ("amp;", "nbsp;", "quot;", "lt;", "gt;", "apos;")


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """`f(value)` with `value` computed once per row, however often `f` refers to it."""
    return F.element_at(F.transform(F.array(value), lambda v: f(v)), 1)


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WS_RUN, " "))


def _char(code: Column) -> Column:
    """The character of a Unicode code point; code points outside the range give nothing."""
    scalar = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    return F.when(
        scalar, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    ).otherwise("")


def unescape_entities(c: Column) -> Column:
    """Replace named and numeric character references in one pass.

    The text is cut at every '&' and only the head of each piece is read, so `&amp;lt;` gives
    `&lt;` and nothing is decoded twice. Names are those of HTML 5; old ones need no ';'. Numbers
    may have any number of digits; those that are no character give nothing.
    """
    every = F.create_map(*[F.lit(x) for name, char in sorted(html5.items()) for x in (name, char)])

    def named(name: Column) -> Column:
        found = F.when(name == "", F.lit(None))
        for common in COMMON_ENTITIES:
            found = found.when(name == common, F.lit(html5[common]))
        return found.otherwise(every[name])

    def numbered(p: Column, digits: str, most: int, code: Callable[[Column], Column]) -> Column:
        n = F.regexp_extract(p, digits, 1)
        inside = (n != "") & (F.length(n) <= most)
        return F.concat(F.when(inside, _char(code(F.when(inside, n)))).otherwise(""), F.regexp_replace(p, digits, ""))

    def by_name(p: Column) -> Column:
        name = F.regexp_extract(p, ENTITY_NAME, 1)
        old = F.regexp_extract(p, ENTITY_OLD, 1)

        def result(char: Column) -> Column:
            return (
                F.when(char.isNotNull(), F.concat(char, F.regexp_replace(p, ENTITY_NAME, "")))
                .when(old != "", F.concat(every[old], F.regexp_replace(p, ENTITY_OLD, "")))
                .otherwise(F.concat(F.lit("&"), p))
            )

        return bind(named(name), result)

    def piece(p: Column) -> Column:
        return (
            F.when(p.rlike("^[A-Za-z]"), by_name(p))
            .when(p.rlike("^#[0-9]"), numbered(p, ENTITY_DEC, 7, lambda n: n.cast("long")))
            .when(p.rlike("^#[xX][0-9A-Fa-f]"), numbered(p, ENTITY_HEX, 6, lambda n: F.conv(n, 16, 10).cast("long")))
            .otherwise(F.concat(F.lit("&"), p))
        )

    def joined(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece)
        return F.concat(F.element_at(parts, 1), F.array_join(rest, ""))

    return F.when(~c.contains("&"), c).otherwise(bind(F.split(c, "&"), joined))


def html_to_text(c: Column) -> Column:
    """Readable text of a page: text nodes joined by a space, white space collapsed."""
    shown = F.regexp_replace(c, HIDDEN, " ")
    plain = F.regexp_replace(F.regexp_replace(shown, TAG, " "), LOOSE_TAG, " ")
    return bind(plain, lambda p: collapse_space(unescape_entities(p)))


def clean_sentence(c: Column) -> Column:
    """Characters outside the kept set become spaces, runs collapse; null gives ''.

    Kept-set complement and white space are replaced together: a run of both is one space. A single
    space is no match, as most of them are single.
    """
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), NOT_KEPT_RUN, " "))


def split_sentences(c: Column) -> Column:
    """Array of non-empty sentences with white space collapsed, before any cleaning."""
    return F.filter(F.transform(F.split(c, SPLIT), collapse_space), lambda s: s != "")


def sentence_array(c: Column, min_len: int = fixed.MIN_SENTENCE_LENGTH) -> Column:
    """Split, clean and keep sentences of at least `min_len` characters, in text order.

    For a positive minimum the whole text is cleaned by one regular expression before it is
    cut; it leaves the sentence ends, where the text is then cut. What lies between two of them is plain ASCII with one
    blank at most at either side, and only what may be long enough is trimmed. At 0 a piece that only
    cleaning empties is kept, so the pieces have to be looked at one by one.
    """
    if min_len <= 0:
        return F.transform(split_sentences(c), clean_sentence)
    pieces = F.split(F.trim(F.regexp_replace(c, NOT_IN_PIECES, " ")), rf"[{fixed.SENTENCE_END}\n]")
    trimmed = F.transform(F.filter(pieces, lambda s: F.octet_length(s) >= min_len), lambda s: F.trim(s))
    return F.filter(trimmed, lambda s: F.octet_length(s) >= min_len)


def ratio_over(c: Column, char_class: str) -> Column:
    """Share of characters matching `char_class` among non-space ones; 1.0 where there are none."""

    def share(dense: Column) -> Column:
        hits = F.length(dense) - F.length(F.regexp_replace(dense, char_class, ""))
        return F.when(F.length(dense) == 0, F.lit(1.0)).otherwise(
            hits.cast("double") / F.length(dense).cast("double")
        )

    return bind(F.regexp_replace(c, WS_RUN, ""), share)


def digit_ratio(c: Column) -> Column:
    return ratio_over(c, fixed.DIGIT)


def clean_digit_ratio(c: Column) -> Column:
    """`digit_ratio` of a cleaned text: its only white space is ' ' and its digits are 0-9. Blanks are
    replaced as bytes and digits by the run, since `translate` looks up each character."""
    size = F.length(F.replace(c, F.lit(" "), F.lit("")))
    hits = F.length(c) - F.length(F.regexp_replace(c, "[0-9]+", ""))
    return F.when(size == 0, F.lit(1.0)).otherwise(hits.cast("double") / size.cast("double"))


def symbol_ratio(c: Column) -> Column:
    return ratio_over(c, NOT_KEPT)


def tokens(c: Column) -> Column:
    """White-space tokens of a text, empties dropped."""
    return F.filter(F.split(c, WS_RUN), lambda t: t != "")


def decode_tolerant(content: Column) -> Column:
    """Bytes to text; bytes that are not valid UTF-8 are dropped."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def normalise_ticker(c: Column) -> Column:
    return F.replace(c, F.lit("."), F.lit("-"))


def padded_cik(c: Column) -> Column:
    return F.format_string("%010d", c.cast("long"))


def accession_key(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def archive_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat_ws(
        "/",
        F.lit(fixed.ARCHIVE_ROOT),
        cik.cast("long").cast("string"),
        accession_key(accession),
        document,
    )


def storage_path(
    base: str, ticker: Column, form: Column, accession: Column, document: Column
) -> Column:
    return F.concat_ws("/", F.lit(base.rstrip("/")), ticker, form, accession_key(accession), document)


def path_accession(path: Column) -> Column:
    return F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit(""))


def path_file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def display_id(number: Column) -> Column:
    return F.format_string("D%03d", number)


def display_number(doc_id: Column) -> Column:
    """The number in a display id, so that D1000 comes after D999; null where there is none."""
    return F.regexp_extract(doc_id.cast("string"), r"^D0*([0-9]{1,18})$", 1).try_cast("long")


def filing_key(cik: Column, accession: Column, document: Column) -> Column:
    """A key of a filing's document that does not change between runs, as display ids do."""
    return F.concat_ws("/", padded_cik(cik), accession_key(accession), document)
