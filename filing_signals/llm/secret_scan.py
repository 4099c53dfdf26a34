"""Secret scans in SQL functions alone: known forms, and sliding-window entropy.

Known forms are matched by pattern. Any other long string of key characters is a candidate: the
Shannon entropy of each window of it is followed by counts that change by the character that enters
and the one that leaves, and the best window is held against the threshold of the string's character
class. Strings on the allow-list are never reported for their entropy.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_signals.functions.text import bind

# Patterns of the known forms and the least length of a match (of its value).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

# Characters of a candidate, and its classes with the entropy in bits that a window of
# WINDOW characters must reach. The first class that all characters fit is the candidate's.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 24
CLASSES = (
    ("digits", r"^[0-9_=-]+$", math.inf),  # account numbers, dates
    ("hex", r"^[0-9a-fA-F_=-]+$", 3.0),
    ("letters", r"^[A-Za-z_=-]+$", math.inf),  # words and identifiers
    ("mixed", "", 3.8),
)
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % WINDOW

# Strings that look random and are none. Identifiers in the 8-4-4-4-12 form, paths of
# lower-case words, alphabets in order, and anything that calls itself an example.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^/?([a-z]+[-_/]+)+[a-z0-9]*$",
    r"(?i)abcdefghijklm|0123456789abcdef|1234567890",
    r"(?i)example|placeholder|changeme|xxxxxx",
)

_BLOCK = 128
#: Entropies are summed as whole numbers of this size, so every order of adding gives the same.
_UNIT = 1 << 20


@dataclass(frozen=True)
class Entropy:
    """S = sum of c * log2(c) over a window's character counts; H = log2(w) - S / w."""

    window: int = WINDOW

    def terms(self) -> list[int]:
        """c * log2(c) for c from 0 to the window's length."""
        return [0, *(round(c * math.log2(c) * _UNIT) for c in range(1, self.window + 1))]

    def most(self, bits: float) -> int:
        """The largest S of a window that reaches so many bits; -1 if none can."""
        if math.isinf(bits):
            return -1
        return math.floor((math.log2(self.window) - bits) * self.window * _UNIT)


def running(lengths: Column) -> Column:
    """Sums of an array up to and with each element, in blocks so that time stays near linear."""

    def sums(part: Column, start: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(
            part,
            F.struct(start.alias("at"), none.alias("all")),
            lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["all"], s["at"] + x).alias("all")),
            lambda s: s["all"],
        )

    def blocks(a: Column) -> Column:
        parts = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK)),
        )
        return bind(parts, lambda p: bind(
            F.concat(F.array(F.lit(0)), sums(F.transform(p, lambda x: F.aggregate(x, F.lit(0), lambda s, y: s + y)), F.lit(0))),
            lambda firsts: F.flatten(F.transform(p, lambda x, i: sums(x, F.get(firsts, i)))),
        ))

    return bind(lengths, blocks)


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches of a pattern: array of (start, end, value) in code points, end exclusive.

    The text between matches and the matches alternate, so their lengths add up to the places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)

    def placed(m: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
        values = F.regexp_extract_all(text, F.lit(pattern), group) if group else m
        lengths = F.flatten(F.transform(m, lambda x, i: F.array(F.get(gaps, i), F.char_length(x))))
        return bind(running(lengths), lambda ends: bind(values, lambda v: F.transform(
            v,
            lambda x, i: F.struct(F.get(ends, 2 * i).alias("start"), F.get(ends, 2 * i + 1).alias("end"), x.alias("value")),
        )))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return bind(matches, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))


def least_sum(value: Column, e: Entropy) -> Column:
    """The smallest S over all windows of a string of at least `window` key characters.

    As the window moves on, what S loses and gains follows from how often the character that leaves
    and the one that enters occur among those that stay, so a step costs a window, whatever the string's length.
    """
    terms = F.array(*(F.lit(t).cast("long") for t in e.terms()))
    step_of = lambda n: F.get(terms, n + 1) - F.get(terms, n)

    def step(s: Column, codes: Column, i: Column) -> Column:
        stay = F.slice(codes, F.greatest(i - e.window + 2, F.lit(1)), F.least(i, F.lit(e.window - 1)))

        def moved(stay: Column) -> Column:
            among = lambda code: F.size(F.filter(stay, lambda c: c == code))
            left = F.when(i >= e.window, step_of(among(F.get(codes, i - e.window)))).otherwise(F.lit(0).cast("long"))
            return s["sum"] + step_of(among(F.get(codes, i))) - left

        def seen(total: Column) -> Column:
            least = F.when(i >= e.window - 1, F.least(s["least"], total)).otherwise(s["least"])
            return F.struct(total.alias("sum"), least.alias("least"))

        return bind(stay, lambda x: bind(moved(x), seen))

    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit((1 << 62)).cast("long").alias("least"))
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return bind(codes, lambda a: F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), start, lambda s, i: step(s, a, i), lambda s: s["least"]))


def random_looking(value: Column, e: Entropy = Entropy()) -> Column:
    """Whether some window of the string reaches its class's entropy, and no allow-list entry fits."""
    most = reduce(
        lambda other, c: F.when(value.rlike(c[1]), F.lit(e.most(c[2])).cast("long")).otherwise(other),
        reversed(CLASSES[:-1]),
        F.lit(e.most(CLASSES[-1][2])).cast("long"),
    )
    allowed = reduce(lambda a, b: a | b, (value.rlike(p) for p in ALLOWED))
    return bind(most, lambda m: F.when((m < 0) | allowed, F.lit(False)).otherwise(least_sum(value, e) <= m))


def spans(text: Column) -> Column:
    """All secrets of a text: array of (start, kind, end), kind as position in KINDS, in order.

    Entropy finds a string only where no known form covers it.
    """
    whole = F.coalesce(text, F.lit(""))

    def of(kind: int, places: Column) -> Column:
        return F.transform(
            places, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
        )

    assign = F.filter(found(whole, ASSIGN, 2), lambda m: F.char_length(m["value"]) >= ASSIGN_LEAST)
    base = F.concat(of(0, assign), of(1, found(whole, ACCESS)), of(2, found(whole, HEX)))
    candidates = F.filter(found(whole, CANDIDATE), lambda m: random_looking(m["value"]))

    def with_new(b: Column) -> Column:
        inside = lambda m: F.exists(b, lambda x: (x["start"] <= m["start"]) & (m["end"] <= x["end"]))
        return F.array_sort(F.concat(b, of(3, F.filter(candidates, lambda m: ~inside(m)))))

    return bind(base, with_new)


def written(places: Column) -> Column:
    """`kind:start:end`, comma-joined, of spans in order."""
    names = F.array(*(F.lit(k) for k in KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(places, one), ",")


def secret_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, secrets) of every row, `secrets` as made by `spans`; one narrow step.

    A null or empty text has none. A row without an id, or one that repeats a document, is scanned
    like any other; an empty table gives no rows. Long texts are scanned whole, and a long candidate in time in
    proportion to its length. Nothing but `doc_id` and `text` is read, so no other name can clash.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), spans(F.col("text")).alias("secrets"))


def redacted(text: Column, places: Column, mark: str = "[secret]") -> Column:
    """The text with each span replaced by a mark; overlapping spans by one."""

    def step(s: Column, m: Column) -> Column:
        keep = F.when(
            m["start"] >= s["at"], F.concat(F.substr(text, s["at"] + 1, m["start"] - s["at"]), F.lit(mark))
        ).otherwise(F.lit(""))
        return F.struct(F.concat(s["out"], keep).alias("out"), F.greatest(s["at"], m["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(places, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.char_length(text))))
