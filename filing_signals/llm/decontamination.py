"""Benchmark decontamination by templates, in SQL functions alone.

A text becomes a sequence of template tokens: words in lower case, with numbers, names and units
replaced by typed placeholders. Windows of templates are hash-joined with those of the benchmark
items, so a question whose numbers or names were exchanged still meets its original. Then the slots
are compared: within one place of a document, an item's value must always stand for the same value
of the document, otherwise the place only looks alike and does not count.

Documents and items are first paired by their distinct windows. For the pairs that share enough, equal windows
at even distances, as of a table of numbers, are runs, and two runs line up in as many ways as they
are long together, each one row, so that repeated windows are not paired place by place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_signals.functions.text import bind
from filing_signals.llm.staging import Stage

# What fills a slot. Placeholders are control characters, which are taken out of the
# texts first. In the strict form a name is a capitalised word that does not start a sentence or line;
# in the loose form it is any capitalised word, whatever stands before it. Those that only the loose form
# takes for names are marked. The slots decide where the loose form is too loose.
_NUMBER, _NAME, _UNIT, _MARK = "\x01", "\x02", "\x03", "\x04"
STRICT, LOOSE = 1, 2
NUMBER = r"(?<![\p{L}\p{N}])[0-9]+(?:[.,:/][0-9]+)*(?![\p{L}\p{N}])"
NAME = r"(?<=[\p{Ll}\p{N},;] )\p{Lu}\p{Ll}+(?![\p{L}\p{N}])"
ANY_NAME = r"(?<![\p{L}\p{N}])\p{Lu}\p{Ll}+(?![\p{L}\p{N}])"
UNIT = (
    r"(?<=[0-9]) ?(?:%|°C|°F|(?:km|cm|mm|nm|kg|mg|g|m|lb|oz|ft|mi|l|ml|s|ms|h|min|kW|W|V|A|Hz|kHz|MHz|GB|MB|kB"
    r"|metres?|meters?|miles?|feet|foot|inch(?:es)?|grams?|kilograms?|pounds?|litres?|liters?|seconds?|minutes?|hours?"
    r"|days?|weeks?|months?|years?|dollars?|euros?|cents?|percent|degrees?)(?![\p{L}\p{N}]))"
)
_BETWEEN = r"[^\p{L}\p{N}\x01-\x04]+"


@dataclass(frozen=True)
class Settings:
    """`window` template tokens are joined at a time; a match needs `coverage` of an item's windows.

    A windowed table of at most `broadcast_rows` rows (36 bytes each) is broadcast; a larger one is
    joined by shuffle.
    """

    window: int = 8
    coverage: float = 0.5
    broadcast_rows: int = 500_000


def _unslotted(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{_NUMBER}-{_MARK}]", " ")


def marked(text: Column) -> Column:
    """Template tokens of a text, as an array of strings, with those marked that are loose names."""
    c = F.regexp_replace(_unslotted(text), UNIT, f" {_UNIT} ")
    c = F.regexp_replace(F.regexp_replace(c, NAME, _NAME), ANY_NAME, f"{_MARK}$0")
    c = F.regexp_replace(c, NUMBER, f" {_NUMBER} ")
    tokens = F.split(F.lower(c), _BETWEEN, -1)
    return F.array_remove(tokens, "")


def _strict(token: Column) -> Column:
    return F.ltrim(token, F.lit(_MARK))


def _loose(token: Column) -> Column:
    return F.when(F.startswith(token, F.lit(_MARK)), _NAME).otherwise(token)


def templates(text: Column) -> Column:
    """Template tokens of a text in the strict form."""
    return F.transform(marked(text), _strict)


def slots(text: Column) -> Column:
    """Values in the slots of a text by type: arrays in the order of the placeholders.

    `names` are those of the strict form, `any_names` those of the loose form.
    """
    c = _unslotted(text)
    every = lambda c, p: F.regexp_extract_all(c, F.lit(p), 0)
    less_units = F.regexp_replace(c, UNIT, f" {_UNIT} ")
    less_names = F.regexp_replace(less_units, NAME, _NAME)
    return F.struct(
        F.transform(every(less_names, NUMBER), F.lower).alias("numbers"),
        F.transform(every(less_units, NAME), F.lower).alias("names"),
        F.transform(every(less_units, ANY_NAME), F.lower).alias("any_names"),
        F.transform(every(c, UNIT), lambda u: F.lower(F.trim(u))).alias("units"),
    )


def _hashed(tokens: Column) -> Column:
    """Hashes of marked tokens in both forms."""
    of = lambda form: F.transform(tokens, lambda t: F.xxhash64(form(t)))
    return F.struct(of(_strict).alias("strict"), of(_loose).alias("loose"))


def _windowed(given: DataFrame, key: list[str], sizes: list[int]) -> DataFrame:
    """(key, pos, size, hash, forms) of the windows of each size over the texts' marked tokens.

    `forms` is STRICT, LOOSE or, for one row where they do not differ, the sum of both. Windows are columns over
    a text's exploded places, and not arrays made by lambdas, so that Spark compiles them.
    """
    both = F.inline(F.array(bind(marked(F.col("text")), _hashed)))
    places = given.select(*key, both).select(*key, "strict", "loose", F.posexplode("strict").alias("pos", "token"))
    value = lambda form, n: F.xxhash64(*(F.get(form, F.col("pos") + k) for k in range(n)))
    values = [value(form, n).alias(f"{form}_{n}") for form in ("strict", "loose") for n in sizes]
    hashed = places.select(*key, "pos", F.size("strict").alias("tokens"), *values)

    def of_size(n: int) -> list[Column]:
        strict, loose = F.col(f"strict_{n}"), F.col(f"loose_{n}")
        one = lambda h, same, other: F.struct(F.lit(n).alias("size"), h.alias("hash"), F.when(strict == loose, same).otherwise(other).alias("forms"))
        return [one(strict, STRICT | LOOSE, STRICT), one(loose, 0, LOOSE)]

    rows = hashed.select(*key, "pos", "tokens", F.inline(F.array(*(w for n in sizes for w in of_size(n)))))
    return rows.where("forms != 0 AND pos + size <= tokens").select(*key, "pos", "size", "hash", "forms")


def _slots_by_place(given: DataFrame, key: list[str]) -> DataFrame:
    """(key, form, kinds, contents): what slot each token is, and its value; null for other tokens."""

    def of_form(place: Column, form: int, token: Callable[[Column], Column], names: str) -> Column:
        at = F.transform(place["t"], lambda t, i: F.struct(i.alias("pos"), token(t).alias("kind")))
        values = {_NUMBER: "numbers", _NAME: names, _UNIT: "units"}
        every = F.array_sort(F.concat(*(of_kind(at, place["s"][name], kind) for kind, name in values.items())))
        return bind(every, lambda x: F.struct(F.lit(form).alias("form"), spread(x, "kind").alias("kinds"), spread(x, "value").alias("contents")))

    def of_kind(at: Column, values: Column, kind: str) -> Column:
        one = lambda x, nth: F.struct(x["pos"].alias("pos"), x["kind"].alias("kind"), F.get(values, nth).alias("value"))
        return F.transform(F.filter(at, lambda x: x["kind"] == kind), one)

    def spread(slots: Column, name: str) -> Column:
        # nulls between one slot and the next, so that a token's place is its index
        before = lambda i: F.coalesce(F.get(slots, i - 1)["pos"], F.lit(-1))
        none = F.lit(None).cast("string")
        return F.flatten(F.transform(slots, lambda x, i: F.concat(F.array_repeat(none, x["pos"] - before(i) - 1), F.array(x[name]))))

    place = F.struct(marked(F.col("text")).alias("t"), slots(F.col("text")).alias("s"))
    both = bind(place, lambda p: F.array(of_form(p, STRICT, _strict, "names"), of_form(p, LOOSE, _loose, "any_names")))
    return given.dropDuplicates(key).select(*key, F.inline(both))


def _runs(places: DataFrame, key: list[str], pos: str, name: str) -> DataFrame:
    """(key, form, size, hash, <name>_first, <name>_stride, <name>_n): places of one window at even distances."""
    same = [*key, "form", "size", "hash"]
    along = Window.partitionBy(*same).orderBy(pos)
    gaps = places.withColumn("gap", F.col(pos) - F.lag(pos).over(along))
    changed = (F.col("gap") != F.lag("gap").over(along)).cast("int")
    numbered = gaps.withColumn("changed", F.coalesce(changed, F.lit(0))).withColumn("run", F.sum("changed").over(along))
    return numbered.groupBy(*same, "run").agg(
        F.min(pos).alias(f"{name}_first"), F.coalesce(F.max_by("gap", pos), F.lit(1)).alias(f"{name}_stride"), F.count("*").alias(f"{name}_n")
    ).drop("run")


def _alignments() -> Column:
    """(shift, first, stride, n) of each way in which a document's run lines up with an item's: the item's
    places first, first + stride, ... that meet the document's run there."""
    d, i = ({c: F.col(f"{of}_{c}") for c in ("first", "stride", "n")} for of in ("doc", "item"))
    stride = F.when(d["n"] > 1, d["stride"]).when(i["n"] > 1, i["stride"]).otherwise(1)
    even = (d["n"] == 1) | (i["n"] == 1) | (d["stride"] == i["stride"])

    def made(shift: Column, first: Column, n: Column) -> Column:
        return F.struct(shift.cast("int").alias("shift"), first.cast("int").alias("first"), stride.cast("int").alias("stride"), n.cast("int").alias("n"))

    def evenly(k: Column) -> Column:
        skipped = F.greatest(-k, F.lit(0))
        return made(d["first"] - i["first"] + stride * k, i["first"] + stride * skipped, F.least(i["n"] - 1, d["n"] - 1 - k) - skipped + 1)

    def singly(j: Column) -> Column:
        at = i["first"] + i["stride"] * j
        return F.transform(F.sequence(F.lit(0).cast("long"), d["n"] - 1), lambda k: made(d["first"] + d["stride"] * k - at, at, F.lit(1)))

    uneven = F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), i["n"] - 1), singly))
    return F.when(even, F.transform(F.sequence(1 - i["n"], d["n"] - 1), evenly)).otherwise(uneven)


_DOC, _ITEM = ["doc_id", "doc_text"], ["item_id", "item_text"]


class Decontamination:
    """The joins of one run; `stage` holds their intermediate tables."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, s: Settings, stage: Stage):
        self.s, self.stage = s, stage
        # the digest of a text tells apart those that come under one id
        given = lambda t, i, of: t.where(F.col(i).isNotNull()).select(F.col(i).cast("long").alias(i), F.xxhash64("text").alias(of), "text")
        self.docs = given(docs, "doc_id", "doc_text")
        items = given(benchmark, "item_id", "item_text").distinct()
        sized = items.withColumn("tokens", F.size(templates(F.col("text")))).where("tokens > 0")
        self.items = stage.keep(sized.withColumn("size", F.least("tokens", F.lit(s.window))), "items")

    def small(self, df: DataFrame) -> DataFrame:
        """A written table, marked for broadcast if it is small enough."""
        return F.broadcast(df) if df.count() <= self.s.broadcast_rows else df

    def windows(self) -> tuple[DataFrame, DataFrame]:
        """Windows of the items, and those of the documents that any item has, by form."""
        sizes = sorted(r["size"] for r in self.items.select("size").distinct().collect())  # at most `window`
        sizes = sizes or [self.s.window]  # no items, no hits
        own = _windowed(self.items, _ITEM, sizes).join(self.items.select(*_ITEM, "size"), [*_ITEM, "size"])
        own = self.stage.keep(own.select(*_ITEM, F.col("pos").alias("item_pos"), "size", "hash", "forms").distinct(), "windows")
        keys = own.groupBy("size", "hash").agg(F.bit_or("forms").alias("item_forms"))
        shared = F.col("forms").bitwiseAND(F.col("item_forms"))
        found = _windowed(self.docs, _DOC, sizes).join(self.small(self.stage.keep(keys, "keys")), ["size", "hash"])
        # written as it comes, by the scan alone; rows of repeated documents are told apart later, among the likely
        found = found.where(shared != 0).select(*_DOC, "pos", "size", "hash", shared.alias("forms"))
        each = lambda df: df.withColumn("form", F.explode(F.array(F.lit(STRICT), F.lit(LOOSE)))).where("forms & form != 0").drop("forms")
        return each(own), each(self.stage.keep(found, "found"))

    def likely(self, own: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs that share enough windows, whatever their places and slots."""
        total = self.items.select(*_ITEM, (F.col("tokens") - F.col("size") + 1).cast("long").alias("n_windows"))
        window = ["form", "size", "hash"]
        met = found.select("doc_id", *window).distinct().join(self.small(self.stage.keep(own, "own")), window)
        per_pair = met.groupBy("doc_id", *_ITEM).agg(F.countDistinct("item_pos").alias("n_matched"))
        return self.stage.keep(per_pair.join(total, _ITEM).where(self.enough()).select("doc_id", *_ITEM, "n_windows"), "likely")

    def enough(self) -> Column:
        return F.col("n_matched") >= self.s.coverage * F.col("n_windows")

    def leaks(self) -> DataFrame:
        own, found = self.windows()
        likely = self.likely(own, found)
        pair = ["doc_id", *_ITEM]
        docs = self.small(self.stage.keep(likely.select("doc_id").distinct(), "likely-docs"))
        of_items = _runs(own.join(F.broadcast(likely.select(*_ITEM).distinct()) if likely.count() <= self.s.broadcast_rows else likely.select(*_ITEM).distinct(), _ITEM), _ITEM, "item_pos", "item")
        of_docs = _runs(found.join(docs, "doc_id").distinct(), _DOC, "pos", "doc")
        met = of_docs.join(likely, "doc_id").join(of_items, [*_ITEM, "form", "size", "hash"])
        place = [*_DOC, *_ITEM, "form", "shift"]
        lined = met.select(*_DOC, *_ITEM, "n_windows", "form", "size", F.explode(_alignments()).alias("a")).select("*", "a.*")
        # runs of one way to line up: at most as many as the item has windows
        ways = lined.groupBy(*place, "n_windows").agg(F.collect_set(F.struct("first", "stride", "n", "size")).alias("runs"))
        item_slots = _slots_by_place(self.items.select(*_ITEM, "text"), _ITEM)
        doc_slots = _slots_by_place(self.docs.join(docs, "doc_id"), _DOC).select(*_DOC, "form", F.col("contents").alias("doc_contents"))
        ways = ways.join(item_slots, [*_ITEM, "form"], "left").join(doc_slots, [*_DOC, "form"], "left")
        judged = self.stage.keep(ways.select(*pair, "doc_text", "n_windows", "form", "shift", self.judged().alias("j")).select("*", "j.*").drop("j"), "judged")
        judged = judged.where("consistent")
        # slots of a place by the form that has more of its windows, by the strict one if both have all
        fullest = F.max(F.struct(F.size("positions").alias("n_here"), (-F.col("form")).alias("order"), "n_slots", "n_changed")).alias("p")
        slots_of = judged.groupBy(*_DOC, *_ITEM, "shift").agg(fullest).groupBy(*pair).agg(
            F.coalesce(F.sum("p.n_slots"), F.lit(0)).alias("n_slots"), F.coalesce(F.sum("p.n_changed"), F.lit(0)).alias("n_changed")
        )
        matched = judged.select(*pair, "n_windows", F.explode("positions").alias("item_pos")).distinct()
        found = matched.groupBy(*pair, "n_windows").agg(F.count("*").alias("n_matched")).where(self.enough()).join(slots_of, pair)
        # of several texts of one item the one that is found the most
        most = F.struct(F.col("n_matched") / F.col("n_windows"), "n_windows", "n_matched", "n_slots", "n_changed")
        return found.groupBy("doc_id", "item_id").agg(F.max(most).alias("m")).select(
            "doc_id", "item_id", "m.n_windows", "m.n_matched", "m.n_slots", "m.n_changed"
        )

    def judged(self) -> Column:
        """(positions, consistent, n_slots, n_changed) of one way to line up: the item's places that match there,
        and whether a value of the item always stands for the same one of the document."""

        def places(r: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), r["n"] - 1), lambda k: r["first"] + r["stride"] * k)

        def tokens(r: Column) -> Column:
            return F.flatten(F.transform(places(r), lambda at: F.sequence(at, at + r["size"] - 1)))

        def slots_at(covered: Column) -> Column:
            slot = lambda at: F.struct(F.get("kinds", at).alias("kind"), F.get("contents", at).alias("value"), F.get("doc_contents", at + F.col("shift")).alias("doc_value"))
            return F.filter(F.transform(covered, slot), lambda x: x["kind"].isNotNull())

        def compared(x: Column) -> Column:
            known = F.filter(x, lambda v: v["doc_value"].isNotNull())
            ways = lambda *names: F.size(F.array_distinct(F.transform(known, lambda v: F.struct(*(v[n].alias(n) for n in names)))))
            return F.struct(
                F.array_distinct(F.flatten(F.transform("runs", places))).alias("positions"),
                (ways("kind", "value") == ways("kind", "value", "doc_value")).alias("consistent"),
                F.size(x).cast("long").alias("n_slots"),
                F.size(F.filter(known, lambda v: v["value"] != v["doc_value"])).cast("long").alias("n_changed"),
            )

        covered = F.array_distinct(F.flatten(F.transform("runs", tokens)))
        return bind(bind(covered, slots_at), compared)


def contaminated(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, n_slots, n_changed): items found in documents.

    A pair is reported when at least `s.coverage` of the item's template windows occur in the
    document, in places where the slots are consistent, by the strict or the loose form of names. `n_changed` of `n_slots` compared slots hold
    another value than the item's: 0 is a copy, more a re-parameterised question. Items shorter than
    the window are matched whole. Null and empty texts, rows without an id and empty tables match
    nothing. Rows that repeat a document's id are one document, whose texts are lined up apart; of
    different texts under one item's id the one found the most is reported. Other columns are not read. Jobs run,
    and tables are written to the shared folder, when this is called.
    """
    return Decontamination(docs, benchmark, s, Stage(docs.sparkSession, "decontamination")).leaks()
