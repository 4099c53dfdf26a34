"""Joins over documents against plain versions: line dedup, Jaccard join, chunks, templates, licences."""

import random
import textwrap

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from filing_signals.llm import chunk_dedup, decontamination, jaccard_join, license_scan, line_dedup
from filing_signals.llm.components import components
from filing_signals.llm.oracle import ORACLE
from filing_signals.llm.queries import QUERIES
from filing_signals.llm.staging import Stage
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def null_last(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{SF}/{t}.parquet')")
    mine = QUERIES[name](spark, SF)
    theirs = con.execute(ORACLE[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(mine.columns)
    assert null_last(map(tuple, mine.select(*names).collect())) == null_last(theirs.fetchall())


def test_line_dedup_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    rows = line_dedup.line_dedup(docs).collect()
    assert list(rows[0].row.asDict()) == docs.columns and {r.row.counts for r in rows} == {"counts"}
    found = [(r.row.doc_id, r.n_lines, r.n_dropped, r.row.text) for r in rows]
    assert null_last(found) == null_last(brute.lines_kept(pairs(docs)))
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_line_keys_and_threshold(spark):
    line = "The Same Line of Text, twenty"
    rows = [(1, f"a\n {line}\t\n{line}"), (2, f"{line.upper()}\r"), (3, f"x\n{line}\ny\n{line}"), (4, "short\nshort"), (5, "short"), (6, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.row.doc_id: r.row.text for r in line_dedup.line_dedup(docs).collect()}
    assert out == {1: "a", 2: "", 3: rows[2][1], 4: "short\nshort", 5: "short", 6: "short"}


def near_copies(seed, n=90):
    """Texts of 1 to 80 words, most of them made from others by a few changes, some by many."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    texts = [[word() for _ in range(r.choice([1, 3, 4, 8, 14, 30, 80]))] for _ in range(8)]
    while len(texts) < n:
        t = list(r.choice(texts))
        for _ in range(r.choice([0, 1, 1, 1, 2, 3, 6])):
            at = r.randrange(len(t) + 1)
            t[at : at + r.choice([0, 1])] = [word()] if r.random() < 0.7 else []
        texts.append(t or [word()])
    return [(i * 3 + 1, " ".join(t).title() if i % 5 == 0 else "  ".join(t)) for i, t in enumerate(texts)]


def around_passages(seed, n=120):
    """Texts that are mostly one of two passages, with words of their own at the ends and some changed."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(100_000)}"
    passages = [[word() for _ in range(m)] for m in (60, 90)]
    rows = []
    for i in range(n):
        t = list(r.choice(passages))
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            t[r.randrange(len(t))] = word()
        own = [word() for _ in range(r.choice([0, 2, 5, 10, 20, 40]))]
        rows.append((i, " ".join(own[: len(own) // 2] + t + own[len(own) // 2 :])))
    return rows


@pytest.mark.parametrize(
    "rows, k, percent",
    [(near_copies(1), 4, 85), (near_copies(2), 5, 80), (near_copies(3), 2, 60), (around_passages(4), 4, 85), (around_passages(5), 5, 80), (around_passages(6), 3, 70)],
)
def test_jaccard_components_equal_all_pairs(spark, monkeypatch, rows, k, percent):
    monkeypatch.setattr(jaccard_join, "COMPARED_AT_ONCE", 50)  # so that subsets are dealt
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", 3)
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
    assert {r.doc_id: r.component_id for r in out} == brute.jaccard(rows, k, percent)
    assert {r.doc_id: r.n_shingles for r in out} == {i: len(brute.shingles(t, k)) for i, t in rows}


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_what_both_count_on(percent):
    """For all sizes that may link, sets that differ as much as they may share the subsets that each leaves out, and one more."""
    t = jaccard_join.Threshold(percent)
    r = np.random.default_rng(percent)
    for s in range(t.tiny() + 1, 120):
        for p in {s, (s + t.largest_partner(s)) // 2, t.largest_partner(s)}:
            common = -(-percent * (s + p) // (100 + percent))
            tokens = r.integers(0, 2**63, s + p - common, dtype=np.uint64)
            parts = [tokens[:s], np.concatenate([tokens[:common], tokens[s:]])]
            segments = jaccard_join.Segments(jaccard_join.Sets(np.concatenate(parts), np.array([0, s, s + p])), t)
            (a, of_a), (b, of_b) = segments.subsets(0), segments.subsets(1)
            scheme = segments.schemes(p)[0]
            here = [k for k in set(a.tolist()) & set(b.tolist()) if k & 1 == scheme & 1]
            assert len(here) >= max(of_a[scheme & 1], of_b[scheme & 1]) >= 1


def test_op3_equals_all_pairs(spark):
    docs = pairs(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r.doc_id: r.component_id for r in QUERIES["op3_jaccard_join"](spark, SF).collect()} == brute.jaccard(docs, 4, 85)


def test_jaccard_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    out = jaccard_join.jaccard_components(docs).collect()
    assert len(out) == docs.count()
    assert {r.doc_id: r.component_id for r in out if r.doc_id} == brute.jaccard(pairs(docs), 5, 80)
    assert [r.component_id for r in out if r.doc_id is None] == [None, None]
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_pigeonhole_bounds():
    for percent in (60, 80, 85, 95):
        t = jaccard_join.Threshold(percent)
        for s in range(1, 200):
            for p in range(s, t.largest_partner(s) + 1):
                shared = -(-percent * (s + p) // (100 + percent))
                assert s + p - 2 * shared <= min(t.most_differing(s), t.most_differing(p))
        for (low, m), (nxt, _) in zip(t.bands(5000), t.bands(5000)[1:]):
            assert m > t.most_differing(nxt - 1) and t.largest_partner(low - 1) < nxt


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(29, 3), (50, 50)]
    stage = Stage(spark, "test")
    out = components(spark.createDataFrame(links, "a long, b long"), stage, "c").collect()
    assert {r.node: r.component for r in out} == {i: 100 for i in range(100, 141)} | {i: 3 for i in [3, *range(7, 30)]}
    assert components(spark.createDataFrame([], "a long, b long"), stage, "e").count() == 0


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(2, 9))) for _ in range(n))


def test_repeated_passages_wherever_they_stand(spark):
    r = random.Random(5)
    passage = prose(r, 70)
    texts = {1: prose(r, 200), 2: prose(r, 37) + " é " + passage + " " + prose(r, 80), 3: passage, 4: prose(r, 11) + "\n" + passage, 5: prose(r, 300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = chunk_dedup.repeated_passages(docs).collect()
    assert {x.doc_id for x in out} == {2, 3, 4}
    assert {x.doc_id for x in out if x.kept} == {2}
    for x in out:
        assert texts[x.doc_id][x.start : x.end] in passage and x.end - x.start > 0.5 * len(passage)
    less = docs.select("doc_id", chunk_dedup.without(F.col("text"), F.array(F.struct(F.lit(2).cast("long").alias("start"), F.lit(5).cast("long").alias("end")))).alias("t"))
    assert {x.doc_id: x.t for x in less.collect()} == {i: t[:2] + t[5:] for i, t in texts.items()}


def test_passages_with_different_first_holders(spark):
    r = random.Random(8)
    one, two = prose(r, 90), prose(r, 90)
    both = one + "\n" + two
    # text 1 has short parts of both passages, though no passage
    bits = " ".join(both[i : i + 40] for i in range(0, len(both), 60))
    texts = {1: bits, 2: prose(r, 50) + "\n" + one, 3: two + "\n" + prose(r, 50), 4: both, 5: both}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = chunk_dedup.repeated_passages(docs).collect()
    assert {x.doc_id for x in out} == {2, 3, 4, 5}
    for i, t in texts.items():
        places = {k: x.first_doc_id for x in out if x.doc_id == i for k in range(x.start, x.end)}
        assert all(x.kept == (x.first_doc_id == i) for x in out if x.doc_id == i)
        for part, first in ((one, 2), (two, 3)):
            at = t.find(part)
            if i > 1 and at >= 0:
                own = [places.get(k) for k in range(at, at + len(part))]
                assert own.count(first) > 0.6 * len(part) and own[len(own) // 2] == first


def test_op4_keeps_one_copy(spark):
    texts = dict(pairs(spark.read.parquet(f"{SF}/documents.parquet")))
    first = {}
    for x in QUERIES["op4_chunk_dedup"](spark, SF).collect():
        first.setdefault(x.doc_id, {}).update(dict.fromkeys(range(x.start, x.end), x.first_doc_id))
    groups = {}
    for i, t in texts.items():
        groups.setdefault(t, []).append(i)
    groups = {t: ids for t, ids in groups.items() if len(t or "") >= 300 and len(ids) > 1}
    assert groups
    for t, ids in groups.items():
        for k in range(len(t)):
            holders = {first[i].get(k) for i in ids}
            assert len(holders) == 1
        own = list(first[ids[0]].values())
        assert own and max(own) <= min(ids) and (set(own) != {min(ids)} or len(own) == len(t))
        for i in set(own) - {min(ids)}:  # an earlier text has a passage of this one
            own = sorted(k for k, h in first[ids[0]].items() if h == i)
            assert t[own[0] : own[0] + 50] in texts[i]


def test_chunks_cover_texts(spark):
    docs = brute.awkward(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    found = {}
    for c in chunk_dedup.chunks(docs).collect():
        found.setdefault((c.doc_id, c.row), []).append((c.start, c.length))
    texts = {(r.doc_id, r.row): r.text for r in docs.select("doc_id", F.xxhash64("text").alias("row"), "text").collect()}
    for key, text in texts.items():
        at = 0
        for start, length in sorted(found.get(key, [])):
            assert start == at and 0 < length <= chunk_dedup.LONGEST_CHUNK
            at += length
        assert at == len(text or "")
    out = chunk_dedup.repeated_passages(docs, least_chars=40).collect()
    assert {6, 7, 11, 12} <= {x.doc_id for x in out} <= {6, 7, 8, 11, 12}
    assert {(x.start, x.end, x.first_doc_id) for x in out if x.doc_id in (11, 12)} == {(0, 3, 11)}
    assert chunk_dedup.repeated_passages(docs.limit(0)).count() == 0


def plain_passages(chunks, least_chars):
    """{(doc_id, row): {place: first holder}} by all runs of at least so many characters, none of which is longer than need be."""
    texts, holders, runs = {}, {}, []
    for c in sorted(chunks, key=lambda c: (c.doc_id, c.row, c.start)):
        texts.setdefault((c.doc_id, c.row), []).append(c)
    for key, cs in texts.items():
        chars = lambda a, b: sum(c.length for c in cs[a:b])
        n = len(cs)
        spans = [(0, n)] if chars(0, n) < least_chars else [
            (a, b) for a in range(n) for b in range(a + 1, n + 1)
            if chars(a, b) >= least_chars > min(chars(a + 1, b), chars(a, b - 1))
        ]
        for a, b in spans:
            content = tuple((c.h1, c.h2) for c in cs[a:b])
            holders.setdefault(content, set()).add(key[0])
            runs.append((key, cs[a].start, cs[b - 1].start + cs[b - 1].length, content))
    out = {key: {} for key in texts}
    for key, start, end, content in runs:
        if len(holders[content]) > 1:
            for at in range(start, end):
                out[key][at] = min(out[key].get(at, 1 << 60), min(holders[content]))
    return out


@pytest.mark.parametrize("heavy", [False, True])
def test_passages_equal_a_plain_version(spark, monkeypatch, heavy):
    if heavy:  # digests of most documents go by salts
        monkeypatch.setattr(chunk_dedup, "SAMPLED", 1.0)
        monkeypatch.setattr(chunk_dedup, "LEAST_HEAVY", 2)
    r = random.Random(21)
    passages = [prose(r, n) for n in (40, 60, 25)]
    texts = [prose(r, r.randrange(1, 60)) + "\n" + r.choice([*passages, ""]) + " " + prose(r, r.randrange(30)) for _ in range(30)]
    texts += ["short", "short", "ünïque short", texts[0], texts[1] + "!", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert bool(chunk_dedup.heavy_digests(docs, 150, chunk_dedup.CUT_BITS)) == heavy
    wanted = {i: places for (i, _), places in plain_passages(chunk_dedup.chunks(docs).collect(), 150).items()}
    found = {i: {} for i in wanted}
    for x in chunk_dedup.repeated_passages(docs).collect():
        assert x.kept == (x.doc_id == x.first_doc_id)
        for at in range(x.start, x.end):
            assert at not in found[x.doc_id]
            found[x.doc_id][at] = x.first_doc_id
    for i, places in wanted.items():
        assert found[i].items() <= places.items()
        # an open end beside an earlier holder is all that is left out
        left = sorted(set(places) - set(found[i]))
        assert all(at - left[0] < 200 or left[-1] - at < 200 for at in left)
    assert sum(map(len, found.values())) > 0.98 * sum(map(len, wanted.values()))


def test_recall_of_repeated_passages(spark):
    """Documents that share 50 words in a row with another are found."""
    sf = SF.replace("0.001", "0.01")
    texts = dict(pairs(spark.read.parquet(f"{sf}/documents.parquet")))
    holders = {}
    for i, t in texts.items():
        w = brute.words(t)
        for a in range(len(w) - 49):
            holders.setdefault(hash(tuple(w[a : a + 50])), set()).add(i)
    wanted = set().union(*(h for h in holders.values() if len(h) > 1))
    found = {x.doc_id for x in QUERIES["op4_chunk_dedup"](spark, sf).select("doc_id").distinct().collect()}
    assert len(wanted) > 50 and len(wanted & found) / len(wanted) >= 0.95


def test_op4_reports_only_repeated_text(spark):
    texts = dict(pairs(spark.read.parquet(f"{SF}/documents.parquet")))
    for x in QUERIES["op4_chunk_dedup"](spark, SF).collect():
        part = texts[x.doc_id][x.start + 20 : x.start + 60]
        assert sum(part in t for t in texts.values()) > 1


ITEM = "A train covers 120 km in 3 hours while Alice walks to the station near Berlin and carries 5 kg of apples"
BENCH = [(1, ITEM), (2, "what is the sum of two and two"), (3, None), (4, ""), (None, ITEM), (5, "tiny item here")]


def leaks(spark, texts, bench=BENCH):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, items).collect()}


def test_templates_find_changed_questions(spark):
    r = random.Random(3)
    changed = ITEM.replace("120", "95").replace("Alice", "Marta").replace("5 kg", "7 lb")
    twice = "He said that 4 cats and 4 dogs and 4 birds live with Anna or Anna in one house of 4 rooms"
    bad = twice.replace("4 cats", "9 cats")
    good = twice.replace("4", "9").replace("Anna", "Petra")
    texts = [prose(r, 60), f"{prose(r, 30)}. {ITEM} {prose(r, 20)}", ITEM.upper(), f"so {changed}, {prose(r, 9)}", "x tiny item here y", None, "", bad, good]
    found = leaks(spark, texts, [*BENCH, (6, twice)])
    assert set(found) == {(1, 1), (3, 1), (4, 5), (8, 6)}  # upper case has no names to exchange
    assert found[1, 1].n_changed == 0 and found[3, 1].n_changed >= 4


def test_repeated_rows_keep_their_own_slots(spark):
    item = "there are 12 boxes and 7 crates and 31 barrels on the way from Rome to Oslo and then to Cairo today"
    other = item.replace("12", "4").replace("31", "8").replace("Oslo", "Lima")
    docs = [(1, f"so {item} x"), (1, f"so {item} x"), (2, f"so {item} x"), (2, f"so {other} x"), (3, f"so {other} y"), (4, "none of it")]
    bench = [(1, item), (1, item), (2, ITEM), (2, item)]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    ).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(d, i) for d in (1, 2, 3) for i in (1, 2)]
    assert {(r.doc_id, r.n_slots, r.n_changed) for r in found} == {(1, 6, 0), (2, 12, 3), (3, 6, 3)}


def test_names_that_start_sentences_are_slots(spark):
    item = "Tom has 5 apples. Anna has 7 pears. Bert wants\nMr. Jones to buy  Clara some figs. Doris then eats 3 of them. How many are left?"
    names = {"Tom": "Ivo", "Anna": "Maria", "Bert": "Kurt", "Jones": "Miller", "Clara": "Lena", "Doris": "Ruth"}
    changed = item
    for a, b in names.items():
        changed = changed.replace(a, b)
    bench = [(1, item), (2, "Small items count too")]
    texts = [f"and so {changed} yes", "we saw Small items count too", "we saw small items count too", item, f"x {item.lower()} y", prose(random.Random(4), 50) + ". Eve said."]
    found = leaks(spark, texts, bench)
    assert set(found) == {(0, 1), (1, 2), (2, 2), (3, 1), (4, 1)}
    assert found[0, 1].n_changed >= 6 and found[3, 1].n_changed == 0


def test_op7_finds_planted_passages(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: r.text for r in bench.collect()}
    expected = {(i, k) for k, q in items.items() for i, t in pairs(docs) if q.lower() in t.lower()}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op7_decontamination"](spark, SF).collect()} == expected and expected


def test_decontamination_of_awkward_rows(spark):
    items = spark.createDataFrame([(1, "a line that is common to several texts"), (1, None)], "item_id long, text string")
    docs = brute.awkward(spark)
    for small in (500_000, 0):  # broadcast, and joined by shuffle
        s = decontamination.Settings(broadcast_rows=small)
        assert {r.doc_id for r in decontamination.contaminated(docs, items, s).collect()} == {6, 7, 8}
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def questions(seed):
    """Documents with benchmark items copied, re-parameterised, broken, and tables of numbers; items of one id too."""
    r = random.Random(seed)
    name = lambda: r.choice(["Anna", "Tom", "Berlin", "Paris", "Ada"])
    number = lambda: str(r.choice([1, 2, 3, 12, "3.5", "1,200"]))
    word = lambda: r.choice(["walks", "to", "the", "station", "with", "apples", "and", "sees", "a", "train"])

    def question():
        return " ".join(r.choice([word, word, word, name, number, lambda: number() + " km"])() for _ in range(r.choice([3, 9, 20])))

    def other_values(t):
        swap = {v: r.choice([v, number()]) for v in ("1", "2", "3", "12", "3.5", "1,200")} | {n: name() for n in ("Anna", "Tom", "Berlin")}
        return " ".join(swap.get(w, w) if r.random() < 0.95 else word() for w in t.split(" "))

    items = [(i, question()) for i in range(8)] + [(8, " ".join(number() for _ in range(12))), (9, "row 1 col 2 " * 5), (0, question()), (10, None)]
    docs = []
    for i in range(30):
        _, base = r.choice(items[:10])
        parts = [question() + ".", r.choice([base, other_values(base), other_values(base)]), question()]
        docs.append((i, "\n".join(r.sample(parts, 3))))
    docs += [(40, " ".join(number() for _ in range(60))), (41, "row 1 col 2 " * 20), (42, "row 1 col 2 " * 9 + "row 2 col 1 " * 9), (0, items[3][1]), (43, "1 1 1 " * 20)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contaminated_equals_all_places(spark, seed):
    docs, items = questions(seed)
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    wanted = brute.contaminated(docs, items)
    assert set(map(tuple, found.collect())) == wanted and len(wanted) > 20


def test_tables_of_numbers_are_not_paired_place_by_place(spark):
    docs = spark.createDataFrame([(1, " ".join(str(i) for i in range(4000)))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(str(i + 7) for i in range(400)))], "item_id long, text string")
    stage = Stage(spark, "test")
    run = decontamination.Decontamination(docs, items, decontamination.Settings(), stage)
    [row] = run.leaks().collect()
    assert (row.n_windows, row.n_matched) == (393, 393)
    # one row for each way in which they line up, in both forms at once where these do not differ
    assert spark.read.parquet(f"{stage.root}/judged").count() <= 2 * (4000 + 400)


def test_license_texts_and_notices(spark):
    mit = license_scan.TEXTS["MIT"]
    other = mit.replace("<year> <copyright holders>", "2019 Some One").replace("MIT License", "The MIT Licence", 1)
    texts = [mit, mit.upper().replace("\n\n", "\n"), mit + " and more", other.replace("The MIT", "MIT"), "x\nreleased under the MIT licence!\ny", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {(r.doc_id, r.scope, r.line, r.license_id) for r in license_scan.license_scan(docs).collect()}
    assert out == {(0, "text", None, "MIT"), (1, "text", None, "MIT"), (3, "text", None, "MIT"), (4, "line", 1, "MIT")}
    assert license_scan.license_scan(brute.awkward(spark)).count() == 0
    assert license_scan.license_scan(docs.limit(0)).count() == 0


def test_license_texts_wrapped_anywhere(spark):
    rows = []
    for name, text in license_scan.TEXTS.items():
        for width in (45, 50, 60, 66, 72, 76, 80, 100, 1000):
            paragraphs = [textwrap.fill(x, width, break_long_words=False, break_on_hyphens=False) for x in text.split("\n\n")]
            rows.append((len(rows), name, "\n\n".join(paragraphs)))
    at = lambda word: license_scan.TEXTS["ISC"].replace(f" {word}", f"\n{word}", 1)
    rows += [(len(rows), "ISC", at("copyright notice")), (len(rows) + 1, "MIT", license_scan.TEXTS["MIT"].replace("OR COPYRIGHT", "OR\nCOPYRIGHT"))]
    rows += [(len(rows), "MIT", license_scan.TEXTS["MIT"].replace("(c) <year> <copyright holders>", "Some One"))]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    found = {(r.doc_id, r.license_id) for r in license_scan.license_scan(docs).collect() if r.scope == "text"}
    assert found == {(i, name) for i, name, _ in rows}


def test_notices_of_any_length(spark):
    long = "Use of this file is granted " + "to all and sundry " * 40
    docs = spark.createDataFrame([(1, f"x\n{long}"), (2, "By me"), (3, "-" * 900 + " Released under the MIT License. ")], "doc_id long, text string")
    notices = {"own": [long, "by me"], **license_scan.NOTICES}
    found = {(r.doc_id, r.line, r.license_id) for r in license_scan.license_scan(docs, notices=notices).collect()}
    assert found == {(1, 1, "own"), (2, 0, "own"), (3, 0, "MIT")}


def test_license_twin_on_wrapped_texts(spark):
    """The SQL twin takes the same lines for copyright statements."""
    texts = [w for t in license_scan.TEXTS.values() for w in (t, textwrap.fill(t, 37), textwrap.fill(t, 61), "(c) 2020 X\n" + t)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(texts)])
    mine = license_scan.license_scan(docs).select("doc_id", "scope", "line", "license_id", "digest").collect()
    assert null_last(map(tuple, mine)) == null_last(con.execute(ORACLE["op10_license_scan"]).fetchall())
    assert {r.license_id for r in mine if r.scope == "text"} == set(license_scan.TEXTS)


def test_empty_lists_of_known_licenses_match_nothing(spark):
    docs = spark.createDataFrame([(1, license_scan.TEXTS["MIT"]), (2, "Released under the MIT licence!")], "doc_id long, text string")
    assert license_scan.license_scan(docs, texts={}, notices={}).count() == 0
    assert {r.scope for r in license_scan.license_scan(docs, texts={}).collect()} == {"line"}


def test_windows_are_made_by_compiled_code(spark):
    text = "Alice paid Bob 30 dollars. She saw Carol in Paris, for 5 km \x02 and \x04home. Then Dan left"
    docs = spark.createDataFrame([(1, text), (2, "one two"), (3, ""), (4, None)], "doc_id long, text string")
    rows = decontamination._windowed(docs, ["doc_id"], [3, 2])
    marked = {r.doc_id: r.m for r in docs.select("doc_id", decontamination.marked(F.col("text")).alias("m")).collect()}
    want = []
    for i, tokens in marked.items():
        forms = {decontamination.STRICT: [t.lstrip("\x04") for t in tokens], decontamination.LOOSE: ["\x02" if t.startswith("\x04") else t for t in tokens]}
        for n in (3, 2):
            for at in range(len(tokens) - n + 1):
                strict, loose = (tuple(forms[f][at : at + n]) for f in (decontamination.STRICT, decontamination.LOOSE))
                want += [(i, at, n, strict, 3)] if strict == loose else [(i, at, n, strict, 1), (i, at, n, loose, 2)]
    got = rows.collect()
    assert sorted((r.doc_id, r.pos, r["size"], r.forms) for r in got) == sorted((i, at, n, f) for i, at, n, _, f in want)
    hash_of = {(r.doc_id, r.pos, r["size"], r.forms): r.hash for r in got}
    values = {w: hash_of[i, at, n, f] for i, at, n, w, f in want}
    assert all(hash_of[i, at, n, f] == values[w] for i, at, n, w, f in want) and len(set(values.values())) == len(values)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction") <= 4  # tokens are hashed by lambdas, windows are not
