"""Sound, meaning, tone, score arithmetic and the whole scoring job."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from filing_signals.functions import phonetic, scores, vectors
from filing_signals.functions.phonetic import encode_text, encode_token
from filing_signals.plans import scoring as C

EXAMPLES = {
    "metaphone": "MTFN", "school": "SKL", "which": "WX", "physics": "FSKS", "bridge": "BRJ",
    "action": "AKXN", "comb": "KM", "xylophone": "SLFN", "science": "SNS", "thumb": "0M",
    "judge": "JJ", "vision": "FXN", "knight": "NT", "bigger": "BKR", "sign": "SN", "signed": "SNT",
    "catch": "KX", "wright": "RT", "pneumonia": "NMN", "whale": "WL", "aeon": "EN", "ghost": "KST",
    "": "", "12.5": "", "ahead": "AHT",
}


@pytest.mark.parametrize("word", EXAMPLES)
def test_metaphone(word):
    assert encode_token(word) == EXAMPLES[word]


def test_code_of_text_keeps_empty_codes_inside():
    assert encode_text("  The 12 Rates 7 ") == "0  RTS"
    assert encode_text("12 34") == ""


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b):
            new.append(row[j] + 1 if c == d else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_indel_ratio_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcd ", k=rng.randrange(0, 90)))
    pairs = [("abcd", "abxd"), ("", ""), ("a", ""), ("same", "same")] + [(word(), word()) for _ in range(400)]
    df = spark.createDataFrame(pairs + [(None, "a")], "a string, b string")
    for r in df.select("a", "b", phonetic.indel_ratio("a", "b").alias("r"), phonetic.indel_ratio("b", "a").alias("s")).collect():
        if r["a"] is None:
            assert r["r"] is None
            continue
        total = len(r["a"]) + len(r["b"])
        assert r["r"] == r["s"] == (2.0 * lcs(r["a"], r["b"]) / total if total else 1.0)


def test_phonetic_similarity_guards(spark):
    df = spark.createDataFrame([("0 RTS", ""), ("", "RTS"), (None, None), ("RTS", "RTS")], "a string, b string")
    got = df.select(phonetic.phonetic_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r["s"] for r in got] == [0.0, 0.0, 0.0, 1.0]


def test_vocabulary(spark):
    df = spark.createDataFrame([("The school the",), (None,)], "text string")
    assert sorted(map(tuple, phonetic.vocabulary(df).collect())) == [("school", "SKL"), ("the", "0")]


def test_dense_similarities_agree_and_guard(spark):
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.5]), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, None)]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    themes = [[1.0, 1.0], [0.0, 0.0]]
    got = df.select("id", vectors.semantic_similarities(F.col("v"), themes).alias("all"), *[
        vectors.semantic_similarity(F.col("v"), F.array(*[F.lit(x) for x in t])).alias(f"t{i}")
        for i, t in enumerate(themes)
    ]).orderBy("id").collect()
    for r in got:
        assert r["all"] == pytest.approx([r["t0"], r["t1"]])
    assert got[0]["all"] == pytest.approx([math.sqrt(0.5), 0.0])
    assert got[1]["all"][0] == 0.0 and got[2]["all"] == [0.0, 0.0] and got[3]["all"][0] == 0.0
    assert got[4]["all"] == [0.0, 0.0]
    empty = df.select(vectors.semantic_similarities(F.col("v"), [None, [1.0, 1.0]]).alias("all")).collect()
    assert all(r["all"][0] == 0.0 for r in empty)


def test_vectors_of_mixed_widths_raise(spark):
    df = spark.createDataFrame([([1.0],), ([0.0, 1.0, 0.0],)], "v array<float>")
    both = (
        vectors.semantic_similarities(F.col("v"), [[1.0, 1.0]]),
        vectors.semantic_similarity(F.col("v"), F.array(F.lit(1.0), F.lit(1.0))),
    )
    for similarity in both:
        with pytest.raises(Exception, match="different widths"):
            df.select(similarity).collect()


def test_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r[0] for r in df.select(vectors.l2_normalise(F.col("v"))).collect()]
    assert got == [[0.6, 0.8], [0.0, 0.0]]


def test_term_similarity_equals_brute_force(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices("a b c d e f".split(), k=rng.randrange(0, 9))) for _ in range(200)]
    df = spark.createDataFrame([(t, "a a b z") for t in texts], "x string, y string")
    x, y = vectors.lower_tokens(F.col("x")), vectors.lower_tokens(F.col("y"))
    sim = vectors.term_similarity(x, vectors.term_norm(x), vectors.term_counts(y), vectors.term_norm(y))
    for r in df.select("x", sim.alias("s")).collect():
        w = r["x"].split()
        dot = 2 * w.count("a") + w.count("b")
        norm = math.sqrt(sum(w.count(t) ** 2 for t in set(w))) * math.sqrt(6)
        assert r["s"] == pytest.approx(dot / norm if norm else 0.0)


def test_tone_and_score_arithmetic(spark):
    df = spark.createDataFrame(
        [("positive", 0.95), ("NEGATIVE", 0.88), ("LABEL_1", 0.7), ("Pos", 1.0), (None, 0.4)], "l string, c double"
    )
    signed = scores.signed_confidence(F.col("l"), F.col("c"))
    got = df.select(signed.alias("s"), scores.stored_polarity(signed).alias("p")).collect()
    assert [r["s"] for r in got] == [0.95, -0.88, 0.0, 1.0, 0.0]
    assert [r["p"] for r in got] == [0.0, 0.0, 0.0, 1.0, 0.0]

    day = dt.date(2024, 1, 2)
    dates = spark.createDataFrame([(day,), (dt.date(2024, 1, 1),), (None,)], "d date")
    raw = scores.raw_base(F.lit(0.5), F.lit(0.25), F.lit(-0.88))
    w = scores.time_weight(F.col("d"), F.lit(day))
    got = dates.select(raw.alias("r"), scores.final_score(raw, w).alias("f")).collect()
    assert [r["r"] for r in got] == pytest.approx([-0.45] * 3)
    assert [r["f"] for r in got] == pytest.approx([-45.0, -27.0, -27.0])
    clipped = dates.select(scores.final_score(F.lit(3.0), F.lit(1.0)), scores.final_score(F.lit(-3.0), F.lit(1.0)))
    assert tuple(clipped.first()) == (100.0, -100.0)
    no_newest = dates.select(scores.time_weight(F.col("d"), F.lit(None).cast("date")).alias("w")).collect()
    assert [r["w"] for r in no_newest] == [0.6] * 3


def test_theme_texts(spark):
    df = spark.createDataFrame([("AI", " deep learning; robots,|x "), ("Oil", None)], "t string, k string")
    got = df.select(scores.keyword_text(F.col("k")), scores.theme_text(F.col("t"), F.col("k"))).collect()
    assert [tuple(r) for r in got] == [("deep learning robots x", "AI deep learning robots x"), ("", "Oil")]


def test_model_hooks(spark):
    df = spark.createDataFrame([(f"text {i}",) for i in range(300)], "text string").repartition(2)

    def classifier():
        def run(batch):
            assert len(batch) <= 128
            return [("POSITIVE" if t.endswith("7") else "NEGATIVE", 0.75) for t in batch]

        return run

    def encoder():
        return lambda batch: [[float(len(t)), 1.0] for t in batch]

    got = df.select(
        "text", scores.classify(F.col("text"), classifier).alias("tone"), vectors.encode(F.col("text"), encoder).alias("v")
    ).collect()
    assert len(got) == 300
    for r in got:
        assert r["tone"]["label"] == ("POSITIVE" if r["text"].endswith("7") else "NEGATIVE")
        assert list(r["v"]) == [len(r["text"]), 1.0]


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(9)
    words = "rates rise fall supply chain artificial intelligence neural energy".split()
    docs = spark.createDataFrame(
        [(f"d{i}", f"c{i % 3}", dt.date(2024, 1, 1 + i % 4) if i else None) for i in range(12)] + [("empty", "c0", dt.date(2024, 2, 1))],
        "doc_id string, company_id string, date date",
    )
    sents = spark.createDataFrame(
        [
            (f"d{rng.choice([0, 0, 0, *range(12)])}", i, " ".join(rng.choices(words, k=rng.randrange(1, 9))),
             rng.choice(["POSITIVE", "NEGATIVE", "NEUTRAL"]), rng.choice([0.5, 1.0]))
            for i in range(400)
        ],
        "doc_id string, sentence_id int, text string, label string, confidence double",
    )
    themes = spark.createDataFrame(
        [("AI", "artificial intelligence", "neural; learning"), ("SUP", "supply", "chain"), ("NO", "energy", None)],
        "theme_id string, theme string, keywords string",
    )
    return sents, docs, themes


def test_score_equals_brute_force_both_ways(spark, inputs):
    sents, docs, themes = inputs
    by_doc = {r["doc_id"]: r for r in docs.collect()}
    newest = max(r["date"] for r in by_doc.values() if r["date"])
    want = {}
    for s in sents.collect():
        d = by_doc[s["doc_id"]]
        for t in themes.collect():
            kw = " ".join(k.strip() for k in (t["keywords"] or "").split(";")).strip()
            a, b = s["text"].split(), f"{t['theme']} {kw}".split()
            dot = sum(a.count(x) * b.count(x) for x in set(a))
            sem = dot / (math.sqrt(sum(a.count(x) ** 2 for x in set(a))) * math.sqrt(sum(b.count(x) ** 2 for x in set(b))))
            ca, cb = encode_text(s["text"]), encode_text(kw)
            pho = 2 * lcs(ca, cb) / (len(ca) + len(cb)) if ca and cb else 0.0
            sign = -1 if s["label"] == "NEGATIVE" else 1
            raw = (0.8 * sem + 0.2 * pho) * sign
            weight = 1.0 if d["date"] == newest else 0.6
            pol = {"POSITIVE": 1, "NEGATIVE": -1, "NEUTRAL": 0}[s["label"]] * int(s["confidence"])
            want[(s["doc_id"], s["sentence_id"], t["theme_id"])] = (
                d["company_id"], sem, pho, pol, raw, weight, max(-100.0, min(100.0, 100 * raw * weight))
            )
    for limit in (8 << 20, 0):
        rows = C.score(sents, docs, themes, small_bytes=limit).collect()
        assert len(rows) == len(want) == 1200
        for r in rows:
            company, *numbers = want[(r["doc_id"], r["sentence_id"], r["theme_id"])]
            assert r["company_id"] == company and r["theme_score"] == r["raw_base"]
            got = [r[c] for c in ("semantic_sim", "phonetic_sim", "polarity", "raw_base", "time_weight", "final_score_100")]
            assert got == pytest.approx(numbers)
            assert -100 <= r["final_score_100"] <= 100


def test_dense_vectors_both_ways(spark, inputs):
    sents, docs, themes = inputs
    s = sents.withColumn("vector", F.array(F.length("text").cast("float"), F.col("sentence_id").cast("float")))
    t = themes.withColumn("vector", F.array(F.lit(1.0), F.length("theme").cast("double")))
    got = [
        sorted((r["doc_id"], r["sentence_id"], r["theme_id"], round(r["semantic_sim"], 9), round(r["phonetic_sim"], 9))
               for r in C.score(s, docs, t, small_bytes=limit).collect())
        for limit in (8 << 20, 0)
    ]
    assert got[0] == got[1] and len(got[0]) == 1200


def test_scoring_plan(spark, inputs):
    sents, docs, themes = inputs
    text = C.score(sents, docs, themes)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("ArrowEvalPython") == 1


def test_roll_up(spark):
    df = spark.createDataFrame(
        [("c", "t", 0.2, 20.0), ("c", "t", -0.4, -24.0)],
        "company_id string, theme_id string, theme_score double, final_score_100 double",
    )
    r = C.roll_up(df).first()
    assert (r["avg_score"], r["n_sentences"], r["avg_final_100"]) == (pytest.approx(-0.1), 2, pytest.approx(-2.0))


def test_newest_date_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id string, date date")
    assert C.newest_date(none).first()["newest"] is None


def test_dry_run_writes_nothing_and_store_is_idempotent(spark, inputs, tmp_path):
    sents, docs, themes = inputs
    scored = C.score(sents, docs, themes)
    C.store(spark, str(tmp_path / "dry"), scored, dry_run=True)[1].collect()
    assert not (tmp_path / "dry").exists()

    def snapshot():
        stored, companies = C.store(spark, str(tmp_path / "t"), scored)
        return (
            sorted(map(tuple, stored.drop("scored_at").collect())),
            sorted((r["company_id"], r["theme_id"], round(r["avg_score"], 9), r["n_sentences"]) for r in companies.collect()),
        )

    assert snapshot() == snapshot()


def test_indels_of_many_texts_equal_one_by_one():
    import random

    from filing_signals.functions.phonetic import char_masks, indel, indels

    r = random.Random(6)
    word = lambda n: "".join(r.choice("ABKLMNRSTéX 0") for _ in range(n))
    texts = [word(r.randrange(0, 90)) for _ in range(200)] + ["", "ABK"]
    for other in ("", "A", word(12), word(60), word(61), word(150)):
        wanted = [indel(char_masks(t), len(t), other) for t in texts]
        assert indels(texts, other).tolist() == wanted
    assert indels([], "A").tolist() == []


def test_rounded_equals_round(spark):
    draw = random.Random(5)
    values = [0.0, -0.0, 0.5, 1e-7, -1e-7, 5e-7, -5e-7, 1.0000005, 0.1234565, -0.1234565, 2.5e-6, 1e12, -1e300, None]
    values += [float("nan"), float("inf"), float("-inf"), 123456.7890125, 0.30000000000000004, 1e6, 999999.9999995]
    values += [draw.uniform(-100, 100) for _ in range(20_000)] + [(2 * draw.randrange(10**7) + 1) / 2e6 for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    c = F.col("x")
    both = df.select(c, scores.rounded(c).alias("a"), F.round(c, 6).alias("b")).collect()
    assert [r for r in both if repr(r.a) != repr(r.b)] == []


def test_batch_similarities_equal_row_by_row(spark):
    texts = ["The rates, the end", " a\u00a0b\x1cA  a ", "", None, "   ", "\u0130stanbul \u212aelvin kn\u00efght", "12 34", "the", "x " * 200]
    themes = ["the the end", "a b", "", "kelvin istanbul", "night rates " * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, x string").coalesce(1)
    kw = spark.createDataFrame([(j, t) for j, t in enumerate(themes)], "j long, y string").coalesce(1)
    y = vectors.lower_tokens(F.col("y"))
    feats = kw.select("j", vectors.term_counts(y).alias("terms"), vectors.term_norm(y).alias("norm"), phonetic.phonetic_code("y").alias("kw_code"))
    small = sorted(feats.collect(), key=lambda r: r["j"])
    lower, x = F.lower("x"), vectors.lower_tokens(F.col("x"))
    arrays = df.select("i", vectors.term_similarities(lower, small).alias("sem"), phonetic.phonetic_similarities(lower, [r["kw_code"] for r in small]).alias("phon"))
    pairs = df.withColumn("code", phonetic.phonetic_code("x")).crossJoin(feats)
    one = pairs.select(
        "i", "j", "code", "x",
        vectors.term_similarity(x, vectors.term_norm(x), F.col("terms"), F.col("norm")).alias("sem"),
        vectors.term_similarity_of_text(lower, F.col("terms"), F.col("norm")).alias("sem_of_text"),
        phonetic.phonetic_similarity(F.col("code"), F.col("kw_code")).alias("phon"),
        "kw_code",
    ).collect()
    got = {r["i"]: r for r in arrays.collect()}
    assert len(one) == len(texts) * len(themes)
    for r in one:
        assert r["sem"] == r["sem_of_text"] == got[r["i"]]["sem"][r["j"]]
        assert r["phon"] == got[r["i"]]["phon"][r["j"]]
        assert r["code"] == (None if r["x"] is None else encode_text(r["x"]))
        a, b = r["code"] or "", r["kw_code"]
        want = phonetic.indel(phonetic.char_masks(a), len(a), b) if a and b else 0.0
        assert r["phon"] == want


def test_scoring_keeps_no_tokens_in_its_plan(spark, capsys):
    """Tokens of sentences are counted in Arrow batches: pairs carry numbers, and no lambda runs per term."""
    s = spark.createDataFrame([("a", 0, "the end of it")], "doc_id string, sentence_id int, text string")
    t = spark.createDataFrame([("T", "the", "end")], "theme_id string, theme string, keywords string")
    C.pair_similarities(s, t).explain()
    plan = capsys.readouterr().out
    assert "array_remove" not in plan and "split(" not in plan


def test_tokens_coded_together_equal_one_by_one():
    import random

    from filing_signals.functions.phonetic import encode_tokens

    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz" * 2 + "aeioucghstw'-,9\u00e9"
    words = ["gh", "h", "", "mb", "sigh", "ahem", *["".join(r.choice(letters) for _ in range(r.randrange(1, 9))) for _ in range(5000)]]
    assert encode_tokens(words) == [encode_token(w) for w in words]
    assert encode_tokens([]) == [] and encode_tokens([""]) == [""]


def test_one_very_long_text_is_read_alone(monkeypatch):
    import random

    from filing_signals.functions import phonetic

    r = random.Random(5)
    texts = ["".join(r.choice("KXT 0RN\u00e9") for _ in range(n)) for n in [*[r.randrange(40) for _ in range(60)], 5000, 700]]
    read, real = [], phonetic._read_on
    monkeypatch.setattr(phonetic, "_read_on", lambda row, hits, full: read.append(len(hits)) or real(row, hits, full))
    others = ["K PR", "UNT NXT", "X" * 9 + "T" * 8, "NK" * 32, "RT" * 33]
    for other, found in zip(others, phonetic.indels_each(texts, others)):
        assert found.tolist() == [phonetic.indel(phonetic.char_masks(t), len(t), other) for t in texts]
    assert max(read) > 4900


def test_sentences_meet_their_tones_as_documents(spark, tmp_path, monkeypatch):
    from contract import fixtures
    from filing_signals.operators import pairing

    text = "The first sentence of this text. And a second one, as long; short. "
    spark.createDataFrame([(i, text * i) for i in range(6)] + [(2, text), (None, text), (9, None)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    wanted = fixtures.toned_sentences(spark, str(tmp_path)).collect()
    assert len(wanted) == 2 * (1 + 2 * (2 + 1) + 3 + 4 + 5) and {r.label for r in wanted if r.doc_id == "2"} == {"NEGATIVE"}
    monkeypatch.setattr(pairing, "is_small", lambda *_: False)
    merged = fixtures.toned_sentences(spark, str(tmp_path))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("SortMergeJoin") < plan.index("Exchange")
    assert sorted(merged.collect(), key=str) == sorted(wanted, key=str)


def test_texts_that_meet_their_tones_by_a_merge_are_shuffled_once(spark, tmp_path, monkeypatch):
    from contract import fixtures
    from filing_signals.operators import pairing

    docs = [(i, "One sentence that is long enough. Another sentence that is long enough.") for i in range(20)] + [(3, "A copied key comes once more here."), (None, "No key, so no sentence is kept.")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (3, 0), (3, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    dealt = fixtures.toned_sentences(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()  # few splits: dealt to all cores
    monkeypatch.setattr(pairing, "is_small", lambda *_: False)
    merged = fixtures.toned_sentences(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" not in merged._jdf.queryExecution().executedPlan().toString()
    assert sorted(merged.collect(), key=str) == sorted(dealt.collect(), key=str)
