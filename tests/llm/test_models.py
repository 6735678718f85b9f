"""Language identification, toxicity and decontamination."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainline.llm import decontaminate, language, toxicity
from grainline.session import load

from . import brute

SMALL = "/root/testdata/sf0.01"


def test_probabilities_sum_to_one():
    model = language.KneserNey({"abba": 3, "ab": 1, "cab": 2, "bca": 1}, 3)
    letters = sorted(model.grams[0])
    for context in ("", "a", " ", "ab", "zz", "ca"):
        total = sum(model.probability(context + c) for c in letters)
        rest = np.prod([model.weight(context[k:]) for k in range(len(context) + 1)]) * (1 - len(letters) * model.floor)
        assert total + rest == pytest.approx(1.0)


def test_table_lookup_is_the_model():
    forms = {"x": {"abba": 3, "ab": 1}, "y": {"cab": 2, "bca": 1, "é": 4}}
    model = language.Model(forms, 3)
    singles = [language.KneserNey(forms[k], 3) for k in ("x", "y")]
    score, sizes = model.form_scores(["abc", "é", "zq", "cabba"])
    for row, form, n in zip(score, ["abc", "é", "zq", "cabba"], sizes):
        text = "  " + form + " "
        want = [sum(np.log(m.probability(text[k : k + 3])) for k in range(len(text) - 2)) for m in singles]
        assert n == len(form) + 1 and row == pytest.approx(want, abs=1e-4)


def test_language_held_out(spark):
    docs = load(spark, SMALL, "documents")
    model = language.fit(docs)
    held = docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)
    found = language.identify(held, model).withColumnRenamed("doc_id", "i").join(held, F.col("i") == held["doc_id"]).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.97
    assert np.mean([r["rejected"] for r in found]) < 0.1
    strange = language.identify(spark.createDataFrame([(1, "жшщ ъыь эюя " * 20)], "doc_id bigint, text string"), model).first()
    assert strange["rejected"]


def test_language_odd_rows(table, odd_rows):
    docs = table(odd_rows)
    model = language.fit(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 10))
    assert by[8]["lang_pred"] in model.languages and 0 <= by[8]["score"] <= 1
    assert language.identify(table([]), model).count() == 0
    none = language.fit(table([(1, "a b", "s", None)]))
    assert language.identify(table([(1, "a b")]), none).first()["lang_pred"] == "und"


def test_every_language_is_tuned(table):
    rows = [(k * 1000 + i, f"w{k}{i} w{k}a w{k}b", "s", f"l{k:02}") for k in range(24) for i in range(60)]
    model = language.fit(table(rows), bound=10)
    tuned = {r["lang"] for r in language.training_rows(table(rows), bound=10).where("tune").collect()}
    # more languages than the bound of one
    assert len(tuned) > 10 and {x for x, limit in zip(model.languages, model.limit) if np.isfinite(limit)} == tuned


def test_folds_are_crc32(spark):
    from grainline.llm.common import remainder

    df = spark.range(50).select("id", remainder(F.col("id"), 4).alias("r"))
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in df.collect())


def test_toxicity_held_out(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    held = found.join(labels, "doc_id").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1)
    rows = held.select("toxic", "predicted", "score").collect()
    hit = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.9
    assert hit / sum(r["toxic"] for r in rows) > 0.75
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_features():
    lexicon = {"form": {"bad": 3.0}, **{f"stem_{k}": {"badst": 2.0} for k in toxicity.STEMS}}
    rows = toxicity.features_of(pa.array(["You are bad! Idiot", "", "a b", "BAD"]), lexicon)
    named = [dict(zip(toxicity.FEATURES, r)) for r in rows]
    assert named[0]["insults"] == 1 and named[0]["forms"] == 1 and named[0]["near_you"] == 0.5
    assert not any(rows[1]) and named[3]["capitals"] == 1 and named[2]["forms"] == 0


def test_toxicity_odd_rows(spark, table, odd_rows):
    docs = table(odd_rows)
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (4, 1), (4, 0), (99, 1)], "doc_id bigint, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    left = toxicity.reject(docs, labels)
    assert left.columns == docs.columns
    assert toxicity.score(table([]), toxicity.fit(table([]), labels.limit(0))).count() == 0


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")


def cases():
    rng = random.Random(7)
    vocabulary = [f"t{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate((30, 25, 12, 3, 18))]
    rows = []
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        item = rng.choice(items)[1].split()
        if i % 3 == 0:  # in another order
            cut = len(item) // 2
            w[5:5] = item[cut:]
            w[:0] = item[:cut]
        elif i % 3 == 1:
            w[3:3] = [x.upper() for x in item[: rng.randint(1, len(item))]]
        rows.append((i, " ".join(w)))
    return rows, items


def test_tiling_against_brute_force(spark, table):
    rows, items = cases()
    pairs = decontaminate.coverage(table(rows), benchmark(spark, items))
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in pairs.collect()}
    for i, text in rows:
        for k, item in items:
            b, t = item.lower().split(), text.lower().split()
            want = brute.tiling(b, t, decontaminate.SEED) / len(b)
            assert got.get((i, k), 0.0) == pytest.approx(want)


def test_tiling_of_overlapping_passages():
    names = [f"w{k}" for k in range(36)]
    texts = [names[0:12] + ["x"] + names[8:18] + ["y"] + names[15:20]]
    rng = random.Random(11)
    for _ in range(200):
        cuts = [(a, a + rng.randint(4, 14)) for a in (rng.randint(0, 30) for _ in range(rng.randint(2, 5)))]
        texts.append([w for k, (a, b) in enumerate(cuts) for w in (*names[a:b], f"z{k}")])
    number = lambda ws: np.array([hash(w) & (2**63 - 1) for w in ws], np.uint64)
    got = [sum(n for n, _, _ in decontaminate.tile(number(names), number(t), decontaminate.SEED)) for t in texts]
    assert got == [brute.tiling(names, t, decontaminate.SEED) for t in texts] and got[0] == 18


def test_large_benchmark_by_shuffle(spark, table):
    rows, items = cases()
    rows.append((3, rows[0][1]))
    near = decontaminate.coverage(table(rows), benchmark(spark, items)).orderBy("doc_id", "text_key", "item_id").collect()
    far = decontaminate.coverage(table(rows), benchmark(spark, items), broadcast_words=0).orderBy("doc_id", "text_key", "item_id").collect()
    assert near == far


@pytest.mark.parametrize("broadcast_words", [decontaminate.BROADCAST_WORDS, 0])
def test_a_threshold_leaves_out_only_pairs_below_it(spark, table, broadcast_words):
    rows, items = cases()
    known = spark.createDataFrame([(f"item {i}", t) for i, t in items], "item_id string, text string")
    for threshold in (0.3, 0.5, 0.9):
        got = decontaminate.coverage(table(rows), known, broadcast_words=broadcast_words, threshold=threshold).where(F.col("coverage") >= threshold)
        want = decontaminate.coverage(table(rows), known).where(F.col("coverage") >= threshold)
        pairs = lambda df: sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in df.collect())
        assert pairs(got) == pairs(want) and len(pairs(got)) > 3


def test_findings_against_brute_force(spark, table):
    rows, items = cases()
    got = {r["doc_id"]: r for r in decontaminate.findings(table(rows), benchmark(spark, items)).collect()}
    for i, text in rows:
        found = [(-brute.tiling(item.lower().split(), text.lower().split(), decontaminate.SEED) / len(item.split()), k) for k, item in items]
        best = min((x for x in found if x[0]), default=(0.0, None))
        assert got[i]["coverage"] == pytest.approx(-best[0]) and got[i]["item_id"] == best[1]
        assert got[i]["n_items"] == sum(-c >= decontaminate.THRESHOLD for c, _ in found)


def test_decontaminate_odd_rows(spark, table, odd_rows):
    item = " ".join(f"w{i}" for i in range(20, 50))
    docs = table([*odd_rows, (20, "prose before " + item + " and after")])
    known = benchmark(spark, [(1, item), (1, item), (2, None), (3, " "), (None, "one")])
    got = decontaminate.findings(docs, known).collect()
    assert len(got) == len(odd_rows) + 1
    assert {r["doc_id"] for r in got if r["contaminated"]} == {4, 5, 6, 9, 20, None}
    left = decontaminate.decontaminate(docs, known)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {1, 2, 3, 7, 8, 10, None}
    empty = benchmark(spark, [])
    assert decontaminate.decontaminate(docs, empty).count() == len(odd_rows) + 1
    assert decontaminate.findings(table([]), known).count() == 0
