"""Chat formatting, source mixing and license scan: values, odd rows, no Python in the plans."""

import random

import pytest
from pyspark.sql import functions as F

from grainline.llm import chat, licenses, mixing

from . import brute


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("Python", "Pandas", "Arrow"))


CHATS = "conv_id bigint, turn bigint, role string, text string, place string, n_turns string"


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    rows = []
    for c in range(40):
        base = [("user" if k % 2 == 0 else "assistant", f"{c % 7}-{k}") for k in range(6)][: rng.randint(1, 6)]
        rows += [(c, k, r, x) for k, (r, x) in enumerate(base)]
    rows += [(None, 0, "user", "no id"), (90, None, None, None), (91, 0, "user", ""), (91, 0, "user", ""), (92, 1, "b", "tie"), (92, 1, "a", "tie")]
    return rows


def test_chats_against_brute_force(spark, turns):
    df = spark.createDataFrame([(*t, "x", "y") for t in turns], CHATS)
    out = chat.format_chats(df)
    got = {r["conv_id"]: r for r in out.collect()}
    want = brute.maximal_chats(turns)
    assert set(got) == set(want)
    for c, lines in want.items():
        assert got[c]["rendered"] == "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in lines)
        assert got[c]["n_turns"] == len(lines)
    assert sum(r["n_copies"] for r in got.values()) <= len({t[0] for t in turns})
    no_python(out)


def test_rows_without_id_are_conversations_of_their_own(spark):
    rows = [(None, 0, "user", "hi"), (None, 5, "user", "hi"), (None, 0, "user", "hi"), (None, 1, "user", "alone"), (None, 0, None, None)]
    rows += [(1, 0, "user", "hi"), (1, 1, "bot", "yes"), (2, 0, "user", "same"), (None, 9, "user", "same")]
    out = chat.format_chats(spark.createDataFrame([(*t, "x", "y") for t in rows], CHATS)).collect()
    got = sorted((str(r["conv_id"]), r["n_turns"], r["n_copies"], r["rendered"]) for r in out)
    line = lambda r, x: f"<|im_start|>{r}\n{x}<|im_end|>\n"
    assert got == sorted([
        ("1", 2, 1, line("user", "hi") + line("bot", "yes")), ("2", 1, 2, line("user", "same")),
        ("None", 1, 1, line("user", "alone")), ("None", 1, 1, line("unknown", "")),
    ])


def test_two_million_rows_without_id_and_a_very_long_conversation(spark):
    rows = spark.range(2_000_000).select(
        F.lit(None).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), (F.col("id") % 1000).cast("string")).alias("text")
    )
    long = spark.range(600_000).select(F.lit(7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("same").alias("text"))
    found = chat.maximal(chat.prefix_hashes(chat.turns(rows.unionByName(long))))
    got = found.groupBy("conv_id", "n_turns").agg(F.count("*").alias("n"), F.sum("n_copies").alias("copies")).collect()
    assert sorted((str(r["conv_id"]), r["n_turns"], r["n"], r["copies"]) for r in got) == [("7", 600_000, 1, 1), ("None", 1, 1000, 2_000_000)]


def test_chats_of_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], CHATS)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_apportionment_is_sainte_lague(spark, seed):
    rng = random.Random(seed)
    votes = [rng.choice([0, 1, 1, 5, rng.randint(1, 10_000)]) for _ in range(rng.randint(1, 30))]
    seats = rng.choice([0, 1, 7, 100, 5000])
    df = spark.createDataFrame([(k, float(v), seats) for k, v in enumerate(votes)], "k int, votes double, house bigint")
    got = {r["k"]: r["seats"] for r in mixing.apportion(df, [], ["k"], "votes", "house").collect()}
    assert [got[k] for k in range(len(votes))] == brute.sainte_lague(votes, seats)


def test_targets(spark):
    sizes = spark.createDataFrame([("b", 100), ("a", 10), (None, 500), ("c", 390)], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # a weighs 3, b 1, c 2, NULL 3; a and then c and b stop at twice their size
    assert got["a"] == 20.0
    assert sum(got.values()) == pytest.approx(1500)
    assert all(got[s] <= 2 * n + 1e-9 for s, n in (("a", 10), ("b", 100), ("c", 390), (None, 500)))


def test_mix_reaches_targets(spark, table):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 300))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    out = mixing.mix(table(rows), shard_rows=40)
    no_python(out)
    got = out.collect()
    assert len(got) == len(rows)
    source = {i: s for i, _, s in rows}
    for s in ("a", "b", "c", None):
        own = [r for r in got if source[r["doc_id"]] == s]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.02)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    again = mixing.mix(table(rows).repartition(7), shard_rows=40).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}


def test_mix_to_other_targets(table):
    rows = [(i, "w " * (i % 50), "ab"[i % 2]) for i in range(200)]
    out = mixing.mix(table(rows), shard_rows=40, weights=(1, 3), share=0.5, repeats=1).collect()
    total = sum(r["size"] for r in out)
    for k, wanted in ((0, 0.125), (1, 0.375)):
        own = [r for r in out if r["doc_id"] % 2 == k]
        assert own[0]["target"] == pytest.approx(wanted * total)
        assert sum(r["taken"] for r in own) == pytest.approx(wanted * total, rel=0.05)
    for r in out:
        spans = sorted((s["start"], s["end"]) for s in r["spans"])
        assert all(0 <= a < b <= r["size"] for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        assert r["taken"] == r["passes"] * r["size"] + sum(b - a for a, b in spans)


def test_mix_odd_rows(table, odd_rows):
    got = mixing.mix(table(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(table([])).count() == 0
    assert [r["taken"] for r in mixing.mix(table([(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


def test_licenses_against_brute_force(spark, table):
    rng = random.Random(1)
    lines = ["Some words of plain prose here", "x", ""]
    for _, text in licenses.TEMPLATES:
        w = text.split()
        lines += [text, text.upper(), " ".join(w[: len(w) * 3 // 4]), " ".join(w + ["extra", "words"]), " ".join(w[::-1])]
    rows = [(i, "\n".join(rng.sample(lines, rng.randint(1, 4)))) for i in range(120)]
    rows.append((500, licenses.TEMPLATES[3][1].replace(" to ", "\nto ")))
    out = licenses.scan(table(rows))
    no_python(out)
    got = {r["doc_id"]: r for r in out.collect()}
    for i, text in rows:
        units = {text, *text.split("\n")}
        scores = [(-brute.dice(u, t), name) for u in units for name, t in licenses.TEMPLATES if brute.dice(u, t) >= licenses.THRESHOLD]
        want = min(scores, default=(None, None))
        assert got[i]["license_id"] == want[1], text
        assert got[i]["dice"] == (pytest.approx(-want[0]) if scores else None)
        assert (got[i]["n_matches"] > 0) == bool(scores)


def test_licenses_without_broadcast(table, monkeypatch):
    rows = [(i, text) for i, (_, text) in enumerate(licenses.TEMPLATES)]
    near = licenses.scan(table(rows)).orderBy("doc_id").collect()
    monkeypatch.setattr(licenses, "BROADCAST_BIGRAMS", 0)
    assert licenses.scan(table(rows)).orderBy("doc_id").collect() == near
    assert all(r["dice"] == 1.0 for r in near)


def test_licenses_odd_rows(spark, table, odd_rows):
    got = licenses.scan(table(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all(r["n_matches"] == 0 and r["dice"] is None for r in got)
    assert licenses.scan(table([])).count() == 0
    none = spark.createDataFrame([], "license_id string, text string")
    assert licenses.scan(table([(1, "Released under the MIT License.")]), none).first()["license_id"] is None
    twice = licenses.scan(table([(1, "Released under the MIT License.")] * 2)).select(F.round("dice", 9).alias("d")).collect()
    assert [r["d"] for r in twice] == [1.0, 1.0]


def test_licenses_of_long_repeated_text(table):
    wrapped = licenses.TEMPLATES[3][1].replace(" to ", "\nto ")
    rows = [(1, "\n".join([wrapped] * 7)), (2, "\n".join(["Released under the MIT License."] * 80))]
    got = {r["doc_id"]: r for r in licenses.scan(table(rows)).collect()}
    assert got[1]["license_id"] == "MIT" and got[1]["dice"] == pytest.approx(brute.dice(rows[0][1], licenses.TEMPLATES[3][1]))
    assert got[2]["n_matches"] == 81


def test_licenses_inside_longer_text(table):
    import textwrap

    known = dict(licenses.FULL_TEXTS)
    short = "Licensed under the Apache License, Version 2.0."
    prose = " ".join(f"w{k}" for k in range(150)) + " "
    rows = [
        (1, "\n".join(textwrap.wrap("The MIT License Copyright (c) 2020 Some One " + known["MIT"], 78))),
        (2, f"Some prose. {short} More prose"),
        (3, "\n".join(textwrap.wrap(prose + licenses.TEMPLATES[3][1] + " " + prose, 40))),
        (4, prose + short + " " + prose + short + " " + licenses.TEMPLATES[3][1]),
        (5, prose + licenses.TEMPLATES[3][1].replace("limitation", "limitation " + "x " * 900) + " " + prose),
        (6, prose + "Permission is hereby granted, free of charge. " + prose),
        (7, short + "\n" + prose + short),
        (8, "\n".join(textwrap.wrap(prose + known["BSD-3-Clause"] + " " + prose, 60))),
    ]
    out = licenses.scan(table([*rows, rows[1]]))
    got = {r["doc_id"]: (r["license_id"], r["dice"] and round(r["dice"], 4), r["n_matches"]) for r in out.collect()}
    assert got[1][0] == "MIT" and got[1][1] > 0.9 and got[1][2] == 1
    assert got[2] == ("Apache-2.0", 1.0, 1) and got[3] == ("MIT", 1.0, 1)
    assert got[4] == ("Apache-2.0", 1.0, 3) and got[7] == ("Apache-2.0", 1.0, 2)
    assert got[5][0] == "MIT" and got[5][1] > 0.9 and got[6] == (None, None, 0)
    assert got[8][:2] == ("BSD-3-Clause", 1.0)
    no_python(out)


def test_license_runs_against_brute_force(spark, table):
    rng = random.Random(8)
    template = "a b c d e f g h"
    rows = []
    for i in range(80):
        w = template.split()
        for _ in range(rng.randint(0, 3)):
            w[(k := rng.randint(0, len(w))) : k + rng.randint(0, 1)] = rng.choice([["x"], ["y", "y", "y", "y"], ["a", "b"], []])
        rows.append((i, " ".join(rng.choices("pqrab", k=rng.randint(0, 12)) + w + rng.choices("pqrgh", k=rng.randint(0, 12)))))
    known = spark.createDataFrame([("T", template)], "license_id string, text string")
    got = {r["doc_id"]: r["dice"] for r in licenses.scan(table(rows), known).collect()}
    for i, text in rows:
        w, line = text.split(), brute.dice(text, template)
        best = max(brute.dice(" ".join(w[a:b]), template) for a in range(len(w)) for b in range(a + 2, len(w) + 1))
        want = line if line >= licenses.THRESHOLD else best
        assert got[i] == (pytest.approx(want) if want >= licenses.THRESHOLD else None), text
    assert len(set(got.values())) > 3
