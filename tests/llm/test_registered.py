"""The registered queries against their SQL, and the stages of the pipeline against brute force."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from grainline.llm import decontaminate, toxicity
from grainline.llm.queries import CHECKS
from grainline.plans.check import TABLES, compare
from grainline.session import load

from . import brute
from .test_dedup import strip

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, db, name):
    text, _, good = compare(spark, FOLDER, name, contract.queries()[name], CHECKS[name], db)
    assert good, text
    assert "types" not in text, text


def test_all_operators_are_registered():
    names = list(contract.queries())
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names


def test_jaccard_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in load(spark, FOLDER, "documents").collect()]
    got = {r["doc_id"]: r["component_id"] for r in contract.queries()["op9_ngram_jaccard_join"](spark, FOLDER).collect()}
    assert got == brute.linked_components(rows, 3, 90, 100)


def test_pipeline(spark, tmp_path):
    docs = load(spark, FOLDER, "documents")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        scored = None
        if name == "toxicity":
            scored = toxicity.score(docs, toxicity.fit(docs, load(spark, FOLDER, "labels"))).collect()
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        rows = docs.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(rows) == len(after)
        if name == "toxicity":
            assert set(after) == {r["doc_id"] for r in scored if not r["predicted"]}
        elif name == "exact_dedup":
            first = {}
            for i, text in sorted(before.items(), key=lambda x: (-len(x[1]), x[0])):
                first.setdefault(strip(text), i)
            assert set(after) == set(first.values())
        elif name == "ngram_jaccard_join":
            assert set(after) == set(brute.linked_components(list(before.items()), 5, 80, 100).values())
        else:
            items = [r["text"].lower().split() for r in load(spark, FOLDER, "benchmark").collect()]

            def dirty(text):
                w = text.lower().split()
                shared = [b for b in items if {tuple(b[k : k + 4]) for k in range(len(b) - 3)} & {tuple(w[k : k + 4]) for k in range(len(w) - 3)}]
                return any(brute.tiling(b, w, decontaminate.SEED) >= decontaminate.THRESHOLD * len(b) for b in shared)

            assert set(after) == {i for i, text in before.items() if not dirty(text)}
        before = after
    final = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in final} == set(before)
    whole = contract.queries()["pipeline"](spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in whole) == sorted((r["doc_id"], r["taken"]) for r in final)
