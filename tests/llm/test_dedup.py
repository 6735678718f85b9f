"""Exact and substring deduplication, the Jaccard join and language-model scoring against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainline.llm import backoff, exact_dedup, ngram_join, substrings, tokens

from . import brute


def strip(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(2)
    base = ["".join(rng.choice("ab é\n\t") for _ in range(rng.choice([0, 1, 5, 40, 300]))) for _ in range(30)]
    rows = []
    for i in range(150):
        text = rng.choice(base)
        rows.append((i, text if rng.random() < 0.6 else text.replace(" ", "  \n")))
    return [*rows, (200, None), (201, None), (202, "")]


@pytest.mark.parametrize("primes,piece", [(exact_dedup.PRIMES, exact_dedup.PIECE), (exact_dedup.PRIMES, 7), ((3, 2), 11)])
def test_exact_classes(table, copies, primes, piece):
    groups = {}
    for i, text in copies:
        groups.setdefault(strip(text), []).append((-len(text or ""), i))
    got = {r["doc_id"]: r for r in exact_dedup.classes(table(copies), primes, piece).collect()}
    assert len(got) == len(copies)
    for i, text in copies:
        own = groups[strip(text)]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(own)[1], len(own), min(own)[1] == i)
        assert r["text_sha256"] == hashlib.sha256(strip(text).encode()).hexdigest()


def test_fingerprints_compose():
    run = exact_dedup._hasher(exact_dedup.PRIMES)
    data = bytes(random.Random(1).randrange(256) for _ in range(20_000))
    for cut in (0, 1, 4095, 4096, 9000):
        (h1, s1, h2, s2), (g1, t1, g2, t2) = run(data[:cut]), run(data[cut:])
        p, q = exact_dedup.PRIMES
        assert run(data) == [(h1 * t1 + g1) % p, s1 * t1 % p, (h2 * t2 + g2) % q, s2 * t2 % q]


def test_exact_odd_rows(table, odd_rows):
    got = exact_dedup.classes(table(odd_rows))
    assert got.count() == len(odd_rows)
    docs = table(odd_rows)
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    texts = [strip(r["text"]) for r in left.collect()]
    assert sorted(texts) == sorted({strip(r[1]) for r in odd_rows})
    assert exact_dedup.classes(table([])).count() == 0 and exact_dedup.deduplicate(table([])).count() == 0


def corpus(seed, n, vocabulary, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, longest))]
        if rows and rng.random() < 0.5:
            other = brute.words(rng.choice(rows)[1])
            a = rng.randint(0, len(other))
            w[len(w) // 2 : len(w) // 2] = other[a : a + rng.randint(5, 60)]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("window,size", [(3, 400), (13, 400), (13, 1 << 20), (30, 400)])
def test_repeats(table, window, size):
    rows = corpus(window, 90, ["a", "b", "c", "dd", "e,", "F"] if window < 20 else [f"v{i}" for i in range(50)], 80)
    got = substrings.remove_repeats(table(rows), window, size).collect()
    want = brute.repeats(rows, window)
    assert {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got} == {(rows[p][0], *v) for p, v in want.items()}


def test_repeats_odd_rows(table, odd_rows):
    got = substrings.remove_repeats(table(odd_rows), 13, 1000).collect()
    want = brute.repeats([r[:2] for r in odd_rows], 13)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got), key=key) == sorted(
        ((odd_rows[p][0], *v) for p, v in want.items()), key=key
    )
    assert substrings.remove_repeats(table([])).count() == 0


def test_no_table_is_left_in_the_catalog(spark, table, odd_rows):
    before = {t.name for t in spark.catalog.listTables()}
    found = substrings.remove_repeats(table(odd_rows), 13)
    assert {t.name for t in spark.catalog.listTables()} == before and found.count() == len(odd_rows)


def test_levels():
    assert substrings.levels(13) == [7, 13] and substrings.levels(50) == [7, 13, 25, 50] and substrings.levels(4) == [4]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff(table, order):
    rows = corpus(4, 60, ["a", "b", "c", "d"], 40)
    got = {r["doc_id"]: r for r in backoff.score(table(rows), order, batch_bytes=300).collect()}
    want = brute.backoff([t for _, t in rows], order, 0.4, 2)
    for (i, text), value in zip(rows, want):
        assert got[i]["log_score"] == pytest.approx(value)
        assert got[i]["n_words"] == len(brute.words(text))


def test_backoff_odd_rows(table, odd_rows):
    got = backoff.score(table(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all((r["mean_log_score"] is None) == (r["n_words"] == 0) for r in got)
    assert backoff.score(table([])).count() == 0


def test_words_of_a_batch():
    texts = ["", None, " a\x1cb c\t\x0b\x0cd\r\n", "   ", "x\u0085y z", "A A"]
    found = tokens.Words(pa.array(texts))
    words = [found.vocab[int(i)].as_py() for i in found.ids]
    assert [words[a:b] for a, b in zip(found.starts[:-1], found.starts[1:])] == [brute.words(t) for t in texts]
    assert tokens.Words(pa.array(["ÀB c"]), lower=True).vocab.to_pylist() == ["Àb", "c"]


@pytest.mark.parametrize("num", [50, 80, 90, 95])
def test_linked_sets_share_a_key(num):
    rng = np.random.default_rng(num)
    tiles, known = ngram_join.Tiles(num, 100), {}
    for _ in range(300):
        common = rng.integers(0, 1 << 63, rng.integers(1, 200), np.uint64)
        spare = int(len(common) * (100 - num) / num)
        left = int(rng.integers(0, spare + 1))
        a = np.unique(np.concatenate((common, rng.integers(0, 1 << 63, left, np.uint64))))
        b = np.unique(np.concatenate((common, rng.integers(0, 1 << 63, spare - left, np.uint64))))
        assert 100 * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b))
        if len(a) == len(b) and (a == b).all():
            continue
        both = np.concatenate((a, b))
        keys, owner = ngram_join.document_keys(np.repeat([0, 1], [len(a), len(b)]), both, np.array([len(a), len(b)]), tiles, known)
        assert len(np.intersect1d(keys[owner == 0], keys[owner == 1])), (len(a), len(b))


def near_copies(seed):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(14):
        base = [f"v{rng.randint(0, 400)}" for _ in range(rng.choice([2, 6, 12, 30, 90, 200]))]
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(["X", "y", f"v{rng.randint(0, 400)}"])
            rows.append((i, " ".join(w)))
            i += 1
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], t) for i, t in rows]


@pytest.mark.parametrize("size,num,seed,block", [(3, 90, 1, 150), (5, 80, 3, ngram_join.BLOCK_KEYS), (1, 50, 4, 150)])
def test_jaccard_components(table, monkeypatch, size, num, seed, block):
    monkeypatch.setattr(ngram_join, "BLOCK_KEYS", block)
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", 300)
    rows = near_copies(seed)
    got = {r["doc_id"]: r for r in ngram_join.join(table(rows), size, num, 100).collect()}
    want = brute.linked_components(rows, size, num, 100)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(brute.shingles(t, size)) for i, t in rows)


def passages(seed):
    """Texts put together from a few passages: nearly all share keys with others, few are near copies."""
    rng = random.Random(seed)
    pool = [" ".join(f"p{k}-{rng.randint(0, 30)}" for _ in range(40)) for k in range(12)]
    rows = []
    for i in range(90):
        text = " ".join([*rng.sample(pool, rng.randint(2, 4)), *(f"own{rng.randint(0, 10**6)}" for _ in range(rng.choice([3, 30, 60])))])
        rows.append(text)
        if rng.random() < 0.4:
            w = text.split()
            for _ in range(rng.randint(1, 6)):
                w[rng.randrange(len(w))] = "changed"
            rows.append(" ".join(w))
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("counted, seed", [(64, 1), (4, 2), (1, 3)])
def test_jaccard_of_texts_that_share_passages(table, monkeypatch, counted, seed):
    """One large component of open keys; with few counted documents a key, the tiles have to find the rest."""
    monkeypatch.setattr(ngram_join, "COUNTED_DOCUMENTS", counted)
    monkeypatch.setattr(ngram_join, "COUNTED_ROWS", 500)
    seen = []
    across = ngram_join._across_keys
    monkeypatch.setattr(ngram_join, "_across_keys", lambda *a: seen.append(across(*a)) or seen[0])
    rows = passages(seed)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(table(rows), 5, 80, 100).collect()}
    want = brute.linked_components(rows, 5, 80, 100)
    assert got == want and len(set(want.values())) < len(rows)
    pairs, heavy = seen[0]
    assert (heavy.count() > 0) == (counted < 64) and pairs.count() < 5 * len(rows)


@pytest.mark.parametrize("num", [50, 80, 90])
def test_linked_sets_share_as_many_keys_as_they_need(num):
    rng = np.random.default_rng(num + 1)
    tiles = ngram_join.Tiles(num, 100)
    for _ in range(200):
        common = rng.integers(0, 1 << 63, rng.integers(20, 400), np.uint64)
        spare = int(len(common) * (100 - num) / num)
        left = int(rng.integers(0, spare + 1))
        a = np.unique(np.concatenate((common, rng.integers(0, 1 << 63, left, np.uint64))))
        b = np.unique(np.concatenate((common, rng.integers(0, 1 << 63, spare - left, np.uint64))))
        sizes = np.array([len(a), len(b)])
        keys, owner, shape = ngram_join.shaped_keys(np.repeat([0, 1], sizes), np.concatenate((a, b)), sizes, tiles, {})
        shared = len(np.intersect1d(keys[owner == 0], keys[owner == 1]))
        low, high = (0, 1) if shape[0, 0] <= shape[0, 1] else (1, 0)
        held = shape[2, high] if shape[0, 0] == shape[0, 1] else shape[4, high]
        assert shared >= max(shape[2, low], held) - (len(a) + len(b)) * (100 - num) // (100 + num)


def test_parities_differ_at_most_as_often_as_sets():
    rng = np.random.default_rng(5)
    for n, changed in ((1, 1), (50, 4), (300, 60), (3000, 700)):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) << np.uint64(1))
        b = np.unique(np.concatenate((rng.permutation(a)[changed:], rng.integers(0, 1 << 63, changed, np.uint64) << np.uint64(1))))
        sizes = [len(a), 0, len(b)]
        words = ngram_join.parities(np.repeat([0, 1, 2], sizes), np.concatenate((a, b)), 3)
        differ = int(np.bitwise_count((words[0] ^ words[2]).view(np.uint64)).sum())
        assert words.shape == (3, 16) and not words[1].any()
        assert len(np.setxor1d(a, b)) * 0.3 < differ <= len(np.setxor1d(a, b))


def test_texts_that_are_near_but_not_linked_are_not_verified_pair_by_pair(table, monkeypatch):
    """Versions of a text share keys with each other, but only the planted pairs link."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10_000)}" for _ in range(300)]
    rows = []
    for k in range(40):
        text = list(base)
        for at in rng.sample(range(300), 6):
            text[at] = f"x{rng.randrange(10_000)}"
        rows.append((k, " ".join(text)))
    rows += [(100 + k, rows[k][1] + " end") for k in range(0, 40, 8)]
    seen = []
    across = ngram_join._across_keys
    monkeypatch.setattr(ngram_join, "_across_keys", lambda *a: seen.append(across(*a)) or seen[0])
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(table(rows), 5, 80, 100).collect()}
    assert got == brute.linked_components(rows, 5, 80, 100)
    assert seen[0][0].count() < len(rows)


@pytest.mark.parametrize("num", [50, 80, 90])
def test_parts_tell_how_much_a_link_of_their_tile_differs(num):
    tiles = ngram_join.Tiles(num, 100)
    assert all(ngram_join.Tiles.differ(parts) == parts - need for n in range(1, 3000) for _, parts, need in tiles.of(n))


def test_a_common_passage_alone_is_not_compared_pair_by_pair(table, monkeypatch):
    """A few large keys are fewer than a link needs, also for texts that are near the upper end of a tile."""
    monkeypatch.setattr(ngram_join, "COUNTED_DOCUMENTS", 4)
    size = next(n for n in range(140, 60, -1) if len(ngram_join.Tiles(80, 100).of(n)) == 2)
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(size * 35 // 100 + 4)]
    rows = [(k, " ".join([*passage, *(word() for _ in range(size + 4 - len(passage)))])) for k in range(16)]
    rows += [(100 + k, rows[k][1] + " end") for k in (0, 7)]
    seen = []
    across = ngram_join._across_keys
    monkeypatch.setattr(ngram_join, "_across_keys", lambda *a: seen.append((a[0], across(*a))) or seen[0][1])
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(table(rows), 5, 80, 100).collect()}
    assert got == brute.linked_components(rows, 5, 80, 100) and got[100] == 0 and got[107] == 7
    members, (_, heavy) = seen[0]
    assert members.groupBy("key").count().where("count > 4").count() > 0 and heavy.count() == 0


def test_components_are_extended_by_more_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "parent bigint, child bigint")
    found = lambda df: {r["doc_id"]: r["component_id"] for r in df.collect()}
    for cut in (0, 15, 39, 40):
        got = found(ngram_join.extended(ngram_join.components(frame(links[:cut])), frame(links[cut:])))
        want = found(ngram_join.components(frame(links)))
        # a document that only links to itself is its own component, with a row or without
        assert {k: v for k, v in got.items() if k in want or k != v} == want


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 51), (51, 50), (52, 51)], "parent bigint, child bigint")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 51: 50, 52: 50}


def test_jaccard_odd_rows(table, odd_rows):
    got = ngram_join.join(table(odd_rows), 3, 90, 100).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r["component_id"] for r in got}
    # 6 and 9 differ in one word of 30,000; 4 and 5 are equal; empty texts link with nothing
    assert by[9] == 6 and by[5] == 4 and by[None] is None and by[1] == 1 and by[2] == 2 and by[3] == 3
    assert ngram_join.join(table([]), 3, 90, 100).count() == 0
    docs = table(odd_rows)
    left = ngram_join.keep_one(docs)
    assert left.columns == docs.columns and left.where(F.col("doc_id").isNull()).count() == 2
