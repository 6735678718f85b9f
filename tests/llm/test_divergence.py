"""Source divergence against a plain version; the pointer sort on its own."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from grainline.llm import divergence
from grainline.llm.infill import buffer_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {k: k + 32 for k in range(0x41, 0x5B)}


def terms(text):
    return [t.translate(FOLD) for t in TERM.findall(text or "")]


def plain(rows, least=3, top=200):
    """Rows of (id, text, source, lang) to all result rows."""
    docs = [(lang or "", source or "", terms(text)) for _, text, source, lang in rows]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        seen[lang].update(set(words))
        counts[lang, source].update(words)
    found = []
    for lang in {x[0] for x in docs}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = sorted(s for x, s in counts if x == lang)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        for a in sources:
            pairs = [(sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept), b) for b in sources if b != a]
            more = [((p[a][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, a][t] and p[a][t] > q[t]]
            for part, values, limit in (("pair", pairs, len(pairs)), ("term", more, top)):
                ordered = sorted(values, key=lambda x: (-x[0], x[1].encode()))[:limit]
                found += [(lang, a, part, item, value, k + 1) for k, (value, item) in enumerate(ordered)]
    return sorted(found)


def corpus():
    rng = random.Random(13)
    vocab = ["a", "The", "the", "é", "straße", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghijklmn", "abcdefghijklmno", "語語語語", "Z", "x" * 40, "x" * 41, " "]
    joins = [" ", "\n", "1", "_", "'", "\x7f", "\x00", "@", "["]
    rows = []
    for k in range(120):
        n = rng.choice([0, 1, 3, 40, 400])
        text = "".join(rng.choice(vocab) + rng.choice(joins) for _ in range(n))
        rows.append((k, text if rng.random() < 0.95 else None, rng.choice(["s1", "s2", None, "", "ß"]), rng.choice(["en", "en", "de", None])))
    return [*rows, (500, "only once here", "s9", "xx"), (501, "...", "s8", "xx"), (502, None, "s1", "en"), (502, "the", "s7", "en"), (502, "the", "s7", "en")]


def test_against_a_plain_version(spark, table, monkeypatch):
    rows = corpus()
    got = sorted(tuple(r) for r in divergence.audit(table(rows)).collect())
    assert got == plain(rows)
    got = sorted(tuple(r) for r in divergence.audit(table(rows), least=1, top=2).collect())
    assert got == plain(rows, 1, 2)


def test_blocks_and_shards_do_not_change_the_result(spark, table):
    rows = corpus()
    entries = divergence.kept_terms(divergence.term_counts(table(rows))).cache()
    sizes = divergence.group_sizes(table(rows), entries).cache()
    whole, cut = (sorted(tuple(r) for r in divergence.pair_divergence(entries, sizes, cells).collect()) for cells in (10**6, 7))
    assert whole == cut and len(whole) > 20


def test_odd_rows_and_empty_table(spark, table, odd_rows):
    out = divergence.audit(table(odd_rows))
    assert sorted(tuple(r) for r in out.collect()) == plain(odd_rows)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert divergence.audit(table(odd_rows).limit(0)).count() == 0


def test_pointer_sort():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abAB") for _ in range(rng.choice([1, 6, 7, 8, 14, 15, 21, 30]))) for _ in range(80)) for _ in range(30)]
    texts += ["", "ab", "AB", "b" * 7, "b" * 8, "b" * 7]
    raw, _, offsets = buffer_of(pa.array(texts))
    start, length, doc = divergence.term_pointers(raw, offsets)
    want = [t for x in texts for t in terms(x)]
    found = [bytes(raw[a : a + n]).decode().translate(FOLD) for a, n in zip(start, length)]
    assert found == want and doc.tolist() == [k for k, x in enumerate(texts) for _ in terms(x)]
    order, run = divergence.sort_pointers(raw, start, length)
    ordered = [want[k] for k in order]
    assert ordered == sorted(want)
    assert [ordered.index(t) for t in ordered] == run.tolist()
    counted = divergence.count_terms(pa.array(texts), np.array([k % 3 for k in range(len(texts))]))
    got = {(t, g): (n, d) for t, g, n, d in zip(counted[0].to_pylist(), *(x.tolist() for x in counted[1:]))}
    n, d = Counter(), Counter()
    for k, x in enumerate(texts):
        n.update((t, k % 3) for t in terms(x))
        d.update((t, k % 3) for t in set(terms(x)))
    assert got == {key: (n[key], d[key]) for key in n}
