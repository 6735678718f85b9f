"""Fill-in-middle against a plain version, exact round trips, and the word arithmetic on single bytes."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainline.llm import infill

MARKS = ("<P>", "<S>", "<M>")


def plain(doc_id, text, unit, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in MARKS) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(11)
    alphabet = ["a", "é", "語", "😀", "\n", "\n", "\r\n", " ", "<", "P>", "<P", "<S>", "\x0b", "\x8a", "\x00"]
    found = [None, "", "\n", "\n\n", "a", "a\n", "\na", "x" * 8, "x" * 7 + "\n", "<M>", "<<P", "long\n" * 60_000 + "end"]
    return found + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]


@pytest.mark.parametrize("unit, rate, spm", [("line", 100, 50), ("char", 100, 50), ("line", 40, 0), ("char", 90, 100)])
def test_against_a_plain_version(spark, table, unit, rate, spm):
    rows = [(k if k % 17 else None, t) for k, t in enumerate(texts())]
    out = infill.transform(table(rows), unit, rate, spm).withColumn("back", infill.restore(F.col("output"), F.col("form")))
    got = sorted((str(r["doc_id"]), r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"], r["back"]) for r in out.collect())
    want = []
    for i, t in rows:
        n, form, p, m, output = plain(i, t, unit, rate, spm)
        want.append((str(i), n, form, str(p), str(m), output, t or ""))
    assert got == sorted(want)


def test_odd_rows_and_empty_table(spark, table, odd_rows):
    out = infill.transform(table(odd_rows))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert out.count() == len(odd_rows)
    assert infill.transform(table(odd_rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        infill.transform(table(odd_rows), unit="word")


def test_marks_of_every_byte_pair():
    data = np.array([[x, y] for x in range(256) for y in range(256)], np.uint8).ravel()
    for marks, want in ((infill.line_marks, data == 10), (infill.lead_marks, (data & 0xC0) != 0x80)):
        got = marks(data.view("<u8")).view(np.uint8)
        assert ((got == 0x80) == want).all() and set(got) <= {0, 0x80}


def test_rank_and_select():
    rng = np.random.default_rng(2)
    data = rng.choice(np.array([10, 65], np.uint8), 4096, p=[0.1, 0.9])
    marked = infill.Marked(data.view("<u8"), infill.line_marks)
    places = np.flatnonzero(data == 10)
    assert (marked.select(np.arange(len(places))) == places).all()
    at = np.arange(len(data) + 1)
    assert (marked.rank(at) == np.concatenate(([0], np.cumsum(data == 10)))).all()


def test_sliced_and_large_arrays():
    held = pa.array(["skip", "a\nb", None, "", "é\n"]).fill_null("").slice(1)
    h = np.array([1, 0, 0, 1]), np.array([1, 0, 0, 1])
    for texts_ in (held, held.cast(pa.large_string())):
        n, a, b, prefix, middle = infill.cuts(texts_, *h, "line")
        assert n.tolist() == [2, 0, 0, 1] and a.tolist() == [2, 0, 0, 3] and prefix.tolist() == [2, 0, 0, 2]
