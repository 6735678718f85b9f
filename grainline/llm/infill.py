"""Fill-in-middle: texts cut at unit borders into prefix, middle and suffix and put in another order.

Borders are found on 64-bit words, without a look at single bytes: the UTF-8 of a whole batch is viewed as uint64, the
bytes that end a unit are marked by arithmetic on the words, ``bitwise_count`` and a running sum give the units before
each word, a binary search finds the word of the wanted unit, and the place in the word is resolved among its eight marks.
The texts of a batch share these steps; a text begins at the rank its first byte has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainline.llm import tokens
from grainline.llm.common import whole

SEED = 7
# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = ("line", "char")

_ONES = np.uint64(0x0101010101010101)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def line_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed. No carry leaves a byte, so neighbours cannot disturb it."""
    other = words ^ (np.uint64(0x0A) * _ONES)
    return ~(((other & _LOW) + _LOW) | other | _LOW)


def lead_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that begins a code point: all but 10xxxxxx."""
    return ~(words & (~words << np.uint64(1))) & _HIGH


class Marked:
    """Ranks and places of marked bytes in one buffer."""

    def __init__(self, words: np.ndarray, marks):
        self.marks = marks(words)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each byte offset."""
        word, rest = at >> 3, (at & 7).astype(np.uint64)
        held = np.append(self.marks, np.uint64(0))[word] & ~(_FULL << (rest * np.uint64(8)))
        return self.before[word] + np.bitwise_count(held)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte offset of the marked byte with rank k, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        places = np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(7)
        bits = (self.marks[word][:, None] >> places) & np.uint64(1)
        inside = np.cumsum(bits, axis=1) == (k - self.before[word] + 1)[:, None]
        return word * 8 + np.argmax(inside, axis=1)


def buffer_of(texts: pa.Array):
    """(bytes as uint64 words, byte offsets of the texts) of a string array, without a copy but for the last word."""
    wide = texts.type == pa.large_string()
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    raw = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.zeros(0, np.uint8)
    padded = np.zeros(-(-len(raw) // 8) * 8, np.uint8)
    padded[: len(raw)] = raw
    return raw, padded.view("<u8"), offsets - low


def cuts(texts: pa.Array, h1: np.ndarray, h2: np.ndarray, unit: str):
    """(units, byte offsets of the end of prefix and of middle, code points of both) per text."""
    raw, words, offsets = buffer_of(texts)
    start, end = offsets[:-1], offsets[1:]
    leads = Marked(words, lead_marks)
    if unit == "char":
        units, first = leads, leads.rank(start)
        n = leads.rank(end) - first
        # a code point ends where the next one begins
        border = lambda k: np.where(k == n, end, units.select(np.minimum(first + k, max(units.before[-1] - 1, 0))))
    else:
        units = Marked(words, line_marks)
        first = units.rank(start)
        closed = units.rank(end) - first
        # a last line without its line feed is a unit as well
        open_end = (end > start) & (raw[np.maximum(end - 1, 0)] != 0x0A) if len(raw) else np.zeros(len(start), bool)
        n = closed + open_end

        def border(k):
            inner = (k > 0) & (k <= closed)
            found = start + np.where(k > closed, end - start, 0)
            found[inner] = units.select(first[inner] + k[inner] - 1) + 1
            return found

    low = np.minimum(h1 % (n + 1), h2 % (n + 1))
    high = np.maximum(h1 % (n + 1), h2 % (n + 1))
    a, b = (border(low), border(high)) if len(raw) else (start, start)
    return n, a - start, b - start, leads.rank(a) - leads.rank(start), leads.rank(b) - leads.rank(a)


def _pieces(texts: pa.Array, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Prefixes, middles and suffixes: the three of a text follow each other in the buffer, so only offsets are new."""
    raw, _, offsets = buffer_of(texts)
    borders = np.append(np.column_stack((offsets[:-1], offsets[:-1] + a, offsets[:-1] + b)).ravel(), offsets[-1:])
    three = pa.LargeStringArray.from_buffers(3 * len(a), pa.py_buffer(borders), pa.py_buffer(raw))
    return [three.take(pa.array(np.arange(k, 3 * len(a), 3))).cast(pa.string()) for k in range(3)]


def _cutting(unit, extra):
    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                texts = part.column("text")
                hashes = [part.column(h).to_numpy(zero_copy_only=False).astype(np.int64) for h in ("h1", "h2")]
                n, a, b, prefix, middle = cuts(texts, *hashes, unit)
                pieces = _pieces(texts, a, b)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in extra), pa.array(n), *pieces, pa.array(prefix), pa.array(middle)],
                    [*extra, "n", "prefix", "middle", "suffix", "prefix_chars", "middle_chars"],
                )

    return run


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. Markers occur only where the transformation put them."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def transform(documents: DataFrame, unit: str = "line", rate: int = 100, spm: int = 50, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per document.

    A unit is a line with its line feed (the last one may lack it) or, with ``unit="char"``, a code point; n is their
    number. Four numbers come from the sha256 of seed, colon and id: the first two cut after h % (n + 1) units, the third
    leaves all but ``rate`` percent as they are, the fourth makes ``spm`` percent of the others suffix first. The form is
    plain for empty texts, for texts that hold a marker and for those left as they are; then the sizes are NULL and the
    output is the text. A NULL text is empty, a NULL id hashes as an empty one. Rows are independent of each other:
    repeated rows give repeated rows, an empty table none, other columns are ignored, a text of any length is cut whole.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")
    rows = documents.select("doc_id", whole(F.col("text")).alias("text"), *(number(k).alias(f"h{k + 1}") for k in range(4)))
    schema = T.StructType(
        [*(rows.schema[c] for c in ("doc_id", "h3", "h4"))]
        + [T.StructField("n", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("prefix", "middle", "suffix")]
        + [T.StructField(c, T.LongType()) for c in ("prefix_chars", "middle_chars")]
    )
    cut = rows.mapInArrow(_cutting(unit, ["doc_id", "h3", "h4"]), schema)
    text = F.concat("prefix", "middle", "suffix")
    held = cut.withColumn("text", text)
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    held = held.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm"))
    is_plain = F.col("form") == "plain"
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm_text = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    return held.select(
        "doc_id", "n", "form",
        *(F.when(~is_plain, F.col(c)).alias(c) for c in ("prefix_chars", "middle_chars")),
        F.when(is_plain, F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm_text).alias("output"),
    )
