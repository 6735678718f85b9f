"""Secret scan: patterns of known credentials, and windows of high Shannon entropy in candidate strings.

A candidate is a long run of key characters; its class is the smallest that holds it: hex digits or the characters of
base64. A window slides over it. The sum of n log n over the counts n of its characters moves with the counts of the
character that enters and of the one that leaves, in whole numbers, so it is exact wherever a window begins. Windows at
or above the entropy limit of their class that hold a letter and a digit are marked, marked windows that touch become one
span. Candidates on the allow-list are passed over. DataFrame functions only, row by row: no shuffle, no group.
"""

from __future__ import annotations

from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import whole

# Patterns of known credentials, in the order in which ties of a start are listed.
_KEYWORD = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = _KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Both of the above lie in such a run.
KEY_RUN = r"[A-Za-z0-9+/_=-]{16,}"

WINDOW = 20
# Entropy from which a window is marked, in bits per character, by class of its candidate.
LIMITS = {"entropy_hex": 3.0, "entropy_base64": 3.8}
KINDS = ("assign", "access", "hex", *LIMITS)
# Candidates that are no secrets: UUIDs, placeholders, checksums named as such, alphabets.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"(?i:example|sample|placeholder|changeme|dummy|redacted|x{6})",
    r"^(?:sha1|sha256|sha384|sha512|md5)[-=]",
    r"(?i:abcdefghij|0123456789)",
)
# Fixed-point scale of n log n.
SCALE = 1 << 20
# Values summed, and windows slid over, in one step of a nested fold: keeps folds over long arrays linear.
BLOCK = 256


def weight(n: int) -> int:
    """n log2 n, fixed point."""
    return round(n * log2(n) * SCALE) if n > 1 else 0


def most_weight(limit: float, window: int) -> int:
    """Largest sum of weights of a window whose entropy reaches ``limit``."""
    return floor(window * (log2(window) - limit) * SCALE)


def _staged(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*df.columns, *(c.alias(n) for n, c in columns.items()))


def running(df: DataFrame, name: str, lengths: str) -> DataFrame:
    """Add ``name``: the sum of all values before each one of an array of whole numbers, block by block."""
    blocks, offsets = f"{name}__blocks", f"{name}__offsets"
    numbers = F.expr(f"CASE WHEN size({lengths}) > 0 THEN sequence(0, (size({lengths}) - 1) div {BLOCK}) ELSE array() END")
    fold = lambda start: lambda values: F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    zero = F.lit(0).cast("bigint")
    df = _staged(df, {blocks: F.transform(numbers, lambda b: F.slice(F.col(lengths), b * BLOCK + 1, F.lit(BLOCK)))})
    df = _staged(df, {offsets: fold(zero)(F.transform(blocks, lambda x: F.aggregate(x, zero, lambda a, v: a + v)))})
    at = F.zip_with(blocks, F.slice(offsets, F.lit(1), F.size(blocks)), lambda x, o: F.slice(fold(o)(x), F.lit(1), F.size(x)))
    return _staged(df, {name: F.flatten(at)}).drop(blocks, offsets)


def located(df: DataFrame, name: str, text: str, pattern: str, gate: Column | None = None) -> DataFrame:
    """Add ``name``: array of (start, end, value) of the matches from left to right that do not overlap, in code points.

    The texts between the matches and the matches themselves give the places by their lengths.
    """
    found, between, lengths, before = (f"{name}__{x}" for x in ("found", "between", "lengths", "before"))
    some = F.col(text).rlike(pattern) if gate is None else gate & F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    df = _staged(df, {found: F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)})
    df = _staged(df, {between: F.when(F.size(found) > 0, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))).otherwise(none)})
    df = _staged(df, {lengths: F.zip_with(between, found, lambda b, m: (F.length(b) + F.length(m)).cast("bigint"))})
    df = running(df, before, lengths)
    zipped = F.arrays_zip(F.col(found).alias("m"), F.col(between).alias("b"), F.col(before).alias("p"))

    def place(x):
        start = x["p"] + F.length(x["b"])
        return F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("value"))

    return _staged(df, {name: F.transform(zipped, place)}).drop(found, between, lengths, before)


def _marks(value: Column, window: int, most: Column) -> Column:
    """One mark per window of a string: 1 where its weight is at most ``most`` and it holds a letter and a digit, else 0."""
    weights = F.array(*(F.lit(weight(n)).cast("bigint") for n in range(window + 2)))
    how_many = lambda part, c: F.length(part) - F.length(F.replace(part, c, F.lit("")))
    is_digit = lambda c: c.between("0", "9").cast("int")
    is_letter = lambda c: (c.between("a", "z") | c.between("A", "Z")).cast("int")

    def slide(part):
        def mark(acc):
            return F.when((acc["weight"] <= most) & (acc["digits"] > 0) & (acc["letters"] > 0), "1").otherwise("0")

        def step(acc, i):
            entering, leaving = part.substr(i, F.lit(1)), F.when(i > window, part.substr(i - window, F.lit(1))).otherwise("")
            held = part.substr(F.greatest(i - window, F.lit(1)), F.least(i - 1, F.lit(window)))
            stay = part.substr(F.greatest(i - window + 1, F.lit(1)), F.least(i - 1, F.lit(window - 1)))
            n_in, n_out = how_many(stay, entering), how_many(held, leaving)
            added = F.get(weights, n_in + 1) - F.get(weights, n_in)
            gone = F.when(i > window, F.get(weights, n_out) - F.get(weights, n_out - 1)).otherwise(0)
            return F.struct(
                (acc["weight"] + added - gone).alias("weight"),
                (acc["digits"] + is_digit(entering) - is_digit(leaving)).alias("digits"),
                (acc["letters"] + is_letter(entering) - is_letter(leaving)).alias("letters"),
                # the window that ended before this character
                F.when(i > window, F.concat(acc["marks"], mark(acc))).otherwise(acc["marks"]).alias("marks"),
            )

        empty = F.struct(F.lit(0).cast("bigint").alias("weight"), F.lit(0).alias("digits"), F.lit(0).alias("letters"), F.lit("").alias("marks"))
        return F.aggregate(F.sequence(F.lit(1), F.length(part)), empty, step, lambda acc: F.concat(acc["marks"], mark(acc)))

    # parts overlap by a window less one character, so each window lies in exactly one part
    last = F.floor((F.length(value) - window) / BLOCK).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda k: value.substr(k * BLOCK + 1, F.lit(BLOCK + window - 1)))
    return F.array_join(F.transform(parts, slide), "")


def _entropy_spans(df: DataFrame, gate: Column, window: int, limits: dict[str, float], allowed: tuple[str, ...]) -> DataFrame:
    """Add ``marked``: (start, end, kind) of the spans of touching marked windows."""
    run = rf"[A-Za-z0-9+/_=-]{{{window},}}"
    none = F.array().cast("array<string>")
    df = _staged(df, {"runs": F.when(gate & F.col("text").rlike(run), F.regexp_extract_all("text", F.lit(run), F.lit(0))).otherwise(none)})
    suspect = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike("|".join(allowed))
    is_hex = lambda v: v.rlike(r"^[0-9A-Fa-f]+$")
    most = [F.lit(most_weight(limits[k], window)).cast("bigint") for k in ("entropy_hex", "entropy_base64")]

    def line(v):
        """A mark per character: 1 or 2, by class, where a marked window begins."""
        marks = F.when(is_hex(v), _marks(v, window, most[0])).otherwise(F.translate(_marks(v, window, most[1]), "1", "2"))
        return F.when(suspect(v), F.rpad(marks, F.length(v), F.lit("0"))).otherwise(F.repeat(F.lit("0"), F.length(v)))

    df = _staged(df, {"lines": F.transform("runs", line)})
    between = F.transform(F.split("text", run, -1), lambda b: F.repeat(F.lit("0"), F.length(b)))
    some = F.exists("lines", lambda x: x.rlike("[12]"))
    # as long as the text: marks of the candidates, zeros between
    whole_line = F.array_join(F.flatten(F.zip_with(between, "lines", lambda b, x: F.array(b, F.coalesce(x, F.lit(""))))), "")
    df = _staged(df, {"line": F.when(some, whole_line).otherwise("")})
    df = located(df, "islands", "line", "1+|2+")
    begins = lambda x, i: (i == 0) | (x["start"] > F.get("islands", i - 1)["end"] + window - 1)
    ends = lambda x, i: (i == F.size("islands") - 1) | (F.get("islands", i + 1)["start"] > x["end"] + window - 1)
    kind = lambda x: F.when(x["value"].startswith("1"), "entropy_hex").otherwise("entropy_base64")
    merged = F.zip_with(
        F.filter("islands", begins), F.filter("islands", ends),
        lambda a, b: F.struct(a["start"].alias("start"), (b["end"] + window - 1).alias("end"), kind(a).alias("kind")),
    )
    return _staged(df, {"marked": merged}).drop("runs", "lines", "line", "islands")


def scan(
    documents: DataFrame, window: int = WINDOW, limits: dict[str, float] | None = None, allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """doc_id, text, spans: one row per document; spans is an array of (start, end, kind), by start, then kind as in KINDS.

    Places are code points, ends are exclusive. Spans of the known patterns: the whole match, leftmost first, those of a
    kind without overlap; an assignment counts from eight characters of value on. Entropy spans are added to them and may
    lie inside one; the allow-list concerns entropy alone. NULL and empty texts have no spans. Rows are independent:
    repeated rows give repeated rows, an empty table none, other columns are ignored, texts of any length are read whole.
    """
    df = documents.select("doc_id", whole(F.col("text")).alias("text"))
    df = _staged(df, {"gate": F.col("text").rlike(KEY_RUN)})
    df = located(df, "assign", "text", ASSIGN)
    for name, pattern in (("access", ACCESS), ("hex", HEX)):
        df = located(df, name, "text", pattern, F.col("gate"))
    df = _entropy_spans(df, F.col("gate") if window >= 16 else F.lit(True), window, limits or LIMITS, allowed)
    valid = F.filter("assign", lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= ASSIGN_LEAST)
    order = F.create_map(*(F.lit(v) for k, name in enumerate(KINDS) for v in (name, k)))
    row = lambda start, end, kind: F.struct(start.alias("start"), F.element_at(order, kind).alias("place"), end.alias("end"), kind.alias("kind"))
    of = lambda name, found: F.transform(found, lambda x: row(x["start"], x["end"], F.lit(name)))
    added = F.transform("marked", lambda x: row(x["start"], x["end"], x["kind"]))
    spans = F.array_sort(F.concat(of("assign", valid), of("access", F.col("access")), of("hex", F.col("hex")), added))
    return df.select("doc_id", "text", F.transform(spans, lambda x: F.struct(x["start"], x["end"], x["kind"])).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))
