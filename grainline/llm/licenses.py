"""License scans: Dice coefficient of word bigrams between normalised text and license templates.

Each line of a text, and each text of several lines as a whole, is a unit, of whatever length. A unit of a bigrams and
a template of t can only reach the threshold s if a * (2 - s) >= t * s and t * (2 - s) >= a * s; units and templates
outside these bounds are never compared. The rest meet by equal bigrams.

Any other run of words is a unit, too, where no line it touches and not the whole text is a match of that license. The
equal bigrams of a whole text show whether it can hold such a run: k distinct ones that it shares must satisfy
k * (2 - s) >= t * s. Only those texts are searched: from each shared bigram on, the best coefficient over all ends.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.llm.common import settle, whole

THRESHOLD = 0.8
# Templates up to this many bigrams in all are sent to every task; more are left to a shuffled join.
BROADCAST_BIGRAMS = 200_000

# Texts of common license statements.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
# Whole licenses of which TEMPLATES has the beginning.
FULL_TEXTS = (
    (
        "MIT",
        dict(TEMPLATES)["MIT"]
        + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        + _AS_IS,
    ),
    (
        "BSD-3-Clause",
        dict(TEMPLATES)["BSD-3-Clause"]
        + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of "
        "the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        '"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY '
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
        "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT "
        "OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY "
        "OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        dict(TEMPLATES)["ISC"]
        + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
)
# Stands for a line that is a match itself; plain texts hold letters, digits, blanks and line ends only.
_CUT = "\u0001"


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*TEMPLATES, *FULL_TEXTS], "license_id string, text string")


def _plain(text):
    """Lower case; every run of other characters than letters, digits and line ends is one blank."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def _with_bigrams(units: DataFrame, least: float, distinct: bool = True) -> DataFrame:
    """Replace the plain text ``part`` by ``grams``, the hashes of its word bigrams; ``a`` is the number of distinct ones."""
    kept = [c for c in units.columns if c != "part"]
    # both arrays come out of a generator, as Spark would push a filter on a computed column into the expression and
    # then split the text again for each of its words
    split = units.select(*kept, F.explode(F.array(F.split(F.trim("part"), r"[ \n]+"))).alias("words")).where(F.size("words") > F.lit(max(1.0, least)))
    pairs = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1)))
    grams = F.slice(pairs, 1, F.size("words") - 1)
    grams = F.array_distinct(grams) if distinct else grams
    return split.select(*kept, F.explode(F.array(grams)).alias("grams")).withColumn("a", F.size(F.array_distinct("grams")))


def _let(value, use):
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _spans(ratio: float):
    """Per shared bigram of ``grams``: struct(minus, piece, first, last) of the best run of words that begins with it.

    Without loss a run ends with a shared bigram that is new in it and does not hold its first one again, so its
    bigrams are a prefix of the distinct ones from its start on, of at most t * ratio.
    """
    most = F.floor(F.col("t") * ratio).cast("int")
    shared = lambda g: F.array_contains("wanted", g)

    def longer(best, g):
        n, k = best["n"] + 1, best["k"] + F.when(shared(g), 1).otherwise(0)
        better = shared(g) & (k * (best["best_n"] + F.col("t")) > best["best_k"] * (n + F.col("t")))
        return F.struct(
            n.alias("n"),
            k.alias("k"),
            F.when(better, n).otherwise(best["best_n"]).alias("best_n"),
            F.when(better, k).otherwise(best["best_k"]).alias("best_k"),
        )

    def run(p, length):
        # the distinct bigrams from p on; nearly always a short stretch has enough of them
        near = F.slice("grams", p, F.least(length, 4 * most))
        new = F.slice(F.array_distinct(F.when(F.size(F.array_distinct(near)) >= most, near).otherwise(F.slice("grams", p, length))), 1, most)
        zero = F.struct(*(F.lit(0).alias(c) for c in ("n", "k", "best_n", "best_k")))
        return _let(
            new,
            lambda d: _let(
                F.aggregate(d, zero, longer),
                lambda best: F.struct(
                    (-2 * best["best_k"] / (best["best_n"] + F.col("t"))).alias("minus"),
                    F.col("piece").alias("piece"),
                    p.alias("first"),
                    (p + F.array_position(F.slice("grams", p, length), F.get(d, best["best_n"] - 1)).cast("int")).alias("last"),
                ),
            ),
        )

    def from_start(p):
        again = F.array_position(F.slice("grams", p + 1, F.size("grams")), F.get("grams", p - 1)).cast("int")
        return _let(F.when(again > 0, again).otherwise(F.size("grams") - p + 1), lambda length: run(p, length))

    return F.transform(F.filter(F.sequence(F.lit(1), F.size("grams")), lambda p: shared(F.get("grams", p - 1))), from_start)


def _apart(spans):
    """The spans, sorted, without those that share a word with one before."""
    none = F.filter(spans, lambda x: F.lit(False))
    meets = lambda x: lambda y: (x["piece"] == y["piece"]) & (x["first"] <= y["last"]) & (y["first"] <= x["last"])
    return F.aggregate(F.array_sort(spans), none, lambda kept, x: F.when(F.exists(kept, meets(x)), kept).otherwise(F.array_append(kept, x)))


def matches(documents: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, unit, license_id, dice for each unit that reaches the threshold.

    Unit 0 is the whole text, 1.. are its lines; -1, -2.. are other runs of words, numbered for each license by
    coefficient. No two runs of a license share a word, nor does a run touch a line or text that is a match of it.
    """
    plain = templates.select("license_id", _plain(whole(F.col("text"))).alias("part"))
    arrays = _with_bigrams(plain.select("license_id", F.xxhash64("part").alias("template"), "part").distinct(), 1)
    known = arrays.select("license_id", "template", F.col("a").alias("t"), F.explode("grams").alias("gram"))
    bounds = known.agg(F.min("t").alias("least"), F.max("t").alias("most"), F.count("*").alias("n")).first()
    # a little wider than the exact bounds, which rounding could put on the wrong side; the coefficient itself decides
    ratio = (2 - threshold) / threshold * (1 + 1e-9)
    least, most = (bounds["least"] or 0) / ratio, (bounds["most"] or 0) * ratio
    lines = F.split("plain", "\n")
    texts = documents.select("doc_id", _plain(whole(F.col("text"))).alias("plain"))
    parts = texts.select(
        "doc_id",
        F.xxhash64("plain").alias("key"),
        (F.size(lines) > 1).alias("several"),
        F.posexplode(F.concat(F.array("plain"), lines)).alias("unit", "part"),
    )
    rows = (
        _with_bigrams(parts, least, distinct=False)
        .where((F.col("unit") == 0) | F.col("a").between(least, most))
        .select("doc_id", "key", "several", "unit", "a", F.explode("grams").alias("gram"))
    )
    if bounds["n"] <= BROADCAST_BIGRAMS:
        known = F.broadcast(known)
    # distinct bigrams: rows that repeat an id with the same text count once
    shared = rows.join(known, "gram").groupBy("doc_id", "key", "several", "unit", "a", "license_id", "template", "t")
    held = shared.agg(F.size(F.collect_set("gram")).alias("k"), F.count("*").alias("n")).where(F.col("k") * ratio >= F.col("t"))
    scored = settle(
        held.withColumn("dice", 2 * F.col("k") / (F.col("a") + F.col("t"))).withColumn(
            "good", (F.col("dice") >= threshold) & ((F.col("unit") > 0) | F.col("several"))
        ),
        "license-units",
    )
    units = scored.where("good").select("doc_id", "unit", "license_id", "dice")

    per = scored.groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "license_id").agg(
        F.max(F.col("good") & (F.col("unit") == 0)).alias("done"),
        F.collect_set(F.when(F.col("good") & (F.col("unit") > 0), F.col("unit"))).alias("taken"),
        F.collect_list(F.struct("unit", "template", "t", "n")).alias("held"),
    )

    def beside(x):
        """At least as many shared bigrams as the text has outside the lines that are matches."""
        inside = F.filter("held", lambda y: (y["template"] == x["template"]) & F.array_contains("taken", y["unit"]))
        return x["n"] - F.aggregate(inside, F.lit(0).cast("bigint"), lambda total, y: total + y["n"])

    able = F.transform(F.filter("held", lambda x: (x["unit"] == 0) & (beside(x) * ratio >= x["t"])), lambda x: x["template"])
    # written, as its size decides whether it is sent to the texts or the texts are shuffled
    sought = settle(
        per.where(~F.col("done")).select("__id", "__key", "license_id", "taken", able.alias("templates")).where(F.size("templates") > 0),
        "license-sought",
    )
    found = texts.join(sought, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("plain") == F.col("__key")))
    left = F.transform(lines, lambda x, i: F.when(F.array_contains("taken", i + 1), _CUT).otherwise(x))
    pieces = found.select(
        "doc_id", "__key", "license_id", "templates", F.posexplode(F.split(F.array_join(left, "\n"), _CUT)).alias("piece", "part")
    )
    wanted = arrays.select("license_id", "template", F.col("a").alias("t"), F.col("grams").alias("wanted"))
    tried = (
        _with_bigrams(pieces, least, distinct=False)
        .withColumn("template", F.explode("templates"))
        .join(wanted, ["license_id", "template"])
        .where(F.size(F.array_intersect("grams", "wanted")) * ratio >= F.col("t"))
        .select("doc_id", "__key", "license_id", F.explode(F.array(_spans(ratio))).alias("spans"))
        .select("doc_id", "__key", "license_id", F.filter("spans", lambda x: -x["minus"] >= threshold).alias("spans"))
        .where(F.size("spans") > 0)
    )
    apart = tried.groupBy("doc_id", "__key", "license_id").agg(_apart(F.flatten(F.collect_list("spans"))).alias("spans"))
    runs = apart.select("doc_id", "license_id", F.posexplode("spans").alias("place", "span"))
    return units.unionByName(runs.select("doc_id", (-1 - F.col("place")).alias("unit"), "license_id", (-F.col("span.minus")).alias("dice")))


def scan(documents: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license_id, dice, n_matches per row of ``documents``: the best match, and how many units match.

    Ties go to the smaller license_id. NULL or empty texts, and texts without a match, have NULL, NULL and 0. A line
    or text that matches several licenses is one unit, runs of words are units of their license. Rows that share an id
    share their matches. An empty table gives no rows; an empty template table matches nothing.
    """
    templates = default_templates(documents.sparkSession) if templates is None else templates
    found = matches(documents, templates, threshold)
    # runs are numbered for each license
    place = F.struct("unit", F.when(F.col("unit") < 0, F.col("license_id")).alias("of"))
    best = found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.min(F.struct((-F.col("dice")).alias("minus"), "license_id")).alias("best"), F.count_distinct(place).alias("n")
    )
    return (
        documents.select("doc_id")
        .join(best, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
        .select(
            "doc_id",
            F.col("best.license_id").alias("license_id"),
            (-F.col("best.minus")).alias("dice"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n_matches"),
        )
    )
