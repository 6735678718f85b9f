"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features per text: densities of lexicon words (a given list, and word forms and word beginnings whose share of toxic
training documents is high), how near they stand to a second-person word, capitals, punctuation and obfuscation rates.
The lexicon, the trees and the calibration are learned from a bounded sample of labelled rows outside the held-out fold, by
cross-fitting.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainline.llm import tokens
from grainline.llm.common import remainder, settle, whole

# Bound of the fitting sample, in labelled documents.
SAMPLE = 40_000
# Training documents that an entry of a learned lexicon must occur in; the sample bounds how many there are.
LEAST_DOCUMENTS = 5
# Lengths of the word beginnings that are learned.
STEMS = (4, 5, 6, 7)
LIMIT = 0.7
TREES, DEPTH = 20, 4
# Parts of the sample, each judged by what was learned from the others.
PARTS = 3

# Common insults.
INSULTS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
# Second-person words of the languages in use.
SECOND_PERSON = ("du", "dich", "dein", "eres", "ihr", "te", "ti", "toi", "tu", "tú", "usted", "vous", "you", "your", "you're", "yourself")
FEATURES = (
    "insults", "insult_share", "forms", "form_share", *(f"stems_{k}" for k in STEMS), *(f"stem_share_{k}" for k in STEMS), "weight", "near_you", "you_share",
    "capitals", "punctuation", "marks_in_words", "repeated_words", "log_words",
)
NEAR = 3


def _bare(words):
    """Lower-case words without outer punctuation."""
    return pc.utf8_lower(pc.utf8_trim(words, r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""))


def _entries():
    """Rows (doc position in task, form or stem, kind) of distinct entries per labelled document."""

    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                found = tokens.Words(part.column("text"))
                if not len(found.ids):
                    continue
                bare = _bare(found.vocab)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
                for kind, values in (("form", bare), *((f"stem_{k}", pc.utf8_slice_codeunits(bare, 0, k)) for k in STEMS)):
                    coded = values.dictionary_encode()
                    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[found.ids]
                    pair = np.unique(found.doc * len(coded.dictionary) + ids)
                    which, hit = np.unique(pair % len(coded.dictionary), return_inverse=True)
                    n = np.bincount(hit, minlength=len(which))
                    bad = np.bincount(hit, toxic[pair // len(coded.dictionary)], len(which)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(which), "string"), coded.dictionary.take(pa.array(which)), pa.array(n.astype(np.int64)), pa.array(bad)],
                        ["kind", "entry", "n", "bad"],
                    )

    return run


def learn_lexicon(sample: DataFrame) -> dict[str, dict[str, float]]:
    """{form: {entry: log odds}, stem_4: ...}: the entries that mark toxic training documents."""
    base = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    found: dict[str, dict[str, float]] = {"form": {}, **{f"stem_{k}": {} for k in STEMS}}
    if not base["bad"] or base["bad"] == base["n"]:
        return found
    prior = float(np.log(base["bad"] / (base["n"] - base["bad"])))
    counts = sample.mapInArrow(_entries(), "kind string, entry string, n bigint, bad bigint").groupBy("kind", "entry").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    odds = F.log((F.col("bad") + 0.5) / (F.col("n") - F.col("bad") + 0.5)) - F.lit(prior)
    marked = counts.where((F.col("n") >= LEAST_DOCUMENTS) & (F.length("entry") > 2)).withColumn("odds", odds).where("odds > 1")
    for r in marked.select("kind", "entry", "odds").collect():
        found[r["kind"]][r["entry"]] = r["odds"]
    return found


def _per_word(values, table):
    """The table's value of each string, 0 where it has none: one lookup of all strings."""
    weights = np.append(np.fromiter(table.values(), np.float64, len(table)), 0.0)
    at = pc.index_in(values, value_set=pa.array(list(table), pa.string()))
    return weights[at.fill_null(len(table)).to_numpy(zero_copy_only=False)]


def features_of(texts: pa.Array, lexicon) -> np.ndarray:
    """One row of FEATURES per text; zeros for an empty one."""
    found = tokens.Words(texts)
    n_docs, ids, doc = len(texts), found.ids, found.doc
    bare = _bare(found.vocab)
    insult = _per_word(bare, dict.fromkeys(INSULTS, 1.0))[ids]
    form = _per_word(bare, lexicon["form"])[ids]
    stems = [_per_word(pc.utf8_slice_codeunits(bare, 0, k), lexicon[f"stem_{k}"])[ids] for k in STEMS]
    you = _per_word(bare, dict.fromkeys(SECOND_PERSON, 1.0))[ids]
    inner = pc.match_substring_regex(bare, r"\p{L}[^\p{L}\s'-]+\p{L}")
    inner = pc.or_(inner, pc.match_substring_regex(found.vocab, r"[\p{L}].*(?:[#$%&*@]{2,})")).to_numpy(zero_copy_only=False).astype(float)[ids]
    upper = pc.utf8_is_upper(found.vocab).to_numpy(zero_copy_only=False).astype(float)[ids]
    marks = pc.count_substring_regex(found.vocab, r"[\p{P}\p{S}]").to_numpy(zero_copy_only=False).astype(float)[ids]
    sizes = pc.utf8_length(found.vocab).to_numpy(zero_copy_only=False).astype(float)[ids]
    # a lexicon word within NEAR words of a second-person word of the same text
    hot = (insult > 0) | (form > 2)
    near = np.zeros(len(ids))
    for step in range(1, NEAR + 1):
        if len(ids) > step:
            same = doc[step:] == doc[:-step]
            near[step:] = np.maximum(near[step:], hot[step:] * you[:-step] * same)
            near[:-step] = np.maximum(near[:-step], hot[:-step] * you[step:] * same)
    again = np.zeros(len(ids))
    if len(ids) > 1:
        again[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    count = np.bincount(doc, minlength=n_docs).astype(float)
    safe = np.maximum(count, 1)
    total = lambda x: np.bincount(doc, x, n_docs)
    form_hit, stem_hits = total((form > 1).astype(float)), [total((s > 1).astype(float)) for s in stems]
    return np.column_stack(
        [
            total(insult), total(insult) / safe, form_hit, form_hit / safe, *stem_hits, *(h / safe for h in stem_hits), total(form + sum(stems)) / safe,
            total(near) / safe, total(you) / safe, total(upper) / safe, total(marks) / np.maximum(total(sizes), 1),
            total(inner) / safe, total(again) / safe, np.log1p(count),
        ]
    )


def _featurize(lexicon, extra):
    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                rows = features_of(pc.fill_null(part.column("text"), ""), lexicon)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in extra), *(pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(FEATURES)))], [*extra, *FEATURES]
                )

    return run


def featurize(rows: DataFrame, lexicon, extra: list[str]) -> DataFrame:
    """The columns ``extra`` of ``rows`` and one double per feature of ``text``."""
    schema = T.StructType([*(rows.schema[n] for n in extra), *(T.StructField(n, T.DoubleType()) for n in FEATURES)])
    return rows.select(*extra, "text").mapInArrow(_featurize(lexicon, extra), schema)


class Model:
    """Lexicon, trees and calibration; without both labels in the sample, a constant."""

    def __init__(self, lexicon, trees, calibration, constant):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant


def _assembled(rows):
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def _raw(trees, rows):
    scored = trees.transform(_assembled(rows))
    return scored.withColumn("raw", F.element_at(vector_to_array("probability"), 2)).drop("features", "rawPrediction", "probability", "prediction")


def labelled(documents: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, bound: int = SAMPLE) -> DataFrame:
    """id, text, toxic, part of a bounded sample of labelled ids outside the held-out fold; part 0 to PARTS - 1 by hash of the id.

    Of labels that repeat an id the larger counts, of documents that repeat one the smallest text; labels without a value
    are left out. So the sample has at most about ``bound`` rows.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(remainder(F.col("__id"), modulus) != held_out)
    n = known.count()
    place = F.pmod(F.xxhash64("__id", F.lit("toxic-sample")), F.lit(1 << 30)) / F.lit(1 << 30)
    chosen = known.where(place * F.lit(float(n)) < bound)
    # about ``bound`` ids, so the texts need not be shuffled to meet them
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    one = rows.groupBy(F.col("__id").alias("id")).agg(F.min(whole(F.col("text"))).alias("text"), F.first("toxic").alias("toxic"))
    return one.withColumn("part", F.pmod(F.xxhash64("id", F.lit("toxic-part")), F.lit(PARTS)).cast("int"))


def _trees(rows):
    """Boosted trees on rows in the order of their ids, in one partition: at most the sample, whatever its layout was."""
    train = _assembled(rows).select("id", "features", F.col("toxic").cast("double").alias("label")).repartition(1).sortWithinPartitions("id")
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, minInstancesPerNode=5).fit(train)


def _both(rows) -> bool:
    return rows.agg(F.count_distinct("toxic")).first()[0] == 2


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, bound: int = SAMPLE) -> Model:
    """Learn lexicon, trees and calibration from all rows of the sample, each from what it has not shaped.

    A lexicon is learned from the other parts for the features of each part, so the trees learn from features as they are
    on new texts; texts to be scored are looked up in the lexicon of all parts. The calibration sees every row with the
    score of trees fitted on the other parts. A part of which the others hold one label alone is left out of it.
    """
    sample = settle(labelled(documents, labels, modulus, held_out, bound), "toxic-sample")
    share = sample.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
    lexicon = learn_lexicon(sample)
    if not _both(sample):
        return Model(lexicon, None, None, float(share))
    own = [featurize(sample.where(F.col("part") == k), learn_lexicon(sample.where(F.col("part") != k)), ["id", "toxic", "part"]) for k in range(PARTS)]
    rows = settle(reduce(DataFrame.unionByName, own), "toxic-features")
    trees, apart = _trees(rows), []
    for k in range(PARTS):
        others = rows.where(F.col("part") != k)
        if _both(others):
            apart.append(_raw(_trees(others), rows.where(F.col("part") == k)).select("id", "toxic", F.col("toxic").cast("double").alias("label"), "raw"))
    if not apart:
        return Model(lexicon, trees, None, float(share))
    seen = settle(reduce(DataFrame.unionByName, apart), "toxic-apart").repartition(1).sortWithinPartitions("raw", "id")
    if not _both(seen):
        return Model(lexicon, trees, None, float(share))
    return Model(lexicon, trees, IsotonicRegression(featuresCol="raw", labelCol="label").fit(seen), float(share))


def _scored(rows: DataFrame, model: Model, extra: list[str]) -> DataFrame:
    """The columns ``extra`` and the score of each row's text."""
    if model.trees is None:
        return rows.select(*extra, F.lit(model.constant).alias("score"))
    out = _raw(model.trees, featurize(rows, model.lexicon, extra))
    value = F.col("raw")
    if model.calibration is not None:
        out = model.calibration.transform(out)
        value = 0.98 * F.col("prediction") + 0.02 * F.col("raw")
    return out.select(*extra, F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)).alias("score"))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted per row, from the text alone; NULL texts score like empty ones.

    The score is the calibrated probability of a toxic label; a small part of the trees' own probability keeps the
    order within the steps of the calibration. ``predicted`` is 1 from a score of 0.7. Rows with equal texts score the
    same. Without both labels in the sample every score is the share of toxic labels. An empty table gives no rows.
    """
    found = _scored(documents.select("doc_id", "text"), model, ["doc_id"])
    return found.withColumn("predicted", F.when(F.col("score") >= LIMIT, 1).otherwise(0))


def reject(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not predicted toxic. The rows pass through the scoring, no join."""
    model = fit(documents, labels)
    rows = documents.select(F.struct(*(documents[c] for c in documents.columns)).alias("row"), "text")
    return _scored(rows, model, ["row"]).where(F.col("score") < LIMIT).select("row.*")
