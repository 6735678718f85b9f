"""Language identification by interpolated Kneser-Ney character models.

One model per language over the characters of lower-case words with their boundaries: "   word " is scored character by
character, each from those before it. Probabilities are interpolated Kneser-Ney and stored per order as one array of
sorted n-gram hashes with a column per language. The language of the lowest cross-entropy per character wins; its score
is a softmax whose temperature, and the rejection limit, are calibrated on training documents kept out of the counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm import tokens
from grainline.llm.common import remainder, settle

ORDER = 4
# Bound of the fitting sample: documents per language, by hash of the id, about four fifths for counts.
SAMPLE_PER_LANGUAGE = 2000
# Bound of the model: word forms of one language, the most frequent ones of its sample.
FORMS_PER_LANGUAGE = 200_000
REJECT_QUANTILE = 0.999
UNKNOWN = "und"
START, END = " ", " "


def _hash(gram):
    return np.uint64(xxhash.xxh3_64_intdigest(gram.encode()))


def _found(keys, grams):
    """(whether each n-gram is in the sorted hashes, its place)."""
    if not len(grams) or not len(keys):
        return np.zeros(len(grams), bool), np.zeros(len(grams), np.int64)
    wanted = np.array([_hash(g) for g in grams], np.uint64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def training_rows(documents: DataFrame, modulus: int = 4, held_out: int = 2, bound: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """lang, text, tune of a bounded sample: documents with a language and a text outside the held-out fold.

    Per language about ``bound`` documents, those with the smallest hashes of their id; a fifth of them is for tuning.
    """
    usable = documents.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), modulus) != held_out))
    per = usable.groupBy(F.col("lang").alias("__lang")).agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("lang-sample")), F.lit(1 << 30)) / F.lit(1 << 30)
    # one row per language, as many as the model has columns: the texts stay where they are
    return usable.join(F.broadcast(per), usable["lang"] == F.col("__lang")).where(place * F.col("n") < bound).select(
        "lang", "text", (F.pmod(F.xxhash64("doc_id", F.lit("lang-tune")), F.lit(5)) == 0).alias("tune")
    )


def _counted_forms():
    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                found = tokens.Words(pc.utf8_lower(part.column("text")))
                if not len(found.ids):
                    continue
                langs = part.column("lang").dictionary_encode()
                which = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[found.doc]
                pair, n = np.unique(which * len(found.vocab) + found.ids, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(pair // len(found.vocab))), found.vocab.take(pa.array(pair % len(found.vocab))), pa.array(n.astype(np.int64))],
                    ["lang", "form", "n"],
                )

    return run


class KneserNey:
    """Counts of one language and its interpolated probabilities P(c | h) = (n(hc) - D)+ / n(h) + D t(h) / n(h) P(c | h')."""

    def __init__(self, forms: dict[str, int], order: int):
        self.order = order
        full: dict[str, float] = {}
        for form, n in forms.items():
            text = START * (order - 1) + form + END
            for k in range(len(text) - order + 1):
                gram = text[k : k + order]
                full[gram] = full.get(gram, 0) + n
        levels = [full]
        for _ in range(order - 1):
            lower: dict[str, float] = {}
            for gram in levels[0]:
                lower[gram[1:]] = lower.get(gram[1:], 0) + 1  # continuations: distinct characters before it
            levels.insert(0, lower)
        self.grams = levels
        self.context, self.types, self.discount = [], [], []
        for level in levels:
            total: dict[str, float] = {}
            kinds: dict[str, int] = {}
            for gram, n in level.items():
                total[gram[:-1]] = total.get(gram[:-1], 0) + n
                kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
            ones, twos = sum(n == 1 for n in level.values()), sum(n == 2 for n in level.values())
            self.discount.append(ones / (ones + 2 * twos) if ones and twos else 0.5)
            self.context.append(total)
            self.types.append(kinds)
        self.floor = 1.0 / (len(levels[0]) + 1000)

    def probability(self, gram: str) -> float:
        """P of the last character after the others; a gram of any length up to the order."""
        p = self.floor
        for k in range(len(gram)):
            part = gram[len(gram) - 1 - k :]
            total = self.context[k].get(part[:-1], 0)
            if total:
                d = self.discount[k]
                p = max(self.grams[k].get(part, 0) - d, 0) / total + d * self.types[k][part[:-1]] / total * p
        return p

    def weight(self, context: str) -> float:
        """What the next shorter context gets where a character was never seen after this one; 1 after an unseen context."""
        k = len(context)
        total = self.context[k].get(context, 0)
        return self.discount[k] * self.types[k][context] / total if total else 1.0


class Model:
    """Sorted hash arrays of all n-grams of each order, with log probabilities per language."""

    def __init__(self, forms: dict[str, dict[str, int]], order: int = ORDER):
        self.languages = sorted(forms)
        self.order = order
        models = [KneserNey(forms[x], order) for x in self.languages]
        self.levels = []
        for k in range(order):
            grams = sorted(set().union(*(m.grams[k] for m in models)))
            keys = np.array([_hash(g) for g in grams], np.uint64)
            values = np.array([[np.log(m.probability(g)) for m in models] for g in grams], np.float32).reshape(len(grams), len(models))
            at = np.argsort(keys)
            contexts = sorted(set().union(*(m.context[k] for m in models)))
            left = np.array([_hash(c) for c in contexts], np.uint64)
            weights = np.array([[np.log(m.weight(c)) for m in models] for c in contexts], np.float32).reshape(len(contexts), len(models))
            by = np.argsort(left)
            self.levels.append((keys[at], values[at], left[by], weights[by]))
        self.unseen = np.array([np.log(m.floor) for m in models], np.float32)
        self.temperature, self.limit = 1.0, np.full(len(models), np.inf)

    def form_scores(self, forms: list[str]):
        """Log probability per language of each word form, and its number of characters with the end."""
        pad, order = START * (self.order - 1), self.order
        texts = [pad + f + END for f in forms]
        sizes = np.array([len(t) - order + 1 for t in texts], np.int64)
        table: dict[str, int] = {}
        ids = np.fromiter((table.setdefault(t[k : k + order], len(table)) for t in texts for k in range(len(t) - order + 1)), np.int64, int(sizes.sum()))
        grams = list(table)
        score = np.zeros((len(grams), len(self.languages)), np.float32)
        open_ = np.arange(len(grams))
        for k in range(order - 1, -1, -1):
            keys, values, contexts, weights = self.levels[k]
            hit, at = _found(keys, [grams[i][order - 1 - k :] for i in open_])
            score[open_[hit]] += values[at[hit]]
            open_ = open_[~hit]
            seen, at = _found(contexts, [grams[i][order - 1 - k : -1] for i in open_])
            score[open_[seen]] += weights[at[seen]]
        score[open_] += self.unseen
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return np.add.reduceat(score[ids], ends[:-1], axis=0) if len(ids) else np.zeros((0, len(self.languages))), sizes

    def entropies(self, texts: pa.Array):
        """Nats per character of each text under each language; NaN without a word."""
        found = tokens.Words(pc.utf8_lower(pc.fill_null(texts, "")))
        n = len(texts)
        out = np.full((n, len(self.languages)), np.nan)
        if not len(found.ids):
            return out
        score, sizes = self.form_scores(found.vocab.to_pylist())
        chars = np.bincount(found.doc, sizes[found.ids], n)
        some = chars > 0
        for k in range(len(self.languages)):
            out[some, k] = -np.bincount(found.doc, score[found.ids, k], n)[some] / chars[some]
        return out

    def decide(self, entropies: np.ndarray):
        """(language position, score, rejected) per row of entropies."""
        filled = np.nan_to_num(entropies, nan=0.0)
        best = filled.argmin(axis=1)
        gap = -(filled - filled.min(axis=1, keepdims=True)) / self.temperature
        return best, 1 / np.exp(gap).sum(axis=1), filled.min(axis=1) > self.limit[best]


def calibrate(model: Model, texts: pa.Array, langs: list[str]) -> Model:
    """Set the temperature of least log loss and the rejection limits from tuning documents."""
    rows = model.entropies(texts)
    known = {x: k for k, x in enumerate(model.languages)}
    truth = np.array([known.get(x, -1) for x in langs], np.int64)
    use = (truth >= 0) & ~np.isnan(rows).any(axis=1)
    rows, truth = rows[use], truth[use]
    if not len(rows):
        return model
    losses = []
    for t in (choices := np.geomspace(0.003, 3, 40)):
        gap = -(rows - rows.min(axis=1, keepdims=True)) / t
        losses.append(float(np.mean(np.log(np.exp(gap).sum(axis=1)) - gap[np.arange(len(rows)), truth])))
    model.temperature = float(choices[int(np.argmin(losses))])
    for k in range(len(model.languages)):
        own = rows[truth == k, k]
        if len(own):
            model.limit[k] = np.quantile(own, REJECT_QUANTILE)
    return model


def fit(documents: DataFrame, modulus: int = 4, held_out: int = 2, bound: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from a bounded sample. Only its counted word forms and its tuning fifth reach the driver, both bounded."""
    sample = settle(training_rows(documents, modulus, held_out, bound), "lang-sample")
    counted = sample.where("not tune").mapInArrow(_counted_forms(), "lang string, form string, n bigint")
    totals = counted.groupBy("lang", "form").agg(F.sum("n").alias("n"))
    forms: dict[str, dict[str, int]] = {}
    for (lang,) in sample.select("lang").distinct().collect():
        top = totals.where(F.col("lang") == lang).orderBy(F.desc("n"), "form").limit(FORMS_PER_LANGUAGE).select("form", "n").toArrow()
        forms[lang] = dict(zip(top.column("form").to_pylist(), top.column("n").to_pylist()))
    model = Model(forms)
    tune = sample.where("tune").select("lang", "text").toArrow()
    return calibrate(model, tune.column("text").combine_chunks(), tune.column("lang").to_pylist())


def _predict(model):
    def run(batches):
        names = pa.array([*model.languages, UNKNOWN])
        for batch in batches:
            for part in tokens.slices(batch):
                texts = part.column("text")
                best, score, rejected = model.decide(model.entropies(texts))
                letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                none = ~letters | (not model.languages)
                best, score, rejected = np.where(none, len(model.languages), best), np.where(none, 0.0, score), np.where(none, True, rejected)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), names.take(pa.array(best)), pa.array(score.astype(float)), pa.array(rejected.astype(bool))],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    return run


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected per row, from the text alone.

    NULL texts and texts without a letter are 'und' with score 0, rejected. A text is also rejected when its best
    cross-entropy is above nearly all tuning documents of that language; the closest language is still named. Ties go to
    the language that sorts first. Without any labelled document all rows are 'und'. An empty table gives no rows.
    """
    if not model.languages:
        return documents.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
        )
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(_predict(model), f"doc_id {kind}, lang_pred string, score double, rejected boolean")
