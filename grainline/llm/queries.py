"""The registered queries of this subpackage and, where SQL can express them, their check."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainline.llm import backoff, chat, checks, decontaminate, divergence, exact_dedup, infill, language, licenses, mixing, ngram_join, secrets, substrings, toxicity
from grainline.llm.common import remainder
from grainline.session import load

QUERIES = {}
CHECKS = {}


def query(name, sql=None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return run

    return register


@query(
    "op1_chat_formatting",
    """WITH d AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
    t AS (SELECT *, CASE WHEN conv_id IS NULL THEN 'row ' || row_number() OVER () ELSE 'id ' || conv_id END AS conv FROM d),
    o AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv) AS n_turns,
      string_agg(role || chr(1) || text, chr(2)) OVER w AS prefix
      FROM t WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
    f AS (SELECT md5(prefix) AS p, n_turns, min(conv_id) AS conv_id, arg_min(conv, (conv_id IS NULL, conv_id)) AS conv, count(*) AS n_copies
      FROM o WHERE place = n_turns GROUP BY 1, 2),
    s AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.place < o.n_turns AND o.place = f.n_turns AND md5(o.prefix) = f.p))
    SELECT s.conv_id, s.n_turns, s.n_copies,
      string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
    FROM s JOIN o ON o.conv = s.conv GROUP BY s.conv, 1, 2, 3""",
)
def op1_chat_formatting(spark, folder):
    return chat.format_chats(load(spark, folder, "conversations"))


@query(
    "op3_exact_dedup",
    r"""WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]+', '', 'g') AS c FROM documents),
    k AS (SELECT doc_id, c, first_value(doc_id) OVER (PARTITION BY c ORDER BY n DESC, doc_id) AS keep_id,
      count(*) OVER (PARTITION BY c) AS group_size FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(c) AS text_sha256 FROM k""",
)
def op3_exact_dedup(spark, folder):
    found = exact_dedup.classes(load(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_source_mixing", checks.MIXING)
def op5_source_mixing(spark, folder):
    found = mixing.mix(load(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query("op7_license_scan", checks.LICENSES)
def op7_license_scan(spark, folder):
    return licenses.scan(load(spark, folder, "documents"))


@query("op4_language_id")
def op4_language_id(spark, folder):
    documents = load(spark, folder, "documents")
    found = language.identify(documents, language.fit(documents, modulus=4, held_out=2))
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op6_toxicity")
def op6_toxicity(spark, folder):
    documents = load(spark, folder, "documents")
    model = toxicity.fit(documents, load(spark, folder, "labels"), modulus=3, held_out=1)
    found = toxicity.score(documents, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query("op9_ngram_jaccard_join", checks.JACCARD)
def op9_ngram_jaccard_join(spark, folder):
    return ngram_join.join(load(spark, folder, "documents"), size=3, num=90, den=100)


@query("op10_benchmark_decontamination")
def op10_benchmark_decontamination(spark, folder):
    return decontaminate.findings(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query(
    "op2_substring_dedup",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
    x AS (SELECT doc_id, i, CASE WHEN i + 12 <= len(ws) THEN md5(array_to_string(ws[i:i + 12], ' ')) END AS h, ws[i] AS word FROM p),
    m AS (SELECT h, min(doc_id) AS first_doc FROM x WHERE h IS NOT NULL GROUP BY h),
    g AS (SELECT x.doc_id, x.i, word, CASE WHEN first_doc < x.doc_id THEN 1 ELSE 0 END AS hit FROM x LEFT JOIN m ON x.h = m.h),
    c AS (SELECT doc_id, i, word, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM g),
    k AS (SELECT doc_id, count(*) FILTER (WHERE gone = 1) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN k ON w.doc_id = k.doc_id""",
)
def op2_substring_dedup(spark, folder):
    found = substrings.remove_repeats(load(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op8_lm_scoring",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
    x AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i > 1 THEN ws[i - 1] END AS prev FROM p),
    u AS (SELECT word, count(*) AS n FROM x GROUP BY word), b AS (SELECT prev, word, count(*) AS n FROM x WHERE prev IS NOT NULL GROUP BY 1, 2),
    s AS (SELECT x.doc_id, CASE WHEN x.prev IS NULL THEN ln(u.n / (SELECT count(*) FROM x)) WHEN b.n >= 2 THEN ln(b.n / v.n)
      ELSE ln(u.n / (SELECT count(*) FROM x)) + ln(0.4) END AS ls
      FROM x JOIN u ON u.word = x.word LEFT JOIN u v ON v.word = x.prev LEFT JOIN b ON b.prev = x.prev AND b.word = x.word),
    t AS (SELECT doc_id, sum(ls) AS ls FROM s GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(coalesce(ls, 0), 4) AS log_score, round(ls / len(ws), 6) AS mean_log_score
    FROM w LEFT JOIN t ON w.doc_id = t.doc_id""",
)
def op8_lm_scoring(spark, folder):
    found = backoff.score(load(spark, folder, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


@query("op11_fill_in_middle", checks.INFILL)
def op11_fill_in_middle(spark, folder):
    found = infill.transform(load(spark, folder, "documents"), unit="line", rate=100, spm=50, seed=7)
    restored = infill.restore(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


@query("op12_secret_scan", checks.SECRETS)
def op12_secret_scan(spark, folder):
    found = secrets.scan(load(spark, folder, "documents"))
    base = ("assign", "access", "hex")
    count = lambda kind: F.size(secrets.of_kinds(F.col("spans"), (kind,))).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in base),
        F.sha2(secrets.listed(secrets.of_kinds(F.col("spans"), base)), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


@query("op13_source_divergence", checks.DIVERGENCE)
def op13_source_divergence(spark, folder):
    return divergence.audit(load(spark, folder, "documents"), least=3, top=200)
