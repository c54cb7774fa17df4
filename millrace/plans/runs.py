"""Queries on generation runs and vocabularies."""

import hashlib

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicon import FIXTURE as LEX
from ..operators import runs, segment, tokenize
from ..sources.shared import stored
from . import sql as S
from .cleaning import docs
from .passages import NARRATIVE, _PASSAGES, _reason_sql, theme_tag

QUESTION_TEMPLATE = "Q:{passage}"
ANSWER_NARRATIVE, ANSWER_REFERENCE = "N:{question}|{passage}", "R:{question}|{passage}"


def _hex(s: str) -> str:
    return hashlib.md5(s.encode()).hexdigest()


# Stand-ins for the two models: what they say follows from the digest of the prompt, so that SQL can say the same.
def ask_stub():
    def one(prompt: str) -> str | None:
        h = _hex(prompt)
        if h[0] in "01":
            return None
        return ' "SKIP" ' if h[0] in "23" else f"Court {h[:4]} ?" if h[0] == "4" else "Pourquoi " + " ".join(h[i : i + 4] for i in range(0, 32, 4)) + " ?"

    return lambda prompts: [one(p) for p in prompts]


def answer_stub():
    def one(prompt: str) -> str | None:
        h = _hex(prompt)
        if h[0] in "01":
            return None
        if h[0] in "23":
            return prompt.partition("|")[2] + "</s>"
        return " ".join(h[i : i + 2] for i in range(0, 32, 2)) + (" mot" * (30 if h[0] in "45" else 60)) + ("." if h[0] != "6" else "")

    return lambda prompts: [one(p) for p in prompts]


def _run(spark, sf_dir):
    from .passages import passages

    kept = theme_tag(spark, sf_dir).where("reason = 'kept'").select("doc_id", "pos", "tag")
    p = passages(spark, sf_dir).join(kept, ["doc_id", "pos"]).select("doc_id", "pos", "source", F.col("tag").alias("theme_tag"), "passage")
    template = F.when(F.col("source").isin(NARRATIVE), F.lit(ANSWER_NARRATIVE)).otherwise(F.lit(ANSWER_REFERENCE))

    return runs.run_pairs(p, LEX, ask_stub, answer_stub, QUESTION_TEMPLATE, template, stored, question_model="stub-q", answer_model="stub-a")


def generation_metadata(spark, sf_dir):
    m = runs.metadata(_run(spark, sf_dir), "doc_id", "pos", "source", "theme_tag")
    return m.withColumn("question", F.coalesce("question", F.lit("")))


def generation_records(spark, sf_dir):
    r = runs.records(_run(spark, sf_dir), "doc_id", "pos")
    return r.select("doc_id", "pos", F.md5(F.concat(F.get("messages", F.lit(0))["content"], F.lit("|"), F.get("messages", F.lit(1))["content"])).alias("pair_md5"))


_PARTS4 = " || ' ' || ".join(f"substr(h, {i}, 4)" for i in range(1, 33, 4))
_PARTS2 = " || ' ' || ".join(f"substr(k, {i}, 2)" for i in range(1, 33, 2))
_TOK = "regexp_extract_all(lower({c}), '[a-zà-ÿ]+')"
_TRI = "CASE WHEN len({t}) < 3 THEN [] ELSE list_distinct(list_transform(range(1, len({t}) - 1), lambda i: {t}[i] || ' ' || {t}[i + 1] || ' ' || {t}[i + 2])) END"
_RUN = rf"""{_PASSAGES},
d0 AS (SELECT *, {_reason_sql(False)} AS r, {S.contains("l", LEX.light)} AS light, {S.contains("l", LEX.dark)} AS dark, {S.contains("l", LEX.spiritual)} AS spirit FROM c),
d1 AS (SELECT doc_id, pos, source, passage, CASE WHEN source IN ('src11', 'src12') AND spirit >= 1 THEN 'spiritual_luminous' WHEN light >= 2 AND dark = 0 THEN 'light_luminous'
       WHEN source IN ('src5', 'src6', 'src7', 'src8', 'src9', 'src10') AND light >= 1 AND dark <= 1 THEN 'light_priority' END AS theme_tag FROM d0 WHERE r = 'kept'),
d2 AS (SELECT *, md5('Q:' || passage) AS h FROM d1 WHERE theme_tag IS NOT NULL),
d3 AS (SELECT *, CASE WHEN h[1] IN ('0', '1') THEN '' WHEN h[1] IN ('2', '3') THEN 'SKIP' WHEN h[1] = '4' THEN 'Court ' || substr(h, 1, 4) || ' ?' ELSE 'Pourquoi ' || {_PARTS4} || ' ?' END AS q FROM d2),
d4 AS (SELECT *, CASE WHEN q = '' THEN 'api_error_question' WHEN q = 'SKIP' THEN 'skip_question_model' WHEN h[1] = '4' OR {S.any_hit("lower(q)", LEX.question_reject)} THEN 'invalid_question' END AS gate,
       md5(CASE WHEN source IN ({", ".join(map(S.q, NARRATIVE))}) THEN 'N:' ELSE 'R:' END || q || '|' || passage) AS k FROM d3),
d5 AS (SELECT *, CASE WHEN gate IS NOT NULL OR k[1] IN ('0', '1') THEN '' WHEN k[1] IN ('2', '3') THEN passage ELSE {_PARTS2} || repeat(' mot', CASE WHEN k[1] IN ('4', '5') THEN 30 ELSE 60 END) || CASE WHEN k[1] <> '6' THEN '.' ELSE '' END END AS a FROM d4),
d6 AS (SELECT *, {S.wc("a")} AS n, {_TOK.format(c="passage")} AS sw, {_TOK.format(c="a")} AS aw FROM d5),
d7 AS (SELECT *, CASE WHEN len(sw) >= 6 AND len(aw) >= 6 THEN len(list_intersect({_TRI.format(t="sw")}, {_TRI.format(t="aw")})) / len({_TRI.format(t="aw")}) > 0.30 ELSE false END AS copied FROM d6),
run AS (SELECT *, CASE WHEN gate IS NOT NULL THEN gate WHEN a = '' THEN 'local_error_answer' WHEN copied THEN 'copy' WHEN n < 50 THEN 'invalid_answer:too_short' WHEN {S.any_hit("lower(a)", LEX.answer_reject, "m")} THEN 'invalid_answer:pattern'
        WHEN right(a, 1) NOT IN ('.', '!', '?', '…') THEN 'invalid_answer:truncated' ELSE 'ok' END AS status FROM d7)"""


def vocabulary_windows(spark, sf_dir, path: str | None = None):
    """Token windows of a real vocabulary; the text of one window is the decoded ids, of a short document its own."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    d = tokenize.encode(docs(spark, sf_dir).select("doc_id", "text"), "text", path)
    own = F.when(F.size("token_ids") <= 2048, F.md5("text"))
    w = segment.token_windows(d.withColumn("own", own).drop("text"), F.col("token_ids"))
    w = w.select("doc_id", "pos", "own", F.size("tokens").cast("long").alias("n_tokens"), F.when(F.col("own").isNull(), F.col("tokens")).alias("tokens"))
    w = tokenize.decode(w, "tokens", path)
    return w.select("doc_id", "pos", "n_tokens", F.coalesce("own", F.md5("decoded")).alias("text_md5"))


def dry_run_sample(spark, sf_dir):
    """Fifteen passages of the shuffled order with a preview; nothing is written."""
    from .passages import passages

    p = passages(spark, sf_dir).withColumn("shuffle_key", F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"), F.lit(":"), F.col("pos").cast("string"))))
    return p.orderBy("shuffle_key", "doc_id", "pos").limit(15).select("doc_id", "pos", T.preview(F.col("passage"), 220).alias("preview"))


QUERIES = {"generation_metadata": generation_metadata, "generation_records": generation_records, "dry_run_sample": dry_run_sample, "vocabulary_windows": vocabulary_windows}
SQL = {
    "generation_metadata": f"{_RUN} SELECT doc_id, pos::INT AS pos, source, theme_tag, status, 'stub-q' AS question_model, 'stub-a' AS answer_model, q AS question, CASE WHEN a = '' THEN 0 ELSE n END::INT AS answer_word_count FROM run",
    "generation_records": f"{_RUN} SELECT doc_id, pos::INT AS pos, md5(q || '|' || a) AS pair_md5 FROM run WHERE status = 'ok'",
    "dry_run_sample": f"{_PASSAGES} SELECT doc_id, pos::INT AS pos, substr(passage, 1, 220) AS preview FROM c ORDER BY md5('42:' || doc_id::VARCHAR || ':' || pos::VARCHAR), doc_id, pos LIMIT 15",
}
