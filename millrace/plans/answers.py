"""Queries on questions and answers: validation, sanitising, copying, prompts, outcomes."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicon import FIXTURE as LEX
from ..operators import chat, generate, overlap, validate
from . import sql as S
from .passages import NARRATIVE, source_dim


def conversations(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


# Synthetic turns hold no question marks, tags or reminders, so some get them by turn and conversation; the twins do the same.
def questions(spark, sf_dir):
    c = conversations(spark, sf_dir).where("role = 'user'")
    k = (F.col("conv_id") + F.col("turn")) % 7
    q = F.when(k == 0, F.lit("SKIP")).when(k == 1, F.lit("  ")).when(k < 6, F.concat("text", F.lit(" ?"))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", q.alias("question"))


_QUESTIONS = "SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 7 = 0 THEN 'SKIP' WHEN (conv_id + turn) % 7 = 1 THEN '  ' WHEN (conv_id + turn) % 7 < 6 THEN text || ' ?' ELSE text END AS question FROM conversations WHERE role = 'user'"


def answers(spark, sf_dir):
    c = conversations(spark, sf_dir).where("role = 'assistant'")
    k = (F.col("conv_id") * 3 + F.col("turn")) % 16
    t = F.col("text")
    a = (
        F.when(k == 1, F.concat(t, F.lit(" <b>x</b>."))).when(k == 3, F.concat(F.lit("Ah, "), t)).when(k == 4, F.concat(F.lit("Il y a des "), t)).when(k == 5, F.concat(t, F.lit(" Mon ami.")))
        .when(k == 6, F.concat(t, F.lit(" (il rit) fin."))).when(k == 7, F.concat(F.lit("# "), t)).when(k == 8, F.concat(t, F.lit(" je jeune j'ai je je je jeudi je je je je.")))
        .when(k == 9, F.concat(t, F.lit(" ? ou ?"))).when(k == 10, F.concat(t, F.lit("\n ."))).when(k == 11, F.regexp_replace(t, "[.!?…]+$", "")).when(k == 12, F.lit("")).when(k == 13, F.concat(t, F.lit(" «cité».")))
        .otherwise(t)
    )
    return c.select("conv_id", "turn", a.alias("answer"))


_ANSWERS = r"""SELECT conv_id, turn, CASE (conv_id * 3 + turn) % 16 WHEN 1 THEN text || ' <b>x</b>.' WHEN 3 THEN 'Ah, ' || text WHEN 4 THEN 'Il y a des ' || text WHEN 5 THEN text || ' Mon ami.'
     WHEN 6 THEN text || ' (il rit) fin.' WHEN 7 THEN '# ' || text WHEN 8 THEN text || ' je jeune j''ai je je je jeudi je je je je.' WHEN 9 THEN text || ' ? ou ?' WHEN 10 THEN text || chr(10) || ' .'
     WHEN 11 THEN regexp_replace(text, '[.!?…]+$', '') WHEN 12 THEN '' WHEN 13 THEN text || ' «cité».' ELSE text END AS answer FROM conversations WHERE role = 'assistant'"""


def question_validity(spark, sf_dir):
    return questions(spark, sf_dir).select("conv_id", "turn", F.coalesce(validate.question_reason(F.col("question"), LEX), F.lit("ok")).alias("status"))


_QUESTION_CASE = f"""CASE WHEN q = '' THEN 'empty' WHEN q = 'SKIP' THEN 'skip' WHEN NOT contains(q, '?') THEN 'no_question_mark' WHEN {S.wc(S.norm("q"))} NOT BETWEEN 8 AND 20 THEN 'length'
     WHEN {S.any_hit("lower(q)", LEX.question_reject)} THEN 'pattern' ELSE 'ok' END"""


def answer_validity_long(spark, sf_dir):
    a = F.col("answer")
    reason = validate.answer_reason(a, LEX)
    detail = F.when(reason.isin("too_short", "pattern"), validate.answer_detail(a, LEX))
    return answers(spark, sf_dir).select("conv_id", "turn", F.coalesce(reason, F.lit("ok")).alias("status"), F.coalesce(detail, F.lit("")).alias("detail"))


_FIRST = "CASE " + " ".join(f"WHEN {S.hit('lower(a)', p, 'm')} THEN {S.q(p)}" for p in LEX.answer_reject) + " END"
_LONG = f"""SELECT conv_id, turn, s AS status, CASE s WHEN 'too_short' THEN n::VARCHAR WHEN 'pattern' THEN {_FIRST} ELSE '' END AS detail FROM (
SELECT *, CASE WHEN a = '' THEN 'empty' WHEN n < 50 THEN 'too_short' WHEN {S.any_hit("lower(a)", LEX.answer_reject, "m")} THEN 'pattern' WHEN right(a, 1) NOT IN ('.', '!', '?', '…') THEN 'truncated' ELSE 'ok' END AS s
FROM (SELECT conv_id, turn, a, {S.wc(S.norm("a"))} AS n FROM (SELECT conv_id, turn, {S.strip("answer")} AS a FROM ({_ANSWERS}))))"""


def answer_validity_short(spark, sf_dir):
    return answers(spark, sf_dir).select("conv_id", "turn", F.coalesce(validate.short_answer_reason(F.col("answer"), least=15, most=120), F.lit("ok")).alias("status"))



_WORD = r"(?:^|[^\p{L}\p{N}_])"
_END = r"(?:$|[^\p{L}\p{N}_])"


def _re2(p: str) -> str:
    """Every \\b is replaced; after an opening one an optional character may stand before, and so on."""
    out = p
    while r"\b" in out:
        i = out.index(r"\b")
        opening = i == 0 or out[i - 1] in "(|"
        out = out[:i] + (_WORD if opening else _END) + out[i + 2 :]
    return out


def _any(c: str, patterns: list[str], flags: str = "") -> str:
    return "(" + " OR ".join(f"regexp_matches({c}, {S.q((f'(?{flags})' if flags else '') + _re2(p))})" for p in patterns) + ")"


_SHORT = rf"""SELECT conv_id, turn, CASE WHEN a = '' THEN 'empty' WHEN n < 15 THEN 'too_short' WHEN n > 120 THEN 'too_long' WHEN len(regexp_extract_all(a, '[.!?…]+')) NOT BETWEEN 1 AND 6 THEN 'sentence_count'
WHEN contains(a, '<') OR contains(a, '>') THEN 'tags' WHEN starts_with(l, 'ah') THEN 'familiar_opening' WHEN {" OR ".join(f"starts_with(l, {S.q(o)})" for o in validate.OPENINGS)} THEN 'pompous_opening'
WHEN {_any("l", validate.FAMILIAR)} THEN 'familiarity' WHEN {_any("l", validate.STAGE)} THEN 'stage_direction' WHEN {_any("l", validate.REJECTED, "m")} THEN 'pattern'
WHEN len(regexp_extract_all(l, '(?:^|[^\p{{L}}\p{{N}}_])(?:je|j[''’])')) > 8 THEN 'first_person' WHEN length(a) - length(replace(a, '?', '')) > 1 THEN 'questions'
WHEN regexp_matches(a, '\n\s*[?.!]\s*$') THEN 'orphan_punctuation' WHEN right(a, 1) NOT IN ('.', '!', '?', '…') THEN 'truncated' ELSE 'ok' END AS status
FROM (SELECT *, lower(a) AS l, {S.wc(S.norm("a"))} AS n FROM (SELECT conv_id, turn, {S.strip("answer")} AS a FROM ({_ANSWERS})))"""


def sanitize_answers(spark, sf_dir):
    k = F.col("turn") % 8
    t = F.col("text")
    messy = (
        F.when(k == 1, F.concat(F.lit("  <system-reminder>a\nb</system-reminder>"), t)).when(k == 3, F.concat(F.regexp_replace(t, r"\.$", ""), F.lit("\n \n .")))
        .when(k == 5, F.concat(F.replace(t, F.lit(" "), F.lit(" \t ")), F.lit("\r\n\r\n\r\n\r\nx"))).otherwise(F.concat(F.lit('</s>"'), t, F.lit('"')))
    )
    a = conversations(spark, sf_dir).where("role = 'assistant'").select("conv_id", "turn", messy.alias("m"))
    out = T.sanitize_answer(F.col("m"))
    return a.select("conv_id", "turn", F.md5(out).alias("answer_md5"), F.char_length(out).cast("long").alias("n_answer_chars"), F.md5(T.trim_generated(F.col("m"))).alias("trimmed_md5"))


_SANITIZE = rf"""
WITH a AS (SELECT conv_id, turn, CASE turn % 8 WHEN 1 THEN '  <system-reminder>a' || chr(10) || 'b</system-reminder>' || text WHEN 3 THEN regexp_replace(text, '\.$', '') || chr(10) || ' ' || chr(10) || ' .'
     WHEN 5 THEN replace(text, ' ', ' ' || chr(9) || ' ') || repeat(chr(13) || chr(10), 4) || 'x' ELSE '</s>"' || text || '"' END AS m FROM conversations WHERE role = 'assistant'),
b AS (SELECT *, {S.strip("replace(m, chr(13) || chr(10), chr(10))")} AS t FROM a),
c AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(t, '(?is)<system-reminder>.*?</system-reminder>', ' ', 'g'), '\n\s*\n\s*[?.!]\s*$', '.'), '[?.!]\s*\n\s*\n\s*[?.!]\s*$', '.') AS u FROM b),
d AS (SELECT *, {S.strip(r"regexp_replace(regexp_replace(u, '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g')")} AS v FROM c),
e AS (SELECT *, CASE WHEN v = '' OR right(v, 1) IN ('.', '!', '?', '…') THEN v ELSE v || '.' END AS w, {S.strip("replace(m, '</s>', '')")} AS x FROM d)
SELECT conv_id, turn, md5(w) AS answer_md5, length(w)::BIGINT AS n_answer_chars, md5({S.strip("trim(trim(x, '\"'), '''')")}) AS trimmed_md5 FROM e"""


def _pairs(spark, sf_dir):
    """Adjacent pairs; every third answer repeats its question, as a copied passage would."""
    p = chat.adjacent_pairs(conversations(spark, sf_dir))
    copied = F.when(F.col("conv_id") % 3 == 0, F.concat("question", F.lit(" "), F.col("answer"))).otherwise(F.col("answer"))
    return p.withColumn("answer", copied)


_PAIRS = "SELECT q.conv_id, q.turn, q.text AS question, CASE WHEN q.conv_id % 3 = 0 THEN q.text || ' ' || a.text ELSE a.text END AS answer FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND q.role = 'user' AND a.role = 'assistant'"


def trigram_overlap_pairs(spark, sf_dir):
    q, a = F.col("question"), F.col("answer")
    ratio = F.coalesce(overlap.containment(q, a), F.lit(0.0))
    return _pairs(spark, sf_dir).select("conv_id", "turn", F.round(ratio, 6).alias("ratio"), (ratio > 0.30).alias("trigram_copy"), overlap.is_copy(q, a).alias("is_copy"))


_TRI = "CASE WHEN len({t}) < 3 THEN [] ELSE list_distinct(list_transform(range(1, len({t}) - 1), lambda i: {t}[i] || ' ' || {t}[i + 1] || ' ' || {t}[i + 2])) END"
_OVERLAP = rf"""
WITH p AS ({_PAIRS}),
t AS (SELECT *, regexp_extract_all(lower(question), '[a-zà-ÿ]+') AS s, regexp_extract_all(lower(answer), '[a-zà-ÿ]+') AS a FROM p),
g AS (SELECT *, {_TRI.format(t="s")} AS sg, {_TRI.format(t="a")} AS ag FROM t),
r AS (SELECT *, CASE WHEN len(s) >= 6 AND len(a) >= 6 THEN len(list_intersect(sg, ag)) / len(ag) ELSE 0 END AS ratio,
      len(s) >= 6 AND len(a) >= 6 AND len(list_filter({S.sentences("lower(" + S.norm("question") + ")", False)}, lambda x: length(x) >= 90 AND contains(lower({S.norm("answer")}), x))) > 0 AS long FROM g)
SELECT conv_id, turn, round(ratio, 6)::DOUBLE AS ratio, ratio > 0.30 AS trigram_copy, ratio > 0.30 OR long AS is_copy FROM r"""


def benchmark_contamination(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return overlap.corpus_containment(docs, items).select("doc_id", "item_id", F.col("hits").cast("long").alias("hits"), F.col("item_grams").cast("long").alias("item_grams"))


_CONTAIN = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-zà-ÿ]+') AS t FROM documents), b AS (SELECT item_id, regexp_extract_all(lower(text), '[a-zà-ÿ]+') AS t FROM benchmark),
bg AS (SELECT item_id, unnest(g) AS g, len(g) AS n FROM (SELECT item_id, {_TRI.format(t="t")} AS g FROM b WHERE len(t) >= 6)),
dg AS (SELECT doc_id, unnest({_TRI.format(t="t")}) AS g FROM d WHERE len(t) >= 6)
SELECT doc_id, item_id, count(*)::BIGINT AS hits, n::BIGINT AS item_grams FROM dg JOIN bg USING (g) GROUP BY doc_id, item_id, n HAVING count(*) / n > 0.30"""


def long_segment_copy(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return overlap.corpus_long_segments(items, docs)


_LONG_SEGMENT = f"""
WITH d AS (SELECT doc_id, lower({S.norm("text")}) AS t FROM documents), b AS (SELECT DISTINCT item_id, unnest({S.sentences("lower(" + S.norm("text") + ")", False)}) AS s FROM benchmark)
SELECT doc_id, item_id, count(DISTINCT s)::BIGINT AS segments FROM d JOIN b ON length(s) >= 90 AND contains(t, s) GROUP BY ALL"""


def attempt_status(spark, sf_dir):
    """Every attempt with its status, in the order of the gates: question, copy, answer."""
    p = _pairs(spark, sf_dir).withColumn("q", F.when(F.col("conv_id") % 5 == 0, F.col("question")).otherwise(F.concat("question", F.lit(" ?"))))
    bad = validate.question_reason(F.col("q"), LEX)
    answer = validate.answer_reason(F.col("answer"), LEX, least=30)
    status = F.when(bad.isNotNull(), "invalid_question").when(overlap.is_copy(F.col("question"), F.col("answer")), "copy").when(answer.isNotNull(), F.concat(F.lit("invalid_answer:"), answer)).otherwise("ok")
    return p.select("conv_id", "turn", status.alias("status"))


def run_outcomes_retention(spark, sf_dir):
    s = attempt_status(spark, sf_dir)
    return s.rollup("status").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("status") == "ok") * 100.0 / F.greatest(F.count("*"), F.lit(1)), 4).alias("retention"))


_STATUS = rf"""
WITH p AS (SELECT *, CASE WHEN conv_id % 5 = 0 THEN question ELSE question || ' ?' END AS q0 FROM ({_PAIRS})),
o AS ({_OVERLAP.replace("WITH p AS (" + _PAIRS + "),", "WITH ", 1).strip()}),
v AS (SELECT p.conv_id, p.turn, {S.strip("q0")} AS q, {S.strip("answer")} AS a, is_copy FROM p JOIN o USING (conv_id, turn)),
w AS (SELECT conv_id, turn, CASE WHEN {_QUESTION_CASE} <> 'ok' THEN 'invalid_question' WHEN is_copy THEN 'copy' WHEN a = '' THEN 'invalid_answer:empty' WHEN {S.wc(S.norm("a"))} < 30 THEN 'invalid_answer:too_short'
      WHEN {S.any_hit("lower(a)", LEX.answer_reject, "m")} THEN 'invalid_answer:pattern' WHEN right(a, 1) NOT IN ('.', '!', '?', '…') THEN 'invalid_answer:truncated' ELSE 'ok' END AS status FROM v)"""


def attempt_resolution(spark, sf_dir):
    """Assistant turns of a conversation as attempts: the first valid of at most three, else the last."""
    a = answers(spark, sf_dir).withColumn("answer", T.sanitize_answer(F.col("answer"))).withColumn("attempt", F.floor(F.col("turn") / 2).cast("long"))
    a = a.groupBy("conv_id", "attempt").agg(F.min("answer").alias("answer"))
    ok = validate.answer_reason(F.col("answer"), LEX, least=60).isNull()
    out = chat.resolve_attempts(a, "conv_id", "attempt", ok, "answer")
    return out.select("conv_id", "status", "retries", F.md5(F.coalesce("answer", F.lit(""))).alias("answer_md5"), F.md5("last_answer").alias("last_md5"))


_ATTEMPTS = rf"""
WITH a0 AS ({_ANSWERS}), a1 AS (SELECT conv_id, (turn // 2)::BIGINT AS attempt, answer, {S.strip("answer")} AS t FROM a0),
a2 AS (SELECT *, regexp_replace(t, '\n\s*\n\s*[?.!]\s*$', '.') AS u FROM a1),
a3 AS (SELECT *, {S.strip(r"regexp_replace(regexp_replace(u, '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g')")} AS v FROM a2),
a4 AS (SELECT conv_id, attempt, min(CASE WHEN v = '' OR right(v, 1) IN ('.', '!', '?', '…') THEN v ELSE v || '.' END) AS a FROM a3 GROUP BY ALL),
b AS (SELECT *, a <> '' AND {S.wc(S.norm("a"))} >= 60 AND NOT {S.any_hit("lower(a)", LEX.answer_reject, "m")} AND right(a, 1) IN ('.', '!', '?', '…') AS ok FROM a4 WHERE attempt < 3),
c AS (SELECT conv_id, min(attempt) FILTER (ok) AS first_ok, max(attempt) AS last FROM b GROUP BY conv_id)
SELECT c.conv_id, CASE WHEN first_ok IS NULL THEN 'rejected' ELSE 'ok' END AS status, coalesce(first_ok, last)::BIGINT AS retries, md5(CASE WHEN first_ok IS NULL THEN '' ELSE b.a END) AS answer_md5, md5(b.a) AS last_md5
FROM c JOIN b ON b.conv_id = c.conv_id AND b.attempt = coalesce(first_ok, last)"""

NARRATIVE_TEMPLATE = "Raconte : {question} / {passage}"
REFERENCE_TEMPLATE = "Explique 100% : {question} / {passage}"


def prompt_render(spark, sf_dir):
    p = _pairs(spark, sf_dir).withColumn("source", F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string"))).join(F.broadcast(source_dim(spark)), "source")
    prompts = [T.render(t, question=F.col("question"), passage=F.col("answer")) for t in (NARRATIVE_TEMPLATE, REFERENCE_TEMPLATE)]
    return p.select("conv_id", "turn", F.md5(F.when(F.col("is_narrative"), prompts[0]).otherwise(prompts[1])).alias("prompt_md5"))


def generate_with_stub(spark, sf_dir):
    q = questions(spark, sf_dir)
    return generate.generate(q, "question", generate.digest_stub).select("conv_id", "turn", F.coalesce("generated", F.lit("")).alias("generated"))


QUERIES = {
    "question_validity": question_validity,
    "answer_validity_long": answer_validity_long,
    "answer_validity_short": answer_validity_short,
    "sanitize_answers": sanitize_answers,
    "trigram_overlap_pairs": trigram_overlap_pairs,
    "benchmark_contamination": benchmark_contamination,
    "long_segment_copy": long_segment_copy,
    "attempt_status": attempt_status,
    "run_outcomes_retention": run_outcomes_retention,
    "attempt_resolution": attempt_resolution,
    "prompt_render": prompt_render,
    "generate_with_stub": generate_with_stub,
}
SQL = {
    "question_validity": f"SELECT conv_id, turn, {_QUESTION_CASE} AS status FROM (SELECT conv_id, turn, {S.strip('question')} AS q FROM ({_QUESTIONS}))",
    "answer_validity_long": _LONG,
    "answer_validity_short": _SHORT,
    "sanitize_answers": _SANITIZE,
    "trigram_overlap_pairs": _OVERLAP,
    "benchmark_contamination": _CONTAIN,
    "long_segment_copy": _LONG_SEGMENT,
    "attempt_status": f"{_STATUS} SELECT conv_id, turn, status FROM w",
    "run_outcomes_retention": f"{_STATUS} SELECT status, count(*)::BIGINT AS n, round(count(*) FILTER (status = 'ok') * 100.0 / greatest(count(*), 1), 4)::DOUBLE AS retention FROM w GROUP BY ROLLUP (status)",
    "attempt_resolution": _ATTEMPTS,
    "prompt_render": f"SELECT conv_id, turn, md5(CASE WHEN 'src' || (conv_id % 20)::VARCHAR IN ({', '.join(map(S.q, NARRATIVE))}) THEN 'Raconte : ' ELSE 'Explique 100% : ' END || question || ' / ' || answer) AS prompt_md5 FROM ({_PAIRS})",
    "generate_with_stub": f"SELECT conv_id, turn, 'Pourquoi ' || md5(question) || ' ?' AS generated FROM ({_QUESTIONS})",
}
