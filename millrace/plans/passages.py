"""Queries on passages: packing, windows, order statistics, classifiers, reject counters, order and samples."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lexicon import FIXTURE as LEX
from ..functions.lexicon import word_hits
from ..operators import classify, segment, stats
from . import sql as S
from .cleaning import docs

# The test tables' stand-ins for the groups of sources that the classifiers treat apart.
NARRATIVE = ["src1", "src2", "src3", "src4", "src5"]
PRIORITY = ["src5", "src6", "src7", "src8", "src9", "src10"]
SPIRITUAL = ["src11", "src12"]


def source_dim(spark):
    """Dimension of the sources and their groups; it has as many rows as there are sources."""
    rows = [(f"src{i}", f"src{i}" in NARRATIVE, f"src{i}" in PRIORITY, f"src{i}" in SPIRITUAL) for i in range(20)]
    return spark.createDataFrame(rows, "source string, is_narrative boolean, is_priority boolean, is_spiritual boolean")


def passages(spark, sf_dir, extra=()):
    """(doc_id, source, pos, passage, n_words): every candidate of the generic segmentation."""
    d = docs(spark, sf_dir).select("doc_id", "source", F.explode(T.paragraphs(F.col("text"))).alias("p"))
    d = d.select("doc_id", "source", T.normalize_ws(F.col("p")).alias("p")).where("p <> ''")
    d = d.withColumn("ss", T.sentences_strict(F.col("p")))
    d = d.select("doc_id", "source", F.posexplode(segment.split_long_passage(F.col("p"), F.col("ss"))).alias("pos", "passage"))
    return d.withColumn("n_words", T.words_in(F.col("passage")))


_PASSAGES = f"""
WITH RECURSIVE a AS MATERIALIZED (SELECT doc_id, source, {S.norm("text")} AS t FROM documents),
b AS MATERIALIZED (SELECT doc_id, t, {S.sentences("t", True)} AS ss FROM a),
long AS MATERIALIZED (SELECT doc_id, ss FROM b WHERE {S.wc("t")} > 180 AND len(ss) > 1),
{S.packed("long", 50, 180)},
p AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1 AS pos, t AS passage, n AS n_words FROM g WHERE n >= 50
      UNION ALL SELECT doc_id, 0, t, {S.wc("t")} FROM b WHERE t <> '' AND NOT ({S.wc("t")} > 180 AND len(ss) > 1)),
c AS MATERIALIZED (SELECT p.doc_id, source, pos, passage, n_words, lower(passage) AS l FROM p JOIN a ON a.doc_id = p.doc_id)"""


def pack_passages(spark, sf_dir):
    return passages(spark, sf_dir).select("doc_id", "pos", F.col("n_words").cast("long").alias("n_words"), F.md5("passage").alias("passage_md5"))


def _letters(spark, sf_dir):
    d = docs(spark, sf_dir).where("lang = 'fr'").select("doc_id", T.normalize_ws(F.col("text")).alias("t")).where("t <> ''")
    d = d.withColumn("header", T.hits(F.col("t"), T.any_of(LEX.letter_header), "Ui"))
    ss = T.sentences_loose(F.col("t"))
    sizes = F.transform("ss", T.words_in)
    return d.withColumn("ss", ss).withColumn("runs", segment.pack_bounds(sizes, 55, 120))


def pack_letters(spark, sf_dir):
    out = _letters(spark, sf_dir).where("not header").select("doc_id", F.posexplode(F.transform("runs", lambda r: F.array_join(F.slice("ss", r["start"] + 1, r["stop"] - r["start"]), " "))).alias("pos", "t"))
    return out.select("doc_id", "pos", T.words_in(F.col("t")).cast("long").alias("n_words"), F.md5("t").alias("chunk_md5"), F.coalesce(classify.letter_reason(F.lower("t"), LEX), F.lit("kept")).alias("reason"))


_LETTERS = f"""
WITH RECURSIVE a AS (SELECT doc_id, {S.norm("text")} AS t FROM documents WHERE lang = 'fr'),
h AS (SELECT doc_id, t FROM a WHERE t <> '' AND NOT {S.any_hit("t", LEX.letter_header, "i")}),
b AS (SELECT doc_id, {S.sentences("t", False)} AS ss FROM h),
{S.packed("b", 55, 120)},
c AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1 AS pos, n, t, lower(t) AS l FROM g WHERE n >= 55)"""
_DENSITY = " + ".join(f"(length(l) - length(replace(l, {S.q(x)}, ''))) // {len(x)}" for x in LEX.second_person)
_LETTER_REASON = f"""CASE WHEN {S.any_hit("l", LEX.letter_logistic, "i")} THEN 'reject_logistic' WHEN {S.any_hit("l", LEX.letter_intimate, "i")} THEN 'reject_intimate'
     WHEN {S.any_hit("l", LEX.letter_dark, "i")} THEN 'reject_dark' WHEN {_DENSITY} > 2 THEN 'reject_second_person' WHEN {S.contains("l", LEX.letter_light)} < 2 THEN 'reject_not_light' ELSE 'kept' END"""


def letter_classifier(spark, sf_dir):
    return pack_letters(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"), F.sum("n_words").alias("n_words"))


def token_windows(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", T.normalize_ws(F.col("text")).alias("t"))
    w = segment.token_windows(d, T.words(F.col("t"))).withColumn("n_tokens", F.size("tokens").cast("long"))
    return w.select("doc_id", "pos", "n_tokens", F.md5(F.array_join("tokens", " ")).alias("window_md5"), (F.col("n_tokens") >= 256).alias("kept"))


_WINDOWS = f"""
WITH a AS (SELECT doc_id, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS w FROM (SELECT doc_id, {S.norm("text")} AS t FROM documents)),
b AS (SELECT doc_id, w, unnest(range(0, greatest(ceil((len(w) - 2048) / 1920), 0)::BIGINT + 1)) AS pos FROM a),
c AS (SELECT doc_id, pos, w[pos * 1920 + 1:pos * 1920 + 2048] AS x FROM b)"""


def chunk_size_quantiles(spark, sf_dir):
    return stats.order_statistics(token_windows(spark, sf_dir).where("kept"), "n_tokens")


def chunk_kept_counts(spark, sf_dir):
    w = token_windows(spark, sf_dir)
    return w.agg(F.count("*").alias("n_chunks"), F.count_if("kept").alias("n_kept"), F.count_if(~F.col("kept")).alias("n_filtered"))


def logistic_context_flags(spark, sf_dir):
    low = F.lower("text")
    return docs(spark, sf_dir).select("doc_id", classify.is_logistic(low, LEX).alias("is_logistic"), classify.is_context_dependent(low, LEX).alias("is_context_dependent"))


def reflective_score(spark, sf_dir):
    low = F.lower("text")
    return docs(spark, sf_dir).select("doc_id", word_hits(low, LEX.reflective).cast("long").alias("score"), classify.has_lyric_combo(low, LEX).alias("lyric_combo"))


def _classified(spark, sf_dir, **options):
    p = passages(spark, sf_dir).join(F.broadcast(source_dim(spark)), "source", "left").withColumn("low", F.lower("passage"))
    reason = classify.passage_reason(F.col("low"), F.col("n_words"), F.coalesce("is_narrative", F.lit(False)), LEX, **options)
    return p.withColumn("reason", F.coalesce(reason, F.lit("kept")))


def _reason_sql(lyric: bool, fold: bool = False) -> str:
    low = f"{S.contains('l', LEX.reflective)} < 2" + (f" AND NOT ({S.contains('l', LEX.nature)} >= 1 AND {S.contains('l', LEX.emotion)} >= 1)" if lyric else "")
    flags = "i" if fold else ""
    strong, weak = S.hits("l", LEX.context_strong), S.hits("l", LEX.context_weak)
    return f"""CASE WHEN n_words < 50 THEN 'too_short' WHEN n_words > 180 THEN 'too_long' WHEN {S.hits("l", LEX.logistic, flags)} >= 2 THEN 'logistic'
     WHEN {strong} >= 1 OR {strong} + {weak} >= 2 THEN 'context_dependent' WHEN source IN ({", ".join(map(S.q, NARRATIVE))}) AND {S.any_hit("l", LEX.narrative, flags)} THEN 'narrative_proper_noun'
     WHEN {low} THEN 'low_reflective' ELSE 'kept' END"""


def passage_funnel(spark, sf_dir):
    """Counters per source and reason: candidates by reason, and the paragraphs they came from."""
    c = _classified(spark, sf_dir).groupBy("source", "reason").agg(F.count("*").alias("n"))
    total = docs(spark, sf_dir).select("source", F.explode(T.paragraphs(F.col("text"))).alias("p")).groupBy("source").agg(F.lit("total").alias("reason"), F.count("*").alias("n"))
    return c.unionByName(total)


def classify_passage_reasons(spark, sf_dir):
    return _classified(spark, sf_dir).rollup("source").agg(
        *[F.count_if(F.col("reason") == r).alias(f"n_{r}") for r in ("too_short", "too_long", "logistic", "context_dependent", "narrative_proper_noun", "low_reflective", "kept")], F.count("*").alias("n_candidates")
    )


_REASONS = ("too_short", "too_long", "logistic", "context_dependent", "narrative_proper_noun", "low_reflective", "kept")


def case_fold_difference(spark, sf_dir):
    """Passages whose reason changes when patterns with capitals are revived."""
    a = _classified(spark, sf_dir)
    folded = classify.passage_reason(F.col("low"), F.col("n_words"), F.coalesce("is_narrative", F.lit(False)), LEX, case_fold=True)
    return a.withColumn("folded", F.coalesce(folded, F.lit("kept"))).groupBy("reason", "folded").agg(F.count("*").alias("n"))


def theme_tag(spark, sf_dir):
    p = _classified(spark, sf_dir, lyric=False)
    tag = classify.theme_tag(F.col("low"), F.coalesce("is_spiritual", F.lit(False)), F.coalesce("is_priority", F.lit(False)), LEX)
    p = p.withColumn("tag", F.when(F.col("reason") == "kept", tag))
    reason = F.when((F.col("reason") == "kept") & F.col("tag").isNull(), "not_light_theme").otherwise(F.col("reason"))
    return p.select("doc_id", "pos", reason.alias("reason"), F.coalesce("tag", F.lit("none")).alias("tag"))


_THEME = f"""{_PASSAGES},
d AS (SELECT doc_id, pos, {_reason_sql(False)} AS r, {S.contains("l", LEX.light)} AS light, {S.contains("l", LEX.dark)} AS dark, {S.contains("l", LEX.spiritual)} AS spirit, source FROM c),
e AS (SELECT doc_id, pos, r, CASE WHEN r <> 'kept' THEN NULL WHEN source IN ({", ".join(map(S.q, SPIRITUAL))}) AND spirit >= 1 THEN 'spiritual_luminous' WHEN light >= 2 AND dark = 0 THEN 'light_luminous'
      WHEN source IN ({", ".join(map(S.q, PRIORITY))}) AND light >= 1 AND dark <= 1 THEN 'light_priority' END AS tag FROM d)
SELECT doc_id, pos::INT AS pos, CASE WHEN r = 'kept' AND tag IS NULL THEN 'not_light_theme' ELSE r END AS reason, coalesce(tag, 'none') AS tag FROM e"""


def qc_sample(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "source", F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))).alias("key"), "text")
    picked = stats.at_positions(d, "key", "doc_id", lambda n: {"first": 1, "middle": n // 2 + 1, "last": n})
    return picked.select("doc_id", "label", T.preview(F.col("text"), 80).alias("head"), T.preview(F.col("text"), 80, end=True).alias("tail"))


def resume_limit(spark, sf_dir, start: int = 40, n: int = 25):
    """The next n documents of the shuffled order after a progress cursor."""
    key = F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string")))
    return docs(spark, sf_dir).select("doc_id", key.alias("shuffle_key")).orderBy("shuffle_key", "doc_id").offset(start).limit(n)


def question_dedup_first(spark, sf_dir):
    """First place of each distinct trimmed text, as in a hand-made list. min() combines on the map side, so copies cost nothing."""
    d = docs(spark, sf_dir).select("doc_id", T.strip(F.col("text")).alias("t")).where("t <> ''")
    # Digests travel in the place of texts; a SHA-256 names the text.
    d = d.select("doc_id", F.sha2("t", 256).alias("name"), F.md5("t").alias("text_md5"))
    return d.groupBy("name", "text_md5").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")).drop("name")


def left_pad_batches(spark, sf_dir, batch: int = 8):
    """Token ids padded on the left to the longest of their batch, with an attention mask."""
    d = docs(spark, sf_dir).select("doc_id", F.floor(F.col("doc_id") / batch).cast("long").alias("batch"), F.transform(T.words(T.normalize_ws(F.col("text"))), lambda w: F.char_length(w)).alias("ids"))
    widest = Window.partitionBy("batch")
    width = F.max(F.size("ids")).over(widest)
    pad = F.col("width") - F.size("ids")
    d = d.withColumn("width", width)
    return d.select("doc_id", "batch", F.md5(F.array_join(F.concat(F.array_repeat(F.lit(0), pad), "ids"), " ")).alias("padded_md5"), F.md5(F.array_join(F.concat(F.array_repeat(F.lit(0), pad), F.array_repeat(F.lit(1), F.size("ids"))), " ")).alias("mask_md5"))


QUERIES = {
    "passage_funnel": passage_funnel,
    "pack_passages": pack_passages,
    "pack_letters": pack_letters,
    "letter_classifier": letter_classifier,
    "token_windows": token_windows,
    "chunk_size_quantiles": chunk_size_quantiles,
    "chunk_kept_counts": chunk_kept_counts,
    "logistic_context_flags": logistic_context_flags,
    "reflective_score": reflective_score,
    "classify_passage_reasons": classify_passage_reasons,
    "case_fold_difference": case_fold_difference,
    "theme_tag": theme_tag,
    "qc_sample": qc_sample,
    "resume_limit": resume_limit,
    "question_dedup_first": question_dedup_first,
    "left_pad_batches": left_pad_batches,
}
SQL = {
    "passage_funnel": f"{_PASSAGES} SELECT source, {_reason_sql(True)} AS reason, count(*)::BIGINT AS n FROM c GROUP BY ALL UNION ALL SELECT source, 'total', count(*)::BIGINT FROM (SELECT source, unnest(string_split(text, chr(10) || chr(10))) AS p FROM documents) WHERE {S.strip('p')} <> '' GROUP BY source",
    "pack_passages": f"{_PASSAGES} SELECT doc_id, pos::INT AS pos, n_words::BIGINT AS n_words, md5(passage) AS passage_md5 FROM c",
    "pack_letters": f"{_LETTERS} SELECT doc_id, pos::INT AS pos, n::BIGINT AS n_words, md5(t) AS chunk_md5, {_LETTER_REASON} AS reason FROM c",
    "letter_classifier": f"{_LETTERS} SELECT reason, count(*)::BIGINT AS n, sum(n)::BIGINT AS n_words FROM (SELECT n, {_LETTER_REASON} AS reason FROM c) GROUP BY reason",
    "token_windows": f"{_WINDOWS} SELECT doc_id, pos::INT AS pos, len(x)::BIGINT AS n_tokens, md5(array_to_string(x, ' ')) AS window_md5, len(x) >= 256 AS kept FROM c",
    "chunk_size_quantiles": f"{_WINDOWS}, s AS (SELECT list_sort(list(len(x))) AS v FROM c WHERE len(x) >= 256) SELECT len(v)::BIGINT AS n, list_sum(v)::BIGINT AS total, v[1]::BIGINT AS least, v[len(v) // 2 + 1]::BIGINT AS p50, v[floor(len(v) * 0.95::DOUBLE)::BIGINT + 1]::BIGINT AS p95, v[-1]::BIGINT AS most FROM s",
    "chunk_kept_counts": f"{_WINDOWS} SELECT count(*)::BIGINT AS n_chunks, count(*) FILTER (len(x) >= 256)::BIGINT AS n_kept, count(*) FILTER (len(x) < 256)::BIGINT AS n_filtered FROM c",
    "logistic_context_flags": f"SELECT doc_id, {S.hits('l', LEX.logistic)} >= 2 AS is_logistic, {S.hits('l', LEX.context_strong)} >= 1 OR {S.hits('l', LEX.context_strong)} + {S.hits('l', LEX.context_weak)} >= 2 AS is_context_dependent FROM (SELECT doc_id, lower(text) AS l FROM documents)",
    "reflective_score": f"SELECT doc_id, {S.contains('l', LEX.reflective)}::BIGINT AS score, {S.contains('l', LEX.nature)} >= 1 AND {S.contains('l', LEX.emotion)} >= 1 AS lyric_combo FROM (SELECT doc_id, lower(text) AS l FROM documents)",
    "classify_passage_reasons": f"{_PASSAGES}, d AS (SELECT source, {_reason_sql(True)} AS r FROM c) SELECT source, {', '.join(f'count(*) FILTER (r = {S.q(r)})::BIGINT AS n_{r}' for r in _REASONS)}, count(*)::BIGINT AS n_candidates FROM d GROUP BY ROLLUP (source)",
    "case_fold_difference": f"{_PASSAGES} SELECT {_reason_sql(True)} AS reason, {_reason_sql(True, True)} AS folded, count(*)::BIGINT AS n FROM c GROUP BY ALL",
    "theme_tag": _THEME,
    "qc_sample": "WITH a AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) AS r, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE r WHEN 1 THEN 'first' WHEN n THEN 'last' ELSE 'middle' END AS label, substr(text, 1, 80) AS head, right(text, 80) AS tail FROM a WHERE r IN (1, n // 2 + 1, n)",
    "resume_limit": "SELECT doc_id, md5('42:' || doc_id::VARCHAR) AS shuffle_key FROM documents ORDER BY shuffle_key, doc_id LIMIT 25 OFFSET 40",
    "question_dedup_first": f"SELECT min(doc_id) AS doc_id, count(*)::BIGINT AS n_copies, md5(t) AS text_md5 FROM (SELECT doc_id, {S.strip('text')} AS t FROM documents) WHERE t <> '' GROUP BY t",
    "left_pad_batches": f"WITH a AS (SELECT doc_id, (doc_id // 8)::BIGINT AS batch, CASE WHEN t = '' THEN [] ELSE list_transform(string_split(t, ' '), lambda w: length(w)) END AS ids FROM (SELECT doc_id, {S.norm('text')} AS t FROM documents)), b AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) - len(ids) AS pad FROM a) SELECT doc_id, batch, md5(array_to_string(list_concat(list_transform(range(pad), lambda x: 0), ids), ' ')) AS padded_md5, md5(array_to_string(list_concat(list_transform(range(pad), lambda x: 0), list_transform(ids, lambda x: 1)), ' ')) AS mask_md5 FROM b",
}
