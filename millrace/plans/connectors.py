"""Queries on files, settings, lookups and cursors: what is written is read back and compared with the tables it came from."""

import json

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chat, compare, cursor
from ..sources import files
from ..sources.shared import shared_dir
from . import sql as S
from .answers import conversations
from .cleaning import docs
from .runs import _RUN, _run


def text_files(spark, sf_dir):
    """Every document saved as a file of its own, read back whole in the order of the files' names."""
    path = shared_dir(spark)
    d = docs(spark, sf_dir).select(F.format_string("doc%08d", "doc_id").alias("source"), "text")
    counts = files.save_texts(d, path)
    back = files.read_saved(spark, path).groupBy("source").agg(F.min(F.md5("text")).alias("text_md5"))
    return counts.join(back, "source").select("source", "n_words", "n_text_chars", "text_md5").orderBy("source")


def chunk_jsonl(spark, sf_dir):
    """JSON lines: chunks without white space at the right end, appended to by a second writer, read strictly."""
    path = shared_dir(spark)
    d = docs(spark, sf_dir).select("doc_id", F.concat("text", F.lit(" \n\t")).alias("text"))
    files.write_chunks(d.where("doc_id % 2 = 0"), path)
    files.write_chunks(d.where("doc_id % 2 = 1"), path, mode="append")
    return files.read_jsonl(spark, path, "doc_id bigint, text string", strict=True).select("doc_id", F.md5("text").alias("text_md5"), F.lit(True).alias("strict"))


def strip_system_in_place(spark, sf_dir):
    """Chat records rewritten without system messages; the old file stays as a backup."""
    path = shared_dir(spark)
    files.write_jsonl(chat.conversations_to_records(conversations(spark, sf_dir)), path)
    schema = "conv_id bigint, messages array<struct<role:string,content:string>>"
    files.rewrite(spark, path, lambda r: r.withColumn("messages", chat.without_role(F.col("messages"))), schema)
    new, old = (files.read_jsonl(spark, p, schema, strict=True).select("conv_id", F.size("messages").cast("long").alias(n)) for p, n in ((path, "n_after"), (f"{path}.bak", "n_before")))
    return old.join(new, "conv_id")


def run_sinks(spark, sf_dir):
    """The records and the metadata of one generation run, each in its own sink, read back and counted by status."""
    from ..operators import runs

    path, run = shared_dir(spark), _run(spark, sf_dir)
    files.append_jsonl(runs.records(run, "doc_id", "pos"), f"{path}/records")
    files.append_jsonl(runs.metadata(run, "doc_id", "pos", "source", "theme_tag"), f"{path}/metadata")
    made = files.read_jsonl(spark, f"{path}/records", f"doc_id bigint, pos int, {files.MESSAGES}", strict=True).select("doc_id", "pos", F.lit(1).alias("made"))
    seen = files.read_jsonl(spark, f"{path}/metadata", "doc_id bigint, pos int, status string", strict=True)
    return seen.join(made, ["doc_id", "pos"], "left").groupBy("status").agg(F.count("*").alias("n_attempts"), F.count("made").alias("n_records"))


NAMED_FILES = {"anglais": "en.txt", "allemand": "de.txt", "espagnol": "es.txt", "français": "fr.txt", "latin": "la.txt"}


def named_sources(spark, sf_dir):
    """A file for each language, read by a map of names; the map names one file that is not there."""
    path = shared_dir(spark)
    for lang, n in docs(spark, sf_dir).where("lang is not null").groupBy("lang").count().orderBy("lang").limit(1000).collect():
        files.write_small(spark, f"{path}/{lang}.txt", f"{lang}: {n}")
    return files.read_dimension(spark, path, NAMED_FILES).select("name", "found", F.coalesce("text", F.lit("")).alias("text"))


_LANGUAGES = ", ".join(f"({S.q(n)}, {S.q(f.removesuffix('.txt'))})" for n, f in NAMED_FILES.items())


def required_files(spark, sf_dir):
    """First matches of globs over the tables, and whether requiring them raises."""
    rows = []
    for pattern in ("bench*.parquet", "*.pdf", "reg*"):
        first = files.first_match(spark, f"{sf_dir}/{pattern}")
        try:
            files.require(spark, first or f"{sf_dir}/{pattern}")
            raised = False
        except FileNotFoundError:
            raised = True
        rows.append((pattern, first.rpartition("/")[2] if first else "", raised))
    return spark.createDataFrame(rows, "pattern string, first_file string, raised boolean")


QUESTIONS = """
  Que cherches-tu dans le silence ?
La mer console-t-elle ?

La mer console-t-elle ?  
\t Pourquoi rester ?
Que vaut un jour d'été ?

Que cherches-tu dans le silence ?
"""


def question_table(spark, sf_dir):
    return files.literal_rows(spark, QUESTIONS)


SETTINGS = {"r": 32, "lora_alpha": 64, "target_modules": ["q_proj", "v_proj"], "note": "été"}


def run_settings(spark, sf_dir):
    """Settings from a JSON file: one is overridden, one is missing."""
    path = f"{shared_dir(spark)}/adapter.json"
    files.write_small(spark, path, json.dumps(SETTINGS, ensure_ascii=False, indent=1))
    found = files.read_config(spark, path, "r int, lora_alpha int, target_modules array<string>, note string, seed int", r=16)
    return spark.createDataFrame([(k, json.dumps(v, ensure_ascii=False, separators=(",", ":"))) for k, v in found.items()], "name string, value string")


SHARDS = {"0": "model-00001.parquet", "1": "model-00002.parquet", "2": "model-00003.parquet"}


def tensor_lookup(spark, sf_dir):
    """Index to shard to tensor: an eighth of the keys is not in the index, a shard lacks the tensors of one label, one shard has no file."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.concat(F.lit("vec."), F.col("vec_id").cast("string")).alias("key"), "vec_id", "label", "embedding")
    shard = (F.col("vec_id") % 4).cast("string").alias("shard")
    index = e.where("vec_id % 8 <> 5").select("key", shard)
    tensors = e.where("label <> 3").select("key", shard, "embedding")
    found = compare.indexed_lookup(e, index, tensors, "key", "shard", "embedding")
    return found.select("key", compare.mapped(F.col("shard"), SHARDS, "").alias("file"), F.coalesce(F.size("embedding"), F.lit(0)).cast("long").alias("n_values"))


_TENSORS = f"""SELECT 'vec.' || vec_id::VARCHAR AS key, CASE WHEN vec_id % 8 = 5 THEN '' ELSE coalesce(CASE (vec_id % 4)::VARCHAR {" ".join(f"WHEN {S.q(k)} THEN {S.q(v)}" for k, v in SHARDS.items())} END, '') END AS file,
CASE WHEN vec_id % 8 = 5 OR label = 3 THEN 0 ELSE len(embedding) END::BIGINT AS n_values FROM embeddings"""


def cursor_policies(spark, sf_dir):
    """Cursors of each conversation under the three policies; a turn succeeds if it has ten words and is no system turn. Cursors of every
    seventh conversation are shifted by 5, so that some lie beyond the end and start again."""
    c = conversations(spark, sf_dir).select("conv_id", "turn", ((T.word_count(F.col("text")) >= 10) & (F.col("role") != "system")).alias("ok"))
    sizes = c.groupBy("conv_id").agg((F.max("turn") + 1).alias("n"))
    out = sizes
    for policy in cursor.POLICIES:
        out = out.join(cursor.committed(c, "conv_id", "turn", F.col("ok"), policy).withColumnRenamed("cursor", f"after_{policy}"), "conv_id")
    shifted = F.col("after_success") + F.when(F.col("conv_id") % 7 == 0, 5).otherwise(0)
    return out.withColumn("resumed", cursor.resumed(shifted, F.col("n")))


def progress_report(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "text", F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))).alias("shuffle_key"))
    return cursor.progress(d, "shuffle_key", "doc_id", T.word_count(F.col("text")) >= 50)


QUERIES = {
    "text_files": text_files,
    "chunk_jsonl": chunk_jsonl,
    "strip_system_in_place": strip_system_in_place,
    "run_sinks": run_sinks,
    "named_sources": named_sources,
    "required_files": required_files,
    "question_table": question_table,
    "run_settings": run_settings,
    "tensor_lookup": tensor_lookup,
    "cursor_policies": cursor_policies,
    "progress_report": progress_report,
}
SQL = {
    "text_files": f"SELECT printf('doc%08d', doc_id) AS source, {S.wc('t')}::BIGINT AS n_words, length(text)::BIGINT AS n_text_chars, md5(text) AS text_md5 FROM (SELECT *, {S.norm('text')} AS t FROM documents)",
    "chunk_jsonl": r"SELECT doc_id, md5(regexp_replace(text, '\s+$', '')) AS text_md5, true AS strict FROM documents",
    "strip_system_in_place": "SELECT conv_id, count(*)::BIGINT AS n_before, count(*) FILTER (role <> 'system')::BIGINT AS n_after FROM conversations GROUP BY conv_id",
    "run_sinks": f"{_RUN} SELECT status, count(*)::BIGINT AS n_attempts, count(*) FILTER (status = 'ok')::BIGINT AS n_records FROM run GROUP BY status",
    "named_sources": f"SELECT name, n IS NOT NULL AS found, coalesce(lang || ': ' || n::VARCHAR, '') AS text FROM (VALUES {_LANGUAGES}) t(name, lang) LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) USING (lang)",
    "required_files": "SELECT * FROM (VALUES ('bench*.parquet', 'benchmark.parquet', false), ('*.pdf', '', true), ('reg*', 'region.parquet', false)) t(pattern, first_file, raised)",
    "question_table": f"""SELECT (row_number() OVER (ORDER BY i) - 1)::INT AS pos, t AS text FROM (SELECT t, min(i) AS i FROM (SELECT {S.strip("x")} AS t, i FROM (SELECT unnest(l) AS x, unnest(range(len(l))) AS i FROM (SELECT string_split({S.q(QUESTIONS)}, chr(10)) AS l))) WHERE t <> '' GROUP BY t)""",
    "run_settings": """SELECT * FROM (VALUES ('r', '16'), ('lora_alpha', '64'), ('target_modules', '["q_proj","v_proj"]'), ('note', '"été"'), ('seed', 'null')) t(name, value)""",
    "tensor_lookup": _TENSORS,
    "cursor_policies": f"""SELECT conv_id, n, s AS after_success, n AS after_every, 0::BIGINT AS after_never, CASE WHEN s + CASE WHEN conv_id % 7 = 0 THEN 5 ELSE 0 END > n THEN 0 ELSE s + CASE WHEN conv_id % 7 = 0 THEN 5 ELSE 0 END END::BIGINT AS resumed
FROM (SELECT conv_id, max(turn) + 1 AS n, coalesce(max(CASE WHEN role <> 'system' AND {S.wc('t')} >= 10 THEN turn + 1 END), 0)::BIGINT AS s FROM (SELECT *, {S.norm('text')} AS t FROM conversations) GROUP BY conv_id)""",
    "progress_report": f"""SELECT * FROM (SELECT row_number() OVER o AS place, doc_id, sum(({S.wc('t')} >= 50)::BIGINT) OVER o::BIGINT AS n_ok FROM (SELECT *, {S.norm('text')} AS t, md5('42:' || doc_id::VARCHAR) AS k FROM documents) WINDOW o AS (ORDER BY k, doc_id)) WHERE place % 50 = 0""",
}
