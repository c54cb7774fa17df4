"""Queries on chat records, comparison of arrays, and incremental appends."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chat, compare
from ..sources.shared import shared_dir
from ..streaming import incremental
from . import sql as S
from .answers import conversations


def build_pairs(spark, sf_dir):
    p = chat.adjacent_pairs(conversations(spark, sf_dir)).withColumn("messages", chat.pair(F.col("question"), F.col("answer")))
    return p.select("conv_id", "turn", F.size("messages").cast("long").alias("n_messages"), F.md5(F.to_json(F.col("messages"))).alias("json_md5"))


def strip_system(spark, sf_dir):
    r = chat.require_columns(chat.conversations_to_records(conversations(spark, sf_dir)), "messages").withColumn("kept", chat.without_role(F.col("messages")))
    return r.select("conv_id", F.size("messages").cast("long").alias("n_before"), F.size("kept").cast("long").alias("n_after"), (F.size("kept") < F.size("messages")).alias("stripped"), F.md5(chat.render_chat(F.col("kept"))).alias("kept_md5"))


def strip_system_counts(spark, sf_dir):
    return strip_system(spark, sf_dir).agg(F.count("*").alias("n_rows"), F.count_if("stripped").alias("n_stripped"))


def first_user_message(spark, sf_dir):
    """Through JSON lines and back, with broken, blank and foreign lines mixed in."""
    r = chat.conversations_to_records(conversations(spark, sf_dir)).select("conv_id", F.to_json(F.struct("messages")).alias("line"))
    k = F.col("conv_id") % 10
    broken = F.when(k == 3, F.concat(F.lit("{"), F.col("line"))).when(k == 4, F.lit("")).when(k == 5, F.lit('{"other": 1}')).otherwise(F.col("line"))
    parsed = r.select("conv_id", F.from_json(broken, f"struct<messages:array<{chat.MESSAGE}>>").alias("j"))
    first = chat.first_user_content(F.col("j.messages"))
    return parsed.select("conv_id", first.alias("question")).where("question is not null").select("conv_id", F.md5("question").alias("question_md5"))


_FIRST_USER = f"""SELECT conv_id, md5(q) AS question_md5 FROM (SELECT conv_id, {S.strip("arg_min(text, turn)")} AS q FROM conversations WHERE role = 'user' AND conv_id % 10 NOT IN (3, 4, 5) GROUP BY conv_id) WHERE q <> ''"""


def _asked(spark, sf_dir):
    c = conversations(spark, sf_dir).where("role = 'user'").select("conv_id", "turn", T.normalize_ws(F.col("text")).alias("question"))
    done = c.where("conv_id % 2 = 0").select("question").distinct()
    return c, done


def retry_missing_anti(spark, sf_dir):
    c, done = _asked(spark, sf_dir)
    return c.join(done, "question", "left_anti").select("conv_id", "turn")


def already_present_semi(spark, sf_dir):
    c, done = _asked(spark, sf_dir)
    return c.join(done, "question", "left_semi").select("conv_id", "turn")


_ASKED = f"WITH c AS (SELECT conv_id, turn, {S.norm('text')} AS q FROM conversations WHERE role = 'user')"


def _rendered(spark, sf_dir):
    r = chat.conversations_to_records(conversations(spark, sf_dir))
    parts = [r.where(F.col("conv_id") % 3 == i).withColumn("part", F.lit(name)) for i, name in enumerate(("corpus", "light", "casual"))]
    return chat.shuffled(chat.union_all(*parts), F.col("conv_id")).select("conv_id", "part", "shuffle_key", chat.render_chat(F.col("messages")).alias("text"))


def union_shuffle_template(spark, sf_dir):
    return _rendered(spark, sf_dir).select("conv_id", "part", "shuffle_key", F.md5("text").alias("text_md5"))


_RECORDS = "SELECT conv_id, string_agg('<' || role || '>' || text, chr(10) ORDER BY turn, role, text) AS text, count(*) AS n FROM conversations GROUP BY conv_id"


def _arrays(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.concat(F.lit("vec."), F.col("vec_id").cast("string")).alias("key"), "label", F.col("embedding").alias("values"))
    moved = F.transform("values", lambda x: (x + F.lit(0.5)).cast("float"))
    after = e.select("key", F.when(F.col("label") < 5, moved).otherwise(F.col("values")).alias("values"))
    targets = e.select("key", (F.col("label") < 6).alias("is_target"))
    return e.where("label <> 8").select("key", "values"), after, targets


def _compared(spark, sf_dir):
    before, after, targets = _arrays(spark, sf_dir)
    return compare.compare_arrays(before, after.join(targets, "key"), "key", "values", F.lit(True)).drop("is_target").join(targets, "key")


def weights_compare(spark, sf_dir):
    return _compared(spark, sf_dir).select("key", "is_target", "status", F.coalesce(F.round("max_diff", 4), F.lit(-1.0)).alias("max_diff"))


def weights_verdict(spark, sf_dir):
    return compare.verdict(_compared(spark, sf_dir))


_COMPARED = """
WITH e AS (SELECT 'vec.' || vec_id::VARCHAR AS key, label, embedding AS v FROM embeddings),
a AS (SELECT key, label, CASE WHEN label < 5 THEN list_transform(v, lambda x: (x + 0.5::DOUBLE)::FLOAT) ELSE v END AS v FROM e),
c AS (SELECT a.key, a.label < 6 AS is_target, CASE WHEN b.key IS NULL THEN 'missing_before' WHEN a.v = b.v THEN 'identical' ELSE 'modified' END AS status,
      list_max(list_transform(range(1, len(a.v) + 1), lambda i: abs(a.v[i]::DOUBLE - b.v[i]::DOUBLE))) AS d FROM a LEFT JOIN (SELECT * FROM e WHERE label <> 8) b USING (key))"""

# The layers and modules that the comparison of two models covers, and its controls.
LAYERS = [0, 5, 10, 15, 20, 25, 30, 33]
ATTENTION = ["q_proj", "k_proj", "v_proj", "o_proj"]
MLP = ["gate_proj", "up_proj", "down_proj"]
CONTROLS = ["language_model.model.layers.0.input_layernorm.weight", "language_model.model.norm.weight", "language_model.lm_head.weight", "language_model.model.embed_tokens.weight"]


def key_enumeration(spark, sf_dir):
    return compare.module_keys(spark, LAYERS, ATTENTION, MLP, CONTROLS)


_KEYS = f"""SELECT 'language_model.model.layers.' || l::VARCHAR || '.' || CASE WHEN m IN ({", ".join(map(S.q, ATTENTION))}) THEN 'self_attn' ELSE 'mlp' END || '.' || m || '.weight' AS key, true AS is_target
FROM (SELECT unnest({LAYERS}) AS l), (SELECT unnest([{", ".join(map(S.q, ATTENTION + MLP))}]) AS m) UNION ALL SELECT unnest([{", ".join(map(S.q, CONTROLS))}]), false"""


def param_counts(spark, sf_dir):
    """Trainable and total parameters of the module grid: a module counts 32 rows and columns for each layer number."""
    k = key_enumeration(spark, sf_dir).withColumn("n", (F.char_length("key") * 1024).cast("long"))
    out = k.agg(F.sum(F.when(F.col("is_target"), F.col("n")).otherwise(0)).alias("trainable"), F.sum("n").alias("total"))
    return out.withColumn("percent", F.round(F.col("trainable") * 100.0 / F.col("total"), 4))


def config_equality(spark, sf_dir):
    """Adapter settings against the expected ones: equal sets of modules, equal rank and scale."""
    rows = [("same", MLP + ATTENTION, 32, 64), ("order", ATTENTION + MLP, 32, 64), ("fewer", ATTENTION, 32, 64), ("rank", ATTENTION + MLP, 16, 64), ("scale", ATTENTION + MLP, 32, 32)]
    c = spark.createDataFrame(rows, "name string, modules array<string>, r int, alpha int")
    wanted = F.array(*map(F.lit, ATTENTION + MLP))
    return c.select("name", ((F.array_sort(F.array_distinct("modules")) == F.array_sort(wanted)) & (F.col("r") == 32) & (F.col("alpha") == 64)).alias("equal"))


def incremental_append(spark, sf_dir):
    """Questions appended by a stream, run twice over the same target with a new checkpoint: the second run adds nothing."""
    work = shared_dir(spark)
    source = f"{sf_dir}/conversations.parq*"
    schema = conversations(spark, sf_dir).schema

    def ask(df):
        q = df.where("role = 'user'").select(T.normalize_ws(F.col("text")).alias("question"), "conv_id", "turn")
        return q.where("question <> ''")

    for run in range(2):
        incremental.append_new(spark, source, schema, f"{work}/out", f"{work}/checkpoint{run}", "question", ask)
    out = spark.read.schema("question string, conv_id long, turn long").parquet(f"{work}/out")
    return out.groupBy(F.md5("question").alias("question_md5")).agg(F.count("*").alias("n"))


QUERIES = {
    "build_pairs": build_pairs,
    "strip_system": strip_system,
    "strip_system_counts": strip_system_counts,
    "first_user_message": first_user_message,
    "retry_missing_anti": retry_missing_anti,
    "already_present_semi": already_present_semi,
    "union_shuffle_template": union_shuffle_template,
    "weights_compare": weights_compare,
    "weights_verdict": weights_verdict,
    "key_enumeration": key_enumeration,
    "param_counts": param_counts,
    "config_equality": config_equality,
    "incremental_append": incremental_append,
}
_ESCAPED = "replace(replace(replace({c}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"
SQL = {
    "build_pairs": f"""SELECT q.conv_id, q.turn, 2::BIGINT AS n_messages, md5('[{{"role":"user","content":"' || {_ESCAPED.format(c="q.text")} || '"}},{{"role":"assistant","content":"' || {_ESCAPED.format(c="a.text")} || '"}}]') AS json_md5
FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND q.role = 'user' AND a.role = 'assistant'""",
    "strip_system": "SELECT conv_id, count(*)::BIGINT AS n_before, count(*) FILTER (role <> 'system')::BIGINT AS n_after, count(*) FILTER (role = 'system') > 0 AS stripped, md5(coalesce(string_agg('<' || role || '>' || text, chr(10) ORDER BY turn, role, text) FILTER (role <> 'system'), '')) AS kept_md5 FROM conversations GROUP BY conv_id",
    "strip_system_counts": "SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (s)::BIGINT AS n_stripped FROM (SELECT bool_or(role = 'system') AS s FROM conversations GROUP BY conv_id)",
    "first_user_message": _FIRST_USER,
    "retry_missing_anti": f"{_ASKED} SELECT conv_id, turn FROM c WHERE q NOT IN (SELECT q FROM c WHERE conv_id % 2 = 0)",
    "already_present_semi": f"{_ASKED} SELECT conv_id, turn FROM c WHERE q IN (SELECT q FROM c WHERE conv_id % 2 = 0)",
    "union_shuffle_template": f"SELECT conv_id, CASE conv_id % 3 WHEN 0 THEN 'corpus' WHEN 1 THEN 'light' ELSE 'casual' END AS part, md5('42:' || conv_id::VARCHAR) AS shuffle_key, md5(text) AS text_md5 FROM ({_RECORDS})",
    "weights_compare": f"{_COMPARED} SELECT key, is_target, status, coalesce(round(d, 4), -1)::DOUBLE AS max_diff FROM c",
    "weights_verdict": f"""{_COMPARED}, n AS (SELECT count(*) FILTER (is_target AND status = 'modified')::BIGINT AS target_modified, count(*) FILTER (is_target AND status = 'identical')::BIGINT AS target_identical, count(*) FILTER (NOT is_target AND status = 'modified')::BIGINT AS control_modified,
      count(*) FILTER (NOT is_target AND status = 'identical')::BIGINT AS control_identical, count(*) FILTER (starts_with(status, 'missing'))::BIGINT AS skipped FROM c) SELECT *, CASE WHEN target_identical > 0 OR target_modified = 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM n""",
    "key_enumeration": _KEYS,
    "param_counts": f"WITH k AS (SELECT is_target, length(key) * 1024 AS n FROM ({_KEYS})) SELECT sum(n) FILTER (is_target)::BIGINT AS trainable, sum(n)::BIGINT AS total, round(sum(n) FILTER (is_target) * 100.0 / sum(n), 4)::DOUBLE AS percent FROM k",
    "config_equality": "SELECT * FROM (VALUES ('same', true), ('order', true), ('fewer', false), ('rank', false), ('scale', false)) t(name, equal)",
    "incremental_append": f"SELECT md5(q) AS question_md5, 1::BIGINT AS n FROM (SELECT DISTINCT {S.norm('text')} AS q FROM conversations WHERE role = 'user') WHERE q <> ''",
}
