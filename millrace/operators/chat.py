"""Chat records: building, filtering, flattening, uniting, shuffling, rendering, and resolving attempts."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

MESSAGE = "struct<role:string,content:string>"


def pair(question: Column, answer: Column) -> Column:
    """messages of one question and its answer."""

    def message(role: str, c: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), c.alias("content"))

    return F.array(message("user", question), message("assistant", answer))


def without_role(messages: Column, role: str = "system") -> Column:
    return F.filter(messages, lambda m: m["role"] != role)


def conversations_to_records(df: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(key, messages): the turns of each conversation in order."""
    m = df.select(key, F.struct(F.col(order).alias("o"), "role", F.col("text").alias("content")).alias("m"))
    sorted_ = F.sort_array(F.collect_list("m"))
    return m.groupBy(key).agg(F.transform(sorted_, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def first_user_content(messages: Column) -> Column:
    """Stripped content of the first user message; null where there is none or it is blank."""
    return F.nullif(strip(F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))["content"]), F.lit(""))


def adjacent_pairs(df: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(key, order, question, answer): each user turn that an assistant turn follows at once."""
    q = df.where("role = 'user'").select(key, F.col(order).alias(order), F.col("text").alias("question"))
    a = df.where("role = 'assistant'").select(key, (F.col(order) - 1).alias(order), F.col("text").alias("answer"))
    return q.join(a, [key, order])


def shuffled(df: DataFrame, key: Column, seed: int = 42) -> DataFrame:
    """A reproducible order: by a digest of seed and key. The column shuffle_key holds it."""
    return df.withColumn("shuffle_key", F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))))


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name, repeats kept."""
    return reduce(DataFrame.unionByName, frames)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def render_chat(messages: Column) -> Column:
    """One training string: <role>content lines."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<"), m["role"], F.lit(">"), m["content"])), "\n")


def resolve_attempts(df: DataFrame, key: str, attempt: str, valid: Column, value: str, most: int = 3) -> DataFrame:
    """(key, answer, last_answer, status, retries): the first valid of at most so many attempts. Combines on the map side."""
    df = df.where(F.col(attempt) < most).withColumn("_valid", valid)
    out = df.groupBy(key).agg(
        F.min(F.when(F.col("_valid"), F.struct(F.col(attempt).alias("a"), F.col(value).alias("v")))).alias("ok"),
        F.max(F.struct(F.col(attempt).alias("a"), F.col(value).alias("v"))).alias("last"),
    )
    return out.select(key, F.col("ok.v").alias("answer"), F.coalesce("ok.v", "last.v").alias("last_answer"), F.when(F.col("ok").isNotNull(), "ok").otherwise("rejected").alias("status"), F.coalesce("ok.a", "last.a").cast("long").alias("retries"))
