"""The corpus pipeline: five stages, each one operator over all that the stage before it kept.

Stages read and return the columns of documents (COLUMNS; any others are left out), the last one adds block, slot, place and in_mix.
Every stage handles an empty table, null values in any column, repeated rows and rows that share a doc_id.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language, mixing, neardup, privacy
from millrace.llm.common import table
from millrace.sources.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = ["_id", "_null", "_hash"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a language (null, or no letter); a null lang takes the predicted one."""
    docs = docs.select(*COLUMNS)
    named = language.identify(docs, language.fit(docs), keep=COLUMNS).where(F.col("lang_pred") != "und")
    return named.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """COLUMNS and a key that names a row by its doc_id, null or not, and its text: columns without nulls, so that a join on them and
    what follows share one exchange."""
    return docs.select(*COLUMNS, F.coalesce("doc_id", F.lit(0)).alias("_id"), F.isnull("doc_id").alias("_null"), F.xxhash64("text").alias("_hash"))


def keys(found: DataFrame) -> DataFrame:
    """The keys of an operator's rows (doc_id, text_hash)."""
    return found.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.isnull("doc_id").alias("_null"), F.col("text_hash").alias("_hash")).distinct()


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (0.8 of their shingles of five words), the one with the smallest doc_id; equal
    rows become one."""
    kept = keys(neardup.near_duplicates(docs, size=5).where("kept"))
    return keyed(docs).join(kept, KEY, "left_semi").dropDuplicates(KEY).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    found = keys(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated"))
    return keyed(docs).join(found, KEY, "left_anti").select(*COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and disclosing terms by placeholders."""
    docs = docs.select(*COLUMNS)
    clean = privacy.sanitise(docs, keep=COLUMNS)
    return clean.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.char_length("redacted").cast("long").alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Interleave the sources; weights are the square roots of their sizes."""
    return mixing.mix(docs, keep=COLUMNS)


STAGES = [
    ("language", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("mixing", mixture),
]

#: Naive Bayes and Pfair scheduling have no SQL form; tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name == STAGES[-1][0] else stored(docs)
    return docs
