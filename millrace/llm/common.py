"""Helpers shared by the training-data operators."""

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the licence and contamination contracts, after A-Z is lower-cased: runs of ASCII letters, digits and non-ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the fast built-in path, which does the same there."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def folded_words(text: Column) -> Column:
    return F.regexp_extract_all(fold_ascii(text), F.lit(WORD), F.lit(0))
