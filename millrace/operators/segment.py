"""One text to many pieces: greedy sentence packing, overlapping token windows, header-led sections."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import regex, words_in


def pack_bounds(sizes: Column, least: int, most: int) -> Column:
    """Greedy packing of consecutive sizes: array<struct<start, stop>> of 0-based, half-open runs. A run closes before a size that
    would take it above most, if it has at least least by then; a last run below least is left out."""
    zero = F.struct(F.array().cast("array<struct<start:int,stop:int>>").alias("runs"), F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit(0).alias("i"))

    def step(a: Column, x: Column) -> Column:
        close = (a["n"] + x > most) & (a["n"] >= least)
        run = F.struct(a["start"].alias("start"), a["i"].alias("stop"))
        return F.struct(
            F.when(close, F.concat(a["runs"], F.array(run))).otherwise(a["runs"]).alias("runs"),
            F.when(close, a["i"]).otherwise(a["start"]).alias("start"),
            (x + F.when(close, 0).otherwise(a["n"])).alias("n"),
            (a["i"] + 1).alias("i"),
        )

    def finish(a: Column) -> Column:
        run = F.struct(a["start"].alias("start"), a["i"].alias("stop"))
        return F.when(a["n"] >= least, F.concat(a["runs"], F.array(run))).otherwise(a["runs"])

    return F.aggregate(sizes, zero, step, finish)


def pack(sentences: Column, least: int, most: int) -> Column:
    """Consecutive sentences joined to passages by pack_bounds."""
    sizes = F.transform(sentences, words_in)
    return F.transform(pack_bounds(sizes, least, most), lambda r: F.array_join(F.slice(sentences, r["start"] + 1, r["stop"] - r["start"]), " "))


def split_long_passage(normalized: Column, sentences: Column, least: int = 50, most: int = 180) -> Column:
    """A text of at most `most` words, or of one sentence, is one passage; others are packed and a short tail is dropped."""
    whole = (words_in(normalized) <= most) | (F.size(sentences) <= 1)
    return F.when(whole, F.array(normalized)).otherwise(pack(sentences, least, most))


def token_windows(df: DataFrame, tokens: Column, size: int = 2048, overlap: int = 128) -> DataFrame:
    """Overlapping windows of an array: a row for each with pos and tokens. A last window always reaches the end; an array of at
    most size tokens is one window, and so is an empty one."""
    stride = size - overlap
    n = F.size(tokens)
    last = F.greatest(F.ceil((n - size) / stride), F.lit(0)).cast("int") * stride
    starts = df.withColumn("_tokens", tokens).select("*", F.posexplode(F.sequence(F.lit(0), last, F.lit(stride))).alias("pos", "_start"))
    return starts.withColumn("tokens", F.slice("_tokens", F.col("_start") + 1, size)).drop("_tokens", "_start")


def sections(text: Column, header: str) -> Column:
    """array<struct<header, body>> of the parts that a header pattern (without groups) leads; what stands before the first is left out."""
    heads = F.regexp_extract_all(text, F.lit(regex(f"({header})", "Ud")), F.lit(1))
    bodies = F.split(text, regex(header, "Ud"))
    return F.zip_with(heads, F.slice(bodies, F.lit(2), F.size(heads)), lambda h, b: F.struct(h.alias("header"), b.alias("body")))
