"""Copied text: trigram containment within a row, over a whole corpus, and long verbatim segments."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import letter_tokens, normalize_ws, sentences_loose


def trigrams(tokens: Column) -> Column:
    """Distinct trigrams of an array of tokens, joined by a space; none below three tokens."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(tokens) - 2, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, 3), " "))
    return F.when(F.size(tokens) >= 3, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def containment(source: Column, answer: Column) -> Column:
    """Share of the answer's distinct trigrams that the source has; null where either side has fewer than six tokens.

    Tokens and trigrams are elements of one-element arrays, so that lambdas bind them instead of computing them at every place."""
    tokens = F.array(F.struct(letter_tokens(source).alias("s"), letter_tokens(answer).alias("a")))
    enough = F.filter(tokens, lambda x: (F.size(x["s"]) >= 6) & (F.size(x["a"]) >= 6))
    grams = F.transform(enough, lambda x: F.struct(trigrams(x["s"]).alias("s"), trigrams(x["a"]).alias("a")))
    return F.get(F.transform(grams, lambda x: F.size(F.array_intersect(x["s"], x["a"])) / F.size(x["a"])), F.lit(0))


def long_segment(source: Column, answer: Column, least: int = 90) -> Column:
    """Whether a sentence of the source of at least so many characters stands verbatim in the answer, case and spacing aside."""
    s, a = F.lower(normalize_ws(source)), F.lower(normalize_ws(answer))
    enough = (F.size(letter_tokens(source)) >= 6) & (F.size(letter_tokens(answer)) >= 6)
    return enough & F.exists(sentences_loose(s), lambda x: (F.char_length(x) >= least) & F.contains(a, x))


def is_copy(source: Column, answer: Column, most: float = 0.30) -> Column:
    return F.coalesce(containment(source, answer) > most, F.lit(False)) | F.coalesce(long_segment(source, answer), F.lit(False))


def checked_broadcast(df: DataFrame, most_rows: int = 2_000_000, most_bytes: int = 256_000_000) -> DataFrame:
    """Broadcast df if it has at most most_rows rows and, as JSON, most_bytes; otherwise leave the join to shuffle both sides."""
    if df.limit(most_rows + 1).count() > most_rows:
        return df
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= most_bytes else df


def corpus_containment(docs: DataFrame, items: DataFrame, least: float = 0.30) -> DataFrame:
    """(doc_id, item_id, hits, item_grams) of the pairs with containment above least, the item's trigrams as denominator.

    An inverted index join: the items' trigrams are the index; each document trigram that hits is counted, nothing else is kept."""
    t = items.select("item_id", letter_tokens(F.col("text")).alias("t")).where("size(t) >= 6")
    grams = t.select("item_id", trigrams(F.col("t")).alias("g")).select("item_id", F.size("g").alias("item_grams"), F.explode("g").alias("gram"))
    index = checked_broadcast(grams.groupBy("gram").agg(F.collect_list(F.struct("item_id", "item_grams")).alias("items")))
    d = docs.select("doc_id", letter_tokens(F.col("text")).alias("t")).where("size(t) >= 6")
    at = d.select("doc_id", "t", F.explode(F.sequence(F.lit(0), F.size("t") - 3)).alias("i"))
    at = at.select("doc_id", F.concat_ws(" ", F.get("t", F.col("i")), F.get("t", F.col("i") + 1), F.get("t", F.col("i") + 2)).alias("gram"))
    found = at.join(index, "gram").select("doc_id", "gram", "items").groupBy("doc_id", "gram").agg(F.first("items").alias("items"))
    pairs = found.select("doc_id", F.explode("items").alias("x")).groupBy("doc_id", F.col("x.item_id").alias("item_id"), F.col("x.item_grams").alias("item_grams")).agg(F.count("*").alias("hits"))
    return pairs.where(F.col("hits") / F.col("item_grams") > least).select("doc_id", "item_id", "hits", "item_grams")


#: Words of the run inside a sentence that is looked up; shorter sentences are looked up by so many characters of their longest word.
ANCHOR_WORDS, ANCHOR_CHARS = 3, 16


def corpus_long_segments(items: DataFrame, docs: DataFrame, least: int = 90) -> DataFrame:
    """(doc_id, item_id, segments): how many different sentences of an item, of at least so many characters, stand verbatim anywhere in a
    document, case and spacing aside; they may begin and end inside its words.

    A sentence is looked up by the first words inside it, which are whole words wherever it stands. Where it has too few, one of its
    words has at least least / (ANCHOR_WORDS + 1) - 1 characters, and a part of that one is looked up in the documents' words of that
    length. Each candidate is confirmed on the whole text."""
    longest = max(ANCHOR_CHARS, -(-(least - ANCHOR_WORDS) // (ANCHOR_WORDS + 1)))
    s = items.select("item_id", F.explode(F.array_distinct(sentences_loose(F.lower(normalize_ws(F.col("text")))))).alias("s")).where(F.char_length("s") >= least)
    w = F.split("s", " ")
    top = F.array_max(F.transform(w, lambda x: F.struct(F.char_length(x).alias("n"), x.alias("x"))))["x"]
    anchor = F.when(F.size(w) >= ANCHOR_WORDS + 2, F.xxhash64(*(F.get(w, F.lit(i + 1)) for i in range(ANCHOR_WORDS)))).otherwise(F.xxhash64(F.lit("part"), F.substring(top, 1, ANCHOR_CHARS)))
    s = s.select("item_id", "s", anchor.alias("anchor"))
    index = checked_broadcast(s.select("anchor").distinct())
    d = docs.select("doc_id", F.split(F.lower(normalize_ws(F.col("text"))), " ").alias("w"))
    runs = F.transform(F.sequence(F.lit(0), F.size("w") - ANCHOR_WORDS), lambda i: F.xxhash64(*(F.get("w", i + k) for k in range(ANCHOR_WORDS))))
    runs = F.when(F.size("w") >= ANCHOR_WORDS, runs).otherwise(F.array().cast("array<bigint>"))
    parts = F.transform(F.filter("w", lambda x: F.char_length(x) >= longest), lambda x: F.transform(F.sequence(F.lit(1), F.char_length(x) - ANCHOR_CHARS + 1), lambda i: F.xxhash64(F.lit("part"), F.substr(x, i, F.lit(ANCHOR_CHARS)))))
    found = d.select("doc_id", F.explode(F.array_distinct(F.concat(runs, F.flatten(parts)))).alias("anchor")).join(index, "anchor")
    candidates = checked_broadcast(found.join(checked_broadcast(s), "anchor").select("doc_id", "item_id", "s").distinct())
    hits = docs.select("doc_id", F.lower(normalize_ws(F.col("text"))).alias("t")).join(candidates, "doc_id").where(F.contains("t", "s"))
    return hits.select("doc_id", "item_id", "s").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("segments"))
