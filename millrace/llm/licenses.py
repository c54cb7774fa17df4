"""License scan by diagonal voting (DataFrame functions only).

Every rolling k-gram hash of a document is joined with the template positions that have it. A hit at word p of the document and
word q of a template votes for diagonal p - q, and neighbouring diagonals merge (small insertions and deletions). A merged span is verified
by the template's places: it counts when enough of them stand in it, each place once, however often it was voted for.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import folded_words, table

# The phrases and labels of the base rule, and public licence notices as templates.
BASE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


#: Template places in one word of bits.
BITS = 62


def gram_hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(k)])


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """gram long -> places array<struct<template, at, label, n_grams>>; its size is fixed by the templates, never by the corpus."""
    rows = [(i, label, text.split()) for i, (label, text) in enumerate(templates)]
    t = spark.createDataFrame(rows, "template int, label string, w array<string>").withColumn("n_grams", F.size("w") - k + 1)
    t = t.where("n_grams > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("n_grams") - 1)).alias("at"))
    return t.select(gram_hash(F.col("w"), F.col("at"), k).alias("gram"), F.struct("template", "at", "label", "n_grams").alias("place")).groupBy("gram").agg(F.collect_list("place").alias("places"))


def base_label(words: Column, at: Column) -> Column:
    """Label of the base phrase whose words start at this place, else null."""
    rules = []
    for phrase, label in BASE_PHRASES:
        same = [F.get(words, at + i) == w for i, w in enumerate(phrase.split())]
        rules.append(F.when(reduce(lambda a, b: a & b, same), F.lit(label)))
    return F.coalesce(*rules)


def license_hits(docs: DataFrame, grams: DataFrame, k: int) -> DataFrame:
    """A row for each document (pos -1, n_words) and for each place with a base phrase or template k-gram."""
    w = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), folded_words(F.col("text")).alias("w"))
    w = w.select("doc_id", "text_hash", "w", F.explode_outer(F.sequence(F.lit(-1), F.size("w") - 1)).alias("pos"))
    w = w.withColumn("gram", gram_hash(F.col("w"), F.col("pos"), k)).join(F.broadcast(grams), "gram", "left")
    w = w.withColumn("base", F.when(F.col("pos") >= 0, base_label(F.col("w"), F.col("pos"))))
    w = w.where((F.col("pos") < 0) | F.col("base").isNotNull() | F.col("places").isNotNull())
    return w.select("doc_id", "text_hash", "pos", "base", "places", F.when(F.col("pos") < 0, F.size("w")).cast("long").alias("n_words"))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, k: int = 4, max_shift: int = 3, min_share: float = 0.6) -> DataFrame:
    """Licences named or quoted in each document.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels array, labels array (base and verified templates, sorted),
    score (largest share of a template's k-grams found on one merged diagonal; 1 if a base phrase stands there), spans
    array<struct<label, first, last, share>>. Diagonals of one template at most max_shift words apart merge. Null text counts as
    empty: no words, no labels, score 0. A long text counts whole. Repeated rows get equal rows, an empty table gives none. Extra columns
    are ignored."""
    grams = template_grams(docs.sparkSession, templates, k)
    hits = license_hits(docs.select("doc_id", "text"), grams, k)
    key = ["doc_id", "text_hash"]
    none = F.array(F.lit(None).cast("struct<template:int,at:int,label:string,n_grams:int>"))
    hits = hits.withColumn("place", F.explode(F.concat(F.when(F.col("base").isNotNull() | (F.col("pos") < 0), none).otherwise(F.array().cast("array<struct<template:int,at:int,label:string,n_grams:int>>")), F.coalesce("places", F.array().cast("array<struct<template:int,at:int,label:string,n_grams:int>>")))))
    hits = hits.select(*key, "pos", "n_words", F.when(F.col("place").isNull(), F.col("base")).alias("base"), F.col("place.template").alias("template"), F.col("place.label").alias("label"), F.col("place.n_grams").alias("n_grams"), F.coalesce(F.col("pos") - F.col("place.at"), F.lit(0)).alias("diagonal"), F.col("place.at").alias("at"))
    words = range(max((len(text.split()) for _, text in templates), default=0) // BITS + 1)
    places = [F.when(F.col("at").between(BITS * i, BITS * i + BITS - 1), F.expr(f"shiftleft(1L, at - {BITS * i})")).otherwise(0) for i in words]
    names = sorted({label for _, label in BASE_PHRASES})
    bit = F.coalesce(*[F.when(F.col("base") == x, F.lit(1 << i)) for i, x in enumerate(names)], F.lit(0))
    # A row per document and diagonal; every later step keeps this partitioning by document.
    votes = hits.groupBy(*key, "template", "label", "n_grams", "diagonal").agg(
        *(F.bit_or(x).alias(f"places{i}") for i, x in enumerate(places)), F.min("pos").alias("first"), F.max("pos").alias("last"), F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"),
        F.count("base").alias("n_base"), F.min(F.when(F.col("base").isNotNull(), F.col("pos"))).alias("first_word"), F.max(F.when(F.col("base").isNotNull(), F.col("pos"))).alias("last_word"), F.bit_or(bit).alias("bases"),
    ).repartition(*key)
    by = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > max_shift, F.lit(False)).cast("int")
    votes = votes.withColumn("apart", apart).withColumn("cluster", F.sum("apart").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    spans = votes.groupBy(*key, "template", "label", "cluster").agg(
        (sum((F.bit_count(F.bit_or(f"places{i}")) for i in words), F.lit(0)) / F.coalesce(F.first("n_grams"), F.lit(1))).alias("share"), F.min("first").alias("first"), (F.max("last") + k - 1).alias("last"),
        *[f(c).alias(c) for c, f in (("n_words", F.max), ("copies", F.sum), ("n_base", F.sum), ("first_word", F.min), ("last_word", F.max))], F.bit_or("bases").alias("bases"),
    )
    span = F.when(F.col("template").isNotNull() & (F.col("share") >= min_share), F.struct("label", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "share"))
    each = spans.groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"), F.sum("n_base").alias("n_base"), F.min("first_word").cast("long").alias("first_word"), F.max("last_word").cast("long").alias("last_word"),
        F.bit_or("bases").alias("bases"), F.sort_array(F.collect_list(span)).alias("spans"), F.max(F.when(F.col("template").isNotNull(), F.col("share"))).alias("best"),
    )
    # Repeated rows: their hits add up in one group, so counts are divided by the number of copies.
    each = each.withColumn("n_base", F.floor(F.col("n_base") / F.col("copies")).cast("long"))
    each = each.withColumn("base_labels", F.array_compact(F.array(*[F.when(F.col("bases").bitwiseAND(1 << i) != 0, F.lit(x)) for i, x in enumerate(names)])))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("spans", lambda s: s["label"]))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.col("best"), F.lit(0.0)))
    return each.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), score.alias("score"), "spans", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def _op1_sql(k: int = 4, max_shift: int = 3, min_share: float = 0.6) -> str:
    """The same scan in SQL, gram texts in the place of hashes."""
    templates = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    places = [(" AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(phrase.split())), label) for phrase, label in BASE_PHRASES]
    base = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(w) + 1), lambda i: {same})) - 1 AS pos FROM d" for same, label in places)
    gram = f"array_to_string(w[i:i + {k - 1}], ' ')"
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - {k - 2})) AS i, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: {gram})) AS g FROM d WHERE len(w) >= {k}),
t AS (SELECT id, label, string_split(text, ' ') AS w FROM (VALUES {templates}) t(id, label, text)),
tg AS (SELECT id, label, n, i, {gram} AS g FROM (SELECT *, len(w) - {k - 1} AS n, unnest(range(1, len(w) - {k - 2})) AS i FROM t WHERE len(w) >= {k})),
v AS (SELECT doc_id, id, label, n, p.i - tg.i AS diagonal, list(DISTINCT tg.i) AS places FROM p JOIN tg USING (g) GROUP BY ALL),
a AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, id ORDER BY diagonal) > {max_shift}, false)::INT AS apart FROM v),
c AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, id ORDER BY diagonal) AS cluster FROM a),
s AS (SELECT doc_id, label, len(list_distinct(flatten(list(places))))::DOUBLE / n AS share FROM c GROUP BY doc_id, id, label, n, cluster),
b AS ({base}),
bd AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM s WHERE share >= {min_share}) GROUP BY doc_id),
m AS (SELECT doc_id, max(share) AS best FROM s GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0) END::DOUBLE AS score
FROM d LEFT JOIN bd USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN m USING (doc_id)"""


OP1_SQL = _op1_sql()
