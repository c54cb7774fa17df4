"""Benchmark decontamination over a distributed positional index (DataFrame functions only).

The corpus is indexed once per run: every occurrence of an index term becomes a posting (row key, position, neighbourhood),
stored in the shared folder. A benchmark window is looked up through the posting list of its rarest term; the lists of its
other terms are intersected at their offsets, which the neighbourhood (the terms within one window length) holds.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.overlap import checked_broadcast
from ..sources.shared import stored
from .common import folded_words

#: Rows of the benchmark side that are broadcast at most; more are joined by shuffle.
MAX_BROADCAST_ROWS = 2_000_000


def benchmark_windows(bench: DataFrame, width: int) -> DataFrame:
    """One row per distinct window text: gram array<string>, items array of item ids. A short item is one window; null and
    wordless items have none."""
    w = bench.select(F.col("item_id"), folded_words(F.col("text")).alias("w"))
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1))))
    w = w.where((F.size("w") > 0) & F.col("item_id").isNotNull()).select("item_id", "w", start.alias("s"))
    return w.select("item_id", F.slice("w", F.col("s"), width).alias("gram")).groupBy("gram").agg(F.collect_set("item_id").alias("items"))


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Posting-list length of each of the terms over the whole corpus, zero included."""
    terms = checked_broadcast(terms, MAX_BROADCAST_ROWS)
    found = docs.select(F.explode_outer(folded_words(F.col("text"))).alias("term")).join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(found, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def choose_anchors(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Each window with its rarest term (ties: the smaller term, then the first place) and that term's offset."""
    placed = windows.select("gram", "items", F.posexplode("gram").alias("off", "term"))
    placed = placed.join(checked_broadcast(frequencies, MAX_BROADCAST_ROWS), "term")
    best = placed.groupBy("gram").agg(F.min(F.struct("n", "term", "off")).alias("a"), F.first("items").alias("items"))
    return best.select("gram", "items", F.col("a.term").alias("term"), F.col("a.off").alias("off"))


def positional_index(docs: DataFrame, terms: DataFrame, width: int) -> DataFrame:
    """Postings (doc_id, text_hash, pos, term, lead, near) of the terms, and for each document a row at pos -1 with n_words.

    near: the words from lead places before the posting to width - 1 after it."""
    words = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), folded_words(F.col("text")).alias("w")
    ).select("doc_id", "text_hash", "w", F.explode_outer(F.sequence(F.lit(-1), F.size("w") - 1)).alias("pos"))
    words = words.withColumn("term", F.when(F.col("pos") >= 0, F.get("w", F.col("pos"))))
    lead = F.least(F.col("pos"), F.lit(width - 1))
    near = F.when(F.col("pos") >= 0, F.slice("w", F.greatest(F.col("pos") - width + 2, F.lit(1)), lead + width))
    posting = ["doc_id", "text_hash", "pos", "term", lead.alias("lead"), near.alias("near"), F.when(F.col("pos") < 0, F.size("w")).cast("long").alias("n_words")]
    terms = terms.select("term", F.lit(True).alias("listed"))
    if terms.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:  # the words around are cut out of the few that stay
        return words.join(F.broadcast(terms), "term", "left").where((F.col("pos") < 0) | F.col("listed")).select(*posting)
    # Otherwise a posting is cut out of its text before the exchange, so that no text moves along with its words.
    postings = words.select(*posting)
    return postings.where("pos >= 0").join(terms, "term").select(*postings.columns).unionByName(postings.where("pos < 0"))


def phrase_matches(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """Postings joined with the windows they anchor: start, len, exact (the whole window stands there in order) and near
    (all its words stand within one window length of the anchor, in any order)."""
    at = index.where(F.col("pos") >= 0).join(checked_broadcast(anchors, MAX_BROADCAST_ROWS), "term")
    n = F.size("gram")
    here = F.when(F.col("lead") >= F.col("off"), F.slice("near", F.col("lead") - F.col("off") + 1, n))
    at = at.withColumn("exact", F.coalesce(here == F.col("gram"), F.lit(False)))
    at = at.withColumn("close", F.col("exact") | (F.size(F.array_except("gram", "near")) == 0))
    return at.where("close").select("doc_id", "text_hash", (F.col("pos") - F.col("off")).alias("start"), n.alias("len"), "items", "exact")


def covered_words(spans: Column) -> Column:
    """Words under the union of the spans, a sorted array of struct<start, len>."""
    state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(a: Column, s: Column) -> Column:
        end = s["start"] + s["len"]
        return F.struct((a["n"] + F.greatest(end - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], end).alias("end"))

    return F.aggregate(spans, state, step, lambda a: a["n"]).cast("long")


def decontaminate(docs: DataFrame, bench: DataFrame, width: int = 10) -> DataFrame:
    """Exact and proximity matches of every benchmark window in every document.

    Returns doc_id, text_hash, n_words, n_hit (words inside exact occurrences), n_items, items array<string> (sorted), n_near_items (items
    with a proximity match, exact ones included), contaminated. A null text has no words. An empty benchmark hits nothing.
    Rows that repeat a doc_id and text get equal results, one for each; rows that share only a doc_id are told apart by text.
    Null item ids are left out. Further columns of either table are ignored."""
    docs = docs.select("doc_id", "text")
    windows = stored(benchmark_windows(bench, width))
    frequencies = stored(term_frequencies(docs, windows.select(F.explode("gram").alias("term")).distinct()))
    anchors = stored(choose_anchors(windows, frequencies))
    index = stored(positional_index(docs, anchors.select("term").distinct(), width))
    hits = phrase_matches(index, anchors).withColumn("n_words", F.lit(None).cast("long"))
    lengths = index.where("pos < 0").select("doc_id", "text_hash", "n_words")
    span = F.when(F.col("exact"), F.struct("start", "len"))
    each = hits.unionByName(lengths, allowMissingColumns=True).groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"), F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("exact"), F.col("items"))))).alias("hit_items"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("near_items"),
    )
    items = F.array_sort(F.transform("hit_items", lambda x: x.cast("string")))
    return each.select(
        "doc_id", "text_hash", "n_words", covered_words(F.col("spans")).alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), items.alias("items"),
        F.size("near_items").cast("long").alias("n_near_items"), (F.size("spans") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near_items")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, len(list_slice(w, s, s + 9)) AS n, array_to_string(list_slice(w, s, s + 9), ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, item_id, s, dw.n FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
fr AS (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM d) GROUP BY term),
gt AS (SELECT g, unnest(string_split(g, ' ')) AS term, unnest(range(len(string_split(g, ' ')))) AS off FROM (SELECT DISTINCT g FROM bw)),
an AS (SELECT g, min(struct_pack(n := coalesce(n, 0), term := term, off := off)).term AS term FROM gt LEFT JOIN fr USING (term) GROUP BY g),
dp AS (SELECT doc_id, w, p, w[p] AS term FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
nr AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM dp JOIN an USING (term) JOIN bw USING (g) WHERE list_has_all(list_slice(w, greatest(p - 9, 1), p + 9), string_split(g, ' ')) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN nr USING (doc_id) LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
