"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidate edges.

Documents with equal shingle sets fall into one class by a 128-bit hash of the set; only class representatives go on. A document
hashes its shingles once; bin i keeps the least hash of its range, and an empty bin copies the bin that a fixed random sequence
names first among those that are not empty. Bands of bins make buckets. A bucket proposes edges from its centre to its members, never
pairs among members; edges are confirmed on the full sets. A star can lose a link between two members that are not centres.
So documents that share a bucket with another component meet again in buckets of their rarest shingles (two sets of the similarity
share one of these), and every pair of different components that is left in these buckets is compared, save those that sizes, positions
or bitmaps prove to be below the similarity. Components come from alternating large-star and small-star passes over the confirmed links.
"""

from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import forget, release, small_side, stored
from .common import table
from .hashing import mixed, word_hashes

#: Two documents with similarity 0.8 share no band with probability (1 - 0.8 ** ROWS) ** BANDS, about 1 in 900,000.
BANDS, ROWS = 45, 6
BINS = BANDS * ROWS
_TRIES = 4096
#: Ids or edges that are broadcast at most (16 bytes each); more are joined by shuffle.
MAX_BROADCAST_ROWS = 1_000_000
#: Members of a centre that are compared in one group; a larger star is dealt to several, each with the centre's set.
STAR = 200
SKETCH_BITS = 16
#: Words of the bitmap of a set. A bucket with more comparisons than MOST (some seconds of one task) is split by one more shared shingle,
#: up to DEPTH times; a split makes a row for each further shingle of a member, so small buckets are better compared at once.
WORDS, MOST, DEPTH = 8, 20_000_000, 2


@cache
def _factors(size: int) -> np.ndarray:
    return np.random.default_rng(size).integers(1, 2**62, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words, but not none, has one shingle."""
    h = word_hashes(text.encode().lower()) if text else np.zeros(0, np.uint64)  # bytes.lower() changes A-Z only
    if 0 < len(h) < size:
        return mixed(np.array([xxhash.xxh64_intdigest(h.tobytes(), seed=len(h))], np.uint64))
    if not len(h):
        return h
    odd = _factors(size)
    n = len(h) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += mixed(h[k : n + k]) * odd[k]
    return np.unique(mixed(total))


class Signer:
    """Band keys of shingle sets."""

    def __init__(self):
        rng = np.random.default_rng(7)
        self.tries = rng.integers(0, BINS, (_TRIES, BINS), dtype=np.int64)
        self.odd = rng.integers(1, 2**62, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))

    def bands(self, s: np.ndarray) -> np.ndarray:
        """s: sorted hashes, not empty."""
        at = ((s >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        value, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
        bins = at[first].astype(np.int64)
        value[bins], full[bins] = s[first], True
        empty, step, t = np.flatnonzero(~full), 4 * BINS // len(bins) + 4, 0
        found = value.copy()
        while len(empty) and t < _TRIES:
            ok = full[self.tries[t : t + step, empty]]
            done = ok.any(0)
            source = self.tries[t + ok.argmax(0)[done], empty[done]]
            found[empty[done]] = value[source]
            empty, t = empty[~done], t + step
        for i in empty.tolist():  # next full bin, for the rare set that no try reached
            found[i] = value[bins[np.searchsorted(bins, i) % len(bins)]]
        return mixed((mixed(found).reshape(BANDS, ROWS) * self.odd).sum(1, dtype=np.uint64) ^ self.band)


def _sign(batches, size: int):
    signer = Signer()
    for batch in batches:
        n, names, keys = [], [], []
        for text in batch.column(1):
            s = shingles(text.as_py(), size)
            n.append(len(s))
            names.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            keys.append(signer.bands(s).view(np.int64) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n_shingles", "set_hash", "bands"])


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """docs: doc_id, text. Adds the hash of the text, by which rows that share a doc_id are told apart."""
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    return docs.mapInArrow(partial(_sign, size=size), "doc_id long, text_hash long, n_shingles long, set_hash binary, bands array<long>")


def _sets(batches, size: int):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t.as_py(), size).tobytes() for t in batch.column(1)], pa.binary())], names=["id", "shingles"])


def _confirm(batches, percent: int):
    """Rows sorted by centre and part: the centre's set (once for each text that has its id), then the members' sets."""
    key, heads, fresh = None, [], False
    for batch in batches:
        c, m = [], []
        for centre, part, member, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            own = np.frombuffer(own.as_buffer(), np.uint64)
            if member is None:
                heads = [*heads, own] if (centre, part) == key and fresh else [own]
                key, fresh = (centre, part), True
                continue
            fresh = False
            for head in heads if (centre, part) == key else ():
                both = len(np.intersect1d(head, own, assume_unique=True))
                if 100 * both >= percent * (len(head) + len(own) - both):
                    c.append(centre)
                    m.append(member)
                    break
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(m, pa.int64())], names=["a", "b"])


def crowded(reps: DataFrame) -> DataFrame:
    """(bucket, id, n, weight) of the buckets with several members. weight: over the document's buckets, the sum of their sizes; a text
    that many others were made from has the largest and so becomes the centre of its buckets."""
    rows = reps.select(F.explode("bands").alias("bucket"), "id", "n")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    rows = stored(rows.join(sizes, "bucket"))
    weight = rows.groupBy("id").agg(F.sum("size").alias("weight"))
    out = stored(rows.drop("size").join(weight, "id"))
    forget(rows)
    return out


def star_edges(buckets: DataFrame, percent: int) -> DataFrame:
    """Distinct edges (centre c, member m) from the heaviest member of each bucket to the others. The same few documents lead a group's buckets in
    all bands, so that a group of any size has few edges for each member."""
    head = F.max_by(F.struct("id", "n"), F.struct("weight", -F.col("id")))
    pairs = buckets.join(buckets.groupBy("bucket").agg(head.alias("c")), "bucket").select("id", "n", "c")
    may = pairs.where((F.col("id") != F.col("c.id")) & (100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n")))
    return may.select(F.col("c.id").alias("c"), F.col("id").alias("m")).distinct()


def _sketch(batches):
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for x in batch.column(0):
            counts += np.bincount(_sketched(np.frombuffer(x.as_buffer(), np.uint64)), minlength=1 << SKETCH_BITS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["at", "count"])


def _sketched(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _rare(batches, counts, percent: int):
    for batch in batches:
        ns, owns, keys, bits = [], [], [], []
        for x in batch.column(1):
            s = np.frombuffer(x.as_buffer(), np.uint64)
            n = len(s)
            own = n - -(-percent * n // 100) + 1
            keys.append(s[np.lexsort((s, counts.value[_sketched(s)]))[: own + DEPTH]].view(np.int64))
            odd = np.bincount((s % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
            bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            ns.append(n)
            owns.append(own)
        columns = [pa.array(ns, pa.int64()), pa.array(owns, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n", "own", "tokens", "bits"])


def rare_buckets(buckets: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, n, own, tokens, bits) of the documents that share a band bucket with another component. tokens: the rarest shingles of the
    set, rarest first; two sets of the similarity share one of the first own of each (the new buckets), and k more among the first own + k.
    bits: the parity of the shingles in each of 64 * WORDS classes; sets differ in at least as many shingles as bitmaps in bits. The order
    of rarity comes from a counting sketch of fixed size (any order that all documents share is right, a good one only makes small buckets)."""
    rows = buckets.join(labels, "id", "left").select("bucket", "id", F.coalesce("label", "id").alias("label"))
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    open_ = rows.join(mixed, "bucket", "left_semi").select("id").distinct()
    own = stored(sets.join(open_, "id", "left_semi"))
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for at, n in own.select("shingles").mapInArrow(_sketch, "at int, count long").groupBy("at").agg(F.sum("count")).collect():
        counts[at] = n
    value = sets.sparkSession.sparkContext.broadcast(counts)
    return stored(own.mapInArrow(partial(_rare, counts=value, percent=percent), "id long, n long, own int, tokens array<long>, bits array<long>"))


def cross_edges(rare: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Distinct edges (c, m) of all pairs of different components that share a rare bucket and may reach the similarity.

    In a bucket the members outside its largest component are compared with all members, so pairs within that component cost nothing. A
    bucket with many comparisons is split by the next shingle that both must share; sets of the similarity that are not equal share
    percent / (100 - percent) shingles at least, which bounds the splits."""
    rare = rare.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    rows = rare.select("id", "n", "label", F.posexplode(F.slice("tokens", F.lit(1), F.col("own"))).alias("at", "bucket"))
    words = rare.select("id", *(F.get("bits", F.lit(i)).alias(f"w{i}") for i in range(WORDS)))
    least = -(-percent // (100 - percent)) if percent < 100 else DEPTH + 1
    depth, out = max(0, min(DEPTH, least - 1)), []
    for level in range(depth + 1):
        parts = rows.groupBy("bucket", "label").agg(F.count("*").alias("size"))
        heads = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("size").alias("all"), F.max(F.struct("size", "label")).alias("lead")).where("parts > 1")
        heads = heads.select("bucket", F.col("lead.label").alias("lead"), (F.col("all") * (F.col("all") - F.col("lead.size"))).alias("work"))
        rows = stored(rows.join(heads, "bucket"))
        ready = rows if level == depth else rows.where(F.col("work") <= MOST)
        full = ready.drop("work").join(words, "id")
        x, y = full.where("label <> lead").alias("x"), full.drop("lead").alias("y")
        sizes = F.col("x.n") + F.col("y.n")
        near = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
        rest = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) + level
        differ = sum((F.bit_count(F.col(f"x.w{i}").bitwiseXOR(F.col(f"y.w{i}"))) for i in range(WORDS)), F.lit(0))
        once = (F.col("y.label") == F.col("x.lead")) | (F.col("x.id") < F.col("y.id"))
        may = near & (rest * (100 + percent) >= percent * sizes) & (differ * (100 + percent) <= (100 - percent) * sizes)
        both = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") != F.col("y.label")) & once & may)
        out.append(both.select(F.least("x.id", "y.id").alias("c"), F.greatest("x.id", "y.id").alias("m")))
        if level < depth:
            hot = rows.where(F.col("work") > MOST).select("id", "n", "label", "at", "bucket")
            if hot.isEmpty():
                break
            further = F.slice("tokens", F.col("at") + 2, F.greatest(F.col("own") + level - F.col("at"), F.lit(0)))
            hot = hot.join(rare.select("id", "own", "tokens"), "id").select("id", "n", "label", "bucket", "at", F.posexplode(further).alias("k", "token"))
            rows = hot.select("id", "n", "label", (F.col("at") + 1 + F.col("k")).alias("at"), F.xxhash64("bucket", "token").alias("bucket"))
    return reduce(DataFrame.unionByName, out).distinct()


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b): the edges (c, m) whose full sets meet the similarity. The sets stay where they are; those of the edges go to their
    centres, each member once for each of its edges, and a centre once for each STAR members."""
    edges = stored(edges)
    size = edges.groupBy("c").agg(F.ceil(F.count("*") / STAR).alias("parts"))
    plain, edges = edges, stored(edges.join(size, "c").select("c", "m", F.pmod(F.xxhash64("m"), "parts").alias("part")))
    forget(plain)
    centres = edges.select("c", "part").distinct()
    members = sets.join(small_side(edges, MAX_BROADCAST_ROWS), F.col("id") == F.col("m")).select("c", "part", "m", "shingles")
    heads = sets.join(small_side(centres, MAX_BROADCAST_ROWS), F.col("id") == F.col("c")).select("c", "part", F.lit(None).cast("long").alias("m"), "shingles")
    rows = members.unionByName(heads).repartition("c", "part").sortWithinPartitions("c", "part", F.col("m").asc_nulls_first())
    links = stored(rows.mapInArrow(partial(_confirm, percent=percent), "a long, b long").distinct())
    forget(edges)
    return links


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id reachable, for every id with a link. Alternating large-star and small-star passes."""
    edges, state = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        last, edges = edges, stored(small.select("e.u", "e.v").where("u <> v").distinct())
        forget(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
        state = now


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (id, label) after further links (a, b): components of the labels, then renamed."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(labels.withColumnRenamed("id", end), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    renamed = components(ends)
    old = labels.join(renamed.select(F.col("id").alias("label"), F.col("label").alias("new")), "label", "left")
    return stored(old.select("id", F.coalesce("new", "label").alias("label")).unionByName(renamed))


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """Connected components of the documents whose shingle sets have a Jaccard similarity of percent / 100 at least.

    Returns doc_id, text_hash, n_shingles, component_id (smallest doc_id reachable), kept (the row with that doc_id), one row per
    input row; an empty table gives none.
    Null, empty and wordless texts have no shingles and are linked with nothing. Rows with a null doc_id are linked with nothing, have
    a null component and are kept. Rows that share a doc_id are one node, and are all kept where they lead their component. A long text
    counts whole. Extra columns are ignored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(signatures(docs, size))
    linkable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("set_hash").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes)
    buckets = crowded(classes)
    wanted = stored(buckets.select("id").distinct())
    texts = docs.withColumnRenamed("doc_id", "id").join(small_side(wanted, MAX_BROADCAST_ROWS), "id", "left_semi")
    sets = stored(texts.mapInArrow(partial(_sets, size=size), "id long, shingles binary"))
    labels = components(confirmed(star_edges(buckets, percent), sets, percent))
    rare = rare_buckets(buckets, labels, sets, percent)
    new = confirmed(cross_edges(rare, labels, percent), sets, percent)
    if not new.isEmpty():
        labels = joined(labels, new)
    forget(buckets, wanted, sets, rare, new)
    release(docs.sparkSession)
    named = classes.select("set_hash", "id")
    named = named.join(labels, "id", "left").select("set_hash", F.coalesce("label", "id").alias("id"))
    out = signed.drop("bands").join(named, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op8_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]] WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, component_id = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.a = d.doc_id
"""
