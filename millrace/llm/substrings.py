"""Substring deduplication by suffix automata, of a whole corpus against itself and against a bounded reference.

Corpus against itself (remove_repeats). The reference is the corpus, so its shards cannot all be sent to everyone; instead text is
routed to the shard that can answer for it:

1. Documents are dealt to blocks. A window of `width` words is named by its minimizer, the least hash among its runs of GRAM words;
   equal windows have equal minimizers. Blocks count the documents of their distinct minimizers, buckets add the counts up and tell
   each block which of its minimizers occur in more than one document (and which are hot, in very many).
2. Blocks cut out the segments whose windows share a repeated minimizer, each distinct segment once with the least doc_id that has
   it, and send them to shards by minimizer; windows of a hot minimizer go one by one, by their own words.
3. A shard builds a suffix automaton of its segments in the order of their doc_ids, so that each state knows the least doc_id of its
   sequences, and streams the segments through it: the state that holds the last `width` words gives each window's least doc_id.
4. Blocks take out the words under windows whose least doc_id is smaller than the document's own.

Words are compared as words in step 3; hashes only route. Corpus against a reference (remove_reference): suffix automata of the
reference's shards are broadcast, and documents stream through them.
"""

from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .hashing import pieces, window_hashes

#: Words of the runs that minimizers are chosen from.
GRAM = 6
#: Bytes of text for each block, bucket and shard, and the least number of each.
PART_BYTES, MIN_PARTS = 4_000_000, 256
#: Documents beyond which a minimizer is hot.
HOT = 500

_REPLY = "block int, kind int, key binary, value binary"


def planes(a: np.ndarray) -> bytes:
    """The numbers byte plane by byte plane: planes of zeros vanish when the shuffle is compressed."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


class Block:
    """The documents of a block as one run of words, and the minimizers of their windows."""

    def __init__(self, texts: list[str | None], width: int):
        self.words, ends = [], []
        for text in texts:
            for piece in pieces((text or "").encode()):
                self.words += piece.split()
            ends.append(len(self.words))
        self.ends = np.array(ends, np.int64)
        self.starts = np.r_[np.zeros(1, np.int64), self.ends[:-1]] if ends else self.ends
        self.doc = np.repeat(np.arange(len(ends)), self.ends - self.starts)
        self.width = width
        h = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        n, gram = len(h) - width + 1, min(GRAM, width)
        if n <= 0:
            self.inside, self.least, self.at = np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        g = window_hashes(h, gram)
        self.inside = self.doc[:n] == self.doc[width - 1 :]
        self.least, self.at = g[:n].copy(), np.arange(n)
        for k in range(1, width - gram + 1):
            np.copyto(self.at, np.arange(k, n + k), where=g[k : n + k] < self.least)
            np.minimum(self.least, g[k : n + k], out=self.least)

    def minimizers(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct minimizers, sorted, documents that have each); only documents marked as known count."""
        use = self.inside & known[self.doc[: len(self.inside)]]
        m, d = self.least[use], self.doc[: len(self.inside)][use]
        order = np.lexsort((d, m))
        m, d = m[order], d[order]
        new = np.r_[True, (m[1:] != m[:-1]) | (d[1:] != d[:-1])] if len(m) else np.zeros(0, bool)
        return np.unique(m[new], return_counts=True)

    def segments(self, repeated: np.ndarray, hot: np.ndarray, known: np.ndarray):
        """(first word, windows, number of the minimizer in repeated) of the runs of windows with one repeated minimizer."""
        if not len(repeated) or not len(self.inside):
            return np.zeros((3, 0), np.int64)
        number = np.minimum(np.searchsorted(repeated, self.least), len(repeated) - 1)
        take = (repeated[number] == self.least) & self.inside & known[self.doc[: len(self.inside)]]
        first = take & np.r_[True, ~take[:-1] | (self.at[1:] != self.at[:-1]) | hot[number[1:]]]
        begin = np.flatnonzero(first)
        stop = np.flatnonzero(take & np.r_[~take[1:] | first[1:], True]) + 1
        return begin, stop - begin, number[begin]

    def content(self, start: int, windows: int) -> bytes:
        return b" ".join(self.words[start : start + windows + self.width - 1])


def _ids(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(doc_ids, which are not null)."""
    ids = docs["doc_id"]
    return ids.fill_null(0).to_numpy().astype(np.int64), ids.is_valid().to_numpy()


def _count(docs: pa.Table, width: int, buckets: int) -> pa.Table:
    """One chunk of minimizers and their counts for each bucket."""
    m, n = Block(docs["text"].to_pylist(), width).minimizers(_ids(docs)[1])
    cut = np.searchsorted(m, np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64))
    rows = [(b, planes(np.diff(m[i:j], prepend=np.uint64(0))), planes(n[i:j].astype(np.uint64))) for b, (i, j) in enumerate(zip(np.r_[0, cut], np.r_[cut, len(m)], strict=True)) if j > i]
    columns = [*zip(*rows, strict=True)] if rows else [[], [], []]
    block = docs["block"][0].as_py()
    return pa.table([pa.array(columns[0], pa.int32()), pa.array([block] * len(rows), pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["bucket", "block", "grams", "counts"])


def _repeated(chunks: pa.Table) -> pa.Table:
    """For each block its minimizers that several documents have, and which of them are hot."""
    grams = [np.cumsum(unplanes(x.as_py()), dtype=np.uint64) for x in chunks["grams"]]
    counts = np.concatenate([unplanes(x.as_py()) for x in chunks["counts"]])
    blocks = np.repeat(chunks["block"].to_numpy(), [len(g) for g in grams])
    m, which = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(which, counts, len(m))[which]
    take = np.flatnonzero(total > 1)
    take = take[np.argsort(blocks[take], kind="stable")]
    all_grams = np.concatenate(grams)[take]
    hot, of = (total[take] > HOT).astype(np.uint8), blocks[take]
    if not len(of):
        return _replies([])
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    rows = [(int(of[i]), 0, all_grams[i:j].tobytes(), hot[i:j].tobytes()) for i, j in zip(first, np.r_[first[1:], len(of)], strict=True)]
    return _replies(rows)


def _replies(rows: list) -> pa.Table:
    columns = [*zip(*rows, strict=True)] if rows else [[], [], [], []]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "kind", "key", "value"])


def _known_grams(replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    own = replies.filter(pa.compute.equal(replies["kind"], 0))
    if not own.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    grams = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in own["key"]])
    hot = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in own["value"]]).astype(bool)
    order = np.argsort(grams)
    return grams[order], hot[order]


def _cut(docs: pa.Table, replies: pa.Table, width: int):
    """(block, segments as arrays, their contents, the least doc_id of each content, the doc_ids, repeated grams, hot)."""
    block = Block(docs["text"].to_pylist(), width)
    grams, hot = _known_grams(replies)
    ids, known = _ids(docs)
    begin, windows, number = block.segments(grams, hot, known)
    contents = [block.content(s, c) for s, c in zip(begin.tolist(), windows.tolist(), strict=True)]
    least: dict[bytes, int] = {}
    for content, doc_id in zip(contents, ids[block.doc[begin]].tolist(), strict=True):
        if content not in least or doc_id < least[content]:
            least[content] = doc_id
    return block, begin, windows, number, contents, least, ids, grams, hot


def _send(docs: pa.Table, replies: pa.Table, width: int, shards: int) -> pa.Table:
    """The block's distinct segments with their least doc_ids, by shard."""
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
    names = ["shard", "block", "route", "content", "doc_id"]
    if not docs.num_rows or not replies.num_rows:
        return pa.table([pa.array([], t) for t in kinds], names=names)
    _, _, _, number, contents, least, _, grams, hot = _cut(docs, replies, width)
    route = {c: xxhash.xxh64_intdigest(c) if hot[k] else int(grams[k]) for c, k in zip(contents, number.tolist(), strict=True)}
    block = docs["block"][0].as_py()
    columns = [[(route[c] >> 16) % shards for c in least], [block] * len(least), [route[c] - (1 << 63) for c in least], list(least), list(least.values())]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _answer(rows: pa.Table, width: int) -> pa.Table:
    """For each block and segment of a shard the least doc_id of each window, where it is not the block's own least."""
    blocks, routes, contents, ids = (rows[c].to_pylist() for c in ("block", "route", "content", "doc_id"))
    least: dict[bytes, int] = {}
    mates: dict[int, set[bytes]] = {}
    for route, content, doc_id in zip(routes, contents, ids, strict=True):
        if content not in least or doc_id < least[content]:
            least[content] = doc_id
        mates.setdefault(route, set()).add(content)
    # Equal windows have the same route: a segment that is alone on its own shares windows with no other.
    several = {c for own in mates.values() if len(own) > 1 for c in own}
    automaton = SuffixAutomaton()
    split = {c: c.split(b" ") for c in sorted(several, key=least.get)}
    for content, words in split.items():
        automaton.add(words, least[content])
    found = {c: automaton.least_owners(words, width) for c, words in split.items()}
    out = []
    for block, content, doc_id in zip(blocks, contents, ids, strict=True):
        owners = found.get(content)
        if owners is None:
            owners = [least[content]] * (content.count(b" ") + 2 - width) if least[content] != doc_id else ()
        if any(x != doc_id for x in owners):
            out.append((block, 1, xxhash.xxh3_128_digest(content), np.array(owners, np.int64).tobytes()))
    return _replies(out)


def _remove(docs: pa.Table, replies: pa.Table, width: int) -> pa.Table:
    names = ["doc_id", "n_words", "n_removed", "kept"]
    if not docs.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())], names=names)
    block, begin, windows, _, contents, least, ids, _, _ = _cut(docs, replies, width)
    answers = replies.filter(pa.compute.equal(replies["kind"], 1))
    given = dict(zip(answers["key"].to_pylist(), answers["value"].to_pylist(), strict=True))
    owners = {c: o for c in least if (o := given.get(xxhash.xxh3_128_digest(c))) is not None} if given else {}
    # The owner of each window of each segment, segment by segment.
    flat = np.frombuffer(b"".join(owners.get(c) or least[c].to_bytes(8, "little", signed=True) * n for c, n in zip(contents, windows.tolist(), strict=True)), np.int64)
    first = np.cumsum(windows) - windows
    at = np.repeat(begin - first, windows) + np.arange(len(flat))
    at = at[flat < ids[block.doc[at]]]
    edge = np.bincount(at, minlength=len(block.words) + 1) - np.bincount(at + width, minlength=len(block.words) + 1)
    keep = np.cumsum(edge[: len(block.words)]) == 0
    removed = np.r_[0, np.cumsum(~keep)]
    flags = keep.tolist()
    kept = []
    for i, j in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
        words = block.words[i:j]
        kept.append(b" ".join(words if removed[i] == removed[j] else compress(words, flags[i:j])).decode())
    n = block.ends - block.starts
    return pa.table([docs["doc_id"], pa.array(n), pa.array(removed[block.ends] - removed[block.starts]), pa.array(kept, pa.string())], names=names)


def remove_repeats(docs: DataFrame, width: int = 13) -> DataFrame:
    """Remove every word under a window of width words whose word sequence also starts in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept (the rest joined by one space), one row per input row. Null and empty texts have no
    words. Rows with a null doc_id keep all words and are nobody's reference. Rows that share a doc_id count as one document: they
    remove nothing from each other. A long text counts whole; an empty table gives none. Extra columns are ignored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(MIN_PARTS, -(-size // PART_BYTES))
    # The three uses of the blocks are in one plan, so Spark shuffles the texts once and reuses the exchange.
    blocks = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(parts)).cast("int")).groupBy("block")
    # Fewer buckets than blocks: a block sends a row for each, and those rows must not grow with the square of the corpus.
    buckets = max(MIN_PARTS, parts // 16)
    counted = blocks.applyInArrow(lambda t: _count(t, width, buckets), "bucket int, block int, grams binary, counts binary")
    repeated = counted.groupBy("bucket").applyInArrow(_repeated, _REPLY)
    sent = blocks.cogroup(repeated.groupBy("block")).applyInArrow(lambda d, r: _send(d, r, width, 2 * parts), "shard int, block int, route long, content binary, doc_id long")
    answered = sent.groupBy("shard").applyInArrow(lambda t: _answer(t, width), _REPLY)
    replies = repeated.unionByName(answered).groupBy("block")
    return blocks.cogroup(replies).applyInArrow(lambda d, r: _remove(d, r, width), "doc_id long, n_words long, n_removed long, kept string")


class SuffixAutomaton:
    """Of word sequences. A state stands for sequences that end at the same places; its link leads to their longest suffix that also
    ends elsewhere. Added in the order of their owners, sequences leave in each state the least owner of what it stands for: a state
    is made when its sequences first occur or, by a split, from one that is as old."""

    def __init__(self, texts: list[list] = ()):
        self.next, self.link, self.len, self.owner = [{}], [-1], [0], [0]
        for words in texts:
            self.add(words)

    def add(self, words: list, owner: int = 0) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w, owner)

    def _new(self, length: int, edges: dict, link: int, owner: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.len.append(length)
        self.owner.append(owner)
        return len(self.len) - 1

    def _split(self, p: int, q: int, w) -> int:
        """q, or a copy of it that holds only the sequences up to one longer than p's."""
        if self.len[q] == self.len[p] + 1:
            return q
        copy = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q], self.owner[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w, owner: int) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w)
        new, p = self._new(self.len[last] + 1, {}, 0, owner), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][w], w)
        return new

    def least_owners(self, words: list, width: int) -> list[int]:
        """The least owner of each window of a sequence that was added."""
        out, state = [], 0
        for end, w in enumerate(words, 1):
            state = self.next[state][w]
            if end >= width:
                while self.len[self.link[state]] >= width:
                    state = self.link[state]
                out.append(self.owner[state])
        return out

    def matching_statistics(self, words: list) -> list[int]:
        """For each place, how many of the words that end there occur in the reference as one sequence."""
        out, state, n = [], 0, 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.len[state]
            if w in self.next[state]:
                state, n = self.next[state][w], n + 1
            else:
                n = 0
            out.append(n)
        return out


def _stream(batches, shards, width: int):
    automata = None
    for batch in batches:
        automata = automata or [SuffixAutomaton([t.split() for t in texts]) for texts in shards.value]
        rows = []
        for text in batch.column(1):
            words = (text.as_py() or "").encode().split()
            keep = [True] * len(words)
            for a in automata:
                for end, n in enumerate(a.matching_statistics(words)):
                    if n >= width:
                        keep[end - n + 1 : end + 1] = [False] * n
            rows.append((len(words), len(words) - sum(keep), b" ".join(w for w, k in zip(words, keep, strict=True) if k).decode()))
        n, gone, kept = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_reference(docs: DataFrame, reference: DataFrame, width: int = 13, max_words: int = 500_000, shard_words: int = 100_000) -> DataFrame:
    """Remove maximal spans of at least width words that occur in the reference texts, by broadcast suffix automata.

    The reference must have at most max_words words (checked; more raises ValueError), since its automata are held by every task.
    Columns and edge cases as remove_repeats, except that ids do not matter."""
    texts = reference.where("text is not null").select("text")
    words = texts.agg(F.sum(F.size(F.split("text", r"[ \t-\r]+")))).first()[0] or 0
    if words > max_words:
        raise ValueError(f"the reference has {words} words; suffix automata are broadcast for {max_words} at most")
    shards, room = [[]], shard_words
    for (text,) in texts.collect():
        data = text.encode()
        if room <= 0:
            shards.append([])
            room = shard_words
        shards[-1].append(data)
        room -= len(data.split())
    value = docs.sparkSession.sparkContext.broadcast(shards)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial(_stream, shards=value, width=width), "doc_id long, n_words long, n_removed long, kept string")


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 12), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
m AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM g JOIN m USING (g) WHERE least < doc_id),
o AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
k AS (SELECT o.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY o.p) AS t FROM o ANTI JOIN hit ON o.doc_id = hit.doc_id AND o.p = hit.p GROUP BY o.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
