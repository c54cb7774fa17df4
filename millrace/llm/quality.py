"""Quality classifier: supervised subword embeddings.

A document is the mean of the learned vectors of its words and character n-grams (hashed into 2 ** BITS buckets) and of one token for
each word that repeats the word before it; a softmax over two classes follows. Training is stochastic gradient descent in numpy on a bounded sample of labelled documents. Since mean and
output layer are both linear, vectors and output are folded into one number for each bucket, and scoring sums those.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import forget, stored
from .common import table
from .features import blocks, gram_buckets, sums, word_buckets
from .language import held_out

BITS, GRAMS, DIM = 16, (2, 3, 4), 8
#: Bounds of the training sample (a hash of the id picks it): expected documents, and expected bytes of their texts.
TRAIN_DOCS, TRAIN_BYTES = 5_000, 8_000_000
EPOCHS, RATE = 12, 0.6


def _features(batches):
    """Distinct features and their counts for each labelled text; words have the upper half of the buckets' range."""
    for batch in batches:
        ats, ns = [], []
        for text in batch.column(1):
            c = np.zeros(2 << BITS, np.int64)
            for codes, starts, ends, owns, _ in blocks([text.as_py()]):
                for n in GRAMS:
                    c[: 1 << BITS] += np.bincount(gram_buckets(codes, starts, ends, owns, n, BITS), minlength=(1 << BITS) + 1)[:-1]
                c[1 << BITS :] += np.bincount(word_buckets(codes, ends, owns, BITS)[1], minlength=1 << BITS)
            at = np.flatnonzero(c)
            ats.append(at.astype(np.int32))
            ns.append(c[at].astype(np.int32))
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ats, kind), pa.array(ns, kind)], names=["label", "at", "n"])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """The folded model: for each of the 2 * 2 ** BITS buckets its share of the log-odds of label 1, and last the offset."""
    rng = np.random.default_rng(0)
    vectors = rng.uniform(-1, 1, (2 << BITS, DIM)) / DIM
    out = np.zeros((DIM, 2))
    bias = np.zeros(2)
    rows = [(y, at, n / n.sum()) for y, at, n in rows if len(at)]
    total = max(1, EPOCHS * len(rows))
    step = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            y, at, share = rows[i]
            rate = RATE * (1 - step / total)
            step += 1
            mean = share @ vectors[at]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            # A share is tiny in a long text; the square root keeps rare features learning.
            vectors[at] -= rate * np.sqrt(share)[:, None] * back
    side = out[:, 1] - out[:, 0]
    return np.r_[vectors @ side, bias[1] - bias[0]].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> np.ndarray:
    """Fit on a bounded sample of the labelled texts. Null texts and labels other than 0 and 1 teach nothing; without any label the
    model scores 0.5 everywhere. Rows of equal id and text are one; a text with both labels teaches both. The rate of the sample
    comes from the number and the bytes of the labelled texts themselves."""
    labels = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality").distinct()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).where("text is not null")
    keys = texts.select("doc_id", "key", F.octet_length("text").cast("long").alias("size")).distinct().join(labels, "doc_id")
    keys = stored(keys)
    rows, size = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    rate = min(1.0, train_docs / max(rows, 1), train_bytes / max(size, 1))
    picked = keys.where(F.pmod(F.xxhash64("doc_id", "key"), F.lit(2**32)) < F.lit(int(rate * 2**32)).cast("long")).select("doc_id", "key", "quality")
    # The sample is bounded by train_docs (in expectation), whatever the size of the corpus.
    chosen = texts.join(F.broadcast(picked), ["doc_id", "key"]).groupBy("doc_id", "key", "quality").agg(F.first("text").alias("text")).select("quality", "text", "doc_id")
    rows = chosen.mapInArrow(_with_id, "label int, at array<int>, n array<int>, doc_id long").orderBy("doc_id", "label", "at").toArrow()
    forget(keys)
    return train([(y, at.values.to_numpy(), n.values.to_numpy()) for y, at, n in zip(rows["label"].to_pylist(), rows["at"], rows["n"], strict=True)])


def _with_id(batches):
    for batch in batches:
        for out in _features([batch]):
            yield pa.RecordBatch.from_arrays([out.column(0).cast(pa.int32()), out.column(1), out.column(2), batch.column(2).cast(pa.int64())], names=["label", "at", "n", "doc_id"])


def _score(batches, model):
    m = model.value
    grams, words, offset = np.r_[m[: 1 << BITS], np.float32(0)], np.r_[m[1 << BITS : -1], np.float32(0)], float(m[-1])
    for batch in batches:
        scores = []
        for i in range(0, batch.num_rows, 1000):
            texts = [t.as_py() for t in batch.column(1).slice(i, 1000)]
            total, count = sums(texts, [grams], GRAMS, [words], BITS)
            scores.append(1 / (1 + np.exp(-np.clip(total[:, 0] / np.maximum(count, 1) + offset, -500, 500))))
        scores = np.concatenate(scores) if scores else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row. Null and empty texts have the model's offset alone. A
    long text counts whole. One row per input row, repeated ones alike; an empty table gives none. Extra columns are ignored."""
    value = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(partial(_score, model=value), "doc_id long, score double")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 4, 2)
    model = fit(docs, table(spark, sf_dir, "labels").where(~out))
    return score(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
