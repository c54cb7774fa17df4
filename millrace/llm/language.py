"""Language identification: multinomial naive Bayes over hashed character n-grams.

The log-probability matrix (languages x 2 ** BITS buckets) is a fixed size for each language and is broadcast; documents are
scored in batches by gathering and summing its rows.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .features import blocks, gram_buckets, sums

BITS, GRAMS = 15, (1, 2, 3)
#: Expected number of documents that the model is fitted on (a hash of the id picks them); scoring covers every document.
TRAIN_DOCS = 30_000
MAX_LANGUAGES = 500
#: A score is the posterior as if the text had so many n-grams at most, so that it stays below 1 for long texts.
EVIDENCE = 60


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _count(batches):
    counts = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lang in set(langs):
            texts = [t.as_py().lower() for t, x in zip(batch.column(0), langs, strict=True) if x == lang and t.is_valid]
            c = counts.setdefault(lang, np.zeros((1 << BITS) + 1, np.int64))
            for codes, starts, ends, owns, _ in blocks(texts):
                for n in GRAMS:
                    c += np.bincount(gram_buckets(codes, starts, ends, owns, n, BITS), minlength=(1 << BITS) + 1)
    for lang, c in counts.items():
        at = np.flatnonzero(c[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], names=["lang", "bucket", "n"])


def _dense(rows: pa.Table) -> pa.Table:
    """One row for a language: its counts, bucket by bucket."""
    c = np.zeros(1 << BITS, np.int64)
    c[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return pa.table([rows["lang"].slice(0, 1), pa.array([c.tobytes()], pa.binary())], names=["lang", "counts"])


def held_out(doc_id, modulus: int, remainder: int):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """(languages sorted, log-probabilities) from the text and lang of docs. Rows with a null text or lang teach nothing; a hash of id and
    text picks the sample, so rows without an id are picked like others, and equal rows together. All languages have the same prior, so
    that a rare one is not lost. A lang column of more than MAX_LANGUAGES values is none, and raises."""
    docs = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    langs = [r[0] for r in docs.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = docs.select("lang").count()
    share = F.lit(int(min(1.0, train_docs / max(rows, 1)) * 2**32)).cast("long")
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**32)) < share)
    counted = sample.select("text", "lang").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in counted.groupBy("lang").applyInArrow(_dense, "lang string, counts binary").collect()}
    langs = sorted(found)
    matrix = np.array([found[x] for x in langs]).reshape(len(langs), 1 << BITS) + 0.5
    return langs, np.log(matrix / matrix.sum(1, keepdims=True)).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str] = ("doc_id",)) -> DataFrame:
    """The keep columns, lang_pred and score of every row. A null text or one without a letter is `und` with score 0; so is every
    text if the model knows no language. Of languages that score the same, the first by name counts. A long text counts whole. One row
    per input row, repeated ones alike; an empty table gives none. Other columns are dropped."""
    value = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in keep if c != "text"]
    out = docs.select(*columns, "text") if "text" not in keep else docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if f.name != "text" or "text" in keep)
    return out.mapInArrow(partial(_scored, model=value, with_text="text" in keep), f"{schema}, lang_pred string, score double")


def _scored(batches, model, with_text: bool):
    langs, matrix = model.value
    tables = [np.r_[row, np.float32(0)] for row in matrix]
    for batch in batches:
        names, scores = [], []
        for i in range(0, batch.num_rows, 1000):
            texts = [t.as_py() for t in batch.column("text").slice(i, 1000)]
            texts = [t.lower() if langs and has_letter(t) else None for t in texts]
            if not langs:
                names += ["und"] * len(texts)
                scores += [0.0] * len(texts)
                continue
            total, count = sums(texts, tables, GRAMS, None, BITS)
            total *= (np.minimum(count, EVIDENCE) / np.maximum(count, 1))[:, None]
            p = np.exp(total - total.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            names += ["und" if t is None else langs[b] for t, b in zip(texts, best, strict=True)]
            scores += [0.0 if t is None else float(p[j, b]) for j, (t, b) in enumerate(zip(texts, best, strict=True))]
        rest = [n for n in batch.schema.names if n != "text" or with_text]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*rest, "lang_pred", "score"])


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 5, 0)
    model = fit(docs.where(~out))
    return identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
