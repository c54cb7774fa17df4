"""Tokens of an external vocabulary, in Arrow batches. The vocabulary's file is read once on the driver and broadcast."""

import os
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of text and tokens that are worked on at once, a row at least: an encoding takes far more memory than its ids.
CHUNK_BYTES, CHUNK_TOKENS = 500_000, 200_000


def _chunks(batch, sizes, most):
    """batch in parts whose sizes sum to most at most; a larger row is a part of its own."""
    at, held = 0, 0
    for i, n in enumerate(sizes.to_pylist()):
        if i > at and held + (n or 0) > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n or 0
    if at < batch.num_rows:
        yield batch.slice(at)


def _tokenizer(data: bytes):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads beyond it cost more than they do
    t = Tokenizer.from_buffer(data)
    t.encode_special_tokens = True
    return t


def _encode(batches, vocabulary, column):
    t = _tokenizer(vocabulary.value)
    for batch in batches:
        for part in _chunks(batch, pc.binary_length(batch.column(column)), CHUNK_BYTES):
            texts = [x or "" for x in part.column(column).to_pylist()]
            ids = [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
            yield part.append_column("token_ids", pa.array(ids, pa.list_(pa.int32())))


def _decode(batches, vocabulary, column):
    t = _tokenizer(vocabulary.value)
    for batch in batches:
        for part in _chunks(batch, pc.list_value_length(batch.column(column)), CHUNK_TOKENS):
            yield part.append_column("decoded", pa.array(t.decode_batch([x or [] for x in part.column(column).to_pylist()]), pa.string()))


def _run(df: DataFrame, function, path: str, column: str, added: str) -> DataFrame:
    with open(path, "rb") as f:
        vocabulary = df.sparkSession.sparkContext.broadcast(f.read())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(partial(function, vocabulary=vocabulary, column=column), f"{schema}, {added}")


def encode(df: DataFrame, column: str, path: str) -> DataFrame:
    """df with token_ids; a null text has none. path: a tokenizers JSON file."""
    return _run(df, _encode, path, column, "token_ids array<int>")


def decode(df: DataFrame, column: str, path: str) -> DataFrame:
    """df with decoded, the text of an array of token ids."""
    return _run(df, _decode, path, column, "decoded string")
