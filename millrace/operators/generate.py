"""Seam for text generation: a callable over batches of prompts, run in mapInPandas with a memory ladder."""

import hashlib
from collections.abc import Callable
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame

Generator = Callable[[list[str]], list[str | None]]


def ladder(batch: int, n: int) -> list[int]:
    """Batch sizes to try, largest first: min(batch, n), 6, 4, 2, 1, clipped to n, each once."""
    return list(dict.fromkeys(min(b, n) for b in (min(batch, n), 6, 4, 2, 1) if b <= max(n, 1)))


def generate_batch(prompts: list[str], generator: Generator, batch: int = 8) -> list[str | None]:
    """Answers in order; a size that runs out of memory gives way to the next smaller, and at last to null answers."""
    out: list[str | None] = []
    for i in range(0, len(prompts), batch):
        part = prompts[i : i + batch]
        for size in ladder(batch, len(part)):
            try:
                found = [a for j in range(0, len(part), size) for a in generator(part[j : j + size])]
                break
            except MemoryError:
                found = [None] * len(part)
        out += found
    return out


def _run(batches, prompt, make, batch):
    generator = make()  # once for each task, so that a model is loaded once
    for pdf in batches:
        yield pdf.assign(generated=generate_batch(pdf[prompt].fillna("").tolist(), generator, batch))


def generate(df: DataFrame, prompt: str, make: Callable[[], Generator], batch: int = 8) -> DataFrame:
    """df with a column generated. Model output may differ when computed again: write it before it is judged."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(partial(_run, prompt=prompt, make=make, batch=batch), f"{columns}, generated string")


def digest_stub() -> Generator:
    """A deterministic stand-in for a model."""
    return lambda prompts: [f"Pourquoi {hashlib.md5(p.encode()).hexdigest()} ?" if p else None for p in prompts]
