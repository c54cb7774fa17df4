"""The pipeline against plain Python, on a small corpus with planted cases, and on awkward and empty tables."""

import random

import corpus_pipeline
from millrace.llm import queries

from .data import COLUMNS, TEXTS, edge_documents, empty_documents
from .test_models import brute_spans
from .test_text_operators import brute_components, brute_decontamination


def corpus():
    rng = random.Random(8)
    words = [f"wörd{i}" if i % 9 == 0 else f"word{i}" for i in range(800)]
    items = [(i, " ".join(rng.choices(words, k=25))) for i in range(5)]
    docs = []
    for i in range(160):
        text = " ".join(rng.choices(words, k=rng.randrange(20, 120)))
        if docs and rng.random() < 0.2:
            text = rng.choice(docs)[1].replace("word1 ", "changed ", 1)
        if rng.random() < 0.1:
            text += " " + rng.choice(items)[1]
        if rng.random() < 0.1:
            text += f" write to user{i}@mail.example.org or +1 (555) 010-{1000 + i}"
        docs.append((i, text))
    return docs + [(500, "123 456"), (501, None), (502, "")], items


def write(spark, path, docs, items):
    rows = [(i, t, "en", "abc"[(i or 0) % 3], len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_against_brute_force(spark, tmp_path):
    docs, items = corpus()
    write(spark, tmp_path, docs, items)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    kept = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    kept = [(i, t) for (i, t) in kept if i in {c for _, _, c in brute_components(kept, size=5)}]
    hit = {r[0] for r in brute_decontamination(kept, items) if r[2]}
    assert hit and len(kept) < len(docs) - 3
    kept = {i: t for i, t in kept if i not in hit}
    assert set(got) == set(kept)
    changed = 0
    for i, t in kept.items():
        spans = brute_spans(t)
        out, at = "", 0
        for a, k, b in spans:
            if a >= at:
                out += t[at:a] + ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"][k]
            at = max(at, b)
        assert got[i]["text"] == out + t[at:] and got[i]["n_chars"] == len(got[i]["text"])
        changed += bool(spans)
    assert changed
    assert all(r["slot"] >= 0 for r in got.values())


def test_pipeline_edges(spark, tmp_path):
    edge_documents(spark).write.parquet(f"{tmp_path}/a/documents.parquet")
    empty_documents(spark).write.parquet(f"{tmp_path}/b/documents.parquet")
    for d in "ab":
        spark.createDataFrame([(1, "zebra zoo")], "item_id long, text string").write.parquet(f"{tmp_path}/{d}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    assert {r["doc_id"] for r in got} == {1, 6, 8, 10, 11, 13, None}
    assert sum(r["doc_id"] == 10 for r in got) == 2  # two texts under one id
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
    assert COLUMNS and TEXTS


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    edge_documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "zebra zoo")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == corpus_pipeline.COLUMNS


def test_registered_queries():
    assert [f"op{n}_" for n in range(1, 11)] == [f"{q.split('_')[0]}_" for q in queries.QUERIES]
    assert set(queries.SQL) <= set(queries.QUERIES)
