"""Queries against their SQL twins on the given tables, and checks that need those tables."""

import os

import pytest

from millrace.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def plain(v):
    if v is None or v != v:
        return "NULL"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_twin(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[x]) for x in columns) for r in df.collect())
    twin = c.execute(queries.SQL[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(x)]) for x in columns) for r in twin.fetchall())


def test_held_out_quality_and_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    lang = queries.QUERIES["op5_language"](spark, SF).where("held_out").join(docs, "doc_id")
    assert lang.where("lang = lang_pred").count() >= 0.95 * lang.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    quality = queries.QUERIES["op6_quality"](spark, SF).where("held_out").join(labels, "doc_id")
    assert quality.where("predicted = quality").count() >= 0.85 * quality.count()


@pytest.mark.parametrize("name", ["op2_privacy", "op7_mixing", "op9_fertility"])
def test_one_row_per_document(spark, name):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert queries.QUERIES[name](spark, SF).select("doc_id").distinct().count() == n


def test_pages_keep_their_articles(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op10_html"](spark, SF).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[r["page_id"]], re.S)
        blocks = re.sub(r"</?(?:p|h1)>", "\0", article[1] if article else "").split("\0")
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        assert r["text"] == "\n".join(b for b in want if b) and r["n_chars"] == len(r["text"])
