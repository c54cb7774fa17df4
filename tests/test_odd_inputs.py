"""Queries against their SQL twins on hand-written rows that the given tables hold rarely or not at all."""

from types import SimpleNamespace

import pyarrow as pa
import pytest

from millrace.operators import lines, tokenize
from millrace.plans import catalogue
from millrace.sources import files, markup


def both(spark, tmp_path, name, table, rows, schema):
    """Sorted rows of the query and of its twin."""
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW {table} AS FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    df = catalogue.QUERIES[name](spark, str(tmp_path))
    twin = c.execute(catalogue.SQL[name])
    names = [d[0] for d in twin.description]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str), sorted(twin.fetchall(), key=str)


def test_letters_keep_what_the_twin_keeps(spark, tmp_path):
    texts = ["un | 4122859641637651 | deux", "a [3] b www.x.org 12 rue Neuve", "42\nISBN 3\n[Fin de\nfin \t \n\n\n\n x\u00a0y\u00a0", "tab\t\n\t z\n\u2003 x\u00a0y \u00a0", "", None, "9 – ANNA À PAUL\nencore"]
    rows = [(i, t, ["en", "fr"][i % 2]) for i, t in enumerate(texts)]
    got, want = both(spark, tmp_path, "letters_by_sender", "documents", rows, "doc_id long, text string, lang string")
    assert got == want and len(got) == 9


def test_letters_are_cleaned_by_default(spark):
    df = spark.createDataFrame([(1, "1 – ANNA\u00a0À PAUL\na | 4 | b\nISBN 3\n2 – PAUL À ANNA\nc")], "doc_id long, text string")
    got = lines.letters(df, r"\d+\s*–\s*(?:ANNA|PAUL)\s+À\s+(?:ANNA|PAUL)", r"ANNA\s+À\s+PAUL").collect()
    assert [tuple(r) for r in got] == [(1, 1, "a  b")]


def test_html_decodes_what_the_twin_decodes(spark, tmp_path):
    pages = [
        "<p>ver&amp</p><p>a &amp; b &amp;lt; &lt;i&gt; &quot;q&quot; it&#x27;s &amp;&amp</p>",
        "<p>&nbsp;x &eacute; &#39; &copy &lt</p>tail &amp",
        "<p>one<!-- & --> two<script>if (a && b) {}</script> three<br>four</p><div class=\"ad\">x</div>five",
        "<nav>m</nav><p>   x </p><footer>f</footer>",
        "no tags &amp;amp; & &",
        "",
        None,
    ]
    got, want = both(spark, tmp_path, "html_to_text", "pages", list(enumerate(pages)), "page_id long, html string")
    assert got == want and len(got) == 7


def test_html_decodes_all_references_by_default():
    assert markup.text_of("<p>ver&amp</p><p>&eacute;<!-- x -->t&nbsp;</p><script>a && b</script>") == "ver&\né\nt\na && b"
    assert markup.text_of("<p>&eacute; &amp;</p><script>a && b &amp;</script>", (), {"&amp;": "&"}) == "&eacute; &\na && b &"


def test_tokens_are_made_in_bounded_parts(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer(tokenizers.models.WordLevel({"a": 0, "b": 1, "?": 2}, unk_token="?"))
    t.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    value = SimpleNamespace(value=t.to_str().encode())
    monkeypatch.setattr(tokenize, "CHUNK_BYTES", 6)
    monkeypatch.setattr(tokenize, "CHUNK_TOKENS", 3)
    texts = ["a b", "b", None, "", "a a a a a", "b x", "a"]
    batch = pa.record_batch({"i": list(range(7)), "text": texts})
    parts = list(tokenize._encode([batch, batch.slice(0, 0)], value, "text"))
    assert [p.num_rows for p in parts] == [4, 1, 2]
    rows = [r for p in parts for r in p.to_pylist()]
    assert [r["text"] for r in rows] == texts and [r["token_ids"] for r in rows] == [[0, 1], [1], [], [], [0] * 5, [1, 2], [0]]
    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()
    parts = list(tokenize._decode(whole, value, "token_ids"))
    assert [p.num_rows for p in parts] == [4, 1, 2]
    assert [r["decoded"] for p in parts for r in p.to_pylist()] == ["a b", "b", "", "", "a a a a a", "b ?", "a"]


def test_saved_texts_are_files_of_their_own(spark, tmp_path):
    rows = [("a/b", "un\ndeux\n"), ("é 1%", ""), (None, "x"), ("", "y\r\n z"), ("%", "p"), ("twice", "q"), ("twice", "r"), (".", None)]
    df = spark.createDataFrame(rows, "source string, text string").coalesce(1)
    files.save_texts(spark.createDataFrame([("old", "gone")], "source string, text string"), str(tmp_path / "out dir"))
    counts = files.save_texts(df, str(tmp_path / "out dir"))
    assert counts.count() == 7 and {r["source"] for r in counts.collect()} == {r[0] for r in rows}
    got = {r["source"]: r["text"] for r in files.read_saved(spark, str(tmp_path / "out dir")).collect()}
    assert {k: v for k, v in got.items() if k != "twice"} == {s: t or "" for s, t in rows if s != "twice"}
    assert sorted(got["twice"].split("\n")) == ["q", "r"]
    there = [p for p in (tmp_path / "out dir").rglob("*") if p.is_file()]
    assert len(there) == 7 and all(p.name.endswith(".txt") for p in there)  # no other files beside them
    assert files.read_saved(spark, str(tmp_path / "nothing")).count() == 0


def test_texts_in_a_store_of_spark_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_store", lambda uri: None)
    files.save_texts(spark.createDataFrame([("a", "un\ndeux"), ("b", "")], "source string, text string"), str(tmp_path / "out"))
    assert {tuple(r) for r in files.read_saved(spark, str(tmp_path / "out")).collect()} == {("a", "un\ndeux"), ("b", "")}
