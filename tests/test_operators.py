"""Operators on small tables: overlap, chat, comparison, generation, files and streams."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.operators import chat, compare, generate, overlap
from millrace.sources import files, markup
from millrace.streaming import incremental


def test_containment(spark):
    rows = [("a b c d e f", "a b c x y z"), ("a b c d e", "a b c d e f"), ("a b c d e f", "a b c d e f"), (None, "a b c d e f")]
    df = spark.createDataFrame(rows, "s string, a string").select(overlap.containment(F.col("s"), F.col("a")).alias("r"))
    assert [r["r"] for r in df.collect()] == [0.25, None, 1.0, None]


def test_ratio_of_exactly_three_tenths_is_no_copy(spark):
    s = "a b c d e f g"
    a = "a b c d e q r s t u v w"  # 3 of 10 trigrams
    df = spark.createDataFrame([(s, a)], "s string, a string")
    assert df.select(overlap.containment(F.col("s"), F.col("a")), overlap.is_copy(F.col("s"), F.col("a"))).first()[:] == (0.3, False)


@pytest.mark.parametrize("n,copied", [(89, False), (90, True)])
def test_long_segment(spark, n, copied):
    seg = ("mot " * 30)[: n - 1] + "."
    df = spark.createDataFrame([("Avant tout. " + seg, "x y z q r s t " + seg.upper())], "s string, a string")
    assert df.select(overlap.long_segment(F.col("s"), F.col("a"))).first()[0] is copied


def test_corpus_containment_equals_row_local(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "x y z"), (3, None), (4, "a b c d e f g h a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "b c d e f g q"), (8, "h g f e d c b a"), (9, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["hits"] / r["item_grams"] for r in overlap.corpus_containment(docs, items).collect()}
    assert got == {(1, 7): 0.8, (4, 7): 0.8}


def test_chat(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", " q "), (1, 2, "assistant", "a"), (2, 0, "user", "only")], "conv_id long, turn long, role string, text string")
    records = {r["conv_id"]: r for r in chat.conversations_to_records(df).withColumn("first", chat.first_user_content(F.col("messages"))).withColumn("kept", chat.without_role(F.col("messages"))).collect()}
    assert [m["role"] for m in records[1]["messages"]] == ["system", "user", "assistant"] and len(records[1]["kept"]) == 2 and records[1]["first"] == "q"
    assert chat.adjacent_pairs(df).count() == 1
    with pytest.raises(ValueError):
        chat.require_columns(df, "messages")


def test_resolve_attempts(spark):
    df = spark.createDataFrame([(1, 0, "bad"), (1, 1, "ok1"), (1, 2, "ok2"), (2, 0, "bad"), (2, 1, "worse"), (3, 3, "ok late")], "k long, n long, v string")
    got = {r["k"]: tuple(r)[1:] for r in chat.resolve_attempts(df, "k", "n", F.col("v").startswith("ok"), "v").collect()}
    assert got == {1: ("ok1", "ok1", "ok", 1), 2: (None, "worse", "rejected", 1)}


def test_compare(spark):
    kind = "key string, v array<float>"
    before = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0]), ("c", [0.0])], kind)
    after = spark.createDataFrame([("a", [1.0, 2.5]), ("b", [1.0]), ("d", [0.0])], kind)
    got = compare.compare_arrays(before, after, "key", "v", F.col("key") == "a")
    assert {r["key"]: (r["status"], r["max_diff"]) for r in got.collect()} == {"a": ("modified", 0.5), "b": ("identical", 0.0), "c": ("missing_after", None), "d": ("missing_before", None)}
    assert compare.verdict(got).first()["verdict"] == "PASS"
    assert compare.verdict(got.withColumn("is_target", F.col("key") == "b")).first()["verdict"] == "FAIL"


def test_ladder():
    assert generate.ladder(8, 20) == [8, 6, 4, 2, 1] and generate.ladder(8, 3) == [3, 2, 1] and generate.ladder(8, 1) == [1]

    def small(prompts):
        if len(prompts) > 2:
            raise MemoryError
        return [p.upper() for p in prompts]

    def never(prompts):
        raise MemoryError

    assert generate.generate_batch(list("abcde"), small) == list("ABCDE") and generate.generate_batch(["a"], never) == [None]


def test_jsonl_tolerant_and_strict(spark, tmp_path):
    ok = {"messages": [{"role": "user", "content": "é ?"}]}
    (tmp_path / "a.jsonl").write_text("\n".join([json.dumps(ok), "", "{bad", json.dumps({"other": 1})]))
    read = files.read_jsonl(spark, str(tmp_path / "a.jsonl"))
    assert [r[0] for r in read.select(chat.first_user_content(F.col("messages"))).collect() if r[0]] == ["é ?"]
    with pytest.raises(Exception):  # noqa: B017
        files.read_jsonl(spark, str(tmp_path / "a.jsonl"), strict=True).collect()


def test_rewrite_keeps_a_backup(spark, tmp_path):
    path = str(tmp_path / "set")
    df = spark.createDataFrame([([("system", "s"), ("user", "q")],)], files.MESSAGES)
    files.write_jsonl(df, path)
    for _ in range(2):
        files.rewrite(spark, path, lambda d: d.withColumn("messages", chat.without_role(F.col("messages"))))
    assert [len(r[0]) for r in files.read_jsonl(spark, path).collect()] == [1]
    assert (tmp_path / "set.bak").exists() and not (tmp_path / "set.new").exists()


def test_files(spark, tmp_path):
    (tmp_path / "b.txt").write_text("deux\nmots")
    (tmp_path / "a.txt").write_text("un")
    assert [r["source"] for r in files.read_texts(spark, str(tmp_path / "*.txt")).orderBy("source").collect()] == ["a", "b"]
    texts, missing = files.read_named(spark, str(tmp_path), {"first": "a.txt", "third": "c.txt"})
    assert [tuple(r) for r in texts.collect()] == [("first", "un")] and missing == ["third"]
    assert files.read_named(spark, str(tmp_path), {"third": "c.txt"}) == (None, ["third"])
    assert files.first_match(spark, str(tmp_path / "*.txt")).endswith("a.txt") and files.first_match(spark, str(tmp_path / "*.pdf")) is None
    with pytest.raises(FileNotFoundError):
        files.require(spark, str(tmp_path / "a.txt"), str(tmp_path / "zz"))
    saved = files.save_texts(files.read_texts(spark, str(tmp_path / "*.txt")), str(tmp_path / "out"))
    assert {r["source"]: (r["n_words"], r["n_text_chars"]) for r in saved.collect()} == {"a": (1, 2), "b": (2, 9)}
    assert files.dry_run(texts.withColumnRenamed("text", "passage")).count() == 1


def test_epub(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "book.epub", "w") as z:
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("a.xhtml", "<html><body><p>un <b>deux</b></p><div class='notes big'>x</div></body></html>")
        z.writestr("b.xhtml", "<p> </p>")
        z.writestr("c.html", "<p>trois</p>")
    got = markup.read_epub(spark, str(tmp_path / "*.epub"), drop=[("div", "notes")]).orderBy("item_pos").collect()
    assert [tuple(r) for r in got] == [("book", 0, "un\ndeux"), ("book", 1, "trois")]


def test_append_new_is_idempotent(spark, tmp_path):
    schema = "question string, n long"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 3)], schema).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))

    def run(checkpoint):
        incremental.append_new(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / checkpoint), "question")
        return sorted(tuple(r) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())

    assert run("c1") == [("a", 1), ("b", 1)]
    spark.createDataFrame([("c", 5), ("b", 9)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    assert run("c1") == run("c2") == [("a", 1), ("b", 1), ("c", 5)]


def test_tokens_round_trip(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    from millrace.operators import tokenize

    path = tokenizers.path("byte_bpe_50k.json")
    df = tokenize.encode(spark.createDataFrame([("Déjà vu, 漢字 <|endoftext|>",), (None,), ("",)], "t string"), "t", path)
    got = tokenize.decode(df, "token_ids", path).collect()
    assert got[0]["decoded"] == "Déjà vu, 漢字 <|endoftext|>" and got[1]["token_ids"] == got[2]["token_ids"] == []


def test_run_asks_for_answers_only_where_questions_pass(spark, tmp_path):
    from millrace.functions.lexicon import FRENCH
    from millrace.operators import runs

    long = " ".join(["mot"] * 60) + "."
    passages = spark.createDataFrame([(i, p) for i, p in enumerate(["none", "skip", "short", "quiet", "copy " * 30 + ".", "weak", "good"])], "k int, passage string")

    def ask():
        return lambda ps: [{"Q none": None, "Q skip": ' "SKIP" ', "Q short": "Quoi ?"}.get(p, "Pourquoi donc faut il vivre ainsi sans espoir ?") for p in ps]

    def tell():
        def one(p):
            assert "none" not in p and "skip" not in p and "short" not in p
            body = p.partition("|")[2]
            return {"quiet": None, "weak": "mot.", "good": long + "</s>"}.get(body, body)

        return lambda ps: [one(p) for p in ps]

    def keep(df):
        keep.n += 1
        df.write.parquet(str(tmp_path / str(keep.n)))
        return spark.read.schema(df.schema).parquet(str(tmp_path / str(keep.n)))

    keep.n = 0
    run = runs.run_pairs(passages, FRENCH, ask, tell, "Q {passage}", "A {question}|{passage}", keep)
    got = {r["k"]: r["status"] for r in runs.metadata(run, "k").collect()}
    assert got == {0: "api_error_question", 1: "skip_question_model", 2: "invalid_question", 3: "local_error_answer", 4: "copy", 5: "invalid_answer:too_short", 6: "ok"}
    assert [(r["k"], r["messages"][1]["content"]) for r in runs.records(run, "k").collect()] == [(6, long)]


def test_long_segments_stand_anywhere(spark):
    from millrace.operators import overlap

    long = "one sentence of the benchmark that is quite long and has many different words in it until the very end of all."
    few = "x" * 50 + " " + "y" * 60 + "."
    one = "z" * 95 + "!"
    items = [(1, f"Short. {long} {few} {one}"), (2, None), (3, "")]
    docs = [(1, f"abc{long.upper()}def"), (2, f"pre{few}post and  pre{one}post"), (3, long[:-3]), (4, f"{long}\n{long}"), (5, None), (6, ""), (7, "y" * 60 + " " + "x" * 50), (8, few.replace(" ", " \t "))]
    got = overlap.corpus_long_segments(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1), (2, 1, 2), (4, 1, 1), (8, 1, 1)]


def test_large_sides_are_not_broadcast(spark):
    from millrace.operators import overlap

    def plan(df):
        return df._jdf.queryExecution().analyzed().toString()

    df = spark.createDataFrame([(1, "x" * 1000)] * 3, "a long, b string")
    assert "ResolvedHint" in plan(overlap.checked_broadcast(df)) and "ResolvedHint" not in plan(overlap.checked_broadcast(df, most_bytes=2000)) + plan(overlap.checked_broadcast(df, most_rows=2))


def test_cleaner_runs_once(spark):
    from millrace.functions import text
    from millrace.operators import classify

    def optimized(c):
        return spark.createDataFrame([("x",)], "text string").select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString()

    assert optimized(text.clean_text(F.col("text"))).count("fondationlaposte") == 1
    assert optimized(classify.front_matter(F.col("text"))).count("distributed proofreaders") == 1


def test_cursors_and_progress(spark):
    from millrace.operators import cursor

    rows = [("a", i, i in (1, 3)) for i in range(6)] + [("b", 0, False)]
    df = spark.createDataFrame(rows, "key string, pos long, ok boolean")

    def after(policy, start=0):
        return {r[0]: r[1] for r in cursor.committed(df, "key", "pos", F.col("ok"), policy, start).collect()}

    assert after("success") == {"a": 4, "b": 0} and after("every") == {"a": 6, "b": 1} and after("never", 2) == {"a": 2, "b": 2}
    got = spark.createDataFrame([(5, 4), (4, 4), (None, 4), (-1, 4), (2, 4)], "c long, n long").select(cursor.resumed(F.col("c"), F.col("n"))).collect()
    assert [r[0] for r in got] == [0, 4, 0, 0, 2]
    with pytest.raises(ValueError):
        cursor.committed(df, "key", "pos", F.col("ok"), "sometimes")


def test_configuration_and_literals(spark, tmp_path):
    from millrace.sources import files

    path = f"file://{tmp_path}/c.json"
    files.write_small(spark, path, '{"r": 3, "names": ["é"]}')
    assert files.read_config(spark, path, "r int, names array<string>, seed int", seed=7) == {"r": 3, "names": ["é"], "seed": 7}
    with pytest.raises(FileNotFoundError):
        files.read_config(spark, f"file://{tmp_path}/none.json", "r int")
    assert sorted(map(tuple, files.literal_rows(spark, " b \n\na\nb").collect())) == [(0, "b"), (1, "a")]
    assert files.literal_rows(spark, "\n ").count() == 0
