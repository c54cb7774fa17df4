"""Properties over random inputs, checked on whole batches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import chat, segment

hypothesis = pytest.importorskip("hypothesis")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def texts(seed: int, n: int = 150) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        sentences = [" ".join(rng.choices(["mot", "Mot", "été", "12"], k=rng.choice([1, 5, 20, 60, 200]))) + rng.choice([".", "!", "?", "…", ""]) for _ in range(rng.randrange(1, 12))]
        out.append(rng.choice([" ", "\n", "  "]).join(sentences))
    return out


def greedy(sizes, least, most):
    """Plain packing: (groups as lists of places, places of the tail that is left out)."""
    out, group, total = [], [], 0
    for i, n in enumerate(sizes):
        if total + n > most and total >= least:
            out.append(group)
            group, total = [], 0
        group.append(i)
        total += n
    return (out + [group], []) if total >= least else (out, group)


@pytest.mark.parametrize("least,most", [(50, 180), (55, 120), (1, 1)])
def test_packing_equals_a_plain_loop(spark, least, most):
    rows = [(i, t) for i, t in enumerate(texts(1))]
    ss = T.sentences_strict(T.normalize_ws(F.col("t")))
    got = spark.createDataFrame(rows, "i int, t string").select("i", ss.alias("s"), segment.pack(ss, least, most).alias("p")).collect()
    for r in got:
        sizes = [len(x.split()) for x in r["s"]]
        groups, tail = greedy(sizes, least, most)
        assert r["p"] == [" ".join(r["s"][k] for k in g) for g in groups]
        assert sum(sizes[k] for k in tail) < least


def test_windows_rebuild_the_tokens(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(99) for _ in range(rng.choice([0, 1, 7, 8, 9, 20, 50]))]) for i in range(80)]
    got = segment.token_windows(spark.createDataFrame(rows, "i int, w array<int>"), F.col("w"), 8, 3).orderBy("i", "pos").collect()
    for i, w in rows:
        parts = [r["tokens"] for r in got if r["i"] == i]
        assert parts[0] + [x for p in parts[1:] for x in p[3:]] == w
        assert len(parts) == 1 or all(len(p) > 3 for p in parts)


def test_cleaner_leaves_no_dropped_line(spark):
    rng = random.Random(3)
    lines = ["texte", "42", "  7 ", "ISBN 3", "", "JMT", "fin du texte", "a [12] b", "http://x"]
    rows = [(i, "\n".join(rng.choices(lines, k=12))) for i in range(150)]
    for (t,) in spark.createDataFrame(rows, "i int, t string").select(T.clean_text(F.col("t"))).collect():
        assert not re.search(r"(?m)^\d+$|ISBN|JMT|http|\[\d+\]|\n{3}", t) and t == t.strip()


def test_sanitising_twice_changes_nothing_more(spark):
    rows = [(i, t) for i, t in enumerate(texts(4))]
    once = T.sanitize_answer(F.col("t"))
    df = spark.createDataFrame(rows, "i int, t string").select(once.alias("a")).withColumn("b", T.sanitize_answer(F.col("a")))
    assert df.where("a <> b").count() == 0


def test_anti_and_semi_join_split_the_input(spark):
    rng = random.Random(5)
    q = spark.createDataFrame([(i, f"q{rng.randrange(40)}") for i in range(200)], "i int, question string")
    done = q.where("i % 3 = 0").select("question").distinct()
    both = q.join(done, "question", "left_anti").unionByName(q.join(done, "question", "left_semi"))
    assert sorted(r["i"] for r in both.collect()) == list(range(200))


def test_dropping_a_role_is_idempotent(spark):
    rng = random.Random(6)
    rows = [([(rng.choice(["user", "assistant", "system"]), str(k)) for k in range(rng.randrange(6))],) for _ in range(50)]
    once = chat.without_role(F.col("m"))
    df = spark.createDataFrame(rows, "m array<struct<role:string,content:string>>").select(once.alias("a")).withColumn("b", chat.without_role(F.col("a")))
    for r in df.collect():
        assert r["a"] == r["b"] and all(m["role"] != "system" for m in r["a"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1), st.floats(0.01, 100)), min_size=1, max_size=8, unique_by=lambda x: x[0]))
def test_generation_ladder_is_monotone(pairs):
    from millrace.operators.generate import ladder

    sizes = ladder(8, len(pairs))
    assert sizes == sorted(set(sizes), reverse=True) and sizes[-1] == 1 and sizes[0] == min(8, len(pairs))
