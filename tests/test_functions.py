"""Column functions on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import lexicon as L
from millrace.functions import text as T
from millrace.operators import classify, lines, segment, stats, validate


def values(spark, rows, *columns):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    out = df.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in out]


@pytest.fixture(autouse=True)
def text_column(spark):
    """The column t, which needs a session."""
    global C
    C = F.col("t")


def test_normalize_and_count(spark):
    assert values(spark, ["  a  b\n\tc ", "", None, "x"], T.normalize_ws(C)) == ["a b c", "", None, "x"]
    assert values(spark, ["  a  b\n\tc ", "", None, " \n"], T.word_count(C)) == [3, 0, 0, 0]


def test_letters_and_sentences(spark):
    assert values(spark, ["Cœur d'été"], T.letter_tokens(C)) == [["c", "ur", "d", "été"]]
    assert values(spark, ["A. Bé! cé? Été. Œuf"], T.sentences_strict(C), T.sentences_loose(C)) == [(["A.", "Bé! cé?", "Été. Œuf"], ["A.", "Bé!", "cé?", "Été.", "Œuf"])]
    assert values(spark, ["a... b!? c…"], T.sentence_marks(C)) == [3]
    assert values(spark, ["aaaa ba"], T.occurrences(C, "aa")) == [2]


def test_clean_text(spark):
    raw = "Un  deux\n\n\n\n[12] trois |7| fin\n42\nISBN 1\n  voir http://x.y z\nFIN DU TEXTE\nNote de transcription\nperdu"
    assert values(spark, [raw, "", None], T.clean_text(C)) == ["Un deux\n\ntrois  fin\nvoir  z", "", None]
    assert values(spark, ["a\n[Fin de\nb", "[Fin de", "x"], T.clean_text(C)) == ["a", "", "x"]


def test_markers(spark):
    assert values(spark, ["x\nGilbert \ny", "none", None], T.keep_from(C, r"^Gilbert\s*$")) == ["Gilbert \ny", "none", None]
    assert values(spark, ["a FIN b", "none"], T.keep_until(C, "fin")) == ["a ", "none"]


def test_sanitize(spark):
    rows = ["foo.\n\n.", "a\r\nb", "", None, "x <system-reminder>a\nb</system-reminder> y", "ok!", "  "]
    assert values(spark, rows, T.sanitize_answer(C)) == ["foo..", "a\nb.", "", None, "x y.", "ok!", ""]
    assert values(spark, ["</s> \"'hi'\" "], T.trim_generated(C)) == ["hi"]


def test_render_inserts_any_text(spark):
    out = values(spark, ["50% {question} \\1"], T.render("Q {question} P {passage}", question=F.lit("q?"), passage=C))
    assert out == ["Q q? P 50% {question} \\1"]


@pytest.mark.parametrize("sizes,runs", [([60, 60, 60, 60], [(0, 3), (3, 4)]), ([10, 300, 60], [(0, 2), (2, 3)]), ([170, 10, 49], [(0, 2)]), ([49], []), ([], []), ([50, 131], [(0, 1), (1, 2)]), ([49, 132], [(0, 2)])])
def test_pack_bounds(spark, sizes, runs):
    df = spark.createDataFrame([(sizes,)], "s array<int>").select(segment.pack_bounds(F.col("s"), 50, 180).alias("r"))
    assert [(r["start"], r["stop"]) for r in df.first()["r"]] == runs


@pytest.mark.parametrize("n,sizes", [(0, [0]), (255, [255]), (2048, [2048]), (2049, [2048, 129]), (3968, [2048, 2048]), (3969, [2048, 2048, 129])])
def test_token_windows(spark, n, sizes):
    df = spark.createDataFrame([(list(range(n)),)], "w array<int>")
    got = segment.token_windows(df, F.col("w")).orderBy("pos").collect()
    assert [len(r["tokens"]) for r in got] == sizes
    assert n == 0 or got[-1]["tokens"][-1] == n - 1


def test_sections(spark):
    got = values(spark, ["pre 1-A x 2-B y", "none"], segment.sections(C, r"\d-[AB]"))
    assert [[(s["header"], s["body"]) for s in x] for x in got] == [[("1-A", " x "), ("2-B", " y")], []]


def test_footnotes(spark):
    text = "1. À propos\nnote\n\nsuite\n2. plain\n3.4 Titre\n*\n|7 x\n9\nfin"
    assert values(spark, [text], lines.drop_footnote_blocks(C)) == ["\nsuite\n2. plain\nTitre\nfin"]


def test_table_of_contents(spark):
    rows = ["\n".join(["x"] * n) for n in (4, 5, 60, 61)] + ["\n".join(["x"] * 9 + ["y" * 60]), "\n".join(["x"] * 19 + ["y" * 60])]
    assert values(spark, rows, classify.is_table_of_contents(C)) == [False, True, True, False, False, True]
    assert values(spark, [None, "short", "z" * 200, "Éditions\n" + "z" * 200 + "\nAVANT-PROPOS"], classify.is_front_matter(C)) == [True, True, False, True]


def test_unicode_boundaries(spark):
    assert values(spark, ["l'âme est", "créame", None], T.hits(C, r"\bâme\b"), T.hits(C, r"\bame\b")) == [(True, False), (False, False), (False, False)]


def test_capital_patterns_are_dead_unless_revived(spark):
    low = F.lower(C)
    lex = L.FRENCH
    n = F.lit(100)

    def run(**o):
        return values(spark, ["jonas pense à la mort et à la vie"], classify.passage_reason(low, n, F.lit(True), lex, **o))

    assert run() == [None] and run(case_fold=True) == ["narrative_proper_noun"]


def test_logistic_needs_two_patterns(spark):
    assert values(spark, ["à la gare", "à la gare par le train", "le rendez-vous de 5 h"], classify.is_logistic(C, L.FRENCH)) == [False, True, True]


def test_question_reasons(spark):
    ok = "pourquoi faut il donc vivre ainsi sans espoir ?"
    rows = [None, " ", "SKIP", "sans marque du tout ici pour voir cela", ok, "court ?", ok.replace("ainsi", "si tu m'aimes")]
    assert values(spark, rows, validate.question_reason(C, L.FRENCH)) == ["empty", "empty", "skip", "no_question_mark", None, "length", "pattern"]


def test_answer_reasons(spark):
    body = " ".join(["mot"] * 50)
    rows = [None, body[:-4], body, body + ".", body + "…", "- " + body + ".", body + "\"", body + " premièrement."]
    assert values(spark, rows, validate.answer_reason(C, L.FRENCH)) == ["empty", "too_short", "truncated", None, None, "pattern", "truncated", "pattern"]


def test_short_answer_reasons(spark):
    body = " ".join(["mot"] * 40)
    rows = ["", "mot.", " ".join(["mot"] * 91) + ".", body, body + ". <b>", "Ahuri " + body + ".", "Il y a des " + body + ".", body + " mon ami.", body + " (geste).", "# " + body + ".", body + " je" * 9 + ".", body + " je" * 8 + ".", body + "? et ?", body + ".\n !"]
    want = ["empty", "too_short", "too_long", "sentence_count", "tags", "familiar_opening", "pompous_opening", "familiarity", "stage_direction", "pattern", "first_person", None, "questions", "orphan_punctuation"]
    assert values(spark, rows, validate.short_answer_reason(C)) == want


def test_order_statistics(spark):
    df = spark.createDataFrame([(x,) for x in [5, 1, 1, 9, 3, 3, 3, 7, 2, 8] * 3] + [(None,)], "v int")
    v = sorted([5, 1, 1, 9, 3, 3, 3, 7, 2, 8] * 3)
    assert tuple(stats.order_statistics(df, "v").first()) == (30, sum(v), v[0], v[15], v[28], v[-1])
    assert tuple(stats.order_statistics(df.limit(0), "v").first()) == (0, None, None, None, None, None)
