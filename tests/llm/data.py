"""Small tables with every awkward case."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, term string, label int, kept string, score double, slot string, windows binary, redacted string"
BASE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(60_000))
TEXTS = [
    (1, BASE, "en", "a"),
    (2, BASE + " coda", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \n\t\r ", "en", None),
    (6, "one", "de", "b"),
    (7, BASE.lower(), None, "a"),
    (8, "¿Qué? ÉTÉ été ñandú   x y " + BASE, "es", "c"),
    (9, BASE, "en", "a"),
    (9, BASE, "en", "a"),
    (10, "first text of ten " * 8, "en", "c"),
    (10, "second text of ten " * 8, "en", "c"),
    (None, BASE + " coda", "en", "a"),
    (None, None, None, None),
    (11, LONG, "en", "c"),
    (12, "12345 67890 !!! ### $$$", "en", "c"),
    (13, "\x00\x01 nul", "en", "c"),
]


def edge_documents(spark):
    rows = [(i, t, la, s, len(t or ""), 1, "t", 2, "k", 0.5, "s", b"w", "r") for i, t, la, s in TEXTS]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], COLUMNS)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
