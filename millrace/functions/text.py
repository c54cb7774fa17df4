"""Column functions on text: normalisation, counting, cleaning, splitting, slicing, sanitising. All are built-ins of Spark.

Word boundaries, white space and case follow Unicode: patterns run with (?U). Null in, null out, unless said otherwise."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space and the four separators that string splitting also treats as white space.
SPACE = r"[\s\x1c-\x1f]"


def regex(pattern: str, flags: str = "U") -> str:
    return f"(?{flags}){pattern}"


def hits(c: Column, pattern: str, flags: str = "U") -> Column:
    """Whether the pattern is found; null text counts as not found."""
    return F.coalesce(c.rlike(regex(pattern, flags)), F.lit(False))


def strip(c: Column) -> Column:
    """Without white space (line feeds too) at both ends."""
    return F.regexp_replace(c, regex(rf"^{SPACE}+|{SPACE}+$"), "")


def normalize_ws(c: Column) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, regex(rf"{SPACE}+"), " "))


def words(normalized: Column) -> Column:
    """Words of normalised text; an empty text has none."""
    return F.when(normalized == "", F.array().cast("array<string>")).otherwise(F.split(normalized, " "))


def word_count(c: Column) -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.coalesce(F.size(words(normalize_ws(c))), F.lit(0))


def words_in(normalized: Column) -> Column:
    """Number of words of text that is normalised already, by counting its spaces."""
    return F.when(normalized == "", F.lit(0)).otherwise(F.char_length(normalized) - F.char_length(F.replace(normalized, F.lit(" "), F.lit(""))) + 1)


def letter_tokens(c: Column) -> Column:
    """Runs of [a-zà-ÿ] of the lower-cased text."""
    return F.regexp_extract_all(F.lower(c), F.lit("([a-zà-ÿ]+)"), F.lit(1))


def sentences_strict(c: Column) -> Column:
    """Split after . ! ? before a capital letter A-Z or À-Ü."""
    return F.split(c, regex(r"(?<=[.!?])\s+(?=[A-ZÀ-Ü])"))


def sentences_loose(c: Column) -> Column:
    """Split after every . ! ? that white space follows."""
    return F.split(c, regex(r"(?<=[.!?])\s+"))


def sentence_marks(c: Column) -> Column:
    """Number of runs of sentence-ending punctuation."""
    return F.regexp_count(c, F.lit("[.!?…]+"))


def occurrences(c: Column, literal: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.char_length(c) - F.char_length(F.replace(c, F.lit(literal), F.lit("")))) / len(literal)).cast("int")


def paragraphs(c: Column) -> Column:
    """Stripped parts between blank lines; empty ones go."""
    return F.filter(F.transform(F.split(c, "\n\n"), strip), lambda p: p != "")


def preview(c: Column, n: int, end: bool = False) -> Column:
    return F.right(c, F.lit(n)) if end else F.substring(c, 1, n)


def keep_from(c: Column, *markers: str) -> Column:
    """From the first match of the first marker that matches; unchanged without one."""
    found = [F.nullif(F.regexp_extract(c, regex(rf"((?:{m})[\s\S]*)", "Umd"), 1), F.lit("")) for m in markers]
    return F.coalesce(*found, c)


def keep_until(c: Column, marker: str) -> Column:
    """What stands before the first match (any case); unchanged without one."""
    return F.regexp_replace(c, regex(rf"(?:{marker})[\s\S]*", "Uid"), "")


# Fixed values of the cleaner, in the order in which they apply.
TOC_LINK = r"Retour\s+à\s+la\s+table\s+des\s+mat\s*\n?\s*ières"
NOISE = [
    r"Classiques des sciences sociales",
    r"Corrections,\s*édition,\s*conversion informatique.*",
    r"Cette édition électronique du livre.*",
    r"©\s*Éditions Gallimard.*",
    r"Éditions Gallimard\n.*",
    r"www\.\S+",
    r"http\S+",
    r"\d+ rue [\w-]+",
    r"\d+ Paris\b",
    r"fondationlaposte",
]
DROPPED_LINES = [
    r"^[0-9]+$",
    r"JMT",
    r"Livre disponible dans",
    r"ISBN",
    r"Code Sodis",
    r"Nord Compo",
    r"^Numéro d.édition",
    r"a été réalisée le.*Gallimard|Gallimard.*a été réalisée le",
    r"repose sur l.*édition papier|édition papier.*repose sur l",
    r"Ce document numérique a été réalisé",
    r"^(?i:Fin du texte)$",
]
STOP_LINES = [r"^(?i:Note de Transcription)$", r"^\[Fin de$", r"^BRODARD ET TAUPIN", r"^Paris-Coulommiers"]


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def bound(c: Column, body) -> Column:
    """body(c) with c computed once: a lambda binds it, so that the optimizer cannot copy its expression to every place of use."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def truncate_lines(lines: Column, stops: list[str] = STOP_LINES) -> Column:
    """Lines before the first stop line."""

    def cut(x: Column) -> Column:
        at = F.array_position(F.transform(x, lambda line: line.rlike(regex(any_of(stops)))), True)
        return F.slice(x, F.lit(1), bound(at, lambda i: F.when(i > 0, i - 1).otherwise(F.size(x))).cast("int"))

    return bound(lines, cut)


def clean_text(c: Column, noise: list[str] = NOISE, dropped: list[str] = DROPPED_LINES, stops: list[str] = STOP_LINES) -> Column:
    """The corpus cleaner: non-breaking spaces, blank runs, note marks, noise phrases, dropped lines, cut at a stop line."""
    t = F.replace(c, F.lit("\u00a0"), F.lit(" "))
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    t = F.regexp_replace(t, "[ \t]{2,}", " ")
    t = F.regexp_replace(t, regex(r"\[\d+\]"), "")
    t = F.regexp_replace(t, regex(r"\|\s*\d+\s*\|"), "")
    t = reduce(lambda a, p: F.regexp_replace(a, regex(p, "Uid"), ""), [TOC_LINK, *noise], t)
    lines = truncate_lines(F.transform(F.split(t, "\n"), strip), stops)
    lines = F.filter(lines, lambda x: ~x.rlike(regex(any_of(dropped))))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


def trim_generated(c: Column, quotes: bool = True) -> Column:
    """Generated text without end marks, outer white space and outer quotation marks."""
    t = strip(F.replace(c, F.lit("</s>"), F.lit("")))
    if quotes:
        t = strip(F.btrim(F.btrim(t, F.lit('"')), F.lit("'")))
    return t


def sanitize_answer(c: Column) -> Column:
    """Line ends, reminder blocks, orphan punctuation, blank runs; a final . where no final punctuation stands. Empty stays empty."""
    t = strip(F.replace(c, F.lit("\r\n"), F.lit("\n")))
    t = F.regexp_replace(t, r"(?isu)<system-reminder>.*?</system-reminder>", " ")
    t = F.regexp_replace(t, regex(r"\n\s*\n\s*[?.!]\s*$", "Ud"), ".")
    t = F.regexp_replace(t, regex(r"[?.!]\s*\n\s*\n\s*[?.!]\s*$", "Ud"), ".")
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    t = strip(F.regexp_replace(t, "[ \t]+", " "))
    ended = F.right(t, F.lit(1)).isin(".", "!", "?", "…")
    return F.when(c == "", c).when((t == "") | ended, t).otherwise(F.concat(t, F.lit(".")))


def render(template: str, **values: Column) -> Column:
    """The template with {name} replaced by a column. Values are inserted as they are, whatever braces they hold, as long as they do
    not hold a later placeholder."""
    return reduce(lambda t, kv: F.replace(t, F.lit("{" + kv[0] + "}"), kv[1]), values.items(), F.lit(template))
