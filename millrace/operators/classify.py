"""Ordered classifiers: each gives the first reason that applies, null where the text is kept."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import METADATA, Lexicons, any_pattern, front_matter_starts, pattern_hits, word_hits
from ..functions.text import bound, occurrences, strip


def is_metadata(c: Column, patterns: list[str] = METADATA) -> Column:
    return pattern_hits(c, patterns, "Uid") >= 2


def is_table_of_contents(c: Column) -> Column:
    """5 to 60 lines with text, of which more than nine tenths are shorter than 50 characters."""
    lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")

    def short(x: Column) -> Column:
        return F.size(x).between(5, 60) & (F.size(F.filter(x, lambda line: F.char_length(line) < 50)) / F.greatest(F.size(x), F.lit(1)) > 0.9)

    return bound(lines, short)


def front_matter(c: Column, starts: list[str] | None = None, metadata: list[str] = METADATA) -> Column:
    """struct<metadata, contents, any>: the rules, each computed once for a text, and whether the text is front matter by any of them."""

    def rules(t: Column) -> Column:
        each = F.struct(is_metadata(t, metadata).alias("metadata"), is_table_of_contents(t).alias("contents"))
        rest = (F.char_length(t) < 100) | any_pattern(t, starts or front_matter_starts(), "Umd")
        return bound(each, lambda r: F.struct(r["metadata"].alias("metadata"), r["contents"].alias("contents"), (r["metadata"] | r["contents"] | rest).alias("any")))

    return bound(strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\u00a0"), F.lit(" "))), rules)


def is_front_matter(c: Column, starts: list[str] | None = None, metadata: list[str] = METADATA) -> Column:
    return front_matter(c, starts, metadata)["any"]


def content_text(items: DataFrame, book: str, order: str, text: str = "text", **rules) -> DataFrame:
    """(book, n_items, text): each book's items without its front matter, in order, with a blank line between."""
    kept = items.where(~is_front_matter(F.col(text), **rules)).select(book, F.struct(F.col(order).alias("o"), F.col(text).alias("t")).alias("i"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("i")), lambda i: i["t"]), "\n\n")
    return kept.groupBy(book).agg(F.count("*").alias("n_items"), joined.alias("text"))


def is_logistic(lower: Column, lex: Lexicons) -> Column:
    return pattern_hits(lower, lex.logistic) >= 2


def is_context_dependent(lower: Column, lex: Lexicons) -> Column:
    """One strong hit, or two weak ones."""
    return any_pattern(lower, lex.context_strong) | (pattern_hits(lower, lex.context_weak) >= 2)


def has_lyric_combo(lower: Column, lex: Lexicons) -> Column:
    return (word_hits(lower, lex.nature) >= 1) & (word_hits(lower, lex.emotion) >= 1)


def passage_reason(lower: Column, n_words: Column, narrative_source: Column, lex: Lexicons, least: int = 50, most: int = 180, least_score: int = 2, lyric: bool = True, case_fold: bool = False) -> Column:
    """too_short, too_long, logistic, context_dependent, narrative_proper_noun, low_reflective or null. case_fold revives patterns
    with capitals, which lower-cased text otherwise never meets."""
    flags = "Ui" if case_fold else "U"
    low = word_hits(lower, lex.reflective) < least_score
    if lyric:
        low = low & ~has_lyric_combo(lower, lex)
    return (
        F.when(n_words < least, "too_short").when(n_words > most, "too_long").when(pattern_hits(lower, lex.logistic, flags) >= 2, "logistic")
        .when(is_context_dependent(lower, lex), "context_dependent").when(narrative_source & any_pattern(lower, lex.narrative, flags), "narrative_proper_noun").when(low, "low_reflective")
    )


def theme_tag(lower: Column, spiritual_source: Column, priority_source: Column, lex: Lexicons) -> Column:
    light, dark, spiritual = (word_hits(lower, x) for x in (lex.light, lex.dark, lex.spiritual))
    return (
        F.when(spiritual_source & (spiritual >= 1), "spiritual_luminous").when((light >= 2) & (dark == 0), "light_luminous")
        .when(priority_source & (light >= 1) & (dark <= 1), "light_priority")
    )


def letter_reason(lower: Column, lex: Lexicons) -> Column:
    """reject_logistic, reject_intimate, reject_dark, reject_second_person, reject_not_light or null; patterns ignore case."""
    density = reduce(add, [occurrences(lower, x) for x in lex.second_person])
    return (
        F.when(any_pattern(lower, lex.letter_logistic, "Ui"), "reject_logistic").when(any_pattern(lower, lex.letter_intimate, "Ui"), "reject_intimate")
        .when(any_pattern(lower, lex.letter_dark, "Ui"), "reject_dark").when(density > 2, "reject_second_person").when(word_hits(lower, lex.letter_light) < 2, "reject_not_light")
    )
