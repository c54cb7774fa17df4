"""Validation of generated questions and answers: a reason code (null: valid) and the detail that belongs to it."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.lexicon import Lexicons, any_pattern, first_pattern
from ..functions.text import hits, occurrences, sentence_marks, strip, word_count

# Fixed values of the short-answer validator.
OPENINGS = ["il est vrai que", "il y a des", "il arrive parfois que", "la question de savoir", "il faut savoir que", "on ne peut pas"]
FAMILIAR = [r"\bmon vieux\b", r"\bmon ami\b"]
STAGE = [r"\([^)]{3,}\)", r"\*[^*]+\*", r"\b(un temps|silence|soupir|rire sec|je regarde|il se|elle se)\b", r"\b(il se l[eè]ve|il marche|il se tait|je me redresse|les mains dans les poches)\b"]
REJECTED = [r"\b(cam(us)?|sartre)\b", r"\bl[’']etranger\b", r"\bl[’']étranger\b", r"\bla peste\b", r"\bla chute\b", r"\bsisyphe\b", r"\bl[’']homme révolté\b", r"\bl[’']homme revolte\b", r"\bmeursault\b", r"\brieux\b", r"\btarrou\b", r"\bclamence\b", r"\boran\b", r"\balger\b", r"^[-*]\s+", r"^#+\s+", r"\b(premièrement|deuxièmement|troisièmement)\b", r"\b(en tant qu[’']|je suis un|intelligence artificielle|modèle de langage)\b", r"[«»]", r"<system-reminder>", r"</system-reminder>", r"\bplan mode\b", r"\bread-only phase\b", r"\boperational mode has changed\b", r"\bcritical: plan mode active\b"]
FINAL = [".", "!", "?", "…"]


def question_reason(c: Column, lex: Lexicons) -> Column:
    """empty, skip, no_question_mark, length, pattern or null."""
    q = strip(F.coalesce(c, F.lit("")))
    return (
        F.when(q == "", "empty").when(q == "SKIP", "skip").when(~F.contains(q, F.lit("?")), "no_question_mark").when(~word_count(q).between(8, 20), "length")
        .when(any_pattern(F.lower(q), lex.question_reject), "pattern")
    )


def answer_reason(c: Column, lex: Lexicons, least: int = 50) -> Column:
    """empty, too_short, pattern, truncated or null, for long answers."""
    a = strip(F.coalesce(c, F.lit("")))
    return (
        F.when(a == "", "empty").when(word_count(a) < least, "too_short").when(any_pattern(F.lower(a), lex.answer_reject, "Umd"), "pattern")
        .when(~F.right(a, F.lit(1)).isin(FINAL), "truncated")
    )


def answer_detail(c: Column, lex: Lexicons, least: int = 50) -> Column:
    """The word count of a too short answer, the pattern of a rejected one."""
    a = strip(c)
    n = word_count(a)
    return F.when(n < least, n.cast("string")).otherwise(first_pattern(F.lower(a), lex.answer_reject, "Umd"))


def short_answer_reason(c: Column, least: int = 30, most: int = 90, stage: list[str] = STAGE, familiar: list[str] = FAMILIAR, rejected: list[str] = REJECTED, openings: list[str] = OPENINGS, first_person: str = r"\b(je|j['’])", most_first_person: int = 8) -> Column:
    """The ordered exits of the short-answer validator, null for a valid answer."""
    a = strip(F.coalesce(c, F.lit("")))
    lower, n, marks = F.lower(a), word_count(a), sentence_marks(a)
    starts = F.lit(False)
    for o in openings:
        starts = starts | lower.startswith(o)
    return (
        F.when(a == "", "empty").when(n < least, "too_short").when(n > most, "too_long").when(~marks.between(1, 6), "sentence_count")
        .when(F.contains(a, F.lit("<")) | F.contains(a, F.lit(">")), "tags").when(lower.startswith("ah"), "familiar_opening").when(starts, "pompous_opening")
        .when(any_pattern(lower, familiar), "familiarity").when(any_pattern(lower, stage), "stage_direction").when(any_pattern(lower, rejected, "Umd"), "pattern")
        .when(F.regexp_count(lower, F.lit(f"(?U){first_person}")) > most_first_person, "first_person").when(occurrences(a, "?") > 1, "questions")
        .when(hits(a, r"\n\s*[?.!]\s*$", "Ud"), "orphan_punctuation").when(hits(a, r"\n\s*\n\s*[?.!]\s*$", "Ud"), "broken_end").when(hits(a, r"[?.!]\s*\n\s*\n\s*[?.!]\s*$", "Ud"), "double_punctuation")
        .when(~F.right(a, F.lit(1)).isin(FINAL), "truncated")
    )
