"""A generation run: question, gates, answer, gates, and one metadata row for each attempt."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import Lexicons
from ..functions.text import render, strip, trim_generated, word_count
from . import chat, validate
from .generate import Generator, generate
from .overlap import is_copy


def run_pairs(
    passages: DataFrame, lex: Lexicons, ask: Callable[[], Generator], answer: Callable[[], Generator], question_template: str, answer_template: str | Column,
    keep: Callable[[DataFrame], DataFrame], check_overlap: bool = True, question_model: str = "", answer_model: str = "",
) -> DataFrame:
    """passages (with a column passage) with question, answer, status, question_model, answer_model, answer_word_count.

    Status: api_error_question, skip_question_model, invalid_question, local_error_answer, copy, invalid_answer:<reason>, ok. keep
    stores a frame and reads it back: what a model said is judged once, whatever is computed again later. Answers are asked for
    only where the question passed."""
    asked = generate(passages.withColumn("prompt", render(question_template, passage=F.col("passage"))), "prompt", ask)
    asked = keep(asked.withColumn("question", trim_generated(F.col("generated"))).drop("prompt", "generated"))
    bad = validate.question_reason(F.col("question"), lex)
    asked = asked.withColumn(
        "gate", F.when(F.coalesce("question", F.lit("")) == "", "api_error_question").when(strip(F.col("question")) == "SKIP", "skip_question_model").when(bad.isNotNull(), "invalid_question")
    )
    template = F.lit(answer_template) if isinstance(answer_template, str) else answer_template
    prompt = F.replace(F.replace(template, F.lit("{question}"), F.col("question")), F.lit("{passage}"), F.col("passage"))
    told = generate(asked.where("gate is null").withColumn("prompt", prompt), "prompt", answer).withColumn("answer", trim_generated(F.col("generated"))).drop("prompt", "generated")
    told = keep(told)
    reason = validate.answer_reason(F.col("answer"), lex)
    copied = is_copy(F.col("passage"), F.col("answer")) if check_overlap else F.lit(False)
    status = F.when(F.coalesce("answer", F.lit("")) == "", "local_error_answer").when(copied, "copy").when(reason.isNotNull(), F.concat(F.lit("invalid_answer:"), reason)).otherwise("ok")
    done = told.withColumn("status", status).unionByName(asked.where("gate is not null").withColumn("answer", F.lit(None).cast("string")).withColumn("status", F.col("gate")))
    return done.drop("gate").withColumns({"question_model": F.lit(question_model), "answer_model": F.lit(answer_model), "answer_word_count": word_count(F.col("answer"))})


def metadata(run: DataFrame, *keys: str) -> DataFrame:
    """The side-channel record of every attempt, rejects included."""
    return run.select(*keys, "status", "question_model", "answer_model", "question", "answer_word_count")


def records(run: DataFrame, *keys: str) -> DataFrame:
    """The chat records of the attempts that passed."""
    return run.where("status = 'ok'").select(*keys, chat.pair(F.col("question"), F.col("answer")).alias("messages"))
