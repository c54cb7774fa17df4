"""Operators on ordered lines, pages and letters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, regex, strip
from .segment import sections

# Lines that open a footnote, and lines that are dropped outside footnotes.
FOOTNOTE = r"^\d+\.\s+(?:[A-Z]|Ne manquons|J'ai entendu|Mais non pas|À propos|On peut penser|Je n'ai pas|Précisons|Même les|A\. —|Il s'agit|La quantité|Même réflexion|La volonté|Ce qui importe|Au sens plein|Je pense ici|Ce qui est proposé)"
DROPPED = r"^Chapitre \d+$|^\|\d+|^\*$|^\d+$"
NUMBERED = r"^\d+\.\d+\s+"


#: Stands for a run of dropped lines while a text is worked on; a line of the text that is just this is dropped as well.
GONE = "\x00\x1a"


def drop_footnote_blocks(c: Column) -> Column:
    """A line that opens a footnote is dropped with all lines up to the next blank one, which stays. Titles lose their numbers.

    Lines are stripped, so a blank one shows as two line feeds, and one pass over the text finds the runs, however many lines it has."""
    text = F.array_join(F.transform(F.split(c, "\n"), strip), "\n")
    run = FOOTNOTE.replace(r"\s+", r"[^\S\n]+") + r"[\s\S]*?(?=\n\n|\n\z|\z)"
    lines = F.split(F.regexp_replace(text, regex(run, "Umd"), GONE), "\n")
    kept = F.filter(lines, lambda x: (x != GONE) & (x.rlike(regex(NUMBERED)) | ~x.rlike(regex(DROPPED))))
    return F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, regex(NUMBERED), "")), "\n")


def join_pages(pages: DataFrame, book: str, page: str, headers: list[str]) -> DataFrame:
    """Remove header patterns page by page, then join each book's pages in order by a line feed."""
    text = F.col("text")
    for h in headers:
        text = F.regexp_replace(text, regex(h, "Umd"), "")
    clean = pages.select(book, F.struct(F.col(page).alias("page"), text.alias("text")).alias("p"))
    return clean.groupBy(book).agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["text"]), "\n").alias("text"))


def letters(df: DataFrame, header: str, wanted: str, clean=clean_text) -> DataFrame:
    """(doc_id, letter_no, body) of the letters whose header matches wanted; bodies are cleaned by clean, empty ones dropped."""
    out = df.select("doc_id", F.posexplode(sections(F.col("text"), header)).alias("i", "s")).where(F.col("s.header").rlike(regex(wanted)))
    return out.select("doc_id", (F.col("i") + 1).alias("letter_no"), clean(F.col("s.body")).alias("body")).where("body <> ''")
