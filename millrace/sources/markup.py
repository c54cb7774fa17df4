"""Text out of HTML and EPUB, batch by batch in Python with the standard parser."""

import io
import zipfile
from functools import partial
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


#: White space that plain pieces lose at their ends.
BLANKS = " \t\n\f\r"


class _Reader(HTMLParser):
    """Stripped text nodes in page order, without the dropped (tag, class) elements."""

    def __init__(self, drop):
        super().__init__()
        self.drop, self.out, self.open, self.inside = drop, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return self.piece_ends()
        classes = (dict(attrs).get("class") or "").split()
        gone = any(tag == t and (c is None or c in classes) for t, c in self.drop)
        if not gone:
            self.piece_ends()
        self.open.append((tag, gone))
        self.inside += gone

    def handle_endtag(self, tag):
        self.piece_ends()
        if any(t == tag for t, _ in self.open):
            while self.open:
                t, gone = self.open.pop()
                self.inside -= gone
                if t == tag:
                    break

    def handle_data(self, data):
        if not self.inside and data.strip():
            self.out.append(data.strip())

    def piece_ends(self):
        pass


class _PlainReader(_Reader):
    """The same with only some character references decoded, in the order of the map, and pieces that end at kept tags alone, so that
    comments and dropped elements do not part a text. It is fed markup whose every & is written as &amp;."""

    def __init__(self, drop, references):
        super().__init__(drop)
        self.references, self.piece = references, []

    def handle_data(self, data):
        if not self.inside:
            self.piece.append(data.replace("&amp;", "&") if self.cdata_elem else data)

    def piece_ends(self):
        if not self.inside:
            text, self.piece = "".join(self.piece), []
            for name, character in self.references.items():
                text = text.replace(name, character)
            if text := text.strip(BLANKS):
                self.out.append(text)


def text_of(html: str | None, drop=(), references: dict[str, str] | None = None) -> str:
    reader = _Reader(drop) if references is None else _PlainReader(drop, references)
    reader.feed((html or "") if references is None else (html or "").replace("&", "&amp;"))
    reader.close()
    reader.piece_ends()
    return "\n".join(reader.out)


def _html(batches, key, column, drop, references):
    for pdf in batches:
        yield pd.DataFrame({key: pdf[key], "text": [text_of(h, drop, references) for h in pdf[column]]})


def html_text(df: DataFrame, key: str, column: str, drop=(), references: dict[str, str] | None = None) -> DataFrame:
    """key and text of every row; null markup gives an empty text. drop: (tag, class or None) of elements to leave out. references:
    the only character references to decode, in this order; by default all, as browsers do, those without a semicolon too."""
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, column).mapInPandas(partial(_html, key=key, column=column, drop=list(drop), references=references), f"{key} {kind}, text string")


def _epub(batches, drop):
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                names = [n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm"))]
                texts = [text_of(z.read(n).decode("utf-8", "replace"), drop) for n in names]
            rows += [(path.rsplit("/", 1)[-1].rsplit(".", 1)[0], i, t) for i, t in enumerate(t for t in texts if t.strip())]
        yield pd.DataFrame(rows, columns=["doc_id", "item_pos", "text"])


def read_epub(spark: SparkSession, path: str, drop=()) -> DataFrame:
    """(doc_id, item_pos, text): the documents inside EPUB files, empty ones left out; doc_id is the file's stem."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path"), F.col("content"))
    return files.mapInPandas(partial(_epub, drop=list(drop)), "doc_id string, item_pos int, text string")


def _pdf(batches):
    try:
        import pymupdf
    except ImportError as e:
        raise ImportError("reading PDF files needs pymupdf on the executors") from e
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            with pymupdf.open(stream=content, filetype="pdf") as book:
                rows += [(path.rsplit("/", 1)[-1].rsplit(".", 1)[0], i, page.get_text()) for i, page in enumerate(book)]
        yield pd.DataFrame(rows, columns=["doc_id", "page_no", "text"])


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, page_no, text): pages of PDF files; headers go with operators.lines.join_pages."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path"), F.col("content"))
    return files.mapInPandas(_pdf, "doc_id string, page_no int, text string")
