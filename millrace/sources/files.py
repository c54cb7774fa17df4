"""Readers and writers: whole texts, JSON lines (tolerant and strict), required and optional files, safe rewrites."""

from functools import partial
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE, preview, regex, strip, word_count
from ..streaming.incremental import exists

MESSAGES = "messages array<struct<role:string,content:string>>"
METADATA = "index bigint, source string, theme_tag string, status string, question_model string, answer_model string, question string, answer_word_count int"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted."""
    p = _path(spark, pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(str(s.getPath().toString()) for s in (found or []))


def require(spark: SparkSession, *paths: str) -> None:
    """Raise unless every file is there."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(", ".join(missing))


def first_match(spark: SparkSession, pattern: str) -> str | None:
    return next(iter(matches(spark, pattern)), None)


def read_texts(spark: SparkSession, *patterns: str) -> DataFrame:
    """(source, text): one row for each file, source is its stem."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    return spark.read.text(list(patterns), wholetext=True).select(name.alias("source"), F.col("value").alias("text"))


def read_named(spark: SparkSession, folder: str, files: dict[str, str]) -> tuple[DataFrame | None, list[str]]:
    """Texts of a source-to-file map, and the names whose file is missing."""
    there = {n: f"{folder}/{f}" for n, f in files.items() if exists(spark, f"{folder}/{f}")}
    missing = [n for n in files if n not in there]
    if not there:
        return None, missing
    dim = spark.createDataFrame([(files[n].rsplit(".", 1)[0], n) for n in there], "source string, name string")
    texts = read_texts(spark, *there.values()).join(F.broadcast(dim), "source")
    return texts.select(F.col("name").alias("source"), "text"), missing


def read_jsonl(spark: SparkSession, path: str, schema: str = MESSAGES, strict: bool = False) -> DataFrame:
    """JSON lines by schema. strict raises at the first bad line; otherwise bad and blank lines are left out."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Add rows to a folder of JSON lines; what stands there stays. A failed job leaves nothing behind."""
    write_jsonl(df, path, "append")


def write_chunks(df: DataFrame, path: str, text: str = "text", mode: str = "overwrite") -> None:
    """JSON lines with white space cut off the right end of the text; letters stay as they are, unescaped."""
    write_jsonl(df.withColumn(text, F.regexp_replace(text, regex(rf"{SPACE}+$"), "")), path, mode)


def write_small(spark: SparkSession, path: str, content: str) -> None:
    """A small file (a configuration, an index) that the driver writes to any store that Spark can reach."""
    p = _path(spark, path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def read_config(spark: SparkSession, path: str, schema: str, **overrides) -> dict:
    """The settings of one JSON file by schema: a given override wins, a setting that the file lacks is null. Raises if the file is missing
    or no JSON object."""
    require(spark, path)
    row = spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True).first()
    return {k: overrides.get(k, v) for k, v in row.asDict(recursive=True).items()}


def file_dimension(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """(name, stem) of a map from names to file names."""
    return spark.createDataFrame([(n, f.rsplit(".", 1)[0]) for n, f in files.items()], "name string, stem string")


def read_dimension(spark: SparkSession, folder: str, files: dict[str, str]) -> DataFrame:
    """(name, found, text) for every name of the map; a missing file gives a row without a text."""
    dim, (texts, missing) = file_dimension(spark, files), read_named(spark, folder, files)
    if texts is None:
        return dim.select("name", F.lit(False).alias("found"), F.lit(None).cast("string").alias("text"))
    return dim.join(texts.withColumnRenamed("source", "name"), "name", "left").select("name", (~F.col("name").isin(missing)).alias("found"), "text")


def literal_rows(spark: SparkSession, content: str) -> DataFrame:
    """(pos, text): the lines of a literal, stripped, blank ones left out, each text once at its first place (from 0)."""
    lines = spark.range(1).select(F.posexplode(F.split(F.lit(content), "\n")).alias("at", "text")).select("at", strip(F.col("text")).alias("text"))
    first = lines.where("text <> ''").groupBy("text").agg(F.min("at").alias("at"))
    return first.select((F.row_number().over(Window.orderBy("at")) - 1).alias("pos"), "text")


def _store(uri: str):
    """(file system, path) of a qualified path as Arrow opens it in Python workers; None where only Spark can."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    try:
        return fs.FileSystem.from_uri(uri)
    except (pa.ArrowException, OSError):
        return None


def _qualified(spark: SparkSession, path: str) -> str:
    p = _path(spark, path)
    return str(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString())


#: The name of a file without a source; quote() gives none that is just this.
NO_SOURCE = "%"
#: Bytes of texts that are read at once, a file at least.
READ_BYTES = 4_000_000


def _save(batches, uri):
    store, root = _store(uri)
    folder = f"{root}/part-{TaskContext.get().partitionId():05d}"
    name, out, n = None, None, 0
    for batch in batches:
        for source, text in zip(batch.column("source"), batch.column("text"), strict=True):
            stem = quote(source.as_py(), safe="") if source.is_valid else NO_SOURCE
            if stem != name:
                if out:
                    out.close()
                else:
                    store.create_dir(folder)
                name, out, n = stem, store.open_output_stream(f"{folder}/{stem}.txt"), n + 1
            out.write(((text.as_py() or "") + "\n").encode())
    if out:
        out.close()
    yield pa.record_batch({"n": pa.array([n], pa.int64())})


def _saved(batches, uri):
    store, root = _store(uri)

    def rows(sources, texts):
        return pa.record_batch({"source": pa.array(sources, pa.string()), "text": pa.array(texts, pa.string())})

    for batch in batches:
        for part in batch.column("id").to_pylist():
            sources, texts, held = [], [], 0
            for f in store.get_file_info(fs.FileSelector(f"{root}/part-{part:05d}", allow_not_found=True)):
                with store.open_input_stream(f.path) as x:
                    data = x.read()
                stem = f.base_name.removesuffix(".txt")
                sources.append(None if stem == NO_SOURCE else unquote(stem))
                texts.append(data.removesuffix(b"\n").decode("utf-8", "replace"))
                held += len(data)
                if held > READ_BYTES:
                    yield rows(sources, texts)
                    sources, texts, held = [], [], 0
            yield rows(sources, texts)


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """(source, text): the texts that save_texts wrote, one row for each file, without the line feed at its end. A task reads the files
    of one writing task, so the driver lists folders and never the files."""
    uri = _qualified(spark, path)
    if opened := _store(uri):
        store, root = opened
        n = max((int(f.base_name[5:]) + 1 for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.base_name.startswith("part-")), default=0)
        return spark.range(0, n, 1, max(n, 1)).mapInArrow(partial(_saved, uri=uri), "source string, text string")
    files = spark.read.schema("value string, source string").text(path, wholetext=True)
    return files.select("source", F.regexp_replace("value", "\n\\z", "").alias("text"))


def save_texts(df: DataFrame, path: str) -> DataFrame:
    """Write the texts by source, a file for each source of a task, named by it; returns words and characters of each. Files go straight
    to their places, as a folder, a checksum file and a process that sets rights for each cost far more than the texts. In a store
    that Python workers cannot open, Spark writes a folder for each source."""
    spark = df.sparkSession
    uri = _qualified(spark, path)
    if opened := _store(uri):
        store, root = opened
        if store.get_file_info(root).type != fs.FileType.NotFound:
            store.delete_dir(root)
        store.create_dir(root)
        rows = df.select(F.col("source").cast("string").alias("source"), "text").sortWithinPartitions("source")
        rows.mapInArrow(partial(_save, uri=uri), "n long").agg(F.sum("n")).collect()
    else:
        df.select("text", "source").write.mode("overwrite").partitionBy("source").text(path, lineSep="\n")
    return df.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n_words"), F.sum(F.char_length("text")).alias("n_text_chars"))


def rewrite(spark: SparkSession, path: str, change, schema: str = MESSAGES) -> None:
    """Replace a JSON-lines folder by change(its rows); the old one stays as path + '.bak'."""
    fs = _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new, old = f"{path}.new", f"{path}.bak"
    fs.delete(_path(spark, new), True)
    write_jsonl(change(read_jsonl(spark, path, schema, strict=True)), new)
    fs.delete(_path(spark, old), True)
    if not (fs.rename(_path(spark, path), _path(spark, old)) and fs.rename(_path(spark, new), _path(spark, path))):
        raise OSError(f"could not replace {path}")


def dry_run(df: DataFrame, n: int = 15, text: str = "passage") -> DataFrame:
    """A sample that writes nothing: n rows with a preview."""
    return df.limit(n).withColumn(text, preview(F.col(text), 220))
