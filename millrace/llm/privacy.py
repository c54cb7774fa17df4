"""Personal data: exact patterns, and information-theoretic sanitisation of the terms that give protected entities away.

A protected entity is a value that the patterns find (one address, one number). Terms near its mentions are counted over the
corpus in distinct texts, so that copies of a text count once. A term discloses an entity when their pointwise mutual information reaches a share of the
information content of the entity, log2(texts / texts that mention it): seeing the term then says almost as much as seeing the entity. In
documents that mention the entity, such terms are generalised to a placeholder.

Evidence, besides that threshold: a term must stand near the entity in three different contexts, in both where it has two. An entity
of one context says nothing about words that no other text has, as all of them would be its own; of the others there the threshold decides.
"""

import hashlib
import re
from collections import Counter
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import table

# The kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone", "term")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match never starts inside a run of digits: the run's start would do
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
#: Context of a mention: so many characters and so many terms on either side.
CONTEXT_CHARS, CONTEXT_TERMS = 160, 8
#: Different contexts in which an entity must be seen with a term (all of them, where it has fewer), and share of its information content.
MIN_CONTEXTS, MIN_DISCLOSURE = 3, 0.8


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping matches. Every match holds an @, so only the places around one are tried; a long run without an
    @ costs nothing."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.start(), m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(text: str, start: int, kind: int, end: int) -> int:
    """Hash of the kind and the normal form of the value: lower case, digits only for numbers."""
    value = text[start:end].lower()
    value = re.sub("[^0-9]", "", value) if kind in (2, 3) else value
    return xxhash.xxh64_intdigest(f"{kind}:{value}") - 2**63


def context(text: str, start: int, end: int) -> list[str]:
    left = [m.lower() for m in TERM.findall(text[max(0, start - CONTEXT_CHARS) : start])][-CONTEXT_TERMS:]
    return left + [m.lower() for m in TERM.findall(text[end : end + CONTEXT_CHARS])][:CONTEXT_TERMS]


def _contexts(batches):
    for batch in batches:
        rows = []
        for text, key in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            text = text.as_py() or ""
            for start, kind, end in base_spans(text):
                terms = context(text, start, end)
                name, seen = entity(text, start, kind, end), xxhash.xxh64_intdigest("\0".join(terms)) - 2**63
                rows += [(name, seen, t, key) for t in ["", *sorted(set(terms))]]  # the empty term stands for the mention
        columns = [*zip(*rows, strict=True)] if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["entity", "context", "term", "key"])


def _frequencies(batches, wanted, repeated):
    total, copies = Counter(), {}
    for batch in batches:
        for text, key in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            if text.is_valid and key not in copies:
                own = wanted.value.intersection(TERM.findall(text.as_py().lower()))
                if key in repeated.value:
                    copies[key] = own
                else:
                    total.update(own)
    rows = [(t, None, n) for t, n in total.items()] + [(t, k, 1) for k, own in copies.items() for t in own]
    columns = [*zip(*rows, strict=True)] if rows else [[], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["term", "key", "n"])


def _terms(batches):
    """The distinct terms of each text."""
    for batch in batches:
        for text, key in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            own = sorted(set(TERM.findall(text.as_py().lower()))) if text.is_valid else []
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(own), pa.int64()), pa.array(own, pa.string())], names=["key", "term"])


def text_frequencies(texts: DataFrame, terms: DataFrame, broadcast_rows: int) -> DataFrame:
    """(term, n): distinct texts that hold each of the terms. texts: text and its hash, the key. At most broadcast_rows terms and keys of
    repeated texts are broadcast; more are joined by shuffle."""
    few = [t for (t,) in terms.limit(broadcast_rows + 1).collect()]
    again = [k for (k,) in texts.groupBy("key").count().where("count > 1").select("key").limit(broadcast_rows + 1).collect()]
    if max(len(few), len(again)) <= broadcast_rows:
        wanted, repeated = (texts.sparkSession.sparkContext.broadcast(frozenset(x)) for x in (few, again))
        each = texts.select("text", "key").mapInArrow(partial(_frequencies, wanted=wanted, repeated=repeated), "term string, key long, n long")
        each = each.groupBy("term", "key").agg(F.sum("n").alias("n")).select("term", F.when(F.isnull("key"), F.col("n")).otherwise(1).alias("n"))
        return each.groupBy("term").agg(F.sum("n").alias("n"))
    each = texts.mapInArrow(_terms, "key long, term string")
    return each.join(terms, "term", "left_semi").distinct().groupBy("term").agg(F.count("*").alias("n"))


def disclosing_terms(docs: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """(entity, term) of the terms whose disclosure exceeds the threshold."""
    texts = docs.where("text is not null").select("text", F.xxhash64("text").alias("key"))
    seen = stored(texts.mapInArrow(_contexts, "entity long, context long, term string, key long").distinct())
    counts = F.count_distinct("key"), F.count_distinct("context")
    mentions = seen.where("term = ''").groupBy("entity").agg(counts[0].alias("mentions"), counts[1].alias("contexts"))
    both = seen.where("term <> ''").groupBy("entity", "term").agg(counts[0].alias("together"), counts[1].alias("shared")).join(mentions, "entity")
    both = stored(both.where(F.col("shared") >= F.least(F.lit(MIN_CONTEXTS), "contexts")))
    n = texts.select("key").distinct().count()
    frequencies = text_frequencies(texts, both.select("term").distinct(), broadcast_rows)
    both = both.join(frequencies, "term").where((F.col("contexts") > 1) | (F.col("n") > 1))
    information = F.log2(F.lit(float(max(n, 2))) / F.col("mentions"))
    mutual = F.log2(F.col("together") * float(max(n, 2)) / (F.col("mentions") * F.greatest("n", "together")))
    return stored(both.where((information > 0) & (mutual >= MIN_DISCLOSURE * information)).select("entity", "term"))


def spans_of(text: str, disclosing: dict[int, frozenset]) -> list[tuple[int, int, int]]:
    """Base spans and the terms that disclose one of the document's entities, sorted."""
    spans = base_spans(text)
    terms = set().union(*(disclosing.get(entity(text, *s), ()) for s in spans)) if spans and disclosing else set()
    if terms:
        free = sorted((a, b) for a, _, b in spans)
        for m in TERM.finditer(text):
            if m[0].lower() in terms and not any(a < m.end() and m.start() < b for a, b in free):
                spans.append((m.start(), 4, m.end()))
        spans.sort()
    return spans


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans become one placeholder, named by the first of them."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


_OUT = "n_email long, n_ip long, n_card long, n_phone long, n_term long, base_sha256 string, spans string, redacted string"


def _find(batches, given, with_text: bool):
    for batch in batches:
        rows = []
        own = batch.column(batch.num_columns - 1).to_pylist() if given is None else None
        for i, text in enumerate(batch.column("text")):
            text = text.as_py()
            pairs = given.value if given is not None else _by_entity((own[i] or []))
            spans = spans_of(text or "", pairs)
            named = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
            base = ",".join(x for x, s in zip(named, spans, strict=True) if s[1] < 4)
            n = Counter(k for _, k, _ in spans)
            rows.append((*(n[k] for k in range(5)), hashlib.sha256(base.encode()).hexdigest(), ",".join(named), redact(text, spans) if text and with_text else text if with_text else None))
        kept = [c for c in batch.schema.names if c not in ("text", "disclosing")]
        columns = [*zip(*rows, strict=True)] if rows else [[]] * 8
        kinds = [pa.int64()] * 5 + [pa.string()] * 3
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=[*kept, *(x.split()[0] for x in _OUT.split(", "))])


def _by_entity(pairs) -> dict[int, frozenset]:
    out: dict[int, set] = {}
    for p in pairs:
        e, t = (p["entity"], p["term"]) if isinstance(p, dict) else p
        out.setdefault(e, set()).add(t)
    return {e: frozenset(t) for e, t in out.items()}


def _mentions(batches):
    for batch in batches:
        ids, names = [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            own = sorted({entity(text, *s) for s in base_spans(text)})
            ids += [i] * len(own)
            names += own
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(names, pa.int64())], names=["key", "entity"])


def sanitise(docs: DataFrame, keep: list[str] = ("doc_id",), with_text: bool = True, broadcast_rows: int = 200_000) -> DataFrame:
    """Spans and the sanitised text of every row: the keep columns, counts by kind, base_sha256, spans (kind:start:end by start,
    code points), redacted (null for a null text or without with_text).

    Null and empty texts have no spans. Two terms or entities of any case count as one. At most broadcast_rows disclosing pairs are
    broadcast; more are joined by entity. One row per input row; other columns are dropped."""
    columns = [c for c in keep if c not in ("text", "disclosing")]
    pairs = disclosing_terms(docs, broadcast_rows)
    few = [tuple(r) for r in pairs.limit(broadcast_rows + 1).collect()]
    out = docs.select(*columns, "text")
    if len(few) <= broadcast_rows:
        given = docs.sparkSession.sparkContext.broadcast(_by_entity(few))
    else:
        given = None
        key = F.xxhash64("text")
        found = docs.select(key.alias("key"), "text").mapInArrow(_mentions, "key long, entity long").distinct().join(pairs, "entity")
        found = found.groupBy("key").agg(F.collect_list(F.struct("entity", "term")).alias("disclosing"))
        out = out.withColumn("key", key).join(found, "key", "left").drop("key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return out.mapInArrow(partial(_find, given=given, with_text=with_text), f"{schema}, {_OUT}")


def op2_privacy(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sanitise(docs, with_text=False).drop("redacted")
