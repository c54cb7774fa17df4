"""Main text of web pages, with site templates removed.

Every block element is hashed with what it holds (names, classes and text; other attributes vary from page to page), and counted for each
host over the whole table: elements outside the article by distinct pages, elements inside it by distinct articles, so that copies of a
page or an article count once. A subtree that recurs on many pages of its host is a template and is deleted. Inside the article that
goes for containers (advert boxes, share bars) of the smaller part of its text; its text blocks are never templates, nor is an element that
holds an article. Names, classes and roles of boilerplate are the fallback for what does not recur, as on small sites; names=False
leaves them out. What remains is read block by block.
"""

import re
from collections import Counter
from functools import partial
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import table

# Element names of HTML, and usual class and id words of boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table caption thead tbody tfoot tr td th figure figcaption address details summary hgroup".split())
DROPPED = RAW | frozenset("nav header footer aside form button select head dialog menu input".split())
BOILERPLATE = frozenset("ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu nav navbar navigation newsletter notice popup promo promoted related reply replies share sharing sidebar social sponsor sponsored subscribe teaser toolbar widget".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_OPENING = re.compile(r"<!--|<!\[CDATA\[|<[!?]|</?[a-zA-Z]")
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_QUOTED_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_PLAIN_END = re.compile(r"[^<>]*+")
#: Tags of a page whose quotation marks do not close before they are only looked for up to the next < or >; each costs one look at the rest of the page.
UNCLOSED = 8
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORDS = re.compile(r"[a-zA-Z]+")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: A subtree is a template where it stands on so many pages of its host at least, and on so large a share of them.
MIN_PAGES, MIN_SHARE = 10, 0.2


def attributes(text: str) -> list[tuple[str, str]]:
    """class, id and role, in lower case."""
    return [(kind.lower(), (a or b or c).lower()) for kind, a, b, c in _ATTRIBUTE.findall(text)] if text else []


def boilerplate(name: str, given: list[tuple[str, str]], inside: bool) -> bool:
    """By name, class, id or role. A header inside the article is part of it."""
    if name in DROPPED and not (name == "header" and inside):
        return True
    if not given or name in ("html", "body", "article", "main") and not any("omment" in v for _, v in given):
        return False
    for kind, value in given:
        if kind == "role":
            if value in ROLES:
                return True
        elif any(w in BOILERPLATE and not (w == "header" and inside) for w in _WORDS.findall(value)) and not (name in INLINE and name not in ("a", "span")):
            return True
    return False


def tokens(html: str):
    """("text", start, end), ("open", name, start, end, attributes), ("close", name, start, end) and ("raw", name, start, end), which holds
    no markup. Comments, declarations and closing tags without a name are skipped. Time grows with the page, whatever it holds."""
    at, size, unclosed = 0, len(html), 0
    while at < size:
        m = _OPENING.search(html, at)
        if not m:
            break
        start = m.start()
        if start > at:
            yield "text", at, start
        if not m[0][-1].isalpha():
            mark = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            end = html.find(mark, m.end())
            at = end + len(mark) if end >= 0 else size
            continue
        name = _NAME.match(html, m.end() - 1)
        end = _QUOTED_END.match(html, name.end()) if unclosed < UNCLOSED else None
        if end is None:
            unclosed += 1
            stop = _PLAIN_END.match(html, name.end()).end()
            at = stop + 1 if html[stop : stop + 1] == ">" else stop
        else:
            at = end.end()
        tag = name[0].lower()
        if m[0][1] == "/":
            yield "close", tag, start, at
        elif tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else size
            yield "raw", tag, start, at
        else:
            yield "open", tag, start, at, html[name.end() : at]
    if at < size:
        yield "text", at, size


class Element:
    """An element and what it holds: children are Elements, (start, end) of texts, and None for a line break. words: characters of text."""

    __slots__ = ("name", "given", "bad", "inside", "article", "holds", "children", "hash", "words")

    def __init__(self, name, given, bad, inside, article):
        self.name, self.given, self.bad, self.inside, self.article = name, given, bad, inside, article
        self.holds, self.children, self.hash, self.words = article, [], 0, 0


class Page:
    """The elements of a page. Every opened element is closed, at the latest by its parent or the end of the page."""

    def __init__(self, html: str, names: bool = True):
        self.html = html
        self.root = Element("", [], False, False, False)
        stack, opened, inside = [self.root], Counter(), 0
        bads, wrappers, free, hard = [], set(), False, 0

        def close():
            nonlocal inside, hard
            e = stack.pop()
            opened[e.name] -= 1
            inside -= e.article
            if e.bad:
                bads.pop()
                hard -= e.name in DROPPED
            stack[-1].holds |= e.holds
            stack[-1].words += e.words

        for kind, *token in tokens(html):
            if kind == "text":
                stack[-1].children.append((token[0], token[1]))
                stack[-1].words += token[1] - token[0]
            elif kind == "close":
                if opened[token[0]]:
                    while stack[-1].name != token[0]:
                        close()
                    close()
            elif kind == "open" and token[0] in VOID:
                if token[0] in ("br", "hr"):
                    stack[-1].children.append(None)
            else:
                given = attributes(token[3]) if kind == "open" else []
                bad = kind == "raw" or names and boilerplate(token[0], given, inside > 0)
                article = token[0] in ("article", "main") and not bad
                e = Element(token[0], given, bad, inside > 0, article)
                stack[-1].children.append(e)
                if kind == "raw":
                    e.children.append((token[1], token[2]))
                    continue
                if article:
                    # Elements that only a class names boilerplate, such as "with-sidebar", are none where every article stands below one.
                    free = free or not bads
                    if not hard:
                        for x in reversed(bads):
                            if x in wrappers:
                                break
                            wrappers.add(x)
                stack.append(e)
                opened[e.name] += 1
                inside += article
                if bad:
                    bads.append(e)
                    hard += e.name in DROPPED
        while len(stack) > 1:
            close()
        if not free:
            for x in wrappers:
                x.bad = False
        self.only = self._has_article()

    def walk(self):
        """(element, entering?) of all elements below the root, in page order; no recursion, as pages may be deep."""
        stack = [iter(self.root.children)]
        path = [self.root]
        while stack:
            for x in stack[-1]:
                if isinstance(x, Element):
                    yield x, True
                    stack.append(iter(x.children))
                    path.append(x)
                    break
            else:
                stack.pop()
                e = path.pop()
                if e is not self.root:
                    yield e, False

    def _has_article(self) -> bool:
        return any(e.article and not e.bad for e, entering in self.walk() if entering)

    def hashes(self) -> None:
        """Hash every element: its name, its class without digits, its text without outer white space, and the hashes of its elements."""
        for e, entering in self.walk():
            if not entering:
                h = xxhash.xxh64(f"{e.name}|{' '.join(sorted(re.sub('[0-9]+', '', v) for k, v in e.given if k == 'class'))}".encode("utf-8", "surrogatepass"))
                for x in e.children:
                    h.update(x.hash.to_bytes(8, "little") if isinstance(x, Element) else b"\0" + self.html[x[0] : x[1]].strip().encode("utf-8", "surrogatepass") if x else b"\1")
                e.hash = h.intdigest()

    def candidates(self):
        """(subtree, article) of the elements that can be templates; article is None outside one."""
        self.hashes()
        within: list[Element] = []
        for e, entering in self.walk():
            if not entering:
                if e.article:
                    within.pop()
                continue
            if e.article:
                within.append(e)
            elif e.holds or e.name in INLINE or e.name in ("html", "body"):
                pass
            elif not within:
                yield e, None
            elif e.name not in TEXT_BLOCKS and 2 * e.words < within[0].words:
                yield e, within[0]

    def text(self, templates=frozenset()) -> str:
        """Blocks of the article (or of the whole body where there is none), joined by one line feed."""
        drop = {id(e) for e, _ in self.candidates() if signed(e.hash) in templates} if templates else set()
        blocks, piece = [], []

        def flush():
            if piece:
                if block := " ".join(unescape("".join(piece)).split()):
                    blocks.append(block)
                piece.clear()

        stack, path, article = [iter(self.root.children)], [self.root], 0
        while stack:
            for x in stack[-1]:
                if x is None:
                    piece.append(" ")
                elif isinstance(x, tuple):
                    if article or not self.only:
                        piece.append(self.html[x[0] : x[1]])
                elif x.bad or id(x) in drop:
                    if x.name not in INLINE:
                        flush()
                else:
                    if x.name not in INLINE:
                        flush()
                    article += x.article
                    stack.append(iter(x.children))
                    path.append(x)
                    break
            else:
                stack.pop()
                e = path.pop()
                article -= e.article
                if e.name not in INLINE:
                    flush()
        return "\n".join(blocks)


def signed(h: int) -> int:
    return h - 2**63


def main_text(html: str | None, templates=frozenset(), names: bool = True) -> str:
    return Page(html or "", names).text(templates)


def _hashes(batches, names: bool):
    """For each page its subtrees with what they are counted by (the page, or the article around them); subtree 0 counts the host's pages."""
    for batch in batches:
        hosts, hashes, of = [], [], []
        for host, html in zip(batch.column(0), batch.column(1), strict=True):
            html = html.as_py() or ""
            name = signed(xxhash.xxh64_intdigest(html.encode("utf-8", "surrogatepass")))
            own = {(0, name)} | {(signed(e.hash), name if article is None else signed(article.hash)) for e, article in Page(html, names).candidates()}
            hosts += [host.as_py()] * len(own)
            hashes += [x for x, _ in own]
            of += [x for _, x in own]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(of, pa.int64())], names=["host", "subtree", "page"])


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, names: bool = True) -> DataFrame:
    """(host, subtree) of the subtrees that recur on many different pages of their host. Subtree 0 counts the different pages."""
    counted = pages.select("host", "html").mapInArrow(partial(_hashes, names=names), "host string, subtree long, page long").distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    counted = stored(counted.where(F.col("n") >= min_pages))
    whole = counted.where("subtree = 0").select("host", F.col("n").alias("pages"))
    found = counted.where("subtree <> 0").join(whole, "host").where(F.col("n") >= min_share * F.col("pages"))
    return found.select("host", "subtree")


def _texts(batches, templates, names: bool):
    for batch in batches:
        own = batch.column("templates").to_pylist() if templates is None else [templates.value.get(h, frozenset()) for h in batch.column("host").to_pylist()]
        texts = [main_text(x.as_py(), frozenset(t or ()), names) for x, t in zip(batch.column("html"), own, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_pages(pages: DataFrame, broadcast_rows: int = 200_000, names: bool = True, **bounds) -> DataFrame:
    """page_id, url, text of every page, one row per input row; an empty table gives none.

    Null html gives an empty text, a null or hostless url belongs to the empty host. Repeated rows get equal texts and count once. A long
    page counts whole; markup that never closes ends where the page does, and costs no more than its length. names: whether boilerplate is
    also told by names, classes and roles. At most broadcast_rows templates (all hosts together) are broadcast; more are joined by host.
    Extra columns are ignored."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    templates = stored(site_templates(pages, names=names, **bounds))
    few = templates.limit(broadcast_rows + 1).collect()
    if len(few) <= broadcast_rows:
        by_host: dict[str, set[int]] = {}
        for h, t in few:
            by_host.setdefault(h, set()).add(t)
        value = pages.sparkSession.sparkContext.broadcast({h: frozenset(t) for h, t in by_host.items()})
    else:
        value = None
        pages = pages.join(templates.groupBy("host").agg(F.collect_list("subtree").alias("templates")), "host", "left")
    return pages.mapInArrow(partial(_texts, templates=value, names=names), "page_id long, url string, text string")


def op10_html(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
