"""Pages to records.

One Python step, ``parse_pages``, runs the stdlib HTML parser over each page
inside ``mapInArrow`` (bounded batches, one pass, no shuffle) and returns the
raw pieces: title, the labelled spans, text blocks and anchors.  Everything
after it (labels, editor rule, normalisation, dates, link filter) is built-in
column expressions.

Paragraph rule: a ``<p>`` is closed by ``</p>``, by the next ``<p>`` or by
any block-level start or end tag; text inside script and style is ignored;
character references are decoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.common import small_batches

# Tags whose start or end closes an open paragraph.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section table ul".split()
)
# The style and the labels of the page header's spans.
SOURCE_STYLE = "margin-right:10px;"
PUBLISH_RE = re.compile(r"发稿时间：(\d{4}-\d{2}-\d{2} \d{2}:\d{2})")
PERIOD_RE = re.compile(r"期次：(\S+)")
READCOUNT_RE = re.compile(r"阅读：(\d+)")

PARSED_SCHEMA = (
    "page_id long, url string, title string, source string, publish_raw string, period string, "
    "readcount string, blocks array<string>, anchors array<struct<href:string,text:string>>, error string"
)


class _Node:
    __slots__ = ("tag", "attrs", "texts", "children", "order")

    def __init__(self, tag, attrs, order):
        self.tag = tag
        self.attrs = attrs
        self.texts: list[str] = []
        self.children = 0
        self.order = order


class _PageParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.raw = None  # inside script/style
        self.title = None
        self.title_open = False
        self.title_children = 0
        self.title_done = False
        self.p = None
        self.paragraphs: list[str] = []
        self.open_divs: list[tuple[str | None, list[str] | None]] = []
        self.text_content: list[list[str]] = []
        self.content_div: list[str] | None = None
        self.content_div_seen = False
        self.spans: list[_Node] = []
        self.open_spans: list[_Node] = []
        self.anchor = None
        self.anchors: list[tuple[str, list[str]]] = []
        self.n = 0

    # --- paragraph bookkeeping
    def _close_p(self):
        if self.p is not None:
            self.paragraphs.append("".join(self.p))
            self.p = None

    def handle_starttag(self, tag, attrs):
        self.n += 1
        if tag in ("script", "style"):
            self.raw = tag
        if self.title_open:
            self.title_children += 1
        if tag in BLOCK_TAGS:
            self._close_p()
        if tag == "p":
            self.p = []
        a = dict(attrs)
        for s in self.open_spans:
            s.children += 1
        if tag == "title" and not self.title_done and self.title is None:
            self.title_open = True
            self.title = []
        elif tag == "div":
            buf_tc = None
            buf_c = None
            if a.get("id") == "text_content":
                buf_tc = []
                self.text_content.append(buf_tc)
            classes = (a.get("class") or "").split()
            if "content" in classes and not self.content_div_seen:
                self.content_div_seen = True
                buf_c = []
                self.content_div = buf_c
            self.open_divs.append((buf_tc, buf_c))
        elif tag == "span":
            node = _Node("span", a, self.n)
            self.spans.append(node)
            self.open_spans.append(node)
        elif tag == "a" and "href" in a:
            self.anchor = (a.get("href") or "", [])
            self.anchors.append(self.anchor)

    def handle_startendtag(self, tag, attrs):
        # <br/>, <p/>: a start tag without content
        self.handle_starttag(tag, attrs)
        if tag not in ("p",):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.raw = None
        if tag in BLOCK_TAGS:
            self._close_p()
        if tag == "title" and self.title_open:
            self.title_open = False
            self.title_done = True
        elif tag == "div" and self.open_divs:
            self.open_divs.pop()
        elif tag == "span" and self.open_spans:
            self.open_spans.pop()
        elif tag == "a":
            self.anchor = None

    def handle_data(self, data):
        if self.raw is not None:
            return
        if self.title_open:
            self.title.append(data)
        if self.p is not None:
            self.p.append(data)
        for tc, c in self.open_divs:
            if tc is not None:
                tc.append(data)
            if c is not None:
                c.append(data)
        for s in self.open_spans:
            s.texts.append(data)
        if self.anchor is not None:
            self.anchor[1].append(data)

    def close(self):
        super().close()
        self._close_p()


def _span_string(s: _Node) -> str | None:
    """BeautifulSoup ``.string``: the text when the span has no child tag."""
    if s.children:
        return None
    return "".join(s.texts)


def _strip_join(texts: Iterable[str]) -> str:
    """``get_text(strip=True)``: every text node stripped, then joined."""
    return "".join(t.strip() for t in texts if t.strip())


def parse_html(html: str | None) -> dict:
    """Raw pieces of one page (plain Python, also used by tests)."""
    parser = _PageParser()
    error = None
    try:
        parser.feed(html or "")
        parser.close()
    except Exception as e:  # noqa: BLE001 - a broken page yields what was read, and says so
        error = f"{type(e).__name__}: {e}"
        parser._close_p()
    title = None
    if parser.title is not None and parser.title_children == 0:
        title = "".join(parser.title)
    source = ""
    for s in parser.spans:
        if s.attrs.get("style") == SOURCE_STYLE:
            source = _strip_join(s.texts).replace(T.SOURCE_LABEL, "")
            break
    publish = ""
    period = ""
    readcount = ""
    pub_done = per_done = rc_done = False
    for s in parser.spans:
        st = _span_string(s)
        if st is None:
            continue
        if not pub_done and PUBLISH_RE.search(st):
            publish = "".join(s.texts)
            pub_done = True
        if not per_done and PERIOD_RE.search(st):
            period = _strip_join(s.texts).replace(T.PERIOD_LABEL, "")
            per_done = True
        if not rc_done and READCOUNT_RE.search(st):
            readcount = _strip_join(s.texts).replace(T.READCOUNT_LABEL, "")
            rc_done = True
    blocks = list(parser.paragraphs)
    blocks.extend("".join(t) for t in parser.text_content)
    if parser.content_div is not None:
        blocks.append("".join(parser.content_div))
    anchors = [{"href": h, "text": "".join(t)} for h, t in parser.anchors]
    return {
        "title": title,
        "source": source,
        "publish_raw": publish,
        "period": period,
        "readcount": readcount,
        "blocks": blocks,
        "anchors": anchors,
        "error": error,
    }


# Bytes of HTML, and pages, that are parsed at a time.
PARSE_BYTES, PARSE_PAGES = 2 << 20, 500
PARSED = ["title", "source", "publish_raw", "period", "readcount", "blocks", "anchors", "error"]
_PARSED_TYPES = pa.struct([(c, pa.string()) for c in PARSED[:5]] + [("blocks", pa.list_(pa.string())), ("anchors", pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))), ("error", pa.string())])


def _parse_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Python holds the pieces of a few pages at a time, however many a batch has."""
    for b in it:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column("html")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            n = max(min(int(np.searchsorted(ends, before + PARSE_BYTES, "right")) - at, PARSE_PAGES), 1)
            part = b.slice(at, n)
            parsed = pa.array([parse_html(h.as_py()) for h in part.column("html")], _PARSED_TYPES)
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), *parsed.flatten()], names=["page_id", "url", *PARSED])
            at += n
        del b
        pa.default_memory_pool().release_unused()


def parse_pages(pages: DataFrame) -> DataFrame:
    """The page job: ``(page_id, url, html)`` to raw pieces (``PARSED_SCHEMA``).
    Narrow: runs where the pages are, a few pages of an Arrow batch at a time."""
    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_parse_batches, PARSED_SCHEMA)


def to_records(parsed: DataFrame, suffixes: Iterable[str] = (), link_pattern: str | None = None) -> DataFrame:
    """Raw pieces to page records (built-in expressions only).

    ``editor``: the last block when it contains the editor mark, label and
    spaces removed; that block then leaves the content.  ``links``: hrefs
    matching ``link_pattern`` (all hrefs when None), duplicates kept.
    """
    blocks = F.coalesce(F.col("blocks"), F.array().cast("array<string>"))
    n = F.size(blocks)
    last = F.element_at(blocks, -1)
    has_editor = (n > 0) & F.coalesce(last.contains(T.EDITOR_MARK), F.lit(False))
    content_blocks = F.when(has_editor, F.slice(blocks, 1, n - 1)).otherwise(blocks)
    hrefs = F.transform(F.coalesce(F.col("anchors"), F.array()), lambda a: a["href"])
    links = hrefs if link_pattern is None else F.filter(hrefs, lambda h: h.rlike(link_pattern))
    return parsed.select(
        "page_id",
        "url",
        F.coalesce(F.col("title"), F.lit("")).alias("raw_title"),
        T.record_title(F.coalesce(F.col("title"), F.lit("")), suffixes).alias("title"),
        "source",
        T.parse_publish_time(T.last_after_colon(F.col("publish_raw"))).alias("publish_time"),
        F.when(has_editor, T.clean_editor(last)).otherwise(F.lit("")).alias("editor"),
        "period",
        "readcount",
        T.normalize_text(F.array_join(content_blocks, "")).alias("content"),
        links.alias("links"),
    )


def parse_errors(parsed: DataFrame) -> DataFrame:
    """``(error, n_pages)``: pages whose parse broke off, by error."""
    return parsed.filter("error is not null").groupBy("error").agg(F.count(F.lit(1)).alias("n_pages"))


RECORD_COLUMNS = ["url", "title", "source", "publish_time", "editor", "period", "readcount", "content", "links"]


def extract_pages(pages: DataFrame, suffixes: Iterable[str] = (), link_pattern: str | None = None) -> DataFrame:
    """``(page_id, url, raw_title, title, source, publish_time, editor,
    period, readcount, content, links)`` — one record per page."""
    return to_records(parse_pages(pages), suffixes, link_pattern)


# --- titles, keys, map and rejects ------------------------------------------

def title_url_map(pages_titles: DataFrame) -> DataFrame:
    """``(title_key, url)``: the crawl's title-to-url map, last crawl wins.
    Input ``(page_id, url, raw_title)``; pages without a title are skipped."""
    t = pages_titles.filter(F.col("raw_title") != "").select("page_id", "url", T.title_key("raw_title").alias("title_key"))
    return t.groupBy("title_key").agg(F.max_by("url", "page_id").alias("url"))


def join_title_url(records: DataFrame, title_map: DataFrame) -> DataFrame:
    """Records get their URL from the map by title key (inner join); a key
    present twice takes the row with the smallest ``seq``, if the map has one."""
    m = title_map
    if "seq" in m.columns:
        m = m.groupBy("title_key").agg(F.min_by("url", "seq").alias("url"))
    r = records.withColumn("title_key", T.title_key("raw_title")).drop("url")
    return r.join(m, "title_key")


def missing_titles(records: DataFrame, title_map: DataFrame) -> DataFrame:
    """Rejects ``(title, file)``: pages whose title key is not in the map."""
    r = records.select("page_id", T.title_key("raw_title").alias("title_key"))
    return r.join(title_map.select("title_key"), "title_key", "left_anti").select(
        F.col("title_key").alias("title"), F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".html")).alias("file")
    )


def clean_titles(pages_titles: DataFrame, suffixes: Iterable[str]) -> DataFrame:
    """File clean-up as a table: each page's file name (title key) loses the
    suffixes and is stripped; when two files map to one name only the first
    (by ``page_id``) is renamed and the others report ``collision``; names
    that are already clean report ``unchanged``.  A name taken by an existing
    clean file is a collision as well."""
    t = pages_titles.filter(F.col("raw_title") != "").select("page_id", T.title_key("raw_title").alias("name"))
    t = t.withColumn("new_name", T.py_strip(T.strip_all(F.col("name"), suffixes)))
    changed = (F.col("name") != F.col("new_name")).cast("int")
    # the file that keeps a name: an already clean one first, else the
    # lowest page id; an aggregate (partial per task), so a name shared by
    # very many pages never lands in one sort
    keeper = t.groupBy("new_name").agg(F.min_by("page_id", F.struct(changed.alias("c"), "page_id")).alias("keeper"))
    j = t.join(keeper, "new_name")
    first = F.col("page_id") == F.col("keeper")
    action = (
        F.when(F.col("name") == F.col("new_name"), F.when(first, "unchanged").otherwise("collision"))
        .when(first, "renamed")
        .otherwise("collision")
    )
    return j.select("page_id", "name", "new_name", action.alias("action"))


def snapshot_lookup(requests: DataFrame, pages_titles: DataFrame, pages: DataFrame) -> DataFrame:
    """Snapshot of a page by title: the raw HTML of the page whose snapshot
    key equals the request's, else the not-found message.  Last crawl wins
    when two pages share a key."""
    keyed = pages_titles.filter(F.col("raw_title") != "").select(
        "page_id", T.snapshot_key("raw_title").alias("skey")
    )
    latest = keyed.groupBy("skey").agg(F.max("page_id").alias("page_id")).join(pages.select("page_id", "html"), "page_id")
    req = requests.select("request_id", T.snapshot_key("title").alias("skey"))
    out = req.join(latest, "skey", "left")
    return out.select(
        "request_id",
        F.col("page_id"),
        F.when(F.col("page_id").isNull(), F.lit("not found")).otherwise(F.lit("ok")).alias("status"),
        F.col("html").alias("snapshot"),
    )
