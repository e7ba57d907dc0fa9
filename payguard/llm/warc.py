"""WARC derivatives: each response gives a metadata record and a plain-text conversion record.

Both are linked to the response by ``WARC-Refers-To`` and to each other by
``WARC-Concurrent-To``, and carry on the response's target, date and payload digest. A page is
turned in one pass where it lies; nothing is shuffled. ``write`` saves records as WARC files.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
VERSION = "WARC/1.1"
TEXT_TYPE, FIELDS_TYPE = "text/plain", "application/warc-fields"
HIDDEN = ("script", "style", "noscript", "template", "title")
BREAKS = ("p div br hr h1 h2 h3 h4 h5 h6 li ul ol tr table section article nav header footer blockquote pre form body html").split()

_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9]*)?")
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN}
_GAPS = re.compile(r"[ \t\r\f\v\xa0]+")
_LINES = re.compile(r" ?\n[ \n]*")
_LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

SCHEMA = ("record_id string, record_type string, refers_to string, concurrent_to string, target_uri string, date string, "
          "content_type string, content_length long, block_digest string, payload_digest string, source_headers string, block string")


ROWS = 256  # pages turned before their records are handed on


def digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def record_id(kind: str, of: str) -> str:
    """An identifier that depends on the record's kind and source alone, so reruns agree."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, kind + ' ' + of)}>"


@dataclass
class Page:
    """What one walk over a page finds: text as it lies, title, language and links as they are written."""

    text: list[str] = field(default_factory=list)
    title: str | None = None
    lang: str | None = None
    links: list[str] = field(default_factory=list)


def read_page(page: str) -> Page:
    """One walk from the front: every search starts where the last one ended, and a search that finds
    nothing is the last of its kind, so the time is in proportion to the page, whatever it holds.

    A tag goes from ``<`` and a letter, ``/``, ``!`` or ``?`` to the next ``>``; without one, what is left is text. A comment
    or hidden element without an end hides the rest.
    """
    out, at = Page(), 0
    while True:
        start = page.find("<", at)
        if start < 0 or start + 1 == len(page):
            out.text.append(page[at:])
            return out
        out.text.append(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            out.text.append(" ")
            if end < 0:
                return out
            at = end + 3
            continue
        following = page[start + 1]
        slash = following == "/"
        mark = page[start + 2 : start + 3] if slash else following
        if not (mark.isascii() and mark.isalpha() or mark in ("!", "?") and mark):
            out.text.append("<")
            at = start + 1
            continue
        found = _NAME.match(page, start + 1)
        name = (found[1] or "").lower()
        close = page.find(">", start)
        if name in HIDDEN and not slash:
            end = _ENDS[name].search(page, found.end())
            if name == "title" and out.title is None and 0 <= close:
                out.title = page[close + 1 : end.start() if end else len(page)]
            out.text.append(" ")
            if end is None:
                return out
            at = end.end()
            continue
        if close < 0:
            out.text.append(page[start:])
            return out
        if name in _BREAKING:
            out.text.append("\n")
        if not slash and name == "html" and out.lang is None:
            lang = _LANG.search(page, found.end(), close)
            out.lang = lang[1] if lang else None
        elif not slash and name == "a":
            link = _LINK.search(page, found.end(), close)
            if link:
                out.links.append(next(x for x in (*link.groups(), "") if x is not None))
        at = close + 1


_BREAKING = frozenset(BREAKS)


def plain_text(page: str) -> str:
    """What a reader sees: no comments, scripts or tags, entities resolved, one line a block."""
    return _shown(read_page(page.replace("\n", " ")))


def _shown(found: Page) -> str:
    return _LINES.sub("\n", _GAPS.sub(" ", html.unescape("".join(found.text)))).strip()


def metadata(page: str, target: str | None, text: str) -> str:
    """Fields of the metadata record: title, language, links in order (first of equal ones), text digest."""
    return _fields(read_page(page), target, text)


def _fields(found: Page, target: str | None, text: str) -> str:
    one_line = lambda s: " ".join(html.unescape(s).split())
    fields = [f"title: {one_line(found.title)}"] if found.title is not None else []
    fields += [f"language: {found.lang}"] if found.lang else []
    links = []
    for link in map(one_line, found.links):
        try:
            links.append(urljoin(target or "", link))
        except ValueError:  # not a URL
            links.append(link)
    fields += [f"outlink: {x}" for x in dict.fromkeys(links) if x]
    return "".join(f"{x}\r\n" for x in [*fields, f"text-digest: {digest(text.encode())}"])


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages as response records: ``page_id, record_id, target_uri, date, http_headers, payload``.
    The record id follows from page id, URL and payload, so that it differs where any of them does. A null
    page is an empty payload."""
    content = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    named = F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), content, F.coalesce("url", F.lit("")))
    sha = F.sha1(F.concat(F.lit("response "), named).cast("binary"))
    part = lambda a, n: F.substring(sha, a, n)
    uid = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))
    payload = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return pages.select("page_id", uid.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
                        head.alias("http_headers"), payload.alias("payload"))


def derive(responses: DataFrame, key: str = "page_id") -> DataFrame:
    """Two rows a response: its metadata and its conversion record, with ``key`` carried along.

    Needs ``record_id, target_uri, date, http_headers, payload``; other columns are ignored.
    Empty or null payloads give an empty conversion block and a metadata block that says so;
    a null target leaves out the header and links stay relative. The key is carried as it is, whatever its type, a null one
    as null. Equal responses give equal records. An empty table gives an empty result.
    """
    kind = responses.schema[key].dataType.simpleString()
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = {"content_length": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                rows: dict[str, list] = {n: [] for n in names}
                for of, target, date, head, page in zip(*(batch[c].to_pylist() for c in batch.schema.names[1:]), strict=True):
                    page, of, target = page or "", of or "", target or None
                    text = plain_text(page)
                    ids = {t: record_id(t, of) for t in ("metadata", "conversion")}
                    source = digest(page.encode())
                    for t, other, mime, block in (("metadata", "conversion", FIELDS_TYPE, metadata(page, target, text)), ("conversion", "metadata", TEXT_TYPE, text)):
                        data = block.encode()
                        record = (ids[t], t, of, ids[other], target, date, mime, len(data), digest(data), source, head, block)
                        for n, value in zip(names, record, strict=True):
                            rows[n].append(value)
                twice = batch["k"].take(pa.array([i for i in range(batch.num_rows) for _ in range(2)], pa.int64()))
                yield pa.RecordBatch.from_arrays([twice, *(pa.array(rows[n], types.get(n, pa.string())) for n in names)], [key, *names])

    columns = [F.col(key).alias("k"), "record_id", "target_uri", "date", "http_headers", "payload"]
    return responses.select(*columns).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")


def write(records: DataFrame, path: str) -> None:
    """Records as WARC files, one a task. The source's HTTP headers go into a header of their own."""
    line = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit("\r\n"))).otherwise("")
    head = F.concat(
        F.lit(f"{VERSION}\r\n"), line("WARC-Type", "record_type"), line("WARC-Record-ID", "record_id"),
        line("WARC-Refers-To", "refers_to"), line("WARC-Concurrent-To", "concurrent_to"), line("WARC-Target-URI", "target_uri"),
        line("WARC-Date", "date"), line("Content-Type", "content_type"), line("WARC-Block-Digest", "block_digest"),
        line("X-Source-Payload-Digest", "payload_digest"), line("X-Source-HTTP-Headers", "h"), line("Content-Length", "content_length"))
    records.withColumn("h", F.regexp_replace(F.trim("source_headers"), r"[\r\n]+", " | ")).select(F.concat(head, F.lit("\r\n"), F.col("block")).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
