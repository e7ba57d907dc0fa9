"""WARC derivatives against a plain version over all pages, and pages made to be slow or wrong."""

from __future__ import annotations

import hashlib
import html
import re
import time
import uuid
from urllib.parse import urljoin

import pytest

from payguard.llm import warc

# the plain version: one pattern after the other over the whole page, for pages that are well formed
UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
BREAKS = re.compile(r"</?(?:p|div|br|hr|h[1-6]|li|ul|ol|tr|table|section|article|nav|header|footer|blockquote|pre|form|body|html)\b[^>]*>", re.I)
TAG = re.compile(r"</?[a-zA-Z!?][^>]*>")


def plain_text(page):
    text = TAG.sub("", BREAKS.sub("\n", UNSEEN.sub(" ", page.replace("\n", " "))))
    return re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\r\f\v\xa0]+", " ", html.unescape(text))).strip()


def plain_metadata(page, target, text):
    one_line = lambda s: " ".join(html.unescape(s).split())
    seen = UNSEEN.sub(lambda m: m[0] if m[1] and m[1].lower() == "title" else " ", page)
    title = re.search(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", seen, re.S | re.I)
    lang = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", seen, re.I)
    out = [f"title: {one_line(title[1])}"] if title else []
    out += [f"language: {lang[1]}"] if lang else []
    links = []
    for m in re.finditer(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", seen, re.I):
        link = urljoin(target or "", one_line(next(x for x in (*m.groups(), "") if x is not None)))
        if link and link not in links:
            links.append(link)
    out += [f"outlink: {x}" for x in links]
    out.append("text-digest: sha256:" + hashlib.sha256(text.encode()).hexdigest())
    return "".join(x + "\r\n" for x in out)


def plain_records(page_id, url, page):
    page = page or ""
    name = f"response {'' if page_id is None else page_id} {hashlib.sha256(page.encode()).hexdigest()} {url or ''}"
    sha = hashlib.sha1(name.encode()).hexdigest()
    of = f"<urn:uuid:{sha[:8]}-{sha[8:12]}-5{sha[13:16]}-a{sha[17:20]}-{sha[20:32]}>"
    ids = {t: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, t + ' ' + of)}>" for t in ("metadata", "conversion")}
    text = plain_text(page)
    blocks = {"metadata": plain_metadata(page, url or None, text), "conversion": text}
    sha256 = lambda s: "sha256:" + hashlib.sha256(s.encode()).hexdigest()
    for t, other in (("metadata", "conversion"), ("conversion", "metadata")):
        yield (page_id, ids[t], t, of, ids[other], url or None, "1970-01-01T00:00:00Z",
               "application/warc-fields" if t == "metadata" else "text/plain", len(blocks[t].encode()), sha256(blocks[t]), sha256(page),
               f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page.encode())}\r\n\r\n", blocks[t])


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_all_pages_equal_the_plain_version(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()
    want = sorted((r for p in pages for r in plain_records(*p)), key=repr)
    assert got(warc.op5_warc_derivatives(spark, sf)) == want


def test_ids_nulls_repeats_and_clashing_columns(spark):
    page = "<html lang=de><title>A &amp; B</title><a href='x'>y</a><p>one</p><!-- no --><p>two</html>"
    rows = [(2**60 + 1, "http://a/b", page), (None, "http://a/b", page), (None, None, None), (2**60 + 1, "http://a/b", "other"),
            (3, None, ""), (3, "http://a/b", page), (3, "http://a/b", page), (-5, "http://[bad", "<a href='c'>d</a>")]
    df = spark.createDataFrame([(*r, "t", "d", 1, "k") for r in rows],
                               "page_id long, url string, html string, record_type string, date string, block int, k string")
    out = warc.derive(warc.responses(df))
    want = []
    for r in rows[:-1]:
        want += plain_records(*r)
    mine = [r for r in got(out) if r[0] != -5]
    assert mine == sorted(want, key=repr)
    # the same id and URL with another payload is another response, and so are its records
    ids = {(r["refers_to"], r["payload_digest"]) for r in out.collect()}
    assert len({a for a, _ in ids}) == len(ids)
    bad = [r for r in out.collect() if r["page_id"] == -5 and r["record_type"] == "metadata"]
    assert "outlink: c" in bad[0]["block"]
    assert warc.derive(warc.responses(df.limit(0))).collect() == []


def test_keys_of_another_type(spark):
    df = spark.createDataFrame([("x", "i1", "http://a", "d", "h", "<p>t")], "name string, record_id string, target_uri string, date string, http_headers string, payload string")
    out = warc.derive(df, "name").collect()
    assert [r["name"] for r in out] == ["x", "x"] and out[1]["block"] == "t"


SLOW = ["<a", "<html ", "<a href=", "<!--", "<!-", "<script", "</script", "<title>", "<title ", "<p", "< ", "<a href='", "<html lang", "&", "&#", "<a href=\"x", "<b\n", "<style></styl", "<a href    ", "\n", " "]


@pytest.mark.parametrize("part", SLOW)
def test_a_megabyte_of_open_tags(part):
    page = part * (1_000_000 // len(part))
    start = time.process_time()
    text = warc.plain_text(page)
    warc.metadata(page, "http://a/b", text)
    assert time.process_time() - start < 2


def test_malformed_pages_have_a_defined_text():
    cases = {
        "a < b": "a < b", "a <": "a <", "a <b": "a <b", "x<p": "x<p", "a<!-- b": "a", "a<script>b": "a", "<p>a<p>b": "a\nb",
        "a<>b": "a<>b", "a</>b": "a</>b", "a<1>b": "a<1>b", "<title>t</title>a": "a", "a<br/>b": "a\nb", "a<b>c</b>d": "acd",
        "a<title>b": "a", "x</title>y": "xy", "a<!doctype html>b": "ab", "<pre>a</pre>b": "a\nb", "<presto>a": "a",
    }
    assert {k: warc.plain_text(k) for k in cases} == cases
