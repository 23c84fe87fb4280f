"""Derived WARC records: metadata and plain text of responses, linked to them.

For each response, a ``metadata`` record (title, language, links, digests) and a
``conversion`` record (the text without markup) are built. Both name the response's
``WARC-Record-ID`` in ``WARC-Refers-To``, repeat its target URI and date, and carry
digests of their own blocks; the source's digest is a field of its own. Record ids are UUIDs
of version 5 made from the source's id, so building again gives the same records. Headers of
the source, pairs that may repeat a name, are carried as ``Source-<name>`` in the metadata
block in their order; so is a digest that was stored with it.

Markup is read in time in proportion to the page, also where comments, scripts or tags are
never closed. An opening without its end is text, a tag without one stays. Very long pages are
worked on whole, one at a time. A null body is an empty one. A null URI is left out of the
headers, like null headers; a line break in a header is a space. Rows without a record id are left
out. Repeated rows give equal records. An empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of RFC 4122, for URLs
RESPONSES = "record_id string, url string, date timestamp, headers array<struct<name:string,value:string>>, body binary"

_OPENING = re.compile(r"<!--|<(script|style|noscript|template)\b", re.I)
_CLOSING = {kind: re.compile(rf"</{kind}\s*>", re.I) for kind in ("script", "style", "noscript", "template")}
_COMMENT_END = re.compile("-->")
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|title|blockquote|pre)\b[^>]*>", re.I)
_TAG = re.compile(r"<[^>]*>")
_TITLE, _TITLE_END = re.compile(r"<title[^>]*>", re.I), re.compile(r"</title\s*>", re.I)
_HTML, _LANG = re.compile(r"<html[^>]*", re.I), re.compile(r"\blang=[\"']?([A-Za-z-]+)", re.I)
_ANCHOR, _HREF = re.compile(r"<a\b[^>]*", re.I), re.compile(r"\bhref=[\"']", re.I)
_VALUE = re.compile(r"[^\"']*")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '/'.join(parts))}>"


def _shown(page: str) -> str:
    """The page with a space for each comment, script, style, template and part for browsers without scripts."""
    out, at, endless = [], 0, set()
    for opening in _OPENING.finditer(page):
        kind = (opening[1] or "").lower()
        if opening.start() < at or kind in endless:
            continue
        begin = page.find(">", opening.end()) + 1 if kind else opening.end()
        end = (_CLOSING[kind] if kind else _COMMENT_END).search(page, begin) if begin else None
        if end is None:
            endless.add(kind)  # what has no end from here on has none later either
            continue
        out += [page[at : opening.start()], " "]
        at = end.end()
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """Visible text, one line per block element."""
    shown = _shown(page)
    cut = shown.rfind(">") + 1  # before it every tag has an end
    bare = _TAG.sub("", _BREAK.sub("\n", shown[:cut])) + shown[cut:]
    lines = (" ".join(x.split()) for x in html.unescape(bare).split("\n"))
    return "\n".join(x for x in lines if x)


def title_of(page: str) -> str | None:
    opening = _TITLE.search(page, 0, page.rfind(">") + 1)
    end = opening and _TITLE_END.search(page, opening.end())
    return " ".join(html.unescape(page[opening.end() : end.start()]).split()) if end else None


def language_of(page: str) -> str | None:
    found = (_LANG.search(page, *tag.span()) for tag in _HTML.finditer(page))
    return next((m[1].lower() for m in found if m), None)


def links_of(page: str) -> list[str]:
    """The first ``href`` of each anchor; what stands inside a value begins no anchor."""
    found, at = [], 0
    for tag in _ANCHOR.finditer(page):
        link = _HREF.search(page, *tag.span()) if tag.start() >= at else None
        if link:
            value = _VALUE.match(page, link.end())
            found.append(value[0])
            at = value.end()
    return found


def _one_line(value: str) -> str:
    return " ".join(x.strip() for x in value.splitlines()).strip()


def serialised(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as in a WARC/1.1 file."""
    named = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in named if v is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in the bytes of a file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        size = int(headers["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError(f"the record at byte {at} is cut short")
        yield headers, block
        at = end + 4 + size + 4


def derived(source: str, url: str | None, date: datetime | None, headers: Iterable[tuple[str, str | None]], body: bytes) -> tuple[bytes, bytes]:
    """The metadata and the conversion record of a response. ``headers`` are pairs."""
    page = body.decode("utf-8", "replace")
    text = plain_text(page).encode()
    payload = digest(body)
    when = None
    if date is not None:
        when = (date if date.tzinfo else date.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    converted = record_id(source, "conversion")
    facts = [
        ("title", title_of(page)),
        ("language", language_of(page)),
        ("outlinks", json.dumps(links_of(page), ensure_ascii=False)),
        ("source-payload-digest", payload),
        ("source-length", str(len(body))),
        ("conversion-id", converted),
        *((f"Source-{_one_line(k)}", v) for k, v in headers),
    ]
    fields = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in facts if v is not None).encode()
    common_headers = [("WARC-Target-URI", url), ("WARC-Date", when), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", when)]
    metadata = serialised(
        "metadata",
        [("WARC-Record-ID", record_id(source, "metadata")), *common_headers, ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", digest(fields))],
        fields,
    )
    conversion = serialised(
        "conversion",
        [("WARC-Record-ID", converted), *common_headers, ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Block-Digest", digest(text)), ("WARC-Payload-Digest", digest(text)), ("Source-Payload-Digest", payload)],
        text,
    )
    return metadata, conversion


def _pairs(headers: list | None) -> list[tuple[str, str | None]]:
    """Name and value of headers that have a name."""
    return [(h["name"], h["value"]) for h in headers or () if h and h["name"]]


RECORDS = pa.schema([("record_id", pa.string()), ("url", pa.string()), ("metadata", pa.binary()), ("conversion", pa.binary())])


def derive(responses: DataFrame) -> DataFrame:
    """Both records of each response, as bytes. ``responses`` has the columns of ``RESPONSES``."""

    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                out = []
                for source, url, date, headers, body in common.rows([piece], "record_id", "url", "date", "headers", "body"):
                    out.append((source, url, *derived(source, url, date, _pairs(headers), body or b"")))
                yield common.batch_of(RECORDS, list(zip(*out)))

    rows = responses.select("record_id", "url", "date", "headers", "body").where("record_id is not null")
    return rows.mapInArrow(work, "record_id string, url string, metadata binary, conversion binary")


def headers(*pairs: tuple[str, Column]) -> Column:
    """Headers of a response from names and columns, in order."""
    made = F.array(*(F.struct(F.lit(name).alias("name"), value.cast("string").alias("value")) for name, value in pairs))
    return made.cast("array<struct<name:string,value:string>>")


def responses_of(pages: DataFrame, key: str, url: str, body: str, date: Column, headers: Column) -> DataFrame:
    """Pages of a table as responses with ids made from their key."""
    identity = F.concat_ws("/", F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(key).cast("string"), F.lit("")))
    hexed = F.sha1(identity)
    made = F.concat(
        F.lit("<urn:uuid:"), F.substring(hexed, 1, 8), F.lit("-"), F.substring(hexed, 9, 4), F.lit("-5"), F.substring(hexed, 14, 3),
        F.lit("-8"), F.substring(hexed, 18, 3), F.lit("-"), F.substring(hexed, 21, 12), F.lit(">"),
    )
    return pages.select(
        made.alias("record_id"), F.col(url).alias("url"), date.alias("date"), headers.alias("headers"),
        F.coalesce(F.col(body), F.lit("")).cast("binary").alias("body"), F.col(key).alias("key"),
    )


def read_back(records: DataFrame) -> DataFrame:
    """What the records' own bytes say: ids, links, digests and sizes, with both digests checked."""
    names = ["record_id", "url", "metadata_id", "conversion_id", "refers_to", "source_digest", "text_digest", "title", "language"]
    schema = pa.schema([(n, pa.string()) for n in names] + [("outlinks", pa.int64()), ("text_length", pa.int64()), ("linked", pa.bool_())])

    def work(batches):
        for piece in batches:
            out = []
            for source, url, one, other in common.rows([piece], "record_id", "url", "metadata", "conversion"):
                (head, fields), = parsed(one)
                (text_head, text), = parsed(other)
                facts = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in fields.decode().split("\r\n") if x)
                linked = (
                    head["WARC-Refers-To"] == text_head["WARC-Refers-To"] == source
                    and facts["conversion-id"] == text_head["WARC-Record-ID"]
                    and head["WARC-Block-Digest"] == digest(fields)
                    and text_head["WARC-Block-Digest"] == digest(text)
                    and text_head["WARC-Payload-Digest"] == digest(text)
                    and text_head["Source-Payload-Digest"] == facts["source-payload-digest"]
                )
                out.append((
                    source, url, head["WARC-Record-ID"], text_head["WARC-Record-ID"], head["WARC-Refers-To"], text_head["Source-Payload-Digest"],
                    text_head["WARC-Block-Digest"], facts.get("title"), facts.get("language"), len(json.loads(facts["outlinks"])), len(text), linked,
                ))
            yield common.batch_of(schema, list(zip(*out)) if out else [[] for _ in schema])

    fields = ", ".join(f"{n} string" for n in names) + ", outlinks long, text_length long, linked boolean"
    return records.mapInArrow(work, fields)


def write_files(records: DataFrame, folder: str, filesystem=None) -> None:
    """Write the records as gzip WARC files, one per partition, each record a member of its own.

    A file is written under a name of its attempt and renamed, so a repeated task
    leaves one whole file. ``folder`` is a URI that pyarrow can write to.
    """

    def work(batches: Iterable[pa.RecordBatch]):
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = (filesystem, folder) if filesystem else fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"{root}/derived-{task.partitionId():06d}.warc.gz"
        attempt = f"{name}.{task.taskAttemptId()}"
        store.create_dir(root, recursive=True)
        n = 0
        with store.open_output_stream(attempt, compression=None) as out:
            for one, other in common.rows(batches, "metadata", "conversion"):
                out.write(gzip.compress(one, mtime=0))
                out.write(gzip.compress(other, mtime=0))
                n += 2
        store.move(attempt, name)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["records"])

    records.mapInArrow(work, "records long").agg(F.sum("records")).collect()
