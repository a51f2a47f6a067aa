"""WARC derivatives: response records into linked metadata and plain-text conversion records.

A response has a record id, a target URI, a date, its HTTP header and its payload.  Of each, two records are derived:

* ``metadata`` (application/warc-fields): title, language, number of links and of characters, the payload's digest, and
  the whole HTTP header: ``http-status-line`` and a field ``http-<name>`` for each line, in order, repeats included;
* ``conversion`` (text/plain): the payload as text.

Both carry WARC-Refers-To (the response's id), WARC-Target-URI and WARC-Date of the response, WARC-Block-Digest
(SHA-1, base 32) and WARC-Payload-Digest of the response's payload; the metadata record also names the conversion by
WARC-Concurrent-To.  Ids are name-based (SHA-1 of the response's id and the type), so a job run again makes the same records.

``write`` lets Spark's text writer put records, ended by two line ends, into WARC files; blocks hold no such pair of line ends, so ``read`` can split the
files.  ``read_files`` reads any WARC file by the lengths of its records, and ``http_responses`` makes its responses ready for ``derive``.

Defined results: a null or empty payload gives an empty conversion block and the metadata of an empty text; a null URI is the empty
one; repeated responses give repeated records; an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_batch

VERSION, END = "WARC/1.1", "\r\n"

_SKIP = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|$)|<!\[CDATA\[|\]\]>|<![^>]*>", re.S | re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|<|$)", re.S | re.I)
_BLOCK = re.compile(r"</?(?:p|div|br|li|ul|ol|dl|dt|dd|tr|table|h[1-6]|section|article|header|footer|nav|aside|main|form|blockquote|pre|hr|figure|body|head|title)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-z][^>]*>", re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(refers_to: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}#{kind}')}>"


def plain_text(page: str) -> str:
    """A page as text: markup dropped, references decoded, a line for each block."""
    blocks = _BLOCK.split(_SKIP.sub(" ", page))
    lines = (" ".join(html.unescape(_TAG.sub("", x)).split()) for x in blocks)
    return "\n".join(x for x in lines if x)


def _fields(header: dict[str, str]) -> str:
    return END.join(f"{k}: {' '.join(v.split())}" for k, v in header.items())


def http_fields(http: str) -> list[str]:
    """A field for each line of an HTTP header; folded lines are joined by a space, those without a name are ``http-line``."""
    out: list[str] = []
    for i, line in enumerate(re.split(r"\r\n|\r|\n", http)):
        name, colon, value = line.partition(":")
        if not line.strip():
            continue
        if i == 0 and line.startswith("HTTP/"):
            out.append(f"http-status-line: {line.strip()}")
        elif out and line[0] in " \t":
            out[-1] += f" {line.strip()}"
        elif colon and name.strip():
            out.append(f"http-{name.strip().lower()}: {value.strip()}")
        else:
            out.append(f"http-line: {line.strip()}")
    return out


def derive_one(record: str, uri: str, date: str, http: str, payload: str) -> list[tuple]:
    """(type, id, refers_to, header, block, block_digest) of the two records."""
    data = payload.encode("utf-8", "replace")
    of_payload = digest(data)
    text = plain_text(payload)
    lang, title = _LANG.search(payload), _TITLE.search(payload)
    fields = {
        "title": html.unescape(title[1]) if title else "", "language": lang[1] if lang else "", "links": str(len(_LINK.findall(payload))),
        "characters": str(len(text)), "payload-digest": of_payload,
    }
    about = END.join([_fields(fields), *http_fields(http)])
    out = []
    for kind, mime, block in (("metadata", "application/warc-fields", about), ("conversion", "text/plain; charset=utf-8", text)):
        raw = block.encode("utf-8", "replace")
        own = record_id(record, kind)
        header = {
            "WARC-Type": kind, "WARC-Record-ID": own, "WARC-Refers-To": record, "WARC-Target-URI": uri, "WARC-Date": date,
            "WARC-Block-Digest": digest(raw), "WARC-Payload-Digest": of_payload,
        }
        if kind == "metadata":
            header["WARC-Concurrent-To"] = record_id(record, "conversion")
        header |= {"Content-Type": mime, "Content-Length": str(len(raw))}
        out.append((kind, own, f"{VERSION}{END}{_fields(header)}", block, header["WARC-Block-Digest"], of_payload, len(raw)))
    return out


_OUT = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
    ("header", pa.string()), ("block", pa.string()), ("block_digest", pa.string()), ("payload_digest", pa.string()), ("content_length", pa.int64()),
])
_DDL = "page_id long, url string, warc_type string, record_id string, refers_to string, header string, block string, block_digest string, payload_digest string, content_length long"


def derive(responses: DataFrame) -> DataFrame:
    """Two records for each response (page_id, record_id, url, date, http, payload)."""

    def make():
        def fn(c):
            cols: list[list] = [[] for _ in _OUT]
            for page, record, url, date, http, payload in zip(*(c[k] for k in ("page_id", "record_id", "url", "date", "http", "payload"))):
                for kind, own, header, block, of_block, of_payload, n in derive_one(record or "", url or "", date or "", http or "", payload or ""):
                    for col, v in zip(cols, (page, url, kind, own, record, header, block, of_block, of_payload, n)):
                        col.append(v)
            return dict(zip(_OUT.names, cols))

        return fn

    return responses.select("page_id", "record_id", "url", "date", "http", "payload").mapInArrow(by_batch(make, _OUT, 256), _DDL)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as responses: an id named by the page and its payload, and the header such a page is served with.

    The table holds neither a date nor an HTTP header: ``date`` and the three header lines are made up here.  Pages with the same id and address
    but other payloads have ids of their own; rows equal in all three are one record.
    """
    named = (F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("")), F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    digest_ = F.sha1(F.concat_ws("\n", F.lit("response"), *named))
    name = F.concat_ws("-", *[F.substring(digest_, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(F.coalesce("html", F.lit(""))), F.lit("\r\n"))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.concat(F.lit("<urn:uuid:"), name, F.lit(">")).alias("record_id"), "url",
        F.lit(date).alias("date"), http.alias("http"), F.col("html").alias("payload"),
    )


def write(records: DataFrame, path: str, **options) -> None:
    """Records as WARC files, one for each task."""
    records.select(F.concat("header", F.lit(END * 2), "block").alias("value")).write.option("lineSep", END * 2).options(**options).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(header, block) of WARC files written by ``write``.  A header and its block are neighbours in one file."""
    parts = spark.read.option("lineSep", END * 2).text(path).select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    order = Window.partitionBy("file").orderBy("at")
    headed = parts.withColumns({"block": F.lead("value").over(order), "place": F.row_number().over(order)})
    return headed.where("place % 2 = 1").select(F.col("value").alias("header"), F.coalesce("block", F.lit("")).alias("block"))


_RECORDS = pa.schema([("header", pa.string()), ("block", pa.binary())])


def _records(data: bytes):
    """(header, block) of the records in the bytes of a WARC file; a block ends where its Content-Length says."""
    end, at = END.encode(), 0
    while True:
        while data[at : at + len(end)] == end:
            at += len(end)
        close = data.find(end * 2, at)
        if close < 0:
            return
        header = data[at:close].decode("utf-8", "replace")
        size = next((int(v) for k, _, v in (line.partition(":") for line in header.split(END)[1:]) if k.strip().lower() == "content-length"), 0)
        start = close + 2 * len(end)
        yield header, data[start : start + size]
        at = start + size


def _members(data: bytes):
    """The bytes of a file, or of each member of a gzip file, one after the other."""
    while data[:2] == b"\x1f\x8b":
        one = zlib.decompressobj(31)
        yield one.decompress(data) + one.flush()
        data = one.unused_data
    if data:
        yield data


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(header, block) of the records in real WARC files, plain or with a gzip member for each record.

    Blocks may hold anything, blank lines too: their length is read from the header.  A task reads a whole file, as a gzip file can't be cut; WARC
    files are about 1 GB by convention.
    """

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                for part in _members(content.as_buffer().to_pybytes()):
                    for header, block in _records(part):
                        yield pa.RecordBatch.from_arrays([pa.array([header]), pa.array([block], pa.binary())], schema=_RECORDS)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "header string, block binary")


def http_responses(records: DataFrame) -> DataFrame:
    """The response records of ``read_files`` in the columns that ``derive`` takes: the HTTP header apart from the payload.

    Payloads are taken as UTF-8, with U+FFFD for what is none; page_id is null.
    """

    def field(name: str):
        return F.regexp_extract("header", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)

    text = F.make_valid_utf8(F.col("block").cast("string"))
    apart = F.instr(text, END * 2)
    whole = F.length(text)
    return records.where(field("WARC-Type") == "response").select(
        F.lit(None).cast("long").alias("page_id"), field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("url"), field("WARC-Date").alias("date"),
        F.when(apart > 0, F.substring(text, F.lit(1), apart + 1)).otherwise(text).alias("http"),
        F.when(apart > 0, F.substring(text, apart + 4, whole)).otherwise(F.lit("")).alias("payload"),
    )
