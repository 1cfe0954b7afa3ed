"""WARC archives without repeated payloads: written by Spark's text writer, read back by a small parser.

Equal payloads are found by their headers alone: digest, size and page are shuffled, payloads are not. Of each group
one record keeps its payload as a ``response``; the others become ``revisit`` records that name it. Archives are WARC/1.1,
gzipped as a whole by default: records end in CR LF CR LF, which is the text writer's line separator here. Every record
gets fresh headers: an id from its page and digest, the date of the run, lengths of its own.
"""

from __future__ import annotations

import datetime
import hashlib
import io
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.llm.common import as_text, pick, stored, table
from tidecast.session import shared_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads under so many bytes are always written.
LEAST = 1000
#: A file has at most so many records, so that a reader's task stays small.
FILE_RECORDS = 20_000
#: Parts of the headers of rows that are alike in all that counts.
SALTS = 64


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page, url, payload, bytes, digest and ``key``, the same for rows with the same page, address and payload."""
    rows = pick(pages, page=id_col, url=url_col, payload=html_col)
    rows = rows.select(F.col("page").cast("long").alias("page"), F.col("url").cast("string").alias("url"), as_text(F.col("payload")).alias("payload"))
    raw = F.encode("payload", "UTF-8")
    size = lambda c: F.coalesce(F.concat(F.octet_length(c), F.lit(":"), c), F.lit("-"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1(raw), "also": F.xxhash64("payload")})
    return rows.withColumn("key", F.sha1(F.concat(size(F.col("page").cast("string")), size(F.col("url")), F.col("digest"), F.col("also").cast("string")).cast("binary")))


def _urn(*cols):
    """A record id (a UUID of the kind that leaves its bits to the maker) from columns that name the record."""
    x = F.sha1(F.concat_ws("/", *[c.cast("string") for c in cols]).cast("binary"))
    part = lambda a, n: F.substring(x, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _header(name: str, value):
    """One header line; none for null. Line ends within a value can't start a header of their own."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def _record(kind: str, urn, date: str, more, payload):
    """A whole record but its closing CR LF CR LF: WARC headers, then an HTTP response, with its payload or without."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), _header("Content-Length", F.col("bytes")), F.lit(CRLF))
    block = [http] if payload is None else [http, payload]
    size = F.octet_length(http) if payload is None else F.octet_length(http) + F.col("bytes")
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", F.lit(kind)), _header("WARC-Record-ID", urn), _header("WARC-Date", F.lit(date)),
                    _header("WARC-Target-URI", F.col("url")), _header("WARC-Page-ID", F.col("page")),
                    _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), *more,
                    F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"), _header("Content-Length", size), F.lit(CRLF), *block)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least: int = LEAST, date: str | None = None, compression: str = "gzip") -> None:
    """Write a WARC record for every row of ``pages`` to archives at ``path``.

    Of the records whose payloads are equal and have ``least`` bytes or more, the one with the largest page id is a
    response and the others are revisits of it; all others are responses. Among rows that share that page id the one
    with the smallest address is taken (null last), among rows that are alike any. A null payload counts as empty, a null page id
    is smaller than any, null ids and addresses get no header. Rows repeat as they do in the input, other columns are
    not read, an empty table gives no records. Very long payloads are written whole.

    Only payloads of responses are shuffled, by page, which no group of copies makes uneven; groups are resolved by
    digest with partial aggregation, and joined back by a sort-merge join that Spark can split.
    """
    spark = pages.sparkSession
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = _pages(pages, id_col, url_col, html_col)
    small, large = rows.filter(F.col("bytes") < least), rows.filter(F.col("bytes") >= least)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt")
    heads = large.select("digest", "also", "bytes", "page", "url", "key", salt).groupBy("digest", "also", "bytes", "page", "url", "key", "salt").agg(F.count("*").alias("n"))
    heads = stored(heads, "warc-headers")
    first = Window.partitionBy("digest", "also", "bytes").orderBy(F.col("page").desc_nulls_last(), F.col("url").asc_nulls_last(), "salt")
    chosen = heads.withColumn("_at", F.row_number().over(first)).filter("_at = 1").drop("_at", "n")
    target = _urn(F.col("key"), F.col("digest"), F.lit("response"))
    chosen = stored(chosen.withColumn("urn", target), "warc-responses")

    plain = small.select(_record("response", _urn(F.col("key"), F.lit("small"), F.monotonically_increasing_id()), date, [], F.col("payload")).alias("value"))

    # a key that several rows share (an address and payload that repeat under one page id) is written once
    alike = heads.groupBy("key").agg(F.sum("n").alias("rows"))
    wanted = chosen.select("key", "urn").join(alike, "key")
    met = large.join(wanted, "key")
    single = met.filter("rows = 1").select("key", "urn", "page", "url", "payload", "bytes", "digest")
    merged = met.filter("rows > 1").select(*single.columns).dropDuplicates(["key"])
    kept = single.union(merged).select(_record("response", F.col("urn"), date, [], F.col("payload")).alias("value"))

    to = chosen.select("digest", "also", "bytes", F.col("key").alias("to_key"), F.col("salt").alias("to_salt"), F.col("urn").alias("to"), F.col("url").alias("to_url"))
    copies = F.col("n") - F.when((F.col("key") == F.col("to_key")) & (F.col("salt") == F.col("to_salt")), 1).otherwise(0)
    again = heads.join(to, ["digest", "also", "bytes"]).withColumn("copies", copies).filter("copies > 0")
    again = again.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    more = [_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To", F.col("to")), _header("WARC-Refers-To-Target-URI", F.col("to_url")),
            _header("WARC-Refers-To-Date", F.lit(date))]
    revisits = again.select(_record("revisit", _urn(F.col("key"), F.col("salt"), F.col("_copy"), F.lit("revisit")), date, more, None).alias("value"))

    writer = plain.union(kept).union(revisits).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", compression).text(path)


class _Stream:
    """Bytes of an archive, plain or of any number of gzip members, inflated as they are read."""

    def __init__(self, data: bytes):
        self.raw, self.zipped, self.held = io.BytesIO(data), data[:2] == b"\x1f\x8b", b""
        self.member = zlib.decompressobj(31) if self.zipped else None

    def _more(self) -> bytes:
        if not self.zipped:
            return self.raw.read(1 << 20)
        while True:
            if self.member.eof:
                rest = self.member.unused_data + self.raw.read(1 << 16)
                if not rest:
                    return b""
                self.member = zlib.decompressobj(31)
            else:
                rest = self.member.unconsumed_tail or self.raw.read(1 << 16)
                if not rest:
                    raise ValueError("an archive ends within a gzip member")
            out = self.member.decompress(rest, 1 << 20)
            if out:
                return out

    def read(self, n: int) -> bytes:
        parts, held = [self.held], len(self.held)
        while held < n:
            more = self._more()
            if not more:
                break
            parts.append(more)
            held += len(more)
        data = b"".join(parts)
        self.held = data[n:]
        return data[:n]

    def head(self) -> bytes:
        """Up to and without the next empty line; nothing at the end of the archive."""
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            more = self._more()
            if not more:
                if self.held.strip():
                    raise ValueError("an archive ends within a header")
                return b""
            self.held += more
        head, self.held = self.held[:at], self.held[at + 4:]
        return head


def records(data: bytes):
    """(headers with names in lower case, block) of every record of an archive."""
    stream = _Stream(data)
    while head := stream.head():
        first, *lines = head.split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines)}
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        yield fields, block


HEADERS = "record_id string, record_type string, page long, url string, digest string, refers_to string, bytes long, payload binary"


def _read_batches(batches, with_payload: bool):
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in HEADERS.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows, held = [], 0
    for batch in batches:
        for data in batch["content"]:
            for fields, block in records(data.as_py()):
                kind = fields["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                payload = block.partition(b"\r\n\r\n")[2]
                said = fields["warc-payload-digest"].partition(":")[2].lower()
                if kind == "response" and hashlib.sha1(payload).hexdigest() != said:
                    raise ValueError(f"record {fields['warc-record-id']} doesn't meet its digest")
                page = fields.get("warc-page-id")
                rows.append((fields["warc-record-id"], kind, None if page is None else int(page), fields.get("warc-target-uri"), said,
                             fields.get("warc-refers-to"), len(payload) if kind == "response" else None, payload if with_payload else None))
                held += len(payload) * with_payload
                if len(rows) >= 10_000 or held >= 1 << 25:
                    yield batch_of(rows)
                    rows, held = [], 0
    if rows:
        yield batch_of(rows)


def read_headers(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """record_id, record_type, page, url, digest, refers_to (a record id), bytes and payload of every response and revisit
    in the archives at ``path``; revisits have no bytes of their own. Payloads are checked against their digests;
    damaged archives raise an error."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda it: _read_batches(it, with_payload), HEADERS)


def resolve(heads: DataFrame) -> DataFrame:
    """``heads`` with revisits joined to the responses they name: their bytes, and ``original``, the page they refer to.
    A revisit whose original is missing or has another digest raises an error. Headers only; one record that a third
    of all revisits name is a skewed sort-merge join, which Spark splits."""
    own = ["record_id", "record_type", "page", "url", "digest"]
    first = heads.filter("record_type = 'response'").select(*own, "bytes", F.lit(None).cast("long").alias("original"))
    to = heads.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"), F.col("page").alias("_page"))
    met = heads.filter("record_type = 'revisit'").join(to, "refers_to", "left")
    found = F.when(F.col("_digest") == F.col("digest"), F.col("_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("no original for "), F.col("record_id"))).cast("long"))
    return first.union(met.select(*own, found.alias("bytes"), F.col("_page").alias("original")))


def op13_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    out = resolve(stored(read_headers(spark, path).drop("payload"), "warc-read"))
    return out.select(F.col("page").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
                      F.col("original").alias("refers_to"), F.col("url"), "record_id")
