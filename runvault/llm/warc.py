"""WARC archives with a two-level capture index.

Writing: every partition appends its pages to its own archive file, one gzip
member per record; pages with equal payloads are written once, by the smallest
page_id, and as revisit records otherwise.  A file's name holds a random part,
and its captures enter the capture table through Spark's commit, so files of
lost task attempts are never referenced.

Index: captures are sorted by a key of the reversed host and the rest of the
URL, then by the row number of the capture.  Sorted lines go in blocks of ``BLOCK_LINES`` into
compressed blocks of an index file per range partition; a sparse directory
keeps the first key of each block beside the file.  The list of index files
with their first keys, one entry a file, is the only part that reaches the
driver.

Lookup: keys are sorted like the index; a task finds the file by binary search
in the list, the block by binary search in that file's directory, range-reads
and unpacks the block, and finds the line by binary search.  Records are then
range-read from the archives in the order of file and offset.

Null payloads count as empty, null URLs have an empty key, a null page_id is
written as ``none``.  Of rows with the same page_id and payload one is the
response.  An empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from runvault.llm.common import cut, pick
from runvault.llm.registry import query, table
from runvault.session import scratch_dir

BLOCK_LINES = 256
LEVEL = 3
ROLL_BYTES = 1 << 30
READ_BYTES = 1 << 27  # of archives, for each task that reads records back
GAP = 1 << 16  # ranges this near to each other are read at once
CAPTURE = "key string, page_id long, row long, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """Host labels reversed and joined by commas, ``)``, then path, query and fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url
    rest = parts.path or "/"
    rest += f"?{parts.query}" if parts.query else ""
    rest += f"#{parts.fragment}" if parts.fragment else ""
    return ",".join(reversed(host.split("."))) + port + ")" + rest


def page_urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, size: int, digest: str, refers_to, revisit: bool) -> bytes:
    """One record; ``digest`` is base32.  A revisit holds the HTTP header only, with the payload's ``size``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {page_urn(page_id)}",
            f"WARC-Target-URI: {(url or '').strip().replace(chr(10), '%0A').replace(chr(13), '%0D')}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {page_urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers of a record, its payload, and the payload's length as the HTTP header gives it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
    return {"fields": fields, "payload": payload, "length": length}


def _page_id(urn: str):
    text = urn[len("<urn:page:"):-1]
    return None if text == "none" else int(text)


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _open(root: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(root)


def _batches(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_CAPTURE_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_CAPTURE_NAMES = ["key", "page_id", "row", "file", "offset", "length"]


def with_roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, size, sha1, revisit, refers_to) for every row of ``pages`` (page_id, url,
    html).  Of rows with an equal payload of at least ``least`` bytes the one with the smallest
    page_id (then hash of its URL) is no revisit and the others refer to it.

    Rows are named by what they hold, not by their place, so that scans agree also if executors
    come or go between them.  Rows equal in everything are told apart by number: one is taken,
    and the others, which need no payload, are made from their count.
    """
    rows = pick(pages, "page_id", "url", "html").select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload")).withColumn(
        "url_hash", F.xxhash64("url"))
    equal = rows.filter(F.col("size") >= least).groupBy("sha1", "page_id", "url_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url_hash", "n")).alias("head")
    heads = cut(equal.groupBy("sha1").agg(first, F.sum("n").alias("all")).filter("all > 1").select("sha1", "head"))
    all_rows = rows.join(heads, "sha1", "left")
    is_head = (F.col("head").isNotNull() & F.col("page_id").eqNullSafe(F.col("head.page_id"))
               & (F.col("url_hash") == F.col("head.url_hash")))
    several = is_head & F.coalesce(F.col("head.n") > 1, F.lit(False))
    columns = ["page_id", "url", "payload", "size", "sha1", "revisit", "refers_to"]
    refers_to = F.col("head.page_id").alias("refers_to")
    out = all_rows.withColumn("revisit", F.col("head").isNotNull() & ~is_head).select(
        *columns[:-1], refers_to, several.alias("several")).filter("not several").select(*columns)
    if heads.filter("head.n > 1").isEmpty():
        return out
    some = all_rows.filter(several).groupBy("sha1").agg(
        *[F.first(c).alias(c) for c in ("page_id", "url", "payload", "size", "head")])
    again = some.select("page_id", "url", F.lit("").alias("payload"), "size", "sha1", F.lit(True).alias("revisit"), refers_to,
                        F.explode(F.sequence(F.lit(2).cast("long"), F.col("head.n"))).alias("k")).repartition("sha1", "k")
    return (out.union(some.withColumn("revisit", F.lit(False)).select(*columns[:-1], refers_to))
            .union(again.select(*columns)))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record for every page below ``folder``; returns the captures (key, page_id, row, file, offset, length)."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        out, name, offset, found = None, "", 0, []
        for batch in batches:
            for r in batch.to_pylist():
                if out is None or offset >= ROLL_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    fs.create_dir(posixpath.join(base, "warc"), recursive=True)
                    out = fs.open_output_stream(posixpath.join(base, "warc", name), compression=None)
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                data = _gzip(record(r["page_id"], r["url"], r["payload"].encode(), r["size"], digest, r["refers_to"], r["revisit"]))
                out.write(data)
                found.append((url_key(r["url"]), r["page_id"], r["row"], name, offset, len(data)))
                offset += len(data)
            yield _batches(found, _CAPTURE_NAMES, _CAPTURE_TYPES)
            found = []
        if out is not None:
            out.close()
    rows = with_roles(pages, least).withColumn("row", F.monotonically_increasing_id())  # names a capture
    rows.mapInArrow(write, CAPTURE).write.parquet(f"{folder}/captures")
    return pages.sparkSession.read.schema(CAPTURE).parquet(f"{folder}/captures")


# -- index ----------------------------------------------------------------------

def build_index(captures: DataFrame, folder: str) -> list[tuple[str, int, str]]:
    """Write sorted index files with their directories; returns (first key, first row, file) of each, sorted."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        out, name, offset, lines, directory = None, "", 0, [], []

        def block():
            nonlocal offset, lines
            data = zlib.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode(), LEVEL)
            out.write(data)
            directory.append([lines[0][0], lines[0][1], offset, len(data)])
            offset, lines = offset + len(data), []
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name = uuid.uuid4().hex
                    fs.create_dir(posixpath.join(base, "index"), recursive=True)
                    out = fs.open_output_stream(posixpath.join(base, "index", f"{name}.blocks"), compression=None)
                lines.append([r["key"], r["row"], r["page_id"], r["file"], r["offset"], r["length"]])
                if len(lines) == BLOCK_LINES:
                    block()
        if out is not None:
            if lines:
                block()
            out.close()
            with fs.open_output_stream(posixpath.join(base, "index", f"{name}.directory"), compression=None) as d:
                d.write(zlib.compress(json.dumps(directory).encode(), LEVEL))
            yield _batches([(directory[0][0], directory[0][1], name)], ["key", "row", "name"],
                           [pa.string(), pa.int64(), pa.string()])
    ordered = captures.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    files = cut(ordered.mapInArrow(write, "key string, row long, name string"))
    return sorted((r.key, r.row, r.name) for r in files.collect())  # one a range partition


class IndexReader:
    """Finds captures; keeps the directory and block read last."""

    def __init__(self, folder: str, files: list[tuple[str, int, str]]):
        self.fs, self.base = _open(folder)
        self.files = files
        self.firsts = [(k, r) for k, r, _ in files]
        self.name, self.directory, self.block_at, self.block = None, [], None, []

    def _enter(self, at: int) -> None:
        """Directory and blocks of the ``at``-th index file."""
        if self.files[at][2] != self.name:
            self.name, self.block_at = self.files[at][2], None
            with self.fs.open_input_stream(posixpath.join(self.base, "index", f"{self.name}.directory"), compression=None) as d:
                self.directory = [((k, r), o, n) for k, r, o, n in json.loads(zlib.decompress(d.read()))]
            self.starts = [x[0] for x in self.directory]
            self.blocks = self.fs.open_input_file(posixpath.join(self.base, "index", f"{self.name}.blocks"))

    def _unpack(self, b: int) -> None:
        """Lines of the ``b``-th block of the file."""
        if b != self.block_at:
            _, offset, length = self.directory[b]
            lines = zlib.decompress(self.blocks.read_at(length, offset)).decode().split("\n")
            self.block_at, self.block = b, [json.loads(x) for x in lines]
            self.keys = [(x[0], x[1]) for x in self.block]

    def find(self, key: str, row: int):
        """(page_id, file, offset, length) of a capture, or None."""
        at = bisect_right(self.firsts, (key, row)) - 1
        if at < 0:
            return None
        self._enter(at)
        b = bisect_right(self.starts, (key, row)) - 1
        if b < 0:
            return None
        self._unpack(b)
        k = bisect_right(self.keys, (key, row)) - 1
        return tuple(self.block[k][2:]) if k >= 0 and self.keys[k] == (key, row) else None

    def find_all(self, key: str) -> Iterator[tuple]:
        """(page_id, file, offset, length) of every capture of a key, block after block and file after file."""
        least = (key, -1)
        at = max(0, bisect_left(self.firsts, least) - 1)
        while at < len(self.files) and self.firsts[at][0] <= key:
            self._enter(at)
            b = max(0, bisect_left(self.starts, least) - 1)
            while b < len(self.starts) and self.starts[b][0] <= key:
                self._unpack(b)
                for k in range(bisect_left(self.keys, least), len(self.keys)):
                    if self.keys[k][0] != key:
                        break
                    yield tuple(self.block[k][2:])
                b += 1
            at += 1


def look_up_urls(urls: DataFrame, folder: str, files: list[tuple[str, int, str]]) -> DataFrame:
    """(url, page_id, file, offset, length) of all captures that have the key of a ``url`` of ``urls``.

    Equal URLs are looked up once each; a null URL finds the captures without one.
    """
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batches([(u, url_key(u)) for u in batch.column(0).to_pylist()], ["url", "key"], [pa.string(), pa.string()])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, names = IndexReader(folder, files), ["url", "page_id", "file", "offset", "length"]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            for url, key in zip(*[batch.column(c).to_pylist() for c in (0, 1)]):
                hits = ((url, *hit) for hit in reader.find_all(key))
                while rows := list(islice(hits, 10_000)):
                    yield _batches(rows, names, types)
    ordered = (pick(urls, "url").mapInArrow(keyed, "url string, key string")
               .repartitionByRange("key", "url").sortWithinPartitions("key", "url"))
    return ordered.mapInArrow(find, "url string, page_id long, file string, offset long, length long")


def look_up(wanted: DataFrame, folder: str, files: list[tuple[str, int, str]]) -> DataFrame:
    """(page_id, file, offset, length) of every (key, row) of ``wanted`` that is in the index."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(folder, files)
        for batch in batches:
            hits = [reader.find(k, r) for k, r in zip(*[batch.column(c).to_pylist() for c in (0, 1)])]
            yield _batches([h for h in hits if h], _CAPTURE_NAMES[1:2] + _CAPTURE_NAMES[3:], _CAPTURE_TYPES[1:2] + _CAPTURE_TYPES[3:])
    ordered = wanted.select("key", "row").repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    return ordered.mapInArrow(find, "page_id long, file string, offset long, length long")


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to) of captures, read by
    ranges; ranges that nearly touch are fetched together.  A response whose payload does not
    have its digest and length raises."""
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        name, handle, start, data = None, None, 0, b""
        for batch in batches:
            wanted, out, size = batch.to_pylist(), [], 0
            for i, r in enumerate(wanted):
                if r["file"] != name:
                    if handle is not None:
                        handle.close()
                    name, start, data = r["file"], 0, b""
                    handle = fs.open_input_file(posixpath.join(base, "warc", name))
                if not start <= r["offset"] <= r["offset"] + r["length"] <= start + len(data):
                    end = r["offset"] + r["length"]
                    for x in wanted[i + 1:i + 64]:
                        if x["file"] != name or not end <= x["offset"] <= end + GAP or end - r["offset"] > 16 * GAP:
                            break
                        end = x["offset"] + x["length"]
                    start, data = r["offset"], handle.read_at(end - r["offset"], r["offset"])
                got = parse(zlib.decompress(data[r["offset"] - start:r["offset"] - start + r["length"]], 31))
                fields, payload = got["fields"], got["payload"]
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and (len(payload) != got["length"]
                                    or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"record {fields['WARC-Record-ID']} in {name} is damaged")
                out.append((_page_id(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"],
                            None if revisit else payload, got["length"], digest,
                            _page_id(fields["WARC-Refers-To"]) if revisit else None))
                size += len(payload)
                if size >= 16 << 20:
                    yield _batches(out, names, types)
                    out, size = [], 0
            if out:
                yield _batches(out, names, types)
        if handle is not None:
            handle.close()
    # dealt by the bytes to read: the pointers are far smaller, and Spark would merge them into few tasks
    captures = cut(captures)
    size = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, -(-size // READ_BYTES))
    ordered = captures.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(fetch, "page_id long, url string, record_type string, payload binary, payload_bytes long, "
                                     "payload_digest string, refers_to long")


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write all pages to archives, index them, look every capture up by its URL key, and read its record."""
    captures = write_archives(pages, folder, least)
    files = build_index(captures, folder)
    return read_records(look_up(captures, folder, files), folder)


# base32 takes five bits a sign: 20 bits are five hexadecimal digits and four signs
OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS sha,
             min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((CAST('0x' || substr(sha, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h"""


@query("op8_warc", OP8_SQL)
def op8_warc(spark, sf_dir):
    rows = archive_and_read(spark, table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
