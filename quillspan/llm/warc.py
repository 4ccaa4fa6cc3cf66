"""WARC archives with a two-level capture index.

Archives begin with a warcinfo record and hold one gzip member per record, so any record can be read
by its byte range. Of records with equal payloads of ``least`` bytes or more, the one with the
smallest page id is a response and the others are revisits that refer to it, by its record id, target
and date. Payload digests meet in an aggregation with partial minima; page bodies are only joined
with the digests that occur more than once, and Spark broadcasts those only below its own size
threshold.

The capture index has two levels. Lines (reversed-host URL key, page, archive, offset, length) are
range-sorted and cut into compressed blocks, a file for each range; a file ends with its sparse block
directory (first key and byte range of each block). A master table has a row for each file: its first
and last key. A lookup binary-searches the master table, the file's directory and the block's lines,
and reads the records' ranges. Spark looks many URLs up the same way: they are range-sorted, so that
each task needs the directories of few files; the blocks they name are dealt out and searched, so the
captures of one hot URL are read by many tasks; records are read archive by archive, in offset order.

Defined cases: null html is the empty payload; a null url gets the key and target of its page; null
page ids stay null (as the smallest id they lose to any other); rows that repeat the smallest id
are all responses; empty tables give empty archives and results.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import struct
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append_columns, fetch, filesystem, fresh, n_buckets, settle

LEAST = 100
ROLL = 128 << 20
BLOCK_LINES = 2000
DATE = "1970-01-01T00:00:00Z"


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def url_key(url: str) -> str:
    """Reversed-host key: com,example,www:8080)/path?query in lower-case host, without scheme or fragment.

    Control characters and spaces are escaped, so keys sort and search as they are written in lines.
    """
    url = _clean(url)
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url)
    if not m:
        return url.partition("#")[0]
    host, _, port = m[1].rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (m[2] or "/")


def key_of(page_id, url: str | None) -> str:
    return url_key(url) if url else f"urn:page:{page_id}"


def target_of(page_id, url: str | None) -> str:
    return _clean(url) if url else f"urn:page:{page_id}"


def record_id(page_id, target: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {target} {digest}')}>"


def information(name: str) -> bytes:
    """An archive's first record."""
    block = b"software: quillspan\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {DATE}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC record, not compressed. ``refers_to``: (page id, url) of the response that has the payload."""
    target = target_of(page_id, url)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, target, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block = http + payload
    else:
        first = target_of(*refers_to)
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to[0], first, digest)}",
            f"WARC-Refers-To-Target-URI: {first}", f"WARC-Refers-To-Date: {DATE}", f"Refers-To-Page-ID: {refers_to[0]}",
        ]
        block = http  # the payload's length stays in the stored HTTP header
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's fields; a response's payload is cut by its lengths and hashed anew."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    out = {"page_id": int(fields["Page-ID"]) if "Page-ID" in fields else None, "url": fields["WARC-Target-URI"], "record_id": fields["WARC-Record-ID"], "record_type": fields["WARC-Type"], "payload_bytes": length, "refers_to": None}
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response":
        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("a payload differs from its digest")
        out["payload"] = payload
    else:
        out["refers_to"] = int(fields["Refers-To-Page-ID"])
        if fields["WARC-Refers-To"] != record_id(out["refers_to"], fields["WARC-Refers-To-Target-URI"], digest):
            raise ValueError("a revisit refers to no record of its payload")
    return out | {"payload_digest": digest}


def _digests(col) -> list:
    raw = [x.encode() if x is not None else b"" for x in col.to_pylist()]
    return [pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()), pa.array([len(x) for x in raw], pa.int64())]


def write_archives(pages: DataFrame, uri: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Write the archives below ``uri``; a row (key, page_id, file, offset, length) for each record.

    Files have names of their own for each attempt; only rows of tasks that succeeded name them.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    made = [("digest", "string"), ("bytes", "bigint")]
    hashed = append_columns(rows, "html", _digests, made, ["page_id", "url"])
    first = hashed.filter((F.col("bytes") >= least) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = settle(first.filter("n > 1").select("digest", "first"), "warc-first")
    each = append_columns(rows, "html", _digests, made).join(first, "digest", "left")
    each = each.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first.page_id")), F.col("first")).alias("refers_to"))

    def write(batches):
        fs, base = filesystem(uri)
        out = None
        for b in batches:
            got = []
            for p, u, h, d, r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, head = fs.open_output_stream(f"{base}/{name}", compression=None), gzip.compress(information(name), 4, mtime=0)
                    out.write(head)
                    at = len(head)
                member = gzip.compress(record(p, u, (h or "").encode(), d, (r["page_id"], r["url"]) if r else None), 4, mtime=0)
                out.write(member)
                got.append((key_of(p, u), p, name, at, len(member)))
                at += len(member)
                if at >= ROLL:
                    out.close()
                    out = None
            cols = list(zip(*got, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[i], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return each.mapInArrow(write, "key string, page_id bigint, file string, offset bigint, length bigint")


def write_index(captures: DataFrame, uri: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted lines in compressed blocks, and each file's directory; the master table, a row for each file.

    A file: the blocks, the compressed directory (lines of first key, offset and length), and in the
    last 8 bytes the directory's length.
    """
    n = n_buckets(captures.sparkSession)
    rows = captures.repartitionByRange(n, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")

    def write(batches):
        fs, base = filesystem(uri)
        out, blocks, lines, name, at, last = None, [], [], uuid.uuid4().hex + ".idx", 0, ""

        def close():
            nonlocal at
            data = zlib.compress("\n".join(lines).encode(), 6)
            out.write(data)
            blocks.append(f"{lines[0].split(chr(9))[0]}\t{at}\t{len(data)}")
            at += len(data)
            lines.clear()

        for b in batches:
            for k, p, f, o, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(f"{k}\t{'' if p is None else p}\t{f}\t{o}\t{n}")
                last = k
                if len(lines) >= block_lines:
                    close()
        if lines:
            close()
        if out is not None:
            data = zlib.compress("\n".join(blocks).encode(), 6)
            out.write(data + struct.pack("<Q", len(data)))
            out.close()
            row = (blocks[0].split("\t")[0], last, name, at, at + len(data) + 8, len(blocks))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["first_key", "last_key", "file", "directory", "length", "blocks"])

    return rows.mapInArrow(write, "first_key string, last_key string, file string, directory bigint, length bigint, blocks bigint")


def master(index: DataFrame) -> list[tuple]:
    """The master table, in key order: (first key, last key, file, offset of the directory, length of the file). A row per range."""
    return sorted(tuple(r) for r in index.select("first_key", "last_key", "file", "directory", "length").collect())


def read_directory(uri: str, file: str, directory: int, length: int) -> list[tuple[str, int, int]]:
    """(first key, offset, length) of a file's blocks."""
    raw = fetch(f"{uri}/{file}", directory, length - directory)
    lines = zlib.decompress(raw[: struct.unpack("<Q", raw[-8:])[0]]).decode().split("\n")
    return [(k, int(o), int(n)) for k, o, n in (x.split("\t") for x in lines)]


def read_block(uri: str, file: str, offset: int, length: int) -> list[list[str]]:
    return [x.split("\t") for x in zlib.decompress(fetch(f"{uri}/{file}", offset, length)).decode().split("\n")]


def find_blocks(files: list[tuple], directory, key: str) -> list[tuple[str, int, int]]:
    """(file, offset, length) of the blocks that can hold a key: two binary searches. ``directory(file row)`` gives a file's directory."""
    out = []
    at = bisect.bisect_left(files, key, key=lambda f: f[1])  # the first file that ends at the key or beyond
    while at < len(files) and files[at][0] <= key:
        blocks = directory(files[at])
        i = max(bisect.bisect_left(blocks, key, key=lambda x: x[0]) - 1, 0)
        while i < len(blocks) and blocks[i][0] <= key:
            out.append((files[at][2], *blocks[i][1:]))
            i += 1
        at += 1
    return out


def find_lines(lines: list[list[str]], key: str) -> list[list[str]]:
    """A block's lines of a key, by binary search."""
    first = lambda x: x[0]
    return lines[bisect.bisect_left(lines, key, key=first) : bisect.bisect_right(lines, key, key=first)]


def lookup(files: list[tuple], index_uri: str, archive_uri: str, url: str) -> list[dict]:
    """All captures of a URL."""
    key, out = url_key(url), []
    for where in find_blocks(files, lambda f: read_directory(index_uri, *f[2:]), key):
        for line in find_lines(read_block(index_uri, *where), key):
            out.append(parse(gzip.decompress(fetch(f"{archive_uri}/{line[2]}", int(line[3]), int(line[4])))))
    return out


_BACK = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def lookup_all(keys: DataFrame, index: DataFrame, index_uri: str, archive_uri: str) -> DataFrame:
    """The captures of all ``keys`` (a column ``key``; repeated ones count once), read back."""
    spark = keys.sparkSession
    n, files = n_buckets(spark), master(index)

    def find(batches):
        name = blocks = None

        def directory(f):
            nonlocal name, blocks
            if f[2] != name:
                name, blocks = f[2], read_directory(index_uri, *f[2:])
            return blocks

        for b in batches:
            got = [(k, *where) for k in b.column("key").to_pylist() for where in find_blocks(files, directory, k)]
            cols = list(zip(*got, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[i], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["key", "file", "offset", "length"])

    def search(batches):
        at = lines = None
        for b in batches:
            got = []
            for k, *where in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if where != at:
                    at, lines = where, read_block(index_uri, *where)
                got += [(x[2], int(x[3]), int(x[4])) for x in find_lines(lines, k)]
            cols = list(zip(*got, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[i], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["file", "offset", "length"])

    def read(batches):
        name = handle = None
        for b in batches:
            got = []
            for f, o, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if f != name:
                    fs, path = filesystem(f"{archive_uri}/{f}")
                    name, handle = f, fs.open_input_file(path)
                handle.seek(o)
                r = parse(gzip.decompress(handle.read(length)))
                got.append((r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]))
            cols = list(zip(*got, strict=True)) or [[]] * 6
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(cols[i], t) for i, t in enumerate(types)], names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    where = keys.select("key").distinct().repartitionByRange(n, "key").sortWithinPartitions("key").mapInArrow(find, "key string, file string, offset bigint, length bigint")
    lines = where.repartition(n, "file", "offset").sortWithinPartitions("file", "offset", "key").mapInArrow(search, "file string, offset bigint, length bigint")
    return lines.repartition(n, "file").sortWithinPartitions("file", "offset").mapInArrow(read, _BACK)


def keys_of(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(key) of every page."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([key_of(p, u) for p, u in zip(*(c.to_pylist() for c in b.columns), strict=True)], pa.string())], names=["key"])

    return pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url")).mapInArrow(run, "key string")


def archive(pages: DataFrame, uri: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write archives below ``uri``/data and their index below ``uri``/index; the master table."""
    captures = settle(write_archives(pages, f"{uri}/data"), "warc-captures")
    return settle(write_index(captures, f"{uri}/index", block_lines), "warc-index")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record: the pages' URLs looked up in the index, and their captures read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    uri = fresh(spark, "warc")
    index = archive(pages, uri)
    return lookup_all(keys_of(pages), index, f"{uri}/index", f"{uri}/data").drop("url")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
