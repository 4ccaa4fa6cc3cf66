"""Media columns: content-defined payload chunking with deduplicated chunks.

A payload is the text's UTF-8 bytes and bytes 255 up to a positive multiple of 576. A gear hash
rolls over it: the sum of random values of the last 32 bytes, each shifted by its age, computed for
all positions at once by doubling. Cuts are where its top bits are zero, kept apart by a least and
a greatest chunk size.

Chunk digests meet in an aggregation over (digest, count, first owner) only. Chunks found once stay
with their payload, deflated together; chunks found more often are stored once, in a table by
digest. A payload's recipe, its ordered list of chunk digests and lengths, is written with it: that is
its stored form. Equal payloads are stored once. Reading back parses the stored recipe, joins the
shared chunks by its digests, puts the payload's chunks in order, verifies each chunk against its
digest and the whole against the payload's, and hashes recipe and payload.

Tables of repeated payloads, of shared digests and of payloads' places of shared chunks are broadcast
up to 48 MB of values and shuffled beyond.

Defined cases: null text is the empty payload of 576 bytes 255; repeated rows and equal texts share
a stored payload and get equal values; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, broadcast_if_small, settle, small_batches

UNIT = 576
LEAST, MASK_BITS, MOST = 256, 10, 8192
_GEAR = np.random.default_rng(576).integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
MAGIC = b"QCDC\x01"
_HEAD, _ENTRY = len(MAGIC) + 12, 36  # bytes before the first entry, and of each


def payload(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, over the last 32 bytes."""
    h = _GEAR[data]
    w = 1
    while w < 32 and w < len(h):
        h[w:] = h[w:] + (h[:-w] << np.uint32(w))
        w *= 2
    return h


def chunk_ends(data: np.ndarray, least: int = LEAST, bits: int = MASK_BITS, most: int = MOST) -> list[int]:
    """Where the chunks of one payload end."""
    hits = np.flatnonzero(gear(data) < np.uint32(1 << (32 - bits))) + 1
    out, at, n = [], 0, len(data)
    while n - at > least:
        i = int(np.searchsorted(hits, at + least))
        cut = min(int(hits[i]) if i < len(hits) else n, at + most, n)
        out.append(cut)
        at = cut
    if at < n:
        out.append(n)
    return out


def recipe(size: int, digests: list[bytes], lengths: list[int]) -> bytes:
    """A payload's stored form: size, then digest and length of each chunk in order."""
    return MAGIC + struct.pack("<QI", size, len(digests)) + b"".join(d + struct.pack("<I", n) for d, n in zip(digests, lengths, strict=True))


def parse_recipe(raw: bytes) -> tuple[int, list[bytes], list[int]]:
    if raw[:5] != MAGIC:
        raise ValueError("not a recipe")
    size, n = struct.unpack_from("<QI", raw, 5)
    rows = [(raw[_HEAD + _ENTRY * i : _HEAD + _ENTRY * i + 32], struct.unpack_from("<I", raw, _HEAD + _ENTRY * i + 32)[0]) for i in range(n)]
    return size, [d for d, _ in rows], [x for _, x in rows]


def cut(text: str | None) -> tuple[bytes, list[bytes], list[bytes]]:
    """(payload, its chunks, their digests)."""
    raw = payload(text)
    ends = chunk_ends(np.frombuffer(raw, np.uint8))
    chunks = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return raw, chunks, [hashlib.sha256(c).digest() for c in chunks]


def features(raw: bytes, chunks: int) -> str:
    """Chunk count, mean byte and byte entropy of a payload read back."""
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = counts[counts > 0] / len(raw)
    return f"chunks={chunks};mean={float(np.arange(256) @ counts) / len(raw):.4f};entropy={float(-(p * np.log2(p)).sum()):.4f}"


def payload_key(text: Column) -> Column:
    """SHA-256 of a text's payload, without Python."""
    raw = F.encode(F.coalesce(text, F.lit("")), "utf-8")
    n = F.octet_length(raw)
    pad = F.when(n == 0, F.lit(UNIT)).otherwise(F.pmod(-n, F.lit(UNIT)))
    return F.unhex(F.sha2(F.concat(raw, F.unhex(F.repeat(F.lit("FF"), pad))), 256))


def _digests(batches):
    """(key, digests) of each text's payload."""
    for b in batches:
        for part in small_batches([b], "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([cut(t)[2] for t in part.column("text").to_pylist()], pa.list_(pa.binary()))], names=["key", "digests"])


#: A payload: its key, its recipe, which of its chunks are stored apart, and the others. A shared chunk: its digest as ``recipe``.
_STORED = "key binary, recipe binary, foreign array<boolean>, body binary"


def _pack(batches):
    """A row per payload with its own chunks, and one (without key) per shared chunk that it owns."""
    for b in small_batches(batches, "text", 1 << 20):
        rows = []
        for k, t, foreign, mine in zip(*(b.column(c).to_pylist() for c in ("key", "text", "foreign_places", "mine_places")), strict=True):
            _, chunks, digests = cut(t)
            away = set(foreign or [])
            own = zlib.compress(b"".join(c for i, c in enumerate(chunks) if i not in away), 6)
            rows.append((k, recipe(sum(map(len, chunks)), digests, [len(c) for c in chunks]), [i in away for i in range(len(chunks))], own))
            rows += [(None, digests[i], None, zlib.compress(chunks[i], 6)) for i in mine or []]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        types = (pa.binary(), pa.binary(), pa.list_(pa.bool_()), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["key", "recipe", "foreign", "body"])


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = 48 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write the media: (rows with their payload's key, stored payloads, shared chunks), all settled.

    A stored payload has its recipe and its own chunks deflated together; a shared chunk has its
    digest and deflated bytes. Only digests meet: a payload's bytes go from its text to its row.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("key", payload_key(F.col("text")))
    listed = settle(rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "key"), "media-rows")
    again = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    again = settle(again.filter("n > 1").select(F.col("key").alias("again_key"), "first"), "media-again")
    # the first row of each payload (and rows that repeat its id)
    firsts = rows.join(broadcast_if_small(again, limit), F.col("key") == F.col("again_key"), "left").filter("again_key is null or first <=> doc_id").select("key", "text")

    recipes = settle(firsts.mapInArrow(_digests, "key binary, digests array<binary>"), "media-recipes")
    each = recipes.select("key", F.posexplode("digests").alias("place", "digest"))
    place = F.struct("key", "place")
    counts = each.groupBy("digest").agg(F.min(place).alias("owner"), F.max(place).alias("other"))
    shared = settle(counts.filter("owner != other").select(F.col("digest").alias("shared_digest"), "owner"), "media-shared")
    marks = each.join(broadcast_if_small(shared, limit), F.col("digest") == F.col("shared_digest"))
    marks = marks.groupBy("key").agg(F.collect_set("place").alias("foreign_places"), F.collect_set(F.when(F.col("owner") == place, F.col("place"))).alias("mine_places"))  # one payload's places
    marks = settle(marks.withColumnRenamed("key", "mark_key"), "media-marks")
    packed = firsts.join(broadcast_if_small(marks, limit), F.col("key") == F.col("mark_key"), "left").select("key", "text", "foreign_places", "mine_places")
    stored = settle(packed.mapInArrow(_pack, _STORED), "media-store")
    return listed, stored.filter("key is not null"), stored.filter("key is null").select(F.col("recipe").alias("digest"), "body")


_BACK = "key binary, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def read_back(stored: DataFrame, chunks: DataFrame) -> DataFrame:
    """Each stored payload put together and verified, with what is computed from it.

    Payloads without shared chunks are read where they lie; the chunks of the others meet by key, one
    payload a group.
    """

    def finish(key: bytes, form: bytes, foreign: list[bool], body: bytes, shared: dict[int, bytes]) -> tuple:
        size, digests, lengths = parse_recipe(form)
        raw, at, bodies = zlib.decompress(body), 0, []
        for i, (n, f) in enumerate(zip(lengths, foreign, strict=True)):
            bodies.append(zlib.decompress(shared[i]) if f else raw[at : at + n])
            at += 0 if f else n
        if any(hashlib.sha256(b).digest() != d for d, b in zip(digests, bodies, strict=True)):
            raise ValueError("a chunk differs from its digest")
        raw = b"".join(bodies)
        if len(raw) != size or hashlib.sha256(raw).digest() != key:
            raise ValueError("a payload differs from its digest")
        return key, len(raw), key.hex(), zlib.crc32(raw[-32:]), len(form), hashlib.sha256(form).hexdigest(), features(raw, len(bodies))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 7
        types = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["key", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    def whole(batches):
        for b in batches:
            yield batch([finish(r["key"], r["recipe"], r["foreign"], r["body"], {}) for r in b.to_pylist()])

    def gather(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                bodies = {x["place"]: x["body"] for x in r["bodies"]}
                rows.append(finish(r["key"], r["recipe"], r["foreign"], bodies.pop(-1), bodies))
            yield batch(rows)

    apart = F.exists("foreign", lambda f: f)
    straight = stored.filter(~apart).mapInArrow(whole, _BACK)
    mixed = stored.filter(apart)
    digest = F.expr(f"substring(recipe, {_HEAD + 1} + {_ENTRY} * place, 32)")
    refs = mixed.select("key", "recipe", F.posexplode("foreign").alias("place", "away")).filter("away").select("key", "place", digest.alias("digest"))
    shared = refs.join(chunks, "digest").select("key", "place", "body")
    both = mixed.select("key", F.lit(-1).alias("place"), "body", "recipe", "foreign").unionByName(shared, allowMissingColumns=True)  # own chunks travel once, deflated
    grouped = both.groupBy("key").agg(F.collect_list(F.struct("place", "body")).alias("bodies"), *[F.first(c, ignorenulls=True).alias(c) for c in ("recipe", "foreign")])  # one payload's chunks
    return straight.unionByName(grouped.mapInArrow(gather, _BACK)).dropDuplicates(["key"])


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's payload, stored as chunks and read back."""
    listed, stored, chunks = store(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    back = settle(read_back(stored, chunks), "media-back")
    return listed.join(back, "key").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
