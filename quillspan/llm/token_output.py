"""Token ids in Simple-8b segments: word-aligned, with escapes and per-block offsets.

A segment holds consecutive documents:

    "QS8B", u32 version, u64 documents, u64 ids, u64 blocks, u64 words, u64 escapes
    i64 doc id and u8 has-id flag and u64 ids of each document
    u64 offset of each block's first word
    u64 words: the top 4 bits select how many ids of how many bits the other 60 hold
    u64 position, u64 value of each escape: an id of over 60 bits, 0 among the words

Blocks of 1024 ids are packed on their own, so all of a segment's blocks are coded in lockstep and
decoded selector by selector, without a loop over ids. Documents are range-partitioned by id and
sorted; a file holds one partition's segments; only rows of tasks that succeeded name files.

The tokenizer sees each distinct unit of text once per cache: its pre-tokenizer never joins a
character with white space after it, so a text falls apart before a space or around a line feed
that has no white space beside it.

Defined cases: null text is empty (only the end id); null ids come first; rows of one id are in
order of their texts; empty tables give no files and no rows.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import bound_batches, fetch, filesystem, fresh, kept_by_worker, n_buckets, settle, small_batches
from .units import CachedEncoder, tile

BLOCK = 1024
#: Fixed values of the format: ids per word and bits per id, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
SEGMENT_IDS = 2_000_000
_POWERS = np.uint64(1) << np.arange(60, dtype=np.uint64)
_SHORT = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)
_HEAD = struct.Struct("<4sIQQQQQ")


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    out = _SHORT[(ids & np.uint64(0xFFFF)).astype(np.int64)]
    large = np.flatnonzero(ids >> np.uint64(16))
    if len(large):
        out[large] = np.searchsorted(_POWERS, ids[large], "right")
    return out


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offset of each block's first word, escape positions) of unsigned 64-bit ids."""
    n = len(ids)
    escapes = np.flatnonzero(ids >= np.uint64(1 << 60))
    nb = -(-n // block)
    wide = np.zeros((nb, block + 240), np.uint64)
    flat = np.zeros(nb * block, np.uint64)
    flat[:n] = ids
    flat[escapes] = 0
    wide[:, :block] = flat.reshape(nb, block)
    width = np.zeros((nb, block + 240), np.uint8)
    width[:, :block] = _widths(flat).reshape(nb, block)
    spans = {1: width}
    k = 1
    while k < 128:
        m = spans[k].copy()
        m[:, :-k] = np.maximum(m[:, :-k], spans[k][:, k:])
        spans[2 * k] = m
        k *= 2
    choice = np.full((nb, block), 15, np.uint8)
    for s in range(14, -1, -1):  # wider counts overrule
        c = int(COUNTS[s])
        k = 1 << (c.bit_length() - 1)
        most = np.maximum(spans[k][:, :block], spans[k][:, c - k : c - k + block])
        choice[most <= BITS[s]] = s
    pos = np.zeros(nb, np.int64)
    steps, live = [], np.arange(nb)
    while len(live):
        s = choice[live, pos[live]]
        steps.append((live, pos[live], s))
        pos[live] += COUNTS[s]
        live = live[pos[live] < block]
        if len(live) and live[-1] == nb - 1 and pos[nb - 1] + (nb - 1) * block >= n:
            live = live[:-1]
    per = np.zeros(nb, np.int64)
    for b, _, _ in steps:
        per[b] += 1
    first = np.concatenate([[0], np.cumsum(per)])
    words = np.zeros(int(first[-1]), np.uint64)
    at = np.empty(len(words), np.int64)
    sel = np.empty(len(words), np.uint8)
    for i, (b, p, s) in enumerate(steps):  # a live block takes part in every step so far
        at[first[b] + i] = b * (block + 240) + p
        sel[first[b] + i] = s
    lanes = wide.ravel()
    for s in np.unique(sel):
        which = np.flatnonzero(sel == s)
        out = np.full(len(which), np.uint64(int(s) << 60), np.uint64)
        for j in range(int(COUNTS[s]) if BITS[s] else 0):
            out |= lanes[at[which] + j] << np.uint64(j * int(BITS[s]))
        words[which] = out
    return words, first[:-1].astype(np.uint64), escapes


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids of all blocks (escapes as 0)."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[sel]
    before = np.cumsum(counts) - counts
    blocks = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets.astype(np.int64), len(words))))
    start = blocks * block + before - before[offsets.astype(np.int64)][blocks] if len(words) else before
    out = np.zeros(len(offsets) * block + 240, np.uint64)
    end = (blocks + 1) * block
    for s in np.unique(sel):
        if BITS[s] == 0:
            continue  # zeros
        which = np.flatnonzero(sel == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for j in range(int(COUNTS[s])):
            p = start[which] + j
            ok = p < end[which]  # a block's last word may be padded
            out[p[ok]] = (words[which[ok]] >> np.uint64(j * int(BITS[s]))) & mask
    return out[:n]


def segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    ids = ids.astype(np.uint64)
    words, offsets, escapes = pack(ids)
    return b"".join([
        _HEAD.pack(b"QS8B", 1, len(doc_ids), len(ids), len(offsets), len(words), len(escapes)),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], np.uint8).tobytes(), lengths.astype("<u8").tobytes(),
        offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes(), ids[escapes].astype("<u8").tobytes(),
    ])


def read_segment(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, ids of each document, all ids)."""
    magic, version, docs, n, nb, nw, ne = _HEAD.unpack_from(raw)
    if magic != b"QS8B" or version != 1:
        raise ValueError("not a segment")
    at = _HEAD.size

    def take(dtype, count):
        nonlocal at
        out = np.frombuffer(raw, dtype, count, at)
        at += out.nbytes
        return out

    doc_ids, has, lengths = take("<i8", docs), take(np.uint8, docs), take("<u8", docs)
    offsets, words, pos, values = take("<u8", nb), take("<u8", nw), take("<u8", ne), take("<u8", ne)
    ids = unpack(words, offsets, n)
    ids[pos.astype(np.int64)] = values
    return [int(d) if h else None for d, h in zip(doc_ids, has, strict=True)], lengths.astype(np.int64), ids


_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions before a lone space, and before and after a lone line feed, between characters that are plainly not white space."""
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64)
    right = _SOLID[data] | (data == 0xC3)  # starts a visible ASCII character or U+00C0-U+00FF
    left = _SOLID[data]
    left[1:] |= (data[1:] >= 0x80) & (data[:-1] == 0xC3)
    lone = np.zeros(n, bool)
    lone[1:-1] = left[:-2] & right[2:]
    feed = lone & (data == 0x0A)
    cut = feed | lone & (data == 0x20)
    cut[1:] |= feed[:-1]
    return np.flatnonzero(cut)


_cached: dict[str, CachedEncoder] = kept_by_worker("tokens")


def encoder(path: str) -> CachedEncoder:
    """This process's cached encoder for a tokenizer file."""
    if path not in _cached:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        feed = tokenizer.encode("a\nb", add_special_tokens=False).ids[1]

        def encode(data, starts, ends):
            raw = data.tobytes()
            spans = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            space = np.concatenate([[0], np.cumsum(_SPACE[data] | (data >= 0x80) & ~_latin(data))])
            plain = (space[ends] - space[np.minimum(starts + 1, ends)] == 0) & (_SOLID[data[starts]] | (data[starts] == 0x20) | (data[starts] == 0xC3)) & ((ends - starts > 1) | (data[starts] != 0x20))
            alone, many = np.flatnonzero(~plain), np.flatnonzero(plain)
            ids, counts = [], []
            for k in range(0, len(many), 400):  # a line feed between units is a token of its own
                part = many[k : k + 400]
                got = np.array(tokenizer.encode_batch_fast([b"\n".join([spans[i] for i in part.tolist()]).decode()], add_special_tokens=False)[0].ids, np.int32)
                feeds = got == feed
                ends_at = np.append(np.flatnonzero(feeds), len(got))
                if len(ends_at) != len(part):  # not as foreseen: one by one
                    alone = np.concatenate([alone, part])
                    many = np.concatenate([many[:k], np.full(len(part), -1), many[k + 400 :]])
                    continue
                ids.append(got[~feeds])
                counts.append(np.diff(ends_at, prepend=-1) - 1)
            for e in tokenizer.encode_batch_fast([spans[i].decode() for i in alone.tolist()], add_special_tokens=False):
                ids.append(np.array(e.ids, np.int32))
                counts.append([len(e.ids)])
            return np.concatenate(ids), np.concatenate(counts).astype(np.int64), np.concatenate([many[many >= 0], alone])

        _cached[path] = CachedEncoder(encode, 1_500_000)
    return _cached[path]


def _latin(data: np.ndarray) -> np.ndarray:
    """Bytes of U+00C0-U+00FF."""
    lead = data == 0xC3
    out = lead.copy()
    out[1:] |= lead[:-1]
    return out


def encode_column(col: pa.Array, path: str, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(ids with the end id after each text, ids of each text)."""
    data, off = tk.flat(col)
    starts, ends = tile(off, cuts(data))
    ids, counts = encoder(path)(data, starts, ends)
    per = tk.sums(counts, np.searchsorted(starts, off))
    out = np.full(len(ids) + len(per), end, np.int32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(per)), per)] = ids
    return out, per + 1


def write_ids(docs: DataFrame, uri: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 0) -> DataFrame:
    """Write one file per range of document ids; a row for each segment."""
    bound_batches(docs.sparkSession)
    n = n_buckets(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())

    def write(batches):
        fs, base = filesystem(uri)
        name, out, at, seen, part = f"{uuid.uuid4().hex}.qs8b", None, 0, 0, 0
        held: list = [[], [], []]

        def flush():
            nonlocal out, at, seen
            lengths, ids = np.concatenate(held[1]), np.concatenate(held[2])
            raw = segment(held[0], lengths, ids)
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}")
            out.write(raw)
            row = pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, part, at, len(raw), seen, len(ids))], names=["file", "part", "offset", "length", "before", "ids"])
            at, seen = at + len(raw), seen + len(ids)
            for x in held:
                x.clear()
            return row

        size = 0
        for b in small_batches(batches, "text", 4 << 20, kind="tokens"):
            part = b.column("part")[0].as_py()
            ids, per = encode_column(b.column("text"), tokenizer, end)
            held[0] += b.column("doc_id").to_pylist()
            held[1].append(per)
            held[2].append(ids)
            size += len(ids)
            if size >= SEGMENT_IDS:
                yield flush()
                size = 0
        if size:
            yield flush()
        if out is not None:
            out.close()

    return rows.mapInArrow(write, "file string, part bigint, offset bigint, length bigint, before bigint, ids bigint")


def read_ids(segments: DataFrame, uri: str, digest: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, or with the ``ids``, from the files.

    ``start`` adds the sizes of the partitions before (one row each), of the segments before in the
    partition, and of the documents before in the segment.
    """
    sums = segments.groupBy("part").agg(F.sum("ids").alias("n"))
    base = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    where = segments.join(base, "part").repartition(n_buckets(segments.sparkSession))

    def read(batches):
        for b in batches:
            for r in b.to_pylist():
                doc_ids, lengths, ids = read_segment(fetch(f"{uri}/{r['file']}", r["offset"], r["length"]))
                ends = np.cumsum(lengths)
                starts = ends - lengths
                if digest:
                    raw = memoryview(ids.astype("<u4")).cast("B")
                    last = pa.array([zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(r["base"] + r["before"] + starts), pa.array(lengths), last], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return where.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids array<bigint>"))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and digests of every document's ids, read back from the files."""
    import public_tokenizers

    uri = fresh(spark, "ids")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_ids(settle(write_ids(docs, uri, public_tokenizers.path("byte_bpe_50k.json")), "ids-segments"), uri)
