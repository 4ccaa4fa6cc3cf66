"""Shared plumbing: settled tables in the cluster's shared folder and portable file access."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import operator
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own: list[str] = []
_settled: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a temporary one where that is unset on one machine, as in tests."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if got:
        return got.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="quillspan-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def fresh(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/quillspan/{tag}-{uuid.uuid4().hex}"


def settle(df: DataFrame, tag: str) -> DataFrame:
    """Write and reread: cuts lineage, survives lost executors, computes shared work once."""
    path = fresh(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    _settled.append(path)
    return out


@contextlib.contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Deletes in the end what is settled inside, but for the tables put into the list that it gives."""
    first, keep = len(_settled), []
    try:
        yield keep
    finally:
        kept = {t._settled_at for t in keep}
        discard(*[p for p in _settled[first:] if p not in kept])
        del _settled[first:]
        _settled.extend(kept)  # an outer scratch may still delete them


def discard(*tables) -> None:
    """Delete settled tables (or paths) that nothing reads any more."""
    for t in tables:
        path = t if isinstance(t, str) else getattr(t, "_settled_at", None)
        if path:
            spark = SparkSession.getActiveSession()
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of frames that nothing refers to: Spark removes them once the driver has collected those."""
    gc.collect()
    spark._jvm.System.gc()


def _width(field: T.StructField) -> Column:
    """Bytes of a column's value, near enough to bound a broadcast."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(c) + 16
    elif isinstance(kind, T.ArrayType):
        size = F.size(c) * (16 if isinstance(kind.elementType, T.AtomicType) and not isinstance(kind.elementType, T.StringType | T.BinaryType) else 64) + 16
    elif isinstance(kind, T.MapType):
        size = F.size(c) * 64 + 16
    else:
        size = F.lit(16)
    return F.coalesce(size, F.lit(16)).cast("bigint")


def broadcast_if_small(df: DataFrame, limit: int = 48 << 20) -> DataFrame:
    """A settled table, with a broadcast hint if its values add up to ``limit`` bytes at most; else it is shuffled."""
    size = df.agg(F.sum(reduce(operator.add, map(_width, df.schema.fields)))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_buckets(spark: SparkSession) -> int:
    """Buckets of packed postings: as many as the session's shuffle partitions, which the deployment sizes with its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def buckets_for(docs: DataFrame, text: str, each: int = 16 << 20) -> int:
    """Buckets of packed postings for these texts: one for every ``each`` bytes, the shuffle partitions at least.

    So a reducer's memory does not depend on how a session is configured.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    return max(n_buckets(docs.sparkSession), -(-size // each))


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI or a plain path; file, hdfs, s3 and gs schemes alike."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def publish(uri: str, data: bytes) -> None:
    """Write a file whole under a name of its own, so that a retried or speculative task never shares one."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(data)


def fetch(uri: str, start: int = 0, length: int | None = None) -> bytes:
    """A whole file, or the byte range asked for."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        f.seek(start)
        return f.read(length) if length is not None else f.read()


def shield(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with names that no computed column has, and the new name of each old one."""
    names = [f"shielded_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names, strict=True))


def unshield(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their old names."""
    return rows.select(*[F.col(f"shielded_{i}").alias(c) for i, c in enumerate(docs.columns)])


def crc_mod(doc_id, mod: int):
    """crc32 of the id's decimal text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of 4 MB in this session, however long its texts are: they count in executors' direct memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def append_columns(df: DataFrame, column: str, make, fields: list[tuple[str, str]], keep: list[str] | None = None, kind: str | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns computed from the text ``column`` in Arrow batches.

    ``make(col)`` gets a slice of a few MB and returns one array for each of ``fields``
    (name, Spark type). Columns of ``df`` with such a name are left out. ``kind``: of ``kept_by_worker``.
    """
    bound_batches(df.sparkSession)
    names = [n for n, _ in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    need = list(dict.fromkeys([*kept, column]))
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{n}` {t}" for n, t in fields])

    def run(batches):
        for b in small_batches(batches, column, kind=kind):
            made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in make(b.column(column))]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + made, names=[*kept, *names])

    return df.select(*[F.col(f"`{c}`") for c in need]).mapInArrow(run, schema)


#: What a worker keeps between its tasks, by its kind.
_kept: dict[str, dict] = {}


def kept_by_worker(kind: str) -> dict:
    """A dictionary that a Python worker keeps between tasks of its kind."""
    return _kept.setdefault(kind, {})


def drop_kept(kind: str | None = None) -> None:
    """Let go of what this worker keeps for tasks of other kinds than ``kind``: it lives on, with another operator's cache."""
    for k, held in _kept.items():
        if k != kind:
            held.clear()


def trim() -> None:
    """Give freed memory back to the system: a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run):
    """``run`` over batches, without what other operators keep in the worker, and then ``trim``."""

    @functools.wraps(run)
    def out(batches):
        drop_kept()
        yield from run(batches)
        trim()

    return out


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20, rows: int = 20_000, kind: str | None = None) -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches so that ``column`` holds about ``limit`` bytes at most (one row at least), and to ``rows`` rows.

    What the worker keeps for tasks of other kinds than ``kind`` goes first.
    """
    import numpy as np

    drop_kept(kind)
    for b in batches:
        if b.num_rows == 0:
            continue
        a = b.column(column)
        lens = np.asarray(pc.fill_null(pc.binary_length(a), 0), dtype=np.int64)
        ends = np.cumsum(lens)
        at = 0
        while at < len(lens):
            base = ends[at - 1] if at else 0
            to = min(max(at + 1, int(np.searchsorted(ends, base + limit, "right"))), at + rows)
            yield b.slice(at, to - at)
            at = to
    trim()
