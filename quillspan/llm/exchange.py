"""Packed rows dealt to numbered partitions, in one hop or two.

Senders of packed rows have a row for each receiver. With as many receivers as senders the rows would
grow with the square of the data, so beyond ``FAN`` receivers rows travel in two hops: a sender packs
what goes to a range of receivers into one row, and a task between them, which has a part of the
senders' rows for one range, packs one row for each receiver of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 1024


def _pack(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpack(raw: bytes) -> list[pa.RecordBatch]:
    return list(pa.ipc.open_stream(raw))


def _split(batch: pa.RecordBatch, by: np.ndarray):
    """(value of ``by``, its rows) in ascending order."""
    order = np.argsort(by, kind="stable")
    sorted_batch = batch if (order[:-1] < order[1:]).all() else batch.take(pa.array(order))
    values, first = np.unique(by[order], return_index=True)
    for v, a, b in zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(by)], strict=True):
        yield v, sorted_batch.slice(a, b - a)


def exchange(rows: DataFrame, n: int, to: str, fan: int | None = None) -> DataFrame:
    """``rows`` in ``n`` partitions: partition i has those whose integer column ``to`` is i."""
    fan = fan or FAN
    if n <= fan:
        return rows.repartitionById(n, F.col(to))
    per = -(-n // fan)  # receivers of a range, and tasks between for each range

    def first(batches):
        at = TaskContext.get().partitionId()
        for b in batches:
            if b.num_rows:
                got = [(int(c) * per + at % per, _pack(x)) for c, x in _split(b, b.column(to).to_numpy() // per)]
                at += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*got, strict=True), (pa.int32(), pa.binary()), strict=True)], names=["to", "pack"])

    def between(batches):
        held = [x for b in batches for raw in b.column("pack").to_pylist() for x in _unpack(raw)]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()
            for b in whole:
                for v, x in _split(b, b.column(to).to_numpy()):
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32()), pa.array([_pack(x)], pa.binary())], names=["to", "pack"])

    def last(batches):
        for b in batches:
            for raw in b.column("pack").to_pylist():
                yield from _unpack(raw)

    hop = "to int, pack binary"
    middle = rows.mapInArrow(first, hop).repartitionById(fan * per, F.col("to")).mapInArrow(between, hop)
    return middle.repartitionById(n, F.col("to")).mapInArrow(last, rows.schema)
