"""Filters of bounded size over 64-bit hashes, built by tasks and sent to tasks; a fuller one only lets more rows pass.

A filter has about sixteen bits a value, up to ``FILTER_BITS``; of more values than it could tell apart there is none,
and all rows pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 26
#: Tasks, or groups of them, whose bits meet in one group.
FAN = 64
#: Bits that travel together.
PIECE = 1 << 19


def filter_bits(values: DataFrame) -> np.ndarray | None:
    """Two bits per value of a written table of one column; None where there are too many values for a filter."""
    n = values.count()
    if 2 * n > FILTER_BITS:
        return None
    size = PIECE
    while size < min(16 * n, FILTER_BITS):
        size *= 2

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        own = np.zeros(size // 8, dtype=np.uint8)
        for batch in batches:
            for p in _places(batch.column(0).to_numpy(), size):
                np.bitwise_or.at(own, p >> 3, np.left_shift(1, p & 7).astype(np.uint8))
        some = [k for k in range(size // PIECE) if own[k * PIECE // 8 : (k + 1) * PIECE // 8].any()]
        bits = [own[k * PIECE // 8 : (k + 1) * PIECE // 8].tobytes() for k in some]
        part = [TaskContext.get().partitionId()] * len(some)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(part, pa.int32()), pa.array(bits, pa.binary())], names=["k", "part", "bits"])

    def either(table):
        import pyarrow as pa

        out = np.zeros(PIECE // 8, dtype=np.uint8)
        for x in table.column("bits"):
            out |= np.frombuffer(x.as_buffer(), dtype=np.uint8)
        return pa.table({"k": table.column("k").slice(0, 1), "part": table.column("part").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    found = values.mapInArrow(run, "k int, part int, bits binary")
    for _ in range(3):  # FAN tasks' bits, then those of FAN such groups, and so on
        found = found.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("k", "part").applyInArrow(either, "k int, part int, bits binary")
    out = np.zeros(size // 8, dtype=np.uint8)
    for r in found.collect():
        out[r["k"] * PIECE // 8 : (r["k"] + 1) * PIECE // 8] |= np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def hits(bits: np.ndarray | None, values: np.ndarray) -> np.ndarray:
    """Where the values pass."""
    if bits is None:
        return np.arange(len(values))
    first, second = _places(values, 8 * len(bits))
    some = np.flatnonzero(_set(bits, first))
    return some[_set(bits, second[some])]


def _places(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    v, mask = values.view(np.uint64), np.uint64(size - 1)
    return (v & mask).astype(np.int64), ((v >> np.uint64(30)) & mask).astype(np.int64)


def _set(bits: np.ndarray, p: np.ndarray) -> np.ndarray:
    return (bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def passing(found: DataFrame, column: str, bits: np.ndarray | None) -> DataFrame:
    """Rows whose column passes the filter, which spares the others a shuffle."""
    if bits is None:
        return found
    spread = found.sparkSession.sparkContext.broadcast(bits)
    at = found.columns.index(column)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.take(pa.array(hits(spread.value, batch.column(at).to_numpy())))

    return found.mapInArrow(run, found.schema)
