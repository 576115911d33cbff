"""Summaries of a column whose size is a parameter, whatever the data hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap(df: DataFrame, column: str, log2_bits: int) -> np.ndarray:
    """A bit for the low ``log2_bits`` bits of each value of a long column: a set
    with false positives that takes 2**log2_bits bits on the driver and executors."""
    word = F.shiftright(F.col(column), 6).bitwiseAND(F.lit((1 << (log2_bits - 6)) - 1))
    bit = F.lit(1).cast("long")
    set_bits = df.select(word.cast("int").alias("w"), F.call_function("shiftleft", bit, F.col(column).bitwiseAND(F.lit(63)).cast("int")).alias("b"))
    got = set_bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (log2_bits - 6), np.uint64)
    out[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``values`` a bitmap may hold."""
    values = values.view(np.uint64)
    word = bits[((values >> np.uint64(6)) & np.uint64(len(bits) - 1)).astype(np.int64)]
    return (word >> (values & np.uint64(63))) & np.uint64(1) == 1


def vector_rows(vector: np.ndarray, chunks: int) -> tuple[pa.Array, pa.Array]:
    """A vector as ``chunks`` rows (number, binary)."""
    parts = np.array_split(vector.astype(np.int64), chunks)
    return pa.array(range(chunks), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())


def sum_vectors(rows: DataFrame, chunk: str = "chunk", counts: str = "counts") -> np.ndarray:
    """The elementwise sum of all vectors that ``vector_rows`` made; each chunk is
    added up row by row in its own task, the driver gets one vector."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(data, np.int64)
                total[c] = total[c] + part if c in total else part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], [chunk, counts])

    summed = rows.select(chunk, counts).repartition(F.col(chunk)).mapInArrow(add, f"{chunk} int, {counts} binary").toArrow().sort_by(chunk)
    return np.concatenate([np.empty(0, np.int64), *(np.frombuffer(b, np.int64) for b in summed[counts].to_pylist())])
