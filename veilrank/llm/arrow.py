"""Arrow batches in tasks: text columns in bounded chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Characters of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_CHARS = 4_000_000


def text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts; a null text is empty here."""
    start, chars, texts = 0, 0, []
    values = batch.column(column)
    for i in range(batch.num_rows):
        text = values[i].as_py() or ""
        if texts and chars + len(text) > CHUNK_CHARS:
            yield batch.slice(start, i - start), texts
            start, chars, texts = i, 0, []
        texts.append(text)
        chars += len(text)
    if texts:
        yield batch.slice(start), texts


def replaced(batch: pa.RecordBatch, names: list[str], arrays: list, drop: str = "text") -> pa.RecordBatch:
    """The batch with more columns at its end and without one that the caller has used up."""
    old = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != drop]
    return pa.RecordBatch.from_arrays(
        [*(c for _, c in old), *arrays], names=[*(n for n, _ in old), *names]
    )


def replaced_schema(schema: StructType, ddl: str, drop: str = "text") -> StructType:
    """The schema that goes with ``replaced``."""
    return StructType([f for f in schema.fields if f.name != drop] + StructType.fromDDL(ddl).fields)


SUMS = "block long, sums binary"


def sum_rows(total: np.ndarray, block: int) -> pa.RecordBatch:
    """A task's whole-number sums as rows of ``SUMS``, ``block`` rows of the table in each."""
    flat = np.ascontiguousarray(total, np.int64).reshape(len(total), -1)
    starts = range(0, len(flat), block)
    return pa.RecordBatch.from_arrays(
        [pa.array([i // block for i in starts], pa.int64()),
         pa.array([flat[i : i + block].tobytes() for i in starts], pa.binary())],
        names=["block", "sums"],
    )


def collect_sums(parts: DataFrame, shape: tuple[int, int], block: int) -> np.ndarray:
    """The sum of all tasks' tables.  Blocks are added where they meet, one row in hand for each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = np.frombuffer(data.as_buffer(), np.int64)
                if key in held:
                    held[key] += row
                else:
                    held[key] = row.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()),
             pa.array([r.tobytes() for r in held.values()], pa.binary())],
            names=["block", "sums"],
        )

    out = np.zeros(shape, np.int64)
    for key, data in parts.repartition("block").mapInArrow(add, SUMS).collect():
        rows = np.frombuffer(data, np.int64).reshape(-1, shape[1])
        out[key * block : key * block + len(rows)] += rows
    return out
