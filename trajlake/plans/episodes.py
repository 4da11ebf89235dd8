"""Whole episodes for numpy: one shuffle, Arrow batches, no pandas groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

Columns = dict[str, np.ndarray]
#: Bytes of results that a task holds before it hands them on.
HELD_BYTES = 4 << 20


def series(col: pa.ChunkedArray) -> np.ndarray:
    """[rows, places] of a list column; short or null rows are filled with NaN."""
    arr = pa.concat_arrays(col.chunks)
    offsets = np.asarray(arr.offsets)
    width = np.where(np.asarray(arr.is_valid()), np.diff(offsets), 0)
    out = np.full((len(arr), int(width.max(initial=0))), np.nan)
    flat = arr.values.to_numpy(zero_copy_only=False).astype(float)
    rows = np.repeat(np.arange(len(arr)), width)
    place = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    out[rows, place] = flat[np.repeat(offsets[:-1], width) + place]
    return out


def changes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Whether a row's keys differ from those of the row before; null equals null."""
    new = np.zeros(table.num_rows, bool)
    for k in keys:
        code = table[k].combine_chunks()
        code = code.dictionary_encode() if not isinstance(code, pa.ChunkedArray) else pa.concat_arrays(code.chunks).dictionary_encode()
        n = np.asarray(pa.compute.fill_null(code.indices, -1))
        new[1:] |= n[1:] != n[:-1]
    return new


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        cuts = [0, *np.flatnonzero(changes(table, keys)), table.num_rows]
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-2])
    if rest is not None:
        yield rest


def per_episode(frames: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], kernel: Callable[[pa.Table], dict | None], schema: str | StructType) -> DataFrame:
    """Apply `kernel` to the rows of each episode in order. It gets an Arrow table and returns columns, or None.

    Rows are shuffled once, by the keys, and sorted within tasks; a task holds one episode at a time. Null keys form an
    episode of their own. The kernel's columns come in the order of `schema`.
    """
    kind = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for table in _groups(batches, keys):
            out = kernel(table)
            if out is None:
                continue
            held.append(pa.RecordBatch.from_arrays([_column(out[f.name], f.type) for f in arrow], schema=arrow))
            size += held[-1].nbytes
            if size >= HELD_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    names = list(dict.fromkeys([*keys, *order, *columns]))
    rows = frames.select(*(F.col(f"`{n}`") for n in names)).repartition(*(F.col(f"`{k}`") for k in keys))
    return rows.sortWithinPartitions(*(F.col(f"`{n}`") for n in [*keys, *order])).mapInArrow(run, kind)


def _column(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        return pa.concat_arrays(values.chunks).cast(kind) if values.num_chunks else pa.array([], kind)
    if isinstance(values, np.ndarray) and values.ndim == 2:
        flat = pa.array(values.ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), flat).cast(kind)
    return pa.array(values, kind)
