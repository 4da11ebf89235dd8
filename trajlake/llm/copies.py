"""Records that differ only in how they are written (problem 3).

Bloom filters find the records that may have a copy; only these are shuffled and grouped exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.functions.text import canonical_json, word_array
from trajlake.plans.skew import skew_join
from trajlake.plans.storage import cut

#: Bits of a filter for each record, least bits of a filter, bits of a slice (32 MB: what a task or the driver holds at
#: once), bits of a segment, hashes put in at once.
BITS_PER_ROW, LEAST_BITS, SLICE, SEGMENT, AT_ONCE = 16, 1 << 16, 1 << 28, 1 << 16, 1 << 21


def probes(h: np.ndarray, bits: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each 64-bit hash in a filter of `bits` bits, both in one slice of `size` bits (powers of 2)."""
    u = h.view(np.uint64)
    second = (u ^ (u >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    first, inside = u & np.uint64(bits - 1), np.uint64(size - 1)
    return first.astype(np.int64), ((first & ~inside) | ((second >> np.uint64(20)) & inside)).astype(np.int64)


def _pack(places: np.ndarray) -> bytes:
    """A segment's set places: 2 bytes each while they are few, else its bits."""
    if len(places) <= SEGMENT // 16:
        return b"s" + places.astype("<u2").tobytes()
    bits = np.zeros(SEGMENT, bool)
    bits[places] = True
    return b"d" + np.packbits(bits).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    if blob[:1] == b"s":
        bits = np.zeros(SEGMENT, bool)
        bits[np.frombuffer(blob, "<u2", offset=1)] = True
        return np.packbits(bits)
    return np.frombuffer(blob, np.uint8, offset=1)


def _filters(bits: int, size: int):
    """For each piece of a split the segments of two filters: hashes seen once in it, and repeatedly."""

    def emit(h: np.ndarray) -> pa.RecordBatch:
        own, n = np.unique(h, return_counts=True)
        place: list[np.ndarray] = []
        for some in (own[n == 1], own[n > 1]):
            place.append(np.unique(np.concatenate(probes(some, bits, size))) if len(some) else np.empty(0, np.int64))
        seg = np.unique(np.concatenate([p // SEGMENT for p in place]))
        cuts = [np.searchsorted(p, np.r_[seg, seg[-1:] + 1] * SEGMENT) for p in place]
        part = [[_pack(p[c[i] : np.searchsorted(p, (s + 1) * SEGMENT)] % SEGMENT) for i, s in enumerate(seg)] for p, c in zip(place, cuts)]
        return pa.RecordBatch.from_arrays([pa.array(seg, pa.int64()), *(pa.array(x, pa.binary()) for x in part)], ["segment", "once", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            held.append(np.asarray(b.column(0)))
            if sum(map(len, held)) >= AT_ONCE:
                yield emit(np.concatenate(held))
                held = []
        if sum(map(len, held)):
            yield emit(np.concatenate(held))

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments that arrive sorted: what two pieces have seen once each has been seen again."""
    at, once, again = None, None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([again.tobytes()], pa.binary())], ["segment", "again"])
    for b in batches:
        for seg, o, a in zip(b.column("segment").to_pylist(), b.column("once").to_pylist(), b.column("again").to_pylist()):
            o, a = _unpack(o), _unpack(a)
            if seg != at:
                if at is not None:
                    yield row()
                at, once, again = seg, o.copy(), a.copy()
            else:
                again |= a | (once & o)
                once |= o
    if at is not None:
        yield row()


def _may_repeat(slices: list, bits: int, size: int):
    """Marks hashes that the filter holds; records come sorted by slice, so a task has one slice in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, again = -1, np.empty(0, np.uint8)
        bit = lambda p: (again[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1
        for b in batches:
            one, two = probes(np.asarray(b.column("h")), bits, size)
            at, maybe = one // size, np.zeros(len(one), bool)
            for n in np.unique(at).tolist():
                if n != held:
                    if held >= 0:
                        vars(slices[held]).pop("_value", None)  # a worker keeps a broadcast's value otherwise
                    held, again = n, np.frombuffer(slices[n].value, np.uint8)
                here = at == n
                maybe[here] = (bit(one[here] - n * size) & bit(two[here] - n * size)).astype(bool)
            yield b.append_column("maybe", pa.array(maybe))

    return run


def collapse_copies(rows: DataFrame, record: Column, exact: Sequence[Column], text: Column, document: Column | None, group: Column) -> DataFrame:
    """One row for each distinct record: group_key, record_id, keep_id (the smallest id of its copies) and copies.

    Records are copies when `exact` columns, the words of `text` and the JSON `document` are equal; null equals null.
    JSON is compared by keys and values in whatever order of keys (2.0 equals 2); what can't be parsed is compared as
    written. Texts without words (null, empty, only marks) never are copies. Repeated rows of an id count once; rows
    without id are left out; an id delivered in two versions stands once for each version.

    Two passes read the records' hashes. The first puts them into Bloom filters of what each split sees once and
    repeatedly, and merges these: a hash that two splits have seen once has been seen again. Records outside the merged
    filter are certain to be single and are not shuffled; the others are grouped by a 256-bit digest. The filter has 16
    bits for each record, whatever their number. It lies in slices of at most 32 MB, broadcast one by one; tasks sort
    their records by slice and hold one slice at a time.
    """
    words = word_array(text)
    none = F.size(words) == 0
    parts = [F.to_json(F.struct(*(c.alias(f"c{n}") for n, c in enumerate(exact)))), F.array_join(words, " "), F.coalesce(canonical_json(document), F.lit("\x00")) if document is not None else F.lit("")]
    # a record without words gets a form of its own, so it is a copy of nothing but its own repetition
    form = F.concat_ws("\x1f", *parts, F.when(none, F.concat(F.lit("id "), record.cast("string"))).otherwise(F.lit("")))
    plain = rows.select(group.alias("group_key"), record.alias("record_id"), form.alias("form")).filter("record_id is not null")
    hashed = cut(plain.select("group_key", "record_id", F.xxhash64("form").alias("h"), F.unhex(F.sha2("form", 256)).alias("digest")))
    spark, n = hashed.sparkSession, hashed.count()
    bits = max(LEAST_BITS, 1 << (BITS_PER_ROW * n - 1).bit_length())
    size = min(bits, SLICE)
    pieces = hashed.select("h").mapInArrow(_filters(bits, size), "segment bigint, once binary, again binary")
    merged = cut(pieces.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment bigint, again binary"))
    slices = []
    for part in range(bits // size):
        whole, first = np.zeros(size // 8, np.uint8), part * (size // SEGMENT)
        for r in merged.filter(F.col("segment").between(first, first + size // SEGMENT - 1)).collect():  # one slice: at most 32 MB
            at = (r["segment"] - first) * SEGMENT // 8
            whole[at : at + SEGMENT // 8] = np.frombuffer(r["again"], np.uint8)
        slices.append(spark.sparkContext.broadcast(whole.tobytes()))
    by_slice = hashed.sortWithinPartitions(F.shiftright(F.col("h").bitwiseAND(F.lit(bits - 1)), size.bit_length() - 1))
    marked = by_slice.mapInArrow(_may_repeat(slices, bits, size), T.StructType([*hashed.schema.fields, T.StructField("maybe", T.BooleanType())]))
    single = marked.filter("not maybe").select("group_key", "record_id", F.col("record_id").alias("keep_id"), F.lit(1).cast("bigint").alias("copies"))
    repeats = cut(marked.filter("maybe").select("group_key", "record_id", "digest").distinct())
    groups = repeats.groupBy("digest").agg(F.min("record_id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
    return skew_join(repeats, groups, ["digest"]).select("group_key", "record_id", "keep_id", "copies").unionByName(single)
