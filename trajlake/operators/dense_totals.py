"""Results per key although a few keys hold most rows (problem 4).

Keys become dense numbers. Equal splits of the input are added up with numpy (bincount, and its scatter-reduce
relatives for least and largest) into blocks of arrays over those numbers, and equal blocks are summed across splits in
two steps. Rows are never brought together by key, so no task depends on how they spread over keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.plans.skew import HOT_PART, skew_join
from trajlake.plans.storage import BROADCAST_BYTES, cut

#: Keys in a block of the arrays, blocks that a task holds, groups of the first sum, parts into which a range is cut.
BLOCK, HELD, GROUPS, PARTS = 1024, 1024, 32, 4096
#: Bytes of a key's two ranges in a broadcast.
RANGE_BYTES = 256
_ARRAYS = ("rows", "numbers", "low", "high", "least", "most")


def _number_keys(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(code and value of each row, key of each code, number of keys)."""
    keys = cut(rows.select("key").distinct())
    spark, pid = rows.sparkSession, F.spark_partition_id()
    sizes = keys.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("key")).alias("bytes")).orderBy("pid").collect()  # a row for each partition
    starts, n = {}, 0
    for r in sizes:
        starts[r["pid"]], n = n, n + r["n"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = starts.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.arange(at, at + b.num_rows))], ["key", "code"])
            at += b.num_rows

    codes = cut(keys.mapInArrow(number, "key string, code bigint"))
    if sum(r["bytes"] or 0 for r in sizes) + 24 * n <= BROADCAST_BYTES:
        coded = rows.join(F.broadcast(codes), "key")
    else:
        coded = skew_join(rows, codes, ["key"])
    return cut(coded.select("code", "value")), codes, n


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, dict[str, np.ndarray]] = {}
    big = np.iinfo(np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        code = np.asarray(batch.column("code"))
        ok = np.asarray(pc.is_valid(batch.column("value")))
        v = np.asarray(pc.fill_null(batch.column("value"), 0)).astype(np.int64)
        own, at = np.unique(code, return_inverse=True)
        n, a, v = len(own), at[ok], v[ok]
        least, most = np.full(n, big.max), np.full(n, big.min)
        np.minimum.at(least, a, v)
        np.maximum.at(most, a, v)
        # bincount adds doubles, so a value goes in two halves whose sums stay exact
        part = {"rows": np.bincount(at, minlength=n), "numbers": np.bincount(a, minlength=n), "low": np.bincount(a, v & 0xFFFFFFFF, n).astype(np.int64), "high": np.bincount(a, v >> 32, n).astype(np.int64), "least": least, "most": most}
        block = own // BLOCK
        for b in np.unique(block):
            m, to = block == b, held.get(b)
            if to is None:
                to = held[b] = {k: np.full(BLOCK, big.max if k == "least" else big.min if k == "most" else 0) for k in _ARRAYS}
            _merge(to, own[m] % BLOCK, {k: x[m] for k, x in part.items()})
        if len(held) > HELD:
            yield _blocks(held)
            held = {}
    if held:
        yield _blocks(held)


def _merge(to: dict[str, np.ndarray], at: np.ndarray | slice, part: dict[str, np.ndarray]) -> None:
    for k in ("rows", "numbers", "low", "high"):
        to[k][at] += part[k]
    to["least"][at] = np.minimum(to["least"][at], part["least"])
    to["most"][at] = np.maximum(to["most"][at], part["most"])


def _blocks(held: dict[int, dict[str, np.ndarray]]) -> pa.RecordBatch:
    keys = list(held)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array([held[b][k].astype("<i8").tobytes() for b in keys], pa.binary()) for k in _ARRAYS)], ["block", *_ARRAYS])


def _sum_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    total: dict[str, np.ndarray] | None = None
    for row in pdf[list(_ARRAYS)].itertuples(index=False):
        part = {k: np.frombuffer(x, "<i8") for k, x in zip(_ARRAYS, row)}
        if total is None:
            total = {k: x.copy() for k, x in part.items()}
        else:
            _merge(total, slice(None), part)
    return pd.DataFrame({"block": [pdf["block"].iat[0]], "part": [0], **{k: [x.tobytes()] for k, x in total.items()}})


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            x = {k: np.frombuffer(b.column(k)[i].as_py(), "<i8") for k in _ARRAYS}
            has = np.flatnonzero(x["rows"])
            code = b.column("block")[i].as_py() * BLOCK + has
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(x["rows"][has]), pa.array(x["numbers"][has]), pa.array((x["high"][has] << 32) + x["low"][has]), pa.array(x["least"][has]), pa.array(x["most"][has])], ["code", "rows", "numbers", "total", "least", "most"])


def _ladder(v: np.ndarray) -> np.ndarray:
    """Whole numbers as unsigned ones in the same order, so that differences never overflow."""
    return v.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def _width(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (_ladder(high) - _ladder(low)) // np.uint64(PARTS) + np.uint64(1)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a split by code, half of the median and part of the half's range."""
    for b in batches:
        code, v, side = np.asarray(b.column("code")), np.asarray(b.column("value")), np.asarray(b.column("side"))
        low, high = np.asarray(b.column("low")), np.asarray(b.column("high"))
        if not len(code):
            continue
        part = ((_ladder(v) - _ladder(low)) // _width(low, high)).astype(np.int64)
        pair, at = np.unique(np.stack([code * 2 + side, part]), axis=1, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair[0] // 2), pa.array((pair[0] % 2).astype(np.int32)), pa.array(pair[1].astype(np.int32)), pa.array(np.bincount(at.ravel()))], ["code", "side", "part", "n"])


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        low, high, part = (np.asarray(b.column(k)) for k in ("low", "high", "part"))
        if not len(low):
            continue
        width = _width(low, high)
        start = _ladder(low) + part.astype(np.uint64) * width
        end = np.minimum(start + (width - np.uint64(1)), _ladder(high))
        back = lambda u: (u ^ np.uint64(1 << 63)).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("code"), b.column("side"), pa.array(back(start)), pa.array(back(end)), b.column("rank")], ["code", "side", "low", "high", "rank"])


def _medians(coded: DataFrame, totals: DataFrame, keys: int) -> DataFrame:
    """code, median: the two middle ranks are searched by cutting each key's range into PARTS parts again and again.

    Values meet the range of their key by broadcast as long as all ranges are small enough for that, else by `skew_join`:
    those of hot keys, known from their totals, by broadcast, others by shuffle.
    """
    small = keys * RANGE_BYTES <= BROADCAST_BYTES
    has = totals.filter("numbers > 0")
    every = F.broadcast(has.agg(F.sum("numbers").alias("every")))
    hot = None if small else cut(has.join(every, F.col("numbers") > F.col("every") * HOT_PART).select("code"))  # at most 1/HOT_PART keys
    ranges = has.select("code", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"), F.col("least").alias("low"), F.col("most").alias("high"), "numbers")
    ranges = cut(ranges.select("code", "side", "low", "high", F.expr("case when side = 0 then (numbers - 1) div 2 else numbers div 2 end").alias("rank")))
    values = coded.filter("value is not null")
    while ranges.filter("low < high").limit(1).count():  # at most 6 times: a range shrinks by PARTS each time
        open_ = ranges.filter("low < high")
        sides = open_.groupBy("code").agg(F.collect_list(F.struct("side", "low", "high")).alias("sides"))  # two at most
        met = values.join(F.broadcast(sides), "code") if small else skew_join(values, sides, ["code"], hot=hot)
        inside = met.select("code", "value", F.inline("sides")).filter("value between low and high")
        counts = inside.mapInArrow(_spread, "code bigint, side int, part int, n bigint").groupBy("code", "side", "part").agg(F.sum("n").alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("code", "side").orderBy("part")))
        hit = upto.join(open_.select("code", "side", "rank"), ["code", "side"]).filter("upto > rank and upto - n <= rank").select("code", "side", "part", (F.col("rank") - (F.col("upto") - F.col("n"))).alias("rank"))
        narrowed = hit.join(open_.drop("rank"), ["code", "side"]).select("code", "side", "low", "high", "part", "rank").mapInArrow(_narrow, "code bigint, side int, low bigint, high bigint, rank bigint")
        ranges = cut(narrowed.unionByName(ranges.filter("low = high")))
    return ranges.groupBy("code").agg((F.sum(F.col("low").cast("double")) / 2).alias("median"))


def dense_totals(rows: DataFrame, key: str, value: str) -> DataFrame:
    """For each key: rows, sum and exact median of a whole-number column (`total`, `median`), least and most.

    Rows with a null key are left out; null values count as rows only, and a key with nothing else has a null total and
    median. Sums wrap beyond 64 bits. An empty table gives an empty result; ties need no order.
    """
    plain = rows.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{value}`").cast("bigint").alias("value")).filter("key is not null")
    coded, codes, n = _number_keys(plain)
    schema = "block bigint, part int, " + ", ".join(f"{k} binary" for k in _ARRAYS)
    blocks = coded.mapInArrow(_add_up, "block bigint, " + ", ".join(f"{k} binary" for k in _ARRAYS)).withColumn("part", F.spark_partition_id() % GROUPS)
    blocks = blocks.groupBy("block", "part").applyInPandas(_sum_blocks, schema).groupBy("block").applyInPandas(_sum_blocks, schema)
    totals = cut(blocks.mapInArrow(_open, "code bigint, rows bigint, numbers bigint, total bigint, least bigint, most bigint"))
    out = totals.join(_medians(coded, totals, n), "code", "left").join(codes, "code")
    some = F.col("numbers") > 0
    return out.select(F.col("key").alias(key), "rows", *(F.when(some, F.col(c)).alias(c) for c in ("total", "median", "least", "most")))
