"""Readings that cannot be right for their source (problem 1).

One shuffle brings the frames of an episode together, in blocks of BLOCK frames with HALO frames of their neighbours, so
even an endless episode is cut into tasks of bounded size. Two passes read that one shuffle (the plan reuses the
exchange): the first builds mergeable quantile summaries of the values and of the changes between neighbouring frames,
per source, context and dimension; the second compares every reading with the fences that the merged summaries give.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.plans.storage import BROADCAST_BYTES

BLOCK, HALO = 4096, 64
#: Points that a quantile summary keeps, values that are collected before it is made, summaries that become one.
POINTS, RAW, FAN = 512, 1 << 16, 16
#: Groups of tasks whose summaries are merged before those of all.
GROUPS = 32
#: Part of readings at either end that may differ in a dimension at rest.
REST = 0.01


def summary(values: np.ndarray, weights: np.ndarray | None = None, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """At most `points` weighted order statistics; ranks are off by at most half the total weight / points."""
    if len(values) <= points:
        return values, np.ones(len(values)) if weights is None else weights
    order = np.argsort(values, kind="stable") if weights is not None else None
    values = values[order] if order is not None else np.sort(values)
    upto = np.cumsum(weights[order]) if order is not None else np.arange(1, len(values) + 1, dtype=float)
    total = upto[-1]
    at = np.searchsorted(upto, (np.arange(points) + 0.5) * total / points)
    return values[np.minimum(at, len(values) - 1)], np.full(points, total / points)


def merged(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, weights = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(values, kind="stable")
    return values[order], weights[order]


def quantile(values: np.ndarray, weights: np.ndarray, q: float) -> float:
    """The weighted order statistic at q of sorted values; NaN for none."""
    if not len(values):
        return float("nan")
    upto = np.cumsum(weights)
    return float(values[min(np.searchsorted(upto, q * upto[-1]), len(values) - 1)])


class _Summary:
    """Grows by raw values, keeps a bounded number of points: a tree in which FAN summaries of one level become one of the next.

    Each pressing moves ranks by at most half its weight / POINTS, and a value takes part in one for each level, of which
    there are log_FAN(n / RAW). So the ranks of n values are off by at most (2 + levels) / (2 * POINTS) of n, whatever
    their order: less than 0.6 percent for 2**30 values.
    """

    def __init__(self) -> None:
        self.raw: list[np.ndarray] = []
        self.held, self.levels = 0, [[]]

    def add(self, values: np.ndarray) -> None:
        if len(values):
            self.raw.append(values)
            self.held += len(values)
            if self.held >= RAW:
                self._press()

    def _press(self) -> None:
        if self.raw:
            self.levels[0].append(summary(np.concatenate(self.raw)))
            self.raw, self.held = [], 0
        for n, parts in enumerate(self.levels):
            if len(parts) == FAN:
                if n + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[n + 1].append(summary(*merged(parts)))
                parts.clear()

    def bytes(self) -> bytes:
        self._press()
        parts = [p for level in self.levels for p in level]
        if not parts:
            return b""
        return _bytes(parts[0] if len(parts) == 1 else summary(*merged(parts)))


def _bytes(s: tuple[np.ndarray, np.ndarray]) -> bytes:
    return np.concatenate(s).astype("<f8").tobytes()


def _unpack(blobs: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(b, "<f8") for b in blobs if b]
    if not parts:
        return np.empty(0), np.empty(0)
    return merged([(p[: len(p) // 2], p[len(p) // 2 :]) for p in parts])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that hold whole (src, ctx, ep, blk) blocks of rows that arrive sorted by them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        last = {k: table[k][-1].as_py() for k in ("src", "ctx", "ep", "blk")}
        same = np.ones(table.num_rows, bool)
        for k, v in last.items():
            col = table[k]
            same &= np.asarray(col) == v if k in ("ep", "blk") else np.asarray(pa.compute.equal(col, v))
        start = table.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        rest = table.slice(start)
        if start:
            yield table.slice(0, start)
    if rest is not None:
        yield rest


def _matrix(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """[rows, widest vector] with NaN in empty places, and each row's width; null elements have no reading either."""
    arr = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    offsets = np.asarray(arr.offsets)
    width = np.diff(offsets)
    if arr.null_count:
        width = np.where(np.asarray(arr.is_valid()), width, 0)
    n, wide = len(width), int(width.max(initial=0))
    values = arr.values
    flat = values.to_numpy(zero_copy_only=False)
    out = np.full((n, wide), np.nan)
    if wide:
        full = width == wide
        if full.all():
            out[:] = flat[offsets[0] : offsets[-1]].reshape(n, wide)
        else:
            rows = np.repeat(np.arange(n), width)
            place = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            out[rows, place] = flat[np.repeat(offsets[:-1], width) + place]
    return out, width


def _runs(table: pa.Table) -> Iterator[tuple[str, str, dict]]:
    """For each (src, ctx) of a table of whole blocks: rows without repeats, and where blocks begin."""
    src = table["src"].combine_chunks().dictionary_encode()
    ctx = table["ctx"].combine_chunks().dictionary_encode()
    src, ctx = (x if isinstance(x, pa.DictionaryArray) else x.chunk(0) for x in (src, ctx))
    s, c = np.asarray(src.indices), np.asarray(ctx.indices)
    ep, blk, fr = (np.asarray(table[k]) for k in ("ep", "blk", "fr"))
    new = np.r_[True, (s[1:] != s[:-1]) | (c[1:] != c[:-1])] if len(s) else np.empty(0, bool)
    starts = np.flatnonzero(new)
    for a, b in zip(starts, np.r_[starts[1:], len(s)]):
        first = np.r_[True, (ep[a + 1 : b] != ep[a : b - 1]) | (blk[a + 1 : b] != blk[a : b - 1])]
        keep = first | np.r_[True, fr[a + 1 : b] != fr[a : b - 1]]
        yield src.dictionary[s[a]].as_py(), ctx.dictionary[c[a]].as_py(), {"rows": slice(a, b), "keep": keep, "block": np.cumsum(first), "ep": ep[a:b], "fr": fr[a:b], "own": (fr[a:b] // BLOCK) == blk[a:b]}


def _measure(features: int, gripper: tuple[bool, ...]):
    """Pass 1: a summary for each source, context, feature and dimension of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for table in _blocks(batches):
            for src, ctx, r in _runs(table):
                part = table.slice(r["rows"].start, r["rows"].stop - r["rows"].start)
                keep, block, fr, own = (r[k][r["keep"]] for k in ("keep", "block", "fr", "own"))
                next_to = np.r_[False, (block[1:] == block[:-1]) & (fr[1:] - fr[:-1] == 1)] & own
                for f in range(features):
                    x, width = _matrix(part[f"v{f}"])
                    x, width = x[r["keep"]], width[r["keep"]]
                    for d in range(x.shape[1]):
                        use = own & np.isfinite(x[:, d]) & (width > d + gripper[f])
                        if not use.any():
                            continue
                        one = held.setdefault((src, ctx, f, d), [_Summary(), _Summary(), 0])
                        one[0].add(x[use, d])
                        with np.errstate(all="ignore"):
                            step = np.abs(x[1:, d] - x[:-1, d])[next_to[1:] & use[1:]]
                        step = step[np.isfinite(step)]
                        moved = step[step > 0]
                        one[2] += len(step) - len(moved)
                        one[1].add(moved)
        if held:
            k = list(held)
            n = [held[x] for x in k]
            yield pa.RecordBatch.from_pydict({"src": [x[0] for x in k], "ctx": [x[1] for x in k], "f": pa.array([x[2] for x in k], pa.int32()), "d": pa.array([x[3] for x in k], pa.int32()), "vals": pa.array([x[0].bytes() for x in n], pa.binary()), "steps": pa.array([x[1].bytes() for x in n], pa.binary()), "still": pa.array([x[2] for x in n], pa.int64())})

    return run


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summaries of a group of tasks as one, so that no step holds those of all tasks; they arrive sorted."""
    names = ("src", "ctx", "f", "d", "part")
    at, vals, steps, still = None, [], [], 0
    one = lambda blobs: blobs[0] if len(blobs) == 1 else b"" if not len((x := _unpack(blobs))[0]) else _bytes(summary(*x))

    def row() -> tuple:
        return (*at[:4], one(vals), one(steps), still)

    for b in batches:
        out = []
        for key, v, s, n in zip(zip(*(b.column(k).to_pylist() for k in names)), b.column("vals").to_pylist(), b.column("steps").to_pylist(), b.column("still").to_pylist()):
            if key != at:
                if at is not None:
                    out.append(row())
                at, vals, steps, still = key, [], [], 0
            vals.append(v)
            steps.append(s)
            still += n
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _SUMMARIES.types)], schema=_SUMMARIES)
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(), _SUMMARIES.types)], schema=_SUMMARIES)


_SUMMARIES = pa.schema([("src", pa.string()), ("ctx", pa.string()), ("f", pa.int32()), ("d", pa.int32()), ("vals", pa.binary()), ("steps", pa.binary()), ("still", pa.int64())])


def _fences(fence: float, rate: float, moving: float):
    """From the merged summaries of a dimension: fences for its values, and for the height of an excursion."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v, w = _unpack(pdf["vals"])
        s, sw = _unpack(pdf["steps"])
        still, moved = float(pdf["still"].sum()), float(sw.sum())
        low, q1, q3, high = (quantile(v, w, q) for q in (REST, 0.25, 0.75, 1 - REST))
        moves = moved > 0 and moved >= moving * (moved + still)
        usual = quantile(s, sw, max(0.0, (0.5 * (moved + still) - still) / moved) if still < moved else 0.5) if moved else float("nan")
        # where nearly all readings are one number, the only steps are the spikes' own and can't be a measure
        reach = (q3 - q1) or (abs(q1) * 1e-6 + 1e-9 if low == high and not moves and len(v) >= 1 / REST else usual)
        lo, hi = (q1 - fence * reach, q3 + fence * reach) if reach and np.isfinite(reach) else (-np.inf, np.inf)
        return pd.DataFrame({"src": [pdf["src"].iat[0]], "ctx": [pdf["ctx"].iat[0]], "f": [pdf["f"].iat[0]], "d": [pdf["d"].iat[0]], "lo": [lo], "hi": [hi], "jump": [rate * usual if moves else float("nan")]})

    return run


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """A source's fences as bytes: feature, dimension, low, high, jump."""
    rows = pdf.sort_values(["f", "d"])
    blob = b"".join(struct.pack("<HHddf", f, d, lo, hi, j) for f, d, lo, hi, j in zip(rows["f"], rows["d"], rows["lo"], rows["hi"], rows["jump"]))
    return pd.DataFrame({"src": [pdf["src"].iat[0]], "ctx": [pdf["ctx"].iat[0]], "thr": [blob]})


_ROW = struct.calcsize("<HHddf")


def excursions(x: np.ndarray, block: np.ndarray, fr: np.ndarray, jump: float, within: int) -> np.ndarray:
    """Marks stretches of at most `within` readings that stand out by `jump` from both readings around them.

    At the begin of a block the readings that follow must do alone. Only places where neighbours differ by `jump` are
    looked at, of which a sane source has almost none.
    """
    out = np.zeros(len(x), bool)
    with np.errstate(all="ignore"):
        far = np.abs(np.diff(x)) >= jump
    edge = np.r_[True, block[1:] != block[:-1]]
    for i in np.flatnonzero(far & ~edge[1:]) + 1:
        for n in range(1, within + 1):
            j = i + n
            if j >= len(x) or edge[i + 1 : j + 1].any() or fr[j] - fr[i - 1] > 2 * within:
                break
            inside = x[i:j]
            if inside.min() - max(x[i - 1], x[j]) >= jump or min(x[i - 1], x[j]) - inside.max() >= jump:
                out[i:j] = True
        head = i
        while head > 0 and not edge[head] and i - head < within:
            head -= 1
        if edge[head] and i - head <= within and not (edge[i + 1 : i + 3].any()) and i + 2 < len(x):
            inside, after = x[head:i], x[i : i + 3]
            if inside.min() - after.max() >= jump or after.min() - inside.max() >= jump:
                out[head:i] = True
    return out


def stuck_runs(x: np.ndarray, block: np.ndarray, least: int) -> np.ndarray:
    """Marks `least` or more readings in a row that are exactly equal."""
    begin = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (block[1:] != block[:-1])]) if len(x) else np.empty(0, int)
    length = np.diff(np.r_[begin, len(x)])
    return np.repeat(length >= least, length)


def _flag(names: tuple[str, ...], gripper: tuple[bool, ...], within: int, stuck: int, schema: pa.Schema):
    """Pass 2: the cases of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            cols: list[list] = [[] for _ in range(7)]
            for src, _ctx, r in _runs(table):
                a = r["rows"].start
                part = table.slice(a, r["rows"].stop - a)
                blob = table["thr"][a].as_py() or b""
                fences = {x[:2]: x[2:] for x in struct.iter_unpack("<HHddf", blob)}
                keep = r["keep"]
                block, fr, own, ep = (r[k][keep] for k in ("block", "fr", "own", "ep"))
                for f, name in enumerate(names):
                    x, width = _matrix(part[f"v{f}"])
                    valid = np.asarray(pa.compute.list_flatten(part[f"v{f}"]).is_valid()).all()
                    x, width = x[keep], width[keep]
                    there = None if valid else _there(part[f"v{f}"])[keep]
                    for d in range(x.shape[1]):
                        has = width > d + gripper[f]
                        if there is not None:
                            has &= there[:, d]
                        v = x[:, d]
                        fine = has & np.isfinite(v)
                        kind = np.where(has & ~fine, 1, 0)
                        lo, hi, jump = fences.get((f, d), (-np.inf, np.inf, np.nan))
                        kind |= np.where(fine & ((v < lo) | (v > hi)), 2, 0)
                        if np.isfinite(jump):
                            at = np.flatnonzero(fine)
                            w, b, t = v[at], block[at], fr[at]
                            kind[at] |= np.where(excursions(w, b, t, jump, within), 4, 0)
                            kind[at] |= np.where(stuck_runs(w, b, stuck), 8, 0)
                        hit = np.flatnonzero((kind > 0) & own)
                        if len(hit):
                            for c, y in zip(cols, ([src] * len(hit), ep[hit], fr[hit], [name] * len(hit), np.full(len(hit), d), v[hit], kind[hit])):
                                c.extend(y)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return run


def _there(col: pa.ChunkedArray) -> np.ndarray:
    """Which places of the matrix have an element that is not null."""
    arr = pa.concat_arrays(col.chunks)
    as_one = pa.ListArray.from_arrays(arr.offsets, pa.compute.cast(arr.values.is_valid(), pa.float64()), mask=pa.compute.is_null(arr)) if arr.null_count else pa.ListArray.from_arrays(arr.offsets, pa.compute.cast(arr.values.is_valid(), pa.float64()))
    return _matrix(pa.chunked_array([as_one]))[0] == 1


def find_spikes(
    frames: DataFrame,
    *,
    source: str = "dataset_uid",
    episode: str = "episode_index",
    frame: str = "frame_index",
    features: Sequence[str] = ("observation.state", "action", "observation.tcp_force"),
    gripper_last: Sequence[str] = ("observation.state", "action"),
    context: Column | None = None,
    fence: float = 20.0,
    rate: float = 14.0,
    within: int = 5,
    stuck: int = 12,
    moving: float = 0.1,
) -> DataFrame:
    """One row for each reading that cannot be right: source, episode, frame, feature, dimension, value and kinds.

    `kinds` is a sum: 1 not finite, 2 beyond the quartiles by more than `fence` interquartile ranges, 4 part of an
    excursion of at most `within` frames that is `rate` times higher than the median change between neighbouring
    frames, 8 part of `stuck` or more equal readings in a dimension that moves in at least `moving` of its steps.
    Quartiles and changes belong to a source, or to a source and a `context` (such as an hour) that is the same for all
    frames of an episode. In a dimension at rest, all but a hundredth of whose readings at either end are one number,
    that number with a millionth of it takes the place of the quartiles' range. The last place of the features in `gripper_last` is never looked at.

    Rows without source, episode or frame number are left out; null vectors and null elements are no cases; repeated
    rows of a frame count once (of differing ones the first by value); vectors may have any width, also within a source.
    An empty table gives an empty result, and other columns of the table do not matter.
    """
    q = lambda c: F.col(f"`{c}`")
    names, gripper = tuple(features), tuple(f in set(gripper_last) for f in features)
    fr = q(frame).cast("bigint")
    # not a literal, which the optimizer would drop from one of the two passes, so that they could not share a shuffle
    none = F.substring(q(source).cast("string"), 1, 0)
    rows = frames.filter(q(source).isNotNull() & q(episode).isNotNull() & q(frame).isNotNull()).select(
        q(source).cast("string").alias("src"), (none if context is None else F.coalesce(context.cast("string"), none)).alias("ctx"), q(episode).cast("bigint").alias("ep"), fr.alias("fr"), *(q(f).cast("array<double>").alias(f"v{n}") for n, f in enumerate(names))
    )
    sizes = rows.agg(F.count_distinct("src", "ctx").alias("keys"), *(F.max(F.size(f"v{n}")).alias(f"w{n}") for n in range(len(names)))).first()
    packed = sizes["keys"] * (200 + _ROW * sum(max(0, sizes[f"w{n}"] or 0) for n in range(len(names))))

    low = F.floor((F.col("fr") - HALO) / BLOCK)
    low = F.when(F.col("fr") >= 0, F.greatest(low, F.lit(0))).otherwise(low)  # no block before an episode's begin
    blocks = F.sequence(low, F.floor((F.col("fr") + HALO) / BLOCK))
    order = ["src", "ctx", "ep", "blk", "fr"]
    placed = rows.select("*", F.explode(blocks).alias("blk")).repartition("src", "ctx", "ep", "blk")
    measured = placed.sortWithinPartitions(*order).mapInArrow(_measure(len(names), gripper), "src string, ctx string, f int, d int, vals binary, steps binary, still bigint")
    kind = ["src", "ctx", "f", "d"]
    grouped = measured.withColumn("part", F.spark_partition_id() % GROUPS).repartition(*kind, "part").sortWithinPartitions(*kind, "part").mapInArrow(_combine, measured.schema)
    fences = grouped.groupBy(*kind).applyInPandas(_fences(fence, rate, moving), "src string, ctx string, f int, d int, lo double, hi double, jump double")
    packs = fences.groupBy("src", "ctx").applyInPandas(_pack, "src string, ctx string, thr binary")
    side = F.broadcast(packs) if packed <= BROADCAST_BYTES else packs.hint("merge")
    schema = pa.schema([(source, pa.string()), (episode, pa.int64()), (frame, pa.int64()), ("feature", pa.string()), ("dimension", pa.int32()), ("value", pa.float64()), ("kinds", pa.int32())])
    out = ", ".join(f"`{n}` {t}" for n, t in ((source, "string"), (episode, "bigint"), (frame, "bigint"), ("feature", "string"), ("dimension", "int"), ("value", "double"), ("kinds", "int")))
    # a left join: an inner one would put a filter below one of the two exchanges, so that they would not be shared
    return placed.join(side, ["src", "ctx"], "left").sortWithinPartitions(*order).mapInArrow(_flag(names, gripper, within, stuck, schema), out)
