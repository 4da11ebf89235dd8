"""Source formats: image folders with JSON, record files, line JSON, archives, raw arrays; and their registry."""

from __future__ import annotations

import io
import json
import struct
import tarfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType, _parse_datatype_string

from trajlake.functions.scalars import natural_key
from trajlake.plans.ranks import numbered


def read_image_json(spark: SparkSession, root: str, state: str = "state", action: str = "action", image: str = "image") -> DataFrame:
    """Frames of episodes that are folders with metadata.json: its `frames` list, fields by dotted paths, naturally sorted.

    Unreadable documents give no frames. Fields that are missing are null.
    """
    docs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json").load(root)
    v = F.try_parse_json(F.decode("content", "UTF-8"))
    d = docs.select(F.regexp_extract("path", r"([^/]+)/metadata\.json$", 1).alias("episode"), v.alias("v")).filter("v is not null")
    number = numbered(d.select("episode").distinct(), [natural_key(F.col("episode")), "episode"], "episode_index")
    d = d.join(number, "episode")
    f = d.select("episode", "episode_index", F.try_variant_get("v", "$.language_instruction", "string").alias("instruction"), F.try_variant_get("v", "$.fps", "double").alias("fps"), F.posexplode(F.try_variant_get("v", "$.frames", "array<variant>")).alias("frame_index", "f"))
    return f.select("episode", F.col("episode_index").cast("bigint").alias("episode_index"), F.col("frame_index").cast("bigint").alias("frame_index"), "instruction", "fps", F.try_variant_get("f", f"$.{state}", "array<double>").alias("state"), F.try_variant_get("f", f"$.{action}", "array<double>").alias("action"), F.try_variant_get("f", f"$.{image}", "string").alias("image"))


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line JSON with a schema; unreadable lines come as rows whose `_corrupt` holds them."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


# --- record files: length, checksum, payload, checksum

def _varint(b: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        x = b[at]
        out, at, shift = out | (x & 127) << shift, at + 1, shift + 7
        if x < 128:
            return out, at


def _fields(b: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(number, wire type, value) of a protobuf message."""
    at = 0
    while at < len(b):
        key, at = _varint(b, at)
        kind = key & 7
        if kind == 2:
            n, at = _varint(b, at)
            value, at = b[at : at + n], at + n
        elif kind == 0:
            value, at = _varint(b, at)
        else:
            n = 8 if kind == 1 else 4
            value, at = b[at : at + n], at + n
        yield key >> 3, kind, value


def decode_example(payload: bytes) -> dict[str, list]:
    """Features of a serialised example: lists of bytes, floats or whole numbers by name."""
    out: dict[str, list] = {}
    for number, _, features in _fields(payload):
        if number != 1:
            continue
        for _, _, entry in _fields(features):
            name, value = "", b""
            for k, _, v in _fields(entry):
                name, value = (v.decode(), value) if k == 1 else (name, v)
            for kind, _, items in _fields(value):
                got: list = []
                for _, wire, x in _fields(items):
                    if kind == 1:
                        got.append(x)
                    elif kind == 2:
                        got += np.frombuffer(x, "<f4").tolist()
                    elif wire == 0:
                        got.append(x - (1 << 64) if x >> 63 else x)
                    else:
                        at = 0
                        while at < len(x):
                            y, at = _varint(x, at)
                            got.append(y - (1 << 64) if y >> 63 else y)
                out[name] = got
    return out


class RecordFile(DataSource):
    """Format `trajrecords`: path, byte_offset, length and payload of each record; a damaged end is a row without payload.

    One task reads one file; `read_records` also cuts large files.
    """

    @classmethod
    def name(cls) -> str:
        return "trajrecords"

    def schema(self) -> str:
        return _RECORD

    def reader(self, schema: StructType) -> DataSourceReader:
        return _RecordReader(self.options)


_RECORD = "path string, byte_offset bigint, length bigint, payload binary, status string"


class _Piece(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _RecordReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        import glob

        self.paths = sorted(glob.glob(options.get("path", "")))

    def partitions(self) -> Sequence[InputPartition]:
        return [_Piece(p) for p in self.paths] or [_Piece("")]

    def read(self, piece: _Piece) -> Iterator[tuple]:
        if piece.path:
            with open(piece.path, "rb") as f:
                yield from _records(f, piece.path, 0, None)


def _records(f: io.IOBase, path: str, start: int, stop: int | None) -> Iterator[tuple]:
    """Records of an open file that begin in a stretch of it."""
    end = f.seek(0, io.SEEK_END)
    at = f.seek(start)
    while at < (end if stop is None else stop):
        head = f.read(12)
        n = struct.unpack("<Q", head[:8])[0] if len(head) == 12 else -1
        if n < 0 or at + 16 + n > end:
            yield path, at, max(min(n, end), 0), None, "truncated"
            return
        body = f.read(n)
        at = f.seek(at + 16 + n)
        yield path, at - 16 - n, n, body, "pass"


def _open(path: str):
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    return system.open_input_file(at)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """A listing of files; a pattern that nothing matches gives none."""
    folder, _, pattern = path.rpartition("/")
    if any(c in pattern for c in "*?["):
        return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return spark.read.format("binaryFile").load(path)


def write_records(path: str, payloads: Sequence[bytes]) -> None:
    """Records without real checksums, for tests."""
    with open(path, "wb") as f:
        for p in payloads:
            f.write(struct.pack("<Q", len(p)) + b"\0\0\0\0" + p + b"\0\0\0\0")


def read_records(spark: SparkSession, path: str, bytes_per_task: int = 64 << 20) -> DataFrame:
    """Records of all files: tasks walk the files' length headers in parallel, cut them into pieces of about `bytes_per_task`
    at records' ends, and read the pieces; the driver only lists files."""
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, size in zip(pdf["path"], pdf["length"]):
                starts, at = [0], 0
                with _open(p) as f:
                    while at + 12 <= size:
                        f.seek(at)
                        at += 16 + struct.unpack("<Q", f.read(8))[0]
                        if at < size and at - starts[-1] >= bytes_per_task:
                            starts.append(at)
                yield pd.DataFrame({"path": p, "start": starts, "stop": [*starts[1:], size]})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, start, stop in zip(pdf["path"], pdf["start"], pdf["stop"]):
                rows, held = [], 0
                with _open(p) as f:
                    for r in _records(f, p, start, stop):
                        rows.append(r)
                        held += r[2] + 64
                        if held >= 8 << 20:
                            yield pd.DataFrame(rows, columns=["path", "byte_offset", "length", "payload", "status"])
                            rows, held = [], 0
                yield pd.DataFrame(rows, columns=["path", "byte_offset", "length", "payload", "status"])

    files = _files(spark, path).select("path", "length").repartition("path")
    pieces = files.mapInPandas(walk, "path string, start bigint, stop bigint")
    return pieces.repartition("path", "start").mapInPandas(read, _RECORD)


# --- archives and raw arrays

_MEMBERS = "path string, member string, size bigint, part int, content binary, error string"


def _members(batches: Iterator[pd.DataFrame], wanted: str, most: int) -> Iterator[pd.DataFrame]:
    import fnmatch

    columns = ["path", "member", "size", "part", "content", "error"]

    def pieces(path: str, name: str, size: int, f) -> Iterator[tuple]:
        for n in range(max(1, -(-size // most))):
            yield path, name, size, n, f.read(most), None

    def rows(path: str) -> Iterator[tuple]:
        try:
            with _open(path) as raw:
                f = io.BufferedReader(raw) if not raw.seekable() else raw
                if zipfile.is_zipfile(f):
                    with zipfile.ZipFile(f) as z:
                        for m in z.infolist():
                            if not m.is_dir() and fnmatch.fnmatch(m.filename, wanted):
                                with z.open(m) as inner:
                                    yield from pieces(path, m.filename, m.file_size, inner)
                else:
                    f.seek(0)
                    with tarfile.open(fileobj=f) as t:
                        for m in t:
                            if m.isfile() and fnmatch.fnmatch(m.name, wanted):
                                yield from pieces(path, m.name, m.size, t.extractfile(m))
        except Exception as e:  # an unreadable archive is a row
            yield path, None, None, None, None, str(e)[:200]

    for pdf in batches:
        for path in pdf["path"]:
            for r in rows(path):
                yield pd.DataFrame([r], columns=columns)


def read_archives(spark: SparkSession, path: str, wanted: str = "*", most: int = 64 << 20) -> DataFrame:
    """Members of tar and zip files in parts of at most `most` bytes, numbered from 0; archives are read as streams, nothing is
    written to disk, and no row holds more than a part."""
    files = _files(spark, path).select("path").repartition("path")
    return files.mapInPandas(lambda b: _members(b, wanted, most), _MEMBERS)


def read_raw(spark: SparkSession, path: str, dtype: str, width: int) -> DataFrame:
    """Rows of a raw array file: path, row, values. Objects (pickles) are never loaded."""
    kind = np.dtype(dtype)
    if kind.hasobject:
        raise ValueError("only plain numbers are read")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, c in zip(pdf["path"], pdf["content"]):
                x = np.load(io.BytesIO(c), allow_pickle=False).reshape(-1, width) if c[:6] == b"\x93NUMPY" else np.frombuffer(c[: len(c) // (kind.itemsize * width) * kind.itemsize * width], kind).reshape(-1, width)
                yield pd.DataFrame({"path": p, "row": np.arange(len(x)), "values": list(x.astype(float))})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, row bigint, values array<double>")


# --- registry

def _hdf5(spark: SparkSession, path: str, vectors: dict[str, str] | None = None) -> DataFrame:
    """Frames of HDF5 files, one episode each: vector fields by their paths; needs h5py."""
    try:
        import h5py  # noqa: F401
    except ImportError as e:
        raise RuntimeError("the format hdf5 needs h5py, which is not installed") from e
    fields = vectors or {"state": "observations/qpos", "action": "action"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import h5py

        for pdf in batches:
            for p, c in zip(pdf["path"], pdf["content"]):
                with h5py.File(io.BytesIO(c)) as f:
                    cols = {k: np.asarray(f[at], float).reshape(len(f[at]), -1) for k, at in fields.items()}
                if len({len(x) for x in cols.values()}) > 1:
                    raise ValueError(f"{p}: fields differ in length")
                yield pd.DataFrame({"path": p, "frame_index": np.arange(len(next(iter(cols.values())))), **{k: list(x) for k, x in cols.items()}})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, frame_index bigint, " + ", ".join(f"{k} array<double>" for k in fields))


def _rlds(spark: SparkSession, path: str, **how: object) -> DataFrame:
    """Examples of record files with their features as JSON (bytes as text where they are text)."""
    @F.pandas_udf("string")
    def decode(payload: pd.Series) -> pd.Series:
        text = lambda x: x.decode("utf-8", "replace") if isinstance(x, bytes) else x
        return pd.Series([None if p is None else json.dumps({k: [text(x) for x in v] for k, v in decode_example(p).items()}) for p in payload])

    return read_records(spark, path, **how).select("path", "byte_offset", "length", "status", decode("payload").alias("features"))


READERS: dict[str, Callable[..., DataFrame]] = {"image_json": read_image_json, "tfrecord": read_records, "rlds": _rlds, "hdf5": _hdf5, "archive": read_archives, "raw": read_raw, "jsonl": read_lines, "parquet": lambda spark, path: spark.read.parquet(path)}


def reader(name: str) -> Callable[..., DataFrame]:
    if name not in READERS:
        raise KeyError(f"unknown format {name!r}; known: {', '.join(sorted(READERS))}")
    return READERS[name]


def dump_schema(df: DataFrame) -> dict:
    """Fields and types, without reading rows."""
    return {f.name: f.dataType.simpleString() for f in df.schema}


def parse_schema(text: str) -> StructType:
    return _parse_datatype_string(text)
