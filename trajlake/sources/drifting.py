"""Parquet files whose columns differ, read into one consistent table."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.operators.schema_drift import compare
from trajlake.plans.ordered import previous
from trajlake.plans.storage import cut

#: Spark's types as an ordered lattice of whole and floating numbers; everything else meets in string.
_WHOLE = ["tinyint", "smallint", "int", "bigint"]
_FLOAT = ["float", "double"]


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of a decimal or whole type."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return {"tinyint": (3, 0), "smallint": (5, 0), "int": (10, 0), "bigint": (19, 0)}.get(t.simpleString())


def promote_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest Spark type that holds both: numbers widen, arrays, maps and structs by their parts, else string.

    A bigint or decimal and a float meet in double, which may lose digits (`loses`).
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    x, y = a.simpleString(), b.simpleString()
    number = lambda t, n: n in _WHOLE + _FLOAT or isinstance(t, T.DecimalType)
    if x == "boolean" and number(b, y):
        return b
    if y == "boolean" and number(a, x):
        return a
    if number(a, x) and number(b, y):
        if x in _WHOLE and y in _WHOLE:
            return a if _WHOLE.index(x) >= _WHOLE.index(y) else b
        if x in _FLOAT or y in _FLOAT:
            return T.FloatType() if {x, y} <= {"tinyint", "smallint", "float"} else T.DoubleType()
        (before, after), (before_b, after_b) = _decimal(a), _decimal(b)
        before, after = max(before, before_b), max(after, after_b)
        return T.DecimalType(before + after, after) if before + after <= 38 else T.StringType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(promote_types(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(promote_types(a.keyType, b.keyType), promote_types(a.valueType, b.valueType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        mine, other = {f.name: f.dataType for f in a}, {f.name: f.dataType for f in b}
        return T.StructType([T.StructField(n, promote_types(mine.get(n, T.NullType()), other.get(n, T.NullType()))) for n in sorted({*mine, *other})])
    if {x, y} <= {"date", "timestamp", "timestamp_ntz"}:
        return T.TimestampType() if "timestamp" in (x, y) else T.TimestampNTZType()
    return T.StringType()


def loses(source: T.DataType, target: T.DataType) -> bool:
    """Whether a cast to a promoted type can lose digits."""
    return target.simpleString() in _FLOAT and (source.simpleString() == "bigint" or isinstance(source, T.DecimalType))


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_file(at) as f:
                    out.append((path, from_arrow_schema(pq.read_schema(f)).json(), None))
            except Exception as e:  # a broken file is reported, not fatal
                out.append((path, None, str(e)[:200]))
        yield pd.DataFrame(out, columns=["path", "schema", "error"])


def read_headers(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """path, schema (JSON) and error of each file: only footers are read, in parallel."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path")
    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(_headers, "path string, schema string, error string")


def read_drifting(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> tuple[DataFrame, DataFrame]:
    """(all rows of all files under the union of their columns, the differences in the order of folders and files).

    Files are read once for each distinct schema, of which the driver holds the list; each column is cast to its
    promoted type, a column that a file lacks is null. Unreadable files are named in the differences. A folder without
    readable files gives an empty table without columns.
    """
    headers = cut(read_headers(spark, folder, pattern))
    kinds = headers.filter("schema is not null").groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy(F.col("paths")[0]).collect()
    parsed = [(T.StructType.fromJson(json.loads(k["schema"])), k["paths"]) for k in kinds]
    union: dict[str, T.DataType] = {}
    for schema, _ in parsed:
        for f in schema:
            union[f.name] = promote_types(union.get(f.name, T.NullType()), f.dataType)
    out = None
    for schema, paths in parsed:
        part = spark.read.schema(schema).parquet(*paths)
        have = set(schema.names)
        part = part.select(*((F.col(f"`{n}`") if n in have else F.lit(None)).cast(t).alias(n) for n, t in union.items()))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], T.StructType([]))
    return out, _differences(headers, union)


_LOG = "path string, field_name string, change string, new_name string, old_type string, new_type string"


def _differences(headers: DataFrame, union: dict[str, T.DataType]) -> DataFrame:
    """Changes from each readable file to the next by path, casts that can lose digits, and unreadable files."""
    fields = lambda s: [(f.name, f.dataType.simpleString(), "") for f in T.StructType.fromJson(json.loads(s))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, schema, was, error in zip(pdf["path"], pdf["schema"], pdf["was"], pdf["error"]):
                if error is not None:
                    rows.append((path, None, "unreadable", None, None, error))
                    continue
                if was is not None and was != schema:
                    rows += [(path, *c) for c in compare(fields(was), fields(schema))]
                rows += [(path, f.name, "may_lose_digits", None, f.dataType.simpleString(), union[f.name].simpleString()) for f in T.StructType.fromJson(json.loads(schema)) if loses(f.dataType, union[f.name])]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in _LOG.split(", ")])

    # files of one folder make a bucket of the order
    readable = headers.filter("schema is not null").withColumn("all", F.lit(0))
    paired = previous(readable, ["all"], ["path"], F.regexp_replace("path", "/[^/]*$", "/"), "schema", "was").drop("all")
    broken = headers.filter("schema is null").withColumn("was", F.lit(None).cast("string"))
    return paired.unionByName(broken).select("path", "schema", "was", "error").mapInPandas(run, _LOG)
