"""Fields that are added, removed, renamed or retyped between scans (problem 2)."""

from __future__ import annotations

import difflib
import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.functions.types import normal, promote_all
from trajlake.plans.ordered import previous
from trajlake.plans.skew import skew_join
from trajlake.plans.storage import BROADCAST_BYTES, cut

FIELD = "struct<name:string,dtype:string,shape:string>"
FIELDS = f"array<{FIELD}>"
DAY = 86400.0


def _field(name: object, spec: object) -> tuple[str, str, str] | None:
    if not isinstance(spec, dict):
        spec = {"dtype": spec if isinstance(spec, str) else ""}
    shape = spec.get("shape")
    shape = shape if isinstance(shape, list) else [] if shape is None else [shape]
    return (str(name), normal(str(spec.get("dtype") or "")), ",".join(map(str, shape)))


def parse_schema(text: str | None) -> list[tuple[str, str, str]] | None:
    """Fields (name, dtype, shape) of a schema document, sorted by name; None for what can't be read or has no field.

    Layouts: an object from names to specifications, the same under the key `features` or `fields`, or a list of
    specifications with the key `name`. Only dtype and shape count, a dtype without its letter case.
    """
    try:
        doc = json.loads(text)
    except (TypeError, ValueError, RecursionError):
        return None
    if isinstance(doc, dict):
        for k in ("features", "fields"):
            inner = doc.get(k)
            if len(doc) == 1 and (isinstance(inner, list) or isinstance(inner, dict) and not ({"dtype", "shape"} & inner.keys() and not any(isinstance(v, dict) for v in inner.values()))):
                doc = inner
                break
    if isinstance(doc, dict):
        found = {str(k): _field(k, v) for k, v in doc.items()}
    elif isinstance(doc, list):
        found = {str(x.get("name", x.get("source_key", x.get("path")))): _field(x.get("name", x.get("source_key", x.get("path"))), x) for x in doc if isinstance(x, dict)}
        found.pop("None", None)
    else:
        return None
    return sorted(found.values()) or None


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("name", "dtype", "shape")])))
def schema_fields(text: pd.Series) -> pd.Series:
    """`parse_schema` over Arrow batches."""
    return pd.Series([None if (x := parse_schema(t)) is None else [dict(zip(("name", "dtype", "shape"), y)) for y in x] for t in text], dtype=object)


def struct_fields(col: Column, name: str) -> Column:
    """The same from an array of structs (name, shape, dtype); null for none. Stays in the JVM."""
    clean = F.transform(
        F.filter(col, lambda f: f.isNotNull() & f[name].isNotNull()),
        lambda f: F.struct(f[name].alias("name"), F.coalesce(F.lower(F.regexp_replace(f["dtype"], r"\s+", "")), F.lit("")).alias("dtype"), F.coalesce(F.array_join(F.transform(f["shape"], lambda n: n.cast("string")), ","), F.lit("")).alias("shape")),
    )
    out = F.array_sort(F.array_distinct(clean))
    return F.when(F.size(out) > 0, out)


def renames(gone: Sequence[tuple[str, str, str]], come: Sequence[tuple[str, str, str]]) -> list[tuple[str, str]]:
    """Pairs (old, new) of fields of the same dtype and shape, the most similar names first, each used once.

    As many pairs as the two sides allow; equally similar ones by their names.
    """
    pairs = sorted((-difflib.SequenceMatcher(None, a[0], b[0], autojunk=False).ratio(), a[0], b[0]) for a in gone for b in come if a[1:] == b[1:])
    old, new, out = set(), set(), []
    for _, a, b in pairs:
        if a not in old and b not in new:
            old.add(a)
            new.add(b)
            out.append((a, b))
    return out


def compare(was: Sequence[tuple[str, str, str]], now: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str | None, str | None, str | None]]:
    """Changes (field, change, new name, old type, new type) from one list of fields to the next, by field."""
    a, b = {f[0]: f for f in was}, {f[0]: f for f in now}
    text = lambda f: f"{f[1]}[{f[2]}]"
    gone, come = [a[k] for k in sorted(a.keys() - b.keys())], [b[k] for k in sorted(b.keys() - a.keys())]
    pairs = renames(gone, come)
    old, new = dict(pairs), {y for _, y in pairs}
    out = [(k, "renamed", v, text(a[k]), text(b[v])) for k, v in pairs]
    out += [(f[0], "removed", None, text(f), None) for f in gone if f[0] not in old]
    out += [(f[0], "added", None, None, text(f)) for f in come if f[0] not in new]
    out += [(k, "retyped", None, text(a[k]), text(b[k])) for k in a.keys() & b.keys() if a[k][1:] != b[k][1:]]
    return sorted(out, key=lambda x: (x[0], x[1]))


_OUT = "table_name string, entity string, snapshot_id bigint, field_name string, change string, new_name string, old_type string, new_type string"


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key = lambda fields: [(f["name"], f["dtype"], f["shape"]) for f in fields]
    for pdf in batches:
        rows = [(t, e, s, *c) for t, e, s, was, now in zip(pdf["table_name"], pdf["entity"], pdf["snapshot_id"], pdf["was"], pdf["fields"]) for c in compare(key(was), key(now))]
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in _OUT.split(", ")])


def coded_fields(scans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scans with `codes`, the numbers of their fields, instead of the lists; the union of all fields by number).

    A number is the 64-bit hash of name, dtype and shape, so that lists of fields travel as short arrays. Repeated rows
    count once.
    """
    code = lambda f: F.xxhash64(f["name"], f["dtype"], f["shape"])
    fine = scans.filter("fields is not null and entity is not null").select("table_name", "entity", "snapshot_id", F.coalesce("at", F.lit(float("-inf"))).alias("at"), "fields")
    coded = fine.select("table_name", "entity", "snapshot_id", "at", F.array_sort(F.transform("fields", code)).alias("codes"))
    once = coded.groupBy("table_name", "entity", "snapshot_id", "at", F.xxhash64("codes").alias("h")).agg(F.first("codes").alias("codes"))
    union = fine.select(F.explode(F.transform("fields", lambda f: F.struct(code(f).alias("code"), f.alias("field")))).alias("x")).groupBy("x.code").agg(F.first("x.field").alias("field"))
    return once, cut(union)  # read for hot fields and for others


def schema_changes(scans: DataFrame, bucket_seconds: float = DAY) -> DataFrame:
    """Changes between each scan and the one before of its entity.

    scans: table_name, entity, snapshot_id, at (seconds) and fields (array of name, dtype, shape sorted by name; null
    where the scan can't be read). All schemas are folded into one union of fields, each scan is cast to the numbers of
    its fields there, and the differences are read off neighbouring scans. Scans without fields or entity are skipped,
    repeated rows count once, a null time comes first. Equal times follow the snapshot's number. Only fields that
    vanish or come get their names back and reach Python, which pairs renamings.
    """
    once, union = coded_fields(scans)
    bucket = F.when(F.col("at") > float("-inf"), F.floor(F.col("at") / bucket_seconds)).otherwise(F.lit(-(1 << 62)))
    paired = previous(once, ["table_name", "entity"], ["at", "snapshot_id", "codes"], bucket, "codes", "was").filter("was is not null")
    moved = lambda a, b, now: F.transform(F.array_except(a, b), lambda c: F.struct(c.alias("code"), F.lit(now).alias("now")))
    scan = ["table_name", "entity", "snapshot_id", "at", "h"]
    each = paired.select(*scan, F.inline(F.concat(moved("was", "codes", False), moved("codes", "was", True))))
    size = union.agg(F.sum(F.length(F.to_json("field")) + 64)).first()[0] or 0
    named = each.join(F.broadcast(union), "code") if size <= BROADCAST_BYTES else skew_join(cut(each), union, ["code"])
    side = lambda now: F.sort_array(F.collect_list(F.when(F.col("now") == now, F.col("field"))))
    changed = named.groupBy(*scan).agg(side(False).alias("was"), side(True).alias("fields")).select("table_name", "entity", "snapshot_id", "was", "fields")
    return changed.mapInPandas(_compare, _OUT)


@F.pandas_udf(T.StringType())
def _widest(kinds: pd.Series) -> pd.Series:
    return pd.Series([promote_all(k) for k in kinds])


def union_fields(scans: DataFrame) -> DataFrame:
    """One consistent list of fields for each entity: the promoted type, the shapes seen, first and last scan, scans.

    A field that some scans lack is optional (`in_all` false). Scans are handled as in `schema_changes`.
    """
    rows = scans.filter("fields is not null and entity is not null").dropDuplicates(["table_name", "entity", "snapshot_id", "at"])
    each = rows.select("table_name", "entity", "snapshot_id", "at", F.explode("fields").alias("f"))
    count = rows.groupBy("table_name", "entity").agg(F.count(F.lit(1)).alias("all_scans"))
    out = each.groupBy("table_name", "entity", F.col("f.name").alias("field_name")).agg(
        F.sort_array(F.collect_set("f.dtype")).alias("kinds"), F.array_join(F.sort_array(F.collect_set("f.shape")), "|").alias("shapes"), F.min("at").alias("first_seen"), F.max("at").alias("last_seen"), F.count(F.lit(1)).alias("scans")
    )
    return out.join(count, ["table_name", "entity"]).select("table_name", "entity", "field_name", _widest("kinds").alias("dtype"), "shapes", "first_seen", "last_seen", "scans", (F.col("scans") == F.col("all_scans")).alias("in_all"))
