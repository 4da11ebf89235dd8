"""References to records that do not exist (problem 6)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.plans.skew import skew_join
from trajlake.plans.storage import cut


@dataclass(frozen=True)
class Reference:
    """`child.columns` point to `parent.parent_columns`, which are unique in the parent.

    `name` is the field that is reported. `carry` are columns of the parent, and `holds` is a condition on the child's
    columns and on them (as `parent__x`) that a reference needs besides existing. `unless` names a reference of the same
    child: a row that is a direct orphan by that one is not reported by this one.
    """

    child: str
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    carry: tuple[str, ...] = ()
    holds: Column | None = None
    unless: str | None = None


@dataclass
class Table:
    """A table of the graph: its rows, the column with the reported key, and the column with the period."""

    rows: DataFrame
    key: str
    period: str


def _attach(rows: DataFrame, ref: Reference, parent: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Left join on the reference, hot keys apart; `parent__found` is null where nothing is."""
    names = [f"__r{n}" for n in range(len(ref.columns))]
    side = parent.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(ref.parent_columns, names)), *(F.col(f"`{c}`").alias(f"parent__{c}") for c in [*ref.carry, *extra]), F.lit(True).alias("parent__found"))
    side = side.dropna(subset=names)
    left = rows.select("*", *(F.col(f"`{c}`").alias(n) for c, n in zip(ref.columns, names)))
    return skew_join(left, side, names).drop(*names)


def find_orphans(tables: dict[str, Table], references: Sequence[Reference]) -> DataFrame:
    """Orphans: table_name, record_key, field_name, period, kind (`direct` or `inherited`), and its distance from a direct one.

    A row is a direct orphan by a reference whose columns are all non-null and which finds no parent (or one for which
    `holds` fails). Then the children of orphans are found by semi-joins down the graph, and theirs, until a round finds
    no row that is new: these are inherited orphans, reported once for each reference by which they inherit, at the
    least distance. A null in a reference's columns refers to nothing and is no orphan. Cycles end, since a row is
    orphaned once. Repeated rows with one key give one row. Rows without a key are left out.
    """
    found: DataFrame | None = None
    for name, t in tables.items():
        rows = t.rows.filter(F.col(f"`{t.key}`").isNotNull())
        bad: dict[str, Column] = {}
        own = [r for r in references if r.child == name]
        for n, ref in enumerate(own):
            rows = _attach(rows, ref, tables[ref.parent].rows, [])
            given = F.lit(True)
            for c in ref.columns:
                given = given & F.col(f"`{c}`").isNotNull()
            fails = F.col("parent__found").isNull()
            if ref.holds is not None:
                fails = fails | ~F.coalesce(ref.holds, F.lit(False))
            wrong = given & fails
            if ref.unless:
                wrong = wrong & ~F.col(f"__bad_{ref.unless}")
            rows = rows.withColumn(f"__bad_{ref.name}", wrong).drop("parent__found", *(f"parent__{c}" for c in ref.carry))
            bad[ref.name] = F.col(f"__bad_{ref.name}")
            if n + 1 < len(own):
                rows = cut(rows)  # the next join reads them for hot, other and null keys apart
        if bad:
            names = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in bad.items())), lambda x: x.isNotNull())
            part = rows.select(F.lit(name).alias("table_name"), F.col(f"`{t.key}`").cast("string").alias("record_key"), F.explode(names).alias("field_name"), F.col(f"`{t.period}`").alias("period"))
            found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no reference given")
    direct = found.groupBy("table_name", "record_key", "field_name").agg(F.min("period").alias("period"))
    every = cut(direct.withColumn("distance", F.lit(0)))
    newest, distance = every, 0
    inherits = [r for r in references if any(x.child == r.parent for x in references)]
    while inherits and newest.limit(1).count():
        distance += 1
        step: DataFrame | None = None
        for ref in inherits:
            t, p = tables[ref.child], tables[ref.parent]
            sick = newest.filter(F.col("table_name") == ref.parent).select("record_key").distinct()
            keyed = p.rows.withColumn("record_key", F.col(f"`{p.key}`").cast("string")).join(sick, "record_key", "left_semi").select(*(F.col(f"`{c}`") for c in ref.parent_columns)).distinct()
            rows = _attach(t.rows, Reference(ref.child, ref.name, ref.columns, ref.parent, ref.parent_columns), keyed, []).filter("parent__found")
            part = rows.select(F.lit(ref.child).alias("table_name"), F.col(f"`{t.key}`").cast("string").alias("record_key"), F.lit(ref.name).alias("field_name"), F.col(f"`{t.period}`").alias("period"))
            step = part if step is None else step.unionByName(part)
        step = step.filter("record_key is not null").groupBy("table_name", "record_key", "field_name").agg(F.min("period").alias("period"))
        newest = cut(step.join(every.select("table_name", "record_key", "field_name"), ["table_name", "record_key", "field_name"], "left_anti").withColumn("distance", F.lit(distance)))
        every = cut(every.unionByName(newest))
    return every.withColumn("kind", F.when(F.col("distance") == 0, "direct").otherwise("inherited"))
