"""How the modules of queries register what they have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a query under its function's name, with the SQL that gives the same rows."""
        def put(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return put


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Keys and order of frames.
KEYS, ORDER = ["dataset_uid", "episode_index"], ["frame_index"]


def frame_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Frames as often as they are stored, with short names for their vectors."""
    f = table(spark, folder, "frames")
    return f.select(*KEYS, *ORDER, "index", F.col("`observation.state`").alias("state"), "action", F.col("`observation.tcp_force`").alias("force"))


def frame_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same once each."""
    return frame_copies(spark, folder).dropDuplicates([*KEYS, *ORDER])


#: The same in SQL, as the CTE f.
FRAMES = """f as (select distinct on (dataset_uid, episode_index, frame_index) dataset_uid, episode_index, frame_index, "index",
  "observation.state" as state, action, "observation.tcp_force" as force from frames)"""
#: Long form of states and actions in SQL, as the CTE v: one row for each place.
PLACES = FRAMES + """,
v as (select dataset_uid, episode_index, frame_index, 'state' as feature, cast(unnest(range(len(state))) as int) as dimension, unnest(state) as value from f
  union all select dataset_uid, episode_index, frame_index, 'action', cast(unnest(range(len(action))) as int), unnest(action) from f)"""
