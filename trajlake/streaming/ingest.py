"""Streams: snapshots that arrive as files, upserts and tombstones, episodes folded as their frames arrive."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from trajlake.plans.catalog import upsert
from trajlake.plans.storage import exists, read_text, remove, write_text

#: Rows of a stage: keys, verdict, a version that rises, and whether the row is taken back.
STAGE_ROWS = "dataset_uid string, episode_index bigint, stage_id int, verdict string, version bigint, deleted boolean"
KEYS = ["dataset_uid", "episode_index", "stage_id"]


#: Parts of a state by the hash of its keys; a batch rewrites only those that it touches.
BUCKETS = 64


def _pointer(table: str) -> dict:
    path = f"{table}/current.json"
    return json.loads(read_text(path)) if exists(path) else {"batch": -1, "buckets": {}}


def current(spark: SparkSession, table: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows that hold now, of all or some buckets: the folders that the pointer names; empty before the first batch."""
    have = {int(k): p for k, p in _pointer(table)["buckets"].items()}
    paths = sorted(p for k, p in have.items() if buckets is None or k in buckets)
    return spark.read.schema(STAGE_ROWS).parquet(*paths) if paths else spark.createDataFrame([], STAGE_ROWS)


def apply_batch(spark: SparkSession, table: str, batch: DataFrame, batch_id: int) -> None:
    """Replace rows by newer versions and drop those taken back; a batch that was applied before changes nothing.

    Only the buckets of the batch's keys are read and written anew, and a pointer is swapped last, so readers see whole
    batches; what neither the new nor the last pointer names is removed. A tombstone stays in the state as a deleted
    row, so that an older version that comes late cannot return.
    """
    was = _pointer(table)
    if batch_id <= was["batch"]:
        return
    bucket = F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("int")
    newest = batch.groupBy(*KEYS).agg(F.max_by(F.struct("verdict", "version", "deleted"), F.struct("version", F.coalesce("deleted", F.lit(False)), "verdict")).alias("r")).select(*KEYS, "r.*").persist()
    touched = sorted(r[0] for r in newest.select(bucket).distinct().collect())  # at most BUCKETS
    old = current(spark, table, touched)
    fresh = newest.join(old.select(*KEYS, F.col("version").alias("__v")), KEYS, "left").filter(F.col("__v").isNull() | (F.col("version") >= F.col("__v"))).drop("__v")
    path = f"{table}/state-{batch_id:010d}"
    upsert(old, fresh, KEYS).withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    newest.unpersist()
    now = {"batch": batch_id, "buckets": {**was["buckets"], **{str(k): f"{path}/bucket={k}" for k in touched}}, "last": was["buckets"]}
    write_text(f"{table}/current.json", json.dumps(now))
    kept = {*now["buckets"].values(), *was["buckets"].values()}
    for p in set(was.get("last", {}).values()) - kept:
        remove(p)


def visible(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.coalesce("deleted", F.lit(False))).drop("deleted")


def ingest(spark: SparkSession, source: str, table: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Follow a folder of Parquet files of STAGE_ROWS until it is read, in batches of bounded size; exactly once."""
    stream = spark.readStream.schema(STAGE_ROWS).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(lambda df, n: apply_batch(spark, table, df, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _Fold(StatefulProcessor):
    """Counts and last times of the episode that a dataset is at; emits it when the next one begins."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("episode", "episode_index bigint, frames bigint, first double, last double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        every = pd.concat(rows).sort_values(["episode_index", "frame_index"], kind="stable")
        at = self.state.get() if self.state.exists() else None
        out = []
        for e, part in every.groupby("episode_index", sort=True):
            first, last, n = float(part["time"].min()), float(part["time"].max()), len(part)
            if at is not None and at[0] == e:
                at = (int(e), at[1] + n, min(at[2], first), max(at[3], last))
            else:
                if at is not None:
                    out.append((key[0], *at))
                at = (int(e), n, first, last)
        self.state.update(at)
        yield pd.DataFrame(out, columns=["dataset_uid", "episode_index", "frames", "first", "last"])

    def close(self) -> None:
        pass


def fold_episodes(frames: DataFrame) -> DataFrame:
    """Finished episodes of a stream of (dataset_uid, episode_index, frame_index, time): frames, first and last time.

    An episode is finished when its dataset's next one begins; the last stays in the state. Needs RocksDB state.
    """
    return frames.groupBy("dataset_uid").transformWithStateInPandas(_Fold(), "dataset_uid string, episode_index bigint, frames bigint, first double, last double", "append", "none")


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their sum by window and type; later than `late` they are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "events", "total")
