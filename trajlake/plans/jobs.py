"""Work in the background: stages as plug-ins, jobs with progress, cancelling and retries, progress of streams."""

from __future__ import annotations

import threading
from collections.abc import Callable
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


class Stage(Protocol):
    """A stage of one's own: an error for input it can't take, labels of each episode, and what they come to."""

    def validate(self, frames: DataFrame) -> None: ...

    def process(self, frames: DataFrame) -> DataFrame: ...

    def aggregate(self, labels: DataFrame) -> DataFrame: ...


def run_stage(stage: Stage, frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels, totals) of a stage."""
    stage.validate(frames)
    labels = stage.process(frames)
    return labels, stage.aggregate(labels)


class Job:
    """A function on the session that runs in a thread of its own, as a group of Spark jobs that can be cancelled.

    A failed function is tried again, with the same arguments, as often as `retries` says.
    """

    def __init__(self, spark: SparkSession, name: str, work: Callable[..., Any], *args: object, retries: int = 0) -> None:
        self.spark, self.name, self.work, self.args, self.retries = spark, name, work, args, retries
        self.state, self.attempts, self.result, self.error = "waiting", 0, None, None
        self._thread = threading.Thread(target=self._run, daemon=True)

    def start(self) -> Job:
        self._thread.start()
        return self

    def _run(self) -> None:
        context = self.spark.sparkContext
        context.setJobGroup(self.name, self.name, interruptOnCancel=True)
        while self.attempts <= self.retries and self.state != "cancelled":
            self.attempts, self.state = self.attempts + 1, "running"
            try:
                self.result = self.work(self.spark, *self.args)
                self.state = "done"
                return
            except Exception as e:  # whatever the work raises is its outcome
                self.error = e
                if self.state != "cancelled":
                    self.state = "failed"

    def cancel(self) -> None:
        self.state = "cancelled"
        self.spark.sparkContext.cancelJobGroup(self.name)

    def wait(self, seconds: float | None = None) -> Job:
        self._thread.join(seconds)
        return self

    def progress(self) -> dict[str, int | str]:
        """State, and finished and all tasks of the stages that the group's jobs have now."""
        tracker, done, every = self.spark.sparkContext.statusTracker(), 0, 0
        for job in tracker.getJobIdsForGroup(self.name):
            info = tracker.getJobInfo(job)
            for stage in (tracker.getStageInfo(s) for s in (info.stageIds if info else ())):
                if stage is not None:
                    done, every = done + stage.numCompletedTasks, every + stage.numTasks
        return {"state": self.state, "attempts": self.attempts, "tasks_done": done, "tasks": every}


def stream_progress(query: StreamingQuery) -> dict[str, object]:
    """Where a stream is: batch, rows of it, rows a second, whether it still runs."""
    last = query.lastProgress
    get = (lambda k: None) if last is None else (lambda k: last.get(k) if isinstance(last, dict) else getattr(last, k, None))
    return {"active": query.isActive, "batch": get("batchId"), "rows": get("numInputRows"), "rows_per_second": get("processedRowsPerSecond")}
