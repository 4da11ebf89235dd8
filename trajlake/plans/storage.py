"""Cutting lineage and measuring sizes, both safe against lost executors."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Bytes that one broadcast may hold; larger sides are shuffled.
BROADCAST_BYTES = 32 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a temporary one only where there is one machine, an error elsewhere."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="trajlake-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and continue from there; read once, kept reliably."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _at(path: str | os.PathLike):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    text = str(path)
    return fs.FileSystem.from_uri(text if "://" in text or text.startswith("file:") else os.path.abspath(text))


def read_text(path: str | os.PathLike) -> str:
    """A small file, on whatever file system."""
    system, at = _at(path)
    with system.open_input_file(at) as f:
        return f.read().decode()


def write_text(path: str | os.PathLike, text: str) -> None:
    """Write a small file under another name first, so that readers see all of it or the old one."""
    system, at = _at(path)
    system.create_dir(os.path.dirname(at), recursive=True)
    with system.open_output_stream(f"{at}.new") as f:
        f.write(text.encode())
    system.move(f"{at}.new", at)


def exists(path: str | os.PathLike) -> bool:
    from pyarrow import fs

    system, at = _at(path)
    return system.get_file_info(at).type != fs.FileType.NotFound


def remove(path: str | os.PathLike) -> None:
    """Delete a folder, if it is there."""
    if exists(path):
        system, at = _at(path)
        system.delete_dir(at)
