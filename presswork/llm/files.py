"""Files that tasks write and read themselves, in the shared folder of the session.

A task writes under a name of its own and reports the file as a row. Only the rows that Spark
commits are read later, so a file left by a task that was lost or repeated is never used.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from presswork.plans.stage import stage_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, as a URI or path that ``open_out`` takes."""
    return f"{stage_folder(spark)}/{label}-{uuid.uuid4().hex}"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:") :]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def new_file(folder: str, suffix: str) -> str:
    """Name of a file that no other task uses."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def open_out(path: str):
    fs, place = filesystem(path)
    fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(place, compression=None)


def open_in(path: str):
    """Sequential input."""
    fs, place = filesystem(path)
    return fs.open_input_stream(place, compression=None)


def open_random(path: str):
    """Random access; a local file is mapped into memory, so nothing is copied."""
    import pyarrow as pa

    fs, place = filesystem(path)
    return pa.memory_map(place) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(place)
