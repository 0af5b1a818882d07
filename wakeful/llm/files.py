"""Binary files in the shared folder, written and range-read inside tasks.

The folder is the one that ``spark.checkpoint.dir`` names; any store that Arrow's
file systems know (local, HDFS, S3, GCS) will do. A task writes files of its own
names and returns them in rows: only rows of attempts that Spark committed are read
later, so files of lost or repeated attempts are never looked at.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from wakeful.llm.common import scratch_path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI; tasks create it when they write."""
    return re.sub(r"^file:/(?!/)", "file:///", scratch_path(spark, name))


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def create(folder: str, stem: str, suffix: str):
    """(URI, output stream) of a new file in ``folder``."""
    uri = f"{folder}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"
    store, path = _store(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, store.open_output_stream(path)


def open_random(uri: str):
    """A file for range reads."""
    store, path = _store(uri)
    return store.open_input_file(path)


def read_at(file, offset: int, length: int) -> bytes:
    data = file.read_at(length, offset)
    if len(data) != length:
        raise OSError(f"{length} bytes asked at {offset}, {len(data)} found")
    return data
