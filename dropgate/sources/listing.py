"""Listing of a landing area on the executors: a data source with one partition per group of directories.

The driver lists the first levels until there are directories enough for the tasks; what lies below is listed by them and never
held in one place.  Names starting with '.' or '_' (without a '=') and names ending in '._COPYING_' are hidden, as Spark hides them.
"""

from __future__ import annotations

import fnmatch
import re
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import file_name_of

#: directories to find before the rest is left to the tasks, and directories in a task at least
SPREAD, PER_TASK = 256, 16
_SCHEMA = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modification_time", pa.timestamp("us", "UTC"))])


def hidden(name: str) -> bool:
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


class _Store:
    """The file system of a URI, and its paths in the form of the scan's ``path`` column (``file:/x``, ``s3a://b/x``)."""

    def __init__(self, uri: str):
        from pyarrow import fs

        parts = urlsplit(re.sub("^file:/+", "file:///", uri))
        plain = parts.scheme in ("", "file")
        self.files, self.root = (fs.LocalFileSystem(), parts.path) if plain else fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme) + uri[len(parts.scheme) :])
        self.prefix = "file:" if plain else f"{parts.scheme}://" + ("" if parts.scheme in ("s3", "s3a", "s3n", "gs") else parts.netloc)

    def below(self, directory: str) -> tuple[list[str], list]:
        """(directories, files) right below a directory; one that has gone meanwhile is empty."""
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(directory, allow_not_found=True))
        found = [f for f in found if not hidden(f.base_name)]
        return [f.path for f in found if f.type == fs.FileType.Directory], [f for f in found if f.type == fs.FileType.File]


class _Directories(InputPartition):
    def __init__(self, whole: list[str], flat: list[str]):
        self.whole, self.flat = whole, flat


class LandedFiles(DataSource):
    """``spark.read.format("landed_files").load(directory)``: path, length and modification time of all files below."""

    @classmethod
    def name(cls) -> str:
        return "landed_files"

    def schema(self) -> str:
        return "path string, length bigint, modification_time timestamp"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("pathGlobFilter"))


class _Reader(DataSourceReader):
    def __init__(self, directory: str, name_filter: str | None):
        self.directory, self.name_filter = directory, name_filter

    def partitions(self) -> list[InputPartition]:
        store = _Store(self.directory)
        level, flat = [store.root], []
        while 0 < len(level) < SPREAD:
            flat += level
            level = [d for parent in level for d in store.below(parent)[0]]
        tasks = [_Directories([], flat[i : i + PER_TASK]) for i in range(0, len(flat), PER_TASK)]
        return tasks + [_Directories(level[i : i + PER_TASK], []) for i in range(0, len(level), PER_TASK)]

    def read(self, partition: _Directories):
        store, todo = _Store(self.directory), [(d, False) for d in partition.flat] + [(d, True) for d in partition.whole]
        while todo:
            directory, deep = todo.pop()
            inner, files = store.below(directory)
            if deep:
                todo += [(d, True) for d in inner]
            files = [f for f in files if self.name_filter is None or fnmatch.fnmatchcase(f.base_name, self.name_filter)]
            if files:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([store.prefix + f.path for f in files]), pa.array([f.size for f in files], pa.int64()), pa.array([f.mtime for f in files], _SCHEMA.field(2).type)], schema=_SCHEMA
                )


def reachable(directory: str) -> bool:
    """Can tasks list this store themselves?  Others only Spark's own scan reaches, and so are patterns."""
    try:
        _Store(directory)
    except (OSError, ValueError, ImportError):
        return False
    return not re.search(r"[*?\[{]", directory)


def list_files(spark: SparkSession, directory: str, name_filter: str | None = None) -> DataFrame:
    """Files below a directory in the columns of ``sources.files.list_landing``, those of zero bytes too; nothing is read but metadata."""
    spark.dataSource.register(LandedFiles)
    reader = spark.read.format("landed_files")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    path = F.col("path")
    uri = F.regexp_replace(F.replace(F.url_encode(path), F.lit("+"), F.lit("%20")), "%2F", "/")
    return reader.load(directory).select(
        "path", F.regexp_replace(uri, "^([A-Za-z0-9]+)%3A/", "$1:/").alias("file_uri"), file_name_of(path).alias("file_name"), "length", "modification_time"
    )
