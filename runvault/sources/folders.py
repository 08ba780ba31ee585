"""Folder levels as a table: a Spark data source whose filters prune the walk.

A store is a tree with one meaning per level, such as
``{pipeline}/{zone}/{step}/{run_id}/{entity}``.  The source has a text column for each level.  A
filter on a level is applied where that level is walked, so folders it excludes
are never listed; for ``=`` and ``IN`` the parent is not listed either, the named children
are looked up.  Filters that the walk cannot apply are left to Spark.

The first ``ahead`` levels are walked when the scan is planned, and the folders found
there are dealt to tasks, which walk the rest.  A task gives its rows on as it finds
them.  Below a folder with very many children ``splits`` tasks share the work: each
lists it, and goes on with the children whose hash falls to it.

Leaf ``folder``: one row per folder of the last level, ``committed`` tells whether it holds the
commit marker.  Leaf ``file``: one row per file at the last level, with its ``length``.  A level
written ``=name`` is a fixed folder and gives no column.  A missing root gives no rows.

Spark pushes filters into Python sources only where
``spark.sql.python.filterPushdown.enabled`` is true; ``folders`` sets it for its session.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan,
                                    LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith)

from runvault.functions.names import COMMIT_MARKER

FORMAT = "runvault_folders"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
VERSION_LEVELS = "pipeline/zone/step/run_id/entity"
TMP_LOG_LEVELS = "log_name/run_id/file_name"
STORED_LOG_LEVELS = "pipeline/zone/step/run_id/=tensorboard/log_name/file_name"

_TESTS = {
    EqualTo: lambda x, v: x == v, EqualNullSafe: lambda x, v: x == v, In: lambda x, v: x in v,
    StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: lambda x, v: v in x,
    GreaterThan: lambda x, v: x.encode() > v.encode(), GreaterThanOrEqual: lambda x, v: x.encode() >= v.encode(),
    LessThan: lambda x, v: x.encode() < v.encode(), LessThanOrEqual: lambda x, v: x.encode() <= v.encode(),
}


def list_folder(fs, folder: str) -> list:
    """The entries of one folder (none if it does not exist)."""
    from pyarrow import fs as pafs
    return fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))


@dataclass
class Folder(InputPartition):
    """A folder from which a task walks on, with the names of the levels above."""
    path: str
    names: tuple[str, ...]
    split: int = 0


class FolderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["root"].rstrip("/")
        self.levels = options["levels"].split("/")
        self.leaf = options.get("leaf", "folder")
        self.ahead = min(int(options.get("ahead", "3")), len(self.levels) - 1)
        self.splits = int(options.get("splits", "1"))
        self.filters: list[tuple[type, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ("",))
            if len(column) == 1 and column[0] in self.levels and (type(f) in _TESTS or isinstance(f, IsNotNull)):
                if type(f) in _TESTS:  # names are never null
                    self.filters.append((type(f), column[0], f.value))
            else:
                yield f

    def _open(self):
        from pyarrow import fs as pafs
        fs, base = pafs.FileSystem.from_uri(self.root)
        return fs, base, self.root[:len(self.root) - len(base)] if self.root.endswith(base) else ""

    def _fits(self, level: str, name: str) -> bool:
        return all(value is not None and _TESTS[kind](name, value) for kind, column, value in self.filters if column == level)

    def _named(self, level: str) -> list[str] | None:
        """The only names that a level may have, if a filter says so."""
        if level.startswith("="):
            return [level[1:]]
        for kind, column, value in self.filters:
            if column == level and kind in (EqualTo, EqualNullSafe, In):
                values = value if kind is In else [value]
                return sorted({v for v in values if v and "/" not in v and v not in (".", "..")})
        return None

    def _children(self, fs, folder: str, depth: int) -> Iterator[tuple[str, object]]:
        """(name, entry) of what the filters leave at a level below ``folder``."""
        from pyarrow import fs as pafs
        level = self.levels[depth]
        wanted = pafs.FileType.File if self.leaf == "file" and depth == len(self.levels) - 1 else pafs.FileType.Directory
        if (names := self._named(level)) is not None:
            entries = fs.get_file_info([f"{folder}/{n}" for n in names]) if names else []
        else:
            entries = list_folder(fs, folder)
        for e in entries:
            if e.type == wanted and (level.startswith("=") or self._fits(level, e.base_name)):
                yield e.base_name, e

    def partitions(self) -> list[Folder]:
        fs, base, _ = self._open()
        found = [Folder(base, ())]
        for depth in range(self.ahead):
            found = [Folder(e.path, (*f.names, name)) for f in found for name, e in self._children(fs, f.path, depth)]
        return [Folder(f.path, f.names, s) for f in found for s in range(self.splits)] or [Folder("", ())]

    def read(self, partition: Folder) -> Iterator[tuple]:
        if not partition.path:
            return
        fs, _, prefix = self._open()
        last = len(self.levels) - 1

        def walk(folder: str, names: tuple[str, ...]) -> Iterator[tuple]:
            depth = len(names)
            found = ((n, e) for n, e in self._children(fs, folder, depth)
                     if self.splits == 1 or depth > self.ahead or zlib.crc32(n.encode()) % self.splits == partition.split)
            if depth < last:
                for name, e in found:
                    yield from walk(e.path, (*names, name))
                return
            found = list(found)
            if self.leaf == "file":
                extra = [int(e.size) for _, e in found]
            else:
                from pyarrow import fs as pafs
                marks = fs.get_file_info([f"{e.path}/{COMMIT_MARKER}" for _, e in found]) if found else []
                extra = [m.type == pafs.FileType.File for m in marks]
            for (name, e), x in zip(found, extra):
                shown = (v for v, level in zip((*names, name), self.levels) if not level.startswith("="))
                yield (*shown, prefix + e.path, x)
        yield from walk(partition.path, partition.names)


class FolderSource(DataSource):
    """``spark.read.format("runvault_folders")`` with options root, levels, leaf, ahead, splits."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        columns = [x for x in self.options["levels"].split("/") if not x.startswith("=")]
        extra = T.StructField("length", T.LongType()) if self.options.get("leaf") == "file" else T.StructField(
            "committed", T.BooleanType())
        return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "url"]] + [extra])

    def reader(self, schema: T.StructType) -> FolderReader:
        return FolderReader(dict(self.options))


def folders(spark: SparkSession, root: str, levels: str = VERSION_LEVELS, leaf: str = "folder", ahead: int = 3,
            splits: int = 1) -> DataFrame:
    """The folders (or files) of a store as a table; see the module."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(FolderSource)
    return (spark.read.format(FORMAT).option("root", root).option("levels", levels).option("leaf", leaf)
            .option("ahead", ahead).option("splits", splits).load())


def stored_versions(spark: SparkSession, env_path: str, **options) -> DataFrame:
    """Versions below an environment: pipeline, zone, step, run_id, entity, url, committed."""
    return folders(spark, env_path, VERSION_LEVELS, **options)


def event_log_files(spark: SparkSession, root: str, layout: str = "tmp", **options) -> DataFrame:
    """Event-log files by their levels, with url and length; in the ``stored`` layout below an environment."""
    if layout not in ("tmp", "stored"):
        raise ValueError(f"unknown event-log layout: {layout}")
    return folders(spark, root, TMP_LOG_LEVELS if layout == "tmp" else STORED_LOG_LEVELS, "file",
                   **{"ahead": 1} | options if layout == "tmp" else options)
