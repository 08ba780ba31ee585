"""Restore of files by many tasks at once, all or nothing.

A Spark data source writer.  Every task writes the chunks it has at their
offsets below a hidden staging folder beside the destination, so nothing is
shuffled and one large file is written by all tasks that hold a part of it.
Files of which a task holds every part are checked by it; of the others it
reports what it wrote, and ``commit`` on the driver adds the reports up: only if every
file has all its bytes does the staging folder get its real name.  ``abort``
removes it.  A task that is run again writes the same bytes at the same
places.

This needs a folder that all executors mount and that takes writes at an
offset (``file:``).  Reports hold one entry a task and file that the task has
parts of, without being the only one: with chunks in path order that is two a task.

A destination that exists gets its files one by one, replacing files of the same
name; only a new destination appears as a whole.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "runvault_files"
COLUMNS = ["rel_path", "offset", "length", "file_length", "content"]


def safe_rel(rel: str) -> str:
    """Relative path without leading ``/``; rejects ``..`` and empty parts."""
    r = rel.strip("/")
    parts = r.split("/")
    if not r or any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"unsafe path in archive: {rel!r}")
    return r


@dataclass
class Written(WriterCommitMessage):
    """Of files that a task holds only in part: (bytes written, bytes in all); and its whole files."""
    partial: dict[str, tuple[int, int]] = field(default_factory=dict)
    whole: int = 0


class _Ranges:
    """What was written of one file: merged [start, end) ranges, at most one a gap."""

    def __init__(self, length: int):
        self.length, self.ranges = length, []

    def add(self, rel: str, start: int, end: int, length: int) -> None:
        if length != self.length:
            raise IOError(f"{rel}: file length {length} and {self.length}")
        if self.ranges and self.ranges[-1][1] == start:
            self.ranges[-1][1] = end
        else:
            self.ranges.append([start, end])

    def total(self, rel: str) -> int:
        self.ranges.sort()
        for (_, end), (start, _) in zip(self.ranges, self.ranges[1:]):
            if start < end:
                raise IOError(f"{rel}: bytes {start} to {end} were written twice")
        return sum(end - start for start, end in self.ranges)


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root = os.path.normpath(root)
        parent, name = os.path.split(self.root)
        self.staging = os.path.join(parent, f".{name}.restore-{uuid.uuid4().hex[:12]}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files: dict[str, _Ranges] = {}
        done, current, fd = Written(), None, -1
        empty: set[str] = set()
        try:
            for batch in iterator:
                contents = batch.column(COLUMNS[-1])
                for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in COLUMNS[:-1]))):
                    rel, offset, length, file_length = row
                    content = contents[i].as_buffer() or b""  # not copied
                    if len(content) != length or offset + length > file_length:
                        raise IOError(f"{rel}: {len(content)} bytes at {offset} where {length} of {file_length} were expected")
                    if rel != current:
                        if fd >= 0:
                            os.close(fd)
                            fd = -1
                        path = os.path.join(self.staging, safe_rel(rel))
                        os.makedirs(os.path.dirname(path), exist_ok=True)
                        fd, current = os.open(path, os.O_WRONLY | os.O_CREAT, 0o666), rel
                    if length:
                        view, at = memoryview(content), offset
                        while view:
                            n = os.pwrite(fd, view, at)
                            view, at = view[n:], at + n
                        files.setdefault(rel, _Ranges(file_length)).add(rel, offset, offset + length, file_length)
                        if files[rel].ranges == [[0, file_length]]:  # has all parts: nothing to report
                            del files[rel]
                            done.whole += 1
                    elif file_length == 0:
                        if rel in empty:
                            raise IOError(f"{rel}: an empty file comes twice")
                        empty.add(rel)
        finally:
            if fd >= 0:
                os.close(fd)
        done.whole += len(empty)
        done.partial = {rel: (r.total(rel), r.length) for rel, r in files.items()}
        return done

    def commit(self, messages: list[Written | None]) -> None:
        sums: dict[str, list[int]] = {}
        for m in messages:
            for rel, (n, length) in (m.partial if m else {}).items():
                known = sums.setdefault(rel, [0, length])
                known[0] += n
                if known[1] != length:
                    raise IOError(f"{rel}: file length {length} and {known[1]}")
        if wrong := [f"{rel}: wrote {n} of {length} bytes" for rel, (n, length) in sums.items() if n != length]:
            raise IOError("; ".join(sorted(wrong)[:20]))
        os.makedirs(self.staging, exist_ok=True)  # nothing to restore: an empty folder
        if not os.path.exists(self.root):
            os.rename(self.staging, self.root)
            return
        for folder, _, names in os.walk(self.staging):
            target = os.path.normpath(os.path.join(self.root, os.path.relpath(folder, self.staging)))
            os.makedirs(target, exist_ok=True)
            for name in names:
                os.replace(os.path.join(folder, name), os.path.join(target, name))
        shutil.rmtree(self.staging)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class FilesSource(DataSource):
    """``df.write.format("runvault_files").option("root", folder)`` for chunk rows."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> StagedWriter:
        if missing := [c for c in COLUMNS if c not in schema.names]:
            raise ValueError(f"chunk rows need the columns {missing}")
        return StagedWriter(self.options["root"])


def restore_at_offsets(chunks: DataFrame, folder: str) -> None:
    """Write chunk rows as files below ``folder``, a path that the driver and all executors mount."""
    spark = chunks.sparkSession
    spark.dataSource.register(FilesSource)
    os.makedirs(os.path.dirname(os.path.normpath(folder)), exist_ok=True)
    chunks.select(*COLUMNS).write.format(FORMAT).option("root", folder).mode("append").save()
