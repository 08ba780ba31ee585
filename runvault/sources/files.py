"""File listings and byte-range reads on executors.

Spark's ``binaryFile`` source drops names starting with ``_`` or ``.`` and
zero-length files, and loads each file whole (2 GB cap).  Archives must keep
every file, of any size, so files are handled in two steps:

1. :func:`list_files` - metadata rows ``(path, rel_path, length,
   modification_time)``.  Executor tasks list the folders, level by level.
2. :func:`read_ranges` - chunk plan rows ``(path, rel_path, part, offset,
   length, ...)`` become chunk rows with ``content``, read with seek + read
   by executor tasks.  A large file's ranges are spread over many tasks.

Storage access goes through ``pyarrow.fs`` (local, S3, GCS, HDFS...).  The
file system is opened from the root once a task; ``path`` is a path in that
file system, never parsed again, so names may hold any character.  A root that
pyarrow cannot open is an error.
"""

from __future__ import annotations

import posixpath
from datetime import datetime, timezone
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runvault.functions.names import glob_regex
from runvault.session import ensure_checkpoint_dir

LISTING_BATCH = 10_000  # rows a task gives on at once
_LISTING_COLUMNS = ["path", "rel_path", "length", "modification_time", "is_folder"]
_LISTING_DDL = "path string, rel_path string, length long, modification_time timestamp"
# Bytes per yielded Arrow batch when reading ranges (bounds worker memory).
READ_BATCH_BYTES = 8 * 1024 * 1024


def _fs(root: str):
    from pyarrow import fs as pafs
    return pafs.FileSystem.from_uri(root)


def _norm_root(root: str) -> str:
    return root.rstrip("/") or "/"


def _info_rows(infos, fs_root: str) -> list[tuple]:
    from pyarrow import fs as pafs
    rows = []
    for i in infos:
        if i.type not in (pafs.FileType.File, pafs.FileType.Directory):
            continue
        rel = "/" + posixpath.relpath(i.path, fs_root)
        mtime = (datetime.fromtimestamp(i.mtime_ns / 1e9, tz=timezone.utc)
                 if i.mtime_ns is not None else None)
        rows.append((i.path, rel, int(i.size or 0), mtime, i.type == pafs.FileType.Directory))
    return rows


def list_files(spark: SparkSession, root: str, recursive: bool = True,
               glob: str | None = None) -> DataFrame:
    """Every file under ``root`` as metadata rows, hidden and empty files included.

    Folders are listed by executor tasks, one level of the tree after the
    other; each level's folders are spread anew, so one large sub-tree is
    shared by many tasks.  Levels are kept in the checkpoint folder.
    ``rel_path`` is ``/``-prefixed and relative to ``root`` (a literal prefix,
    never a regex).  ``glob`` filters on the file name, like
    ``pathGlobFilter``.
    """
    root = _norm_root(root)
    fs, base = _fs(root)
    from pyarrow import fs as pafs
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        raise FileNotFoundError(f"not a folder: {root}")
    ensure_checkpoint_dir(spark)

    def lister(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs2, base2 = _fs(root)
        for pdf in batches:
            for folder in pdf["path"]:
                infos = fs2.get_file_info(pafs.FileSelector(folder, recursive=False))
                for at in range(0, len(infos), LISTING_BATCH):
                    rows = _info_rows(infos[at:at + LISTING_BATCH], base2)
                    if rows:
                        yield pd.DataFrame(rows, columns=_LISTING_COLUMNS)

    n = max(1, spark.sparkContext.defaultParallelism * 4)
    level, out = spark.createDataFrame([(base,)], "path string"), None
    while True:
        listed = level.mapInPandas(lister, _LISTING_DDL + ", is_folder boolean").checkpoint()
        files = listed.filter("not is_folder").drop("is_folder")
        out = files if out is None else out.union(files)
        level = listed.filter("is_folder").select("path").repartition(n)
        if not recursive or level.isEmpty():
            break
    if glob:
        out = out.filter(F.element_at(F.split("rel_path", "/"), -1).rlike(glob_regex(glob)))
    return out


def select_files(spark: SparkSession, folder: str, globs: list[str]) -> DataFrame:
    """Files directly in ``folder`` matching any of ``globs`` (no sub-folders).

    Raises when nothing matches.
    """
    listing = list_files(spark, folder, recursive=False)
    name = F.element_at(F.split("rel_path", "/"), -1)
    cond = F.lit(False)
    for g in globs:
        cond = cond | name.rlike(glob_regex(g))
    out = listing.filter(cond).dropDuplicates(["path"])
    if out.isEmpty():
        raise FileNotFoundError(f"no file in {folder} matches {globs}")
    return out


def read_ranges(plan: DataFrame, root: str = "/",
                keep: tuple[str, ...] = ("rel_path", "part", "offset", "length",
                                         "file_length", "modification_time")) -> DataFrame:
    """Chunk plan rows -> chunk rows with ``content`` read from storage.

    ``path`` is a path in the file system of ``root``; a file stays open while its
    ranges follow each other.  Output batches are capped at
    ``READ_BATCH_BYTES`` so a task never holds more than that many bytes.
    """
    cols = [c for c in keep if c in plan.columns]
    out_schema = T.StructType([plan.schema[c] for c in cols]
                              + [T.StructField("content", T.BinaryType(), True)])

    def reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = _fs(_norm_root(root))
        name, handle = None, None
        buf, size = [], 0
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                n = int(row.length)
                data = b""
                if n > 0:
                    if row.path != name:
                        if handle is not None:
                            handle.close()
                        name, handle = row.path, fs.open_input_file(row.path)
                    data = handle.read_at(n, int(row.offset))
                    if len(data) != n:
                        raise IOError(f"short read {row.path}@{row.offset}: {len(data)} of {n}")
                rec = {c: getattr(row, c) for c in cols}
                rec["content"] = bytes(data)
                buf.append(rec)
                size += n
                if size >= READ_BATCH_BYTES:
                    yield pd.DataFrame(buf, columns=cols + ["content"])
                    buf, size = [], 0
        if handle is not None:
            handle.close()
        if buf:
            yield pd.DataFrame(buf, columns=cols + ["content"])

    return plan.select("path", *cols).mapInPandas(reader, out_schema)
