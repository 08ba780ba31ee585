"""Pack folders into chunked Parquet archives and restore them.

pack:    listing -> byte offset of every file in path order -> chunk plan dealt by
         byte ranges -> range reads -> Parquet
unpack:  Parquet -> every task writes its chunks at their offsets -> one commit

Files next to each other stay together, so a folder is a run of row groups, and a
filter on ``rel_path`` reads only those.  Every step runs on executors; the driver
sees one sizing row and what the writers report.  Files of any size are
supported: no file is ever held whole in memory.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runvault.operators.chunks import (CHUNK_SCHEMA, DEFAULT_BLOCK_SIZE, DEFAULT_PARTITION_SIZE,
                                       DEFAULT_ROW_SIZE, PARTITIONS_PER_CORE, check_chunks, chunk_plan)
from runvault.operators.ranges import prefix_sum
from runvault.sinks.files import restore_at_offsets, safe_rel
from runvault.sources.files import list_files, read_ranges


def partition_size(total_bytes: int, block_size: int = DEFAULT_BLOCK_SIZE, cores: int = 1,
                   most: int = DEFAULT_PARTITION_SIZE) -> int:
    """Bytes of a partition: ``most`` for large archives; small ones get
    ``PARTITIONS_PER_CORE`` partitions a core, but none below a row group."""
    return max(1, min(most, max(block_size, -(-total_bytes // (PARTITIONS_PER_CORE * cores)))))


def pack_frame(spark: SparkSession, src_root: str, row_size: int = DEFAULT_ROW_SIZE,
               block_size: int = DEFAULT_BLOCK_SIZE, cores: int | None = None,
               files: DataFrame | None = None, most: int = DEFAULT_PARTITION_SIZE) -> DataFrame:
    """Chunk rows of every file under ``src_root``, in path order and dealt by byte ranges.

    Running sums over the file lengths give every chunk its offset in the whole
    archive; a partition is a range of ``partition_size`` bytes of it.  Only plan rows are
    shuffled, contents are read where they are written.
    """
    if files is None:
        files = list_files(spark, src_root)
    cores = cores or max(1, spark.sparkContext.defaultParallelism)
    taken = F.col("length").cast("long") + 1  # empty files take a place, too
    placed = prefix_sum(files, [F.asc("rel_path")], taken, "start")
    total = placed.agg(F.coalesce(F.max(F.col("start") + taken), F.lit(0))).first()[0]
    size = partition_size(total, block_size, cores, most)
    slot = F.expr(f"cast((start + offset) div {size} as int)")
    plan = (chunk_plan(placed, row_size).withColumn("slot", slot)
            .repartitionById(max(1, -(-total // size)), "slot").sortWithinPartitions("rel_path", "part"))
    return read_ranges(plan, src_root)


def _write(chunks: DataFrame, store_path: str, row_size: int, block_size: int, mode: str) -> None:
    # the writer looks at a row group's size after so many rows: two rows of the largest kind a look
    look = max(1, min(100, block_size // (2 * row_size)))
    (chunks.write.option("parquet.block.size", int(block_size))
     .option("parquet.page.size.row.check.min", look).mode(mode).parquet(store_path))


def pack(spark: SparkSession, src_root: str, store_path: str,
         row_size: int = DEFAULT_ROW_SIZE, block_size: int = DEFAULT_BLOCK_SIZE,
         cores: int | None = None, mode: str = "errorifexists", most: int = DEFAULT_PARTITION_SIZE) -> None:
    """Archive ``src_root`` into Parquet at ``store_path`` (row groups of ``block_size`` in
    files of up to ``most`` bytes).

    The default mode refuses to overwrite: published versions are immutable.
    """
    _write(pack_frame(spark, src_root, row_size, block_size, cores, most=most), store_path, row_size, block_size, mode)


def read_archive(spark: SparkSession, store_path: str) -> DataFrame:
    """Chunk rows of an archive (schema fixed, no inference)."""
    return spark.read.schema(CHUNK_SCHEMA).parquet(store_path)


def write_files(chunks: DataFrame, dest_root: str, n_partitions: int | None = None) -> None:
    """Write chunk rows back as files under ``dest_root``.

    A folder that all executors mount (a plain path or ``file:``) gets the chunks at
    their offsets, without a shuffle and all or nothing (``sinks.files``).  Other stores
    take no writes at an offset, and chunks without ``offset`` have none; there every
    file is streamed by one task (``stream_files``, in ``n_partitions`` tasks).
    """
    from pyarrow import fs as pafs
    fs, base = pafs.FileSystem.from_uri(dest_root.rstrip("/"))
    if fs.type_name == "local" and "offset" in chunks.columns:
        restore_at_offsets(chunks, base)
    else:
        stream_files(chunks, dest_root, n_partitions)


def stream_files(chunks: DataFrame, dest_root: str, n_partitions: int | None = None) -> None:
    """Write chunk rows back as files, each by one task as a stream of ordered appends.

    Chunks are hash-partitioned by file and sorted by part.  On file systems
    with atomic rename a file is written under a hidden attempt-specific name
    and renamed when complete, so a lost task never leaves a partial file
    under the real name; a retried task rewrites its files from the start.
    Parts are checked to be contiguous and to add up to ``file_length``.
    """
    spark = chunks.sparkSession
    n = n_partitions or max(spark.sparkContext.defaultParallelism,
                            int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = (chunks.select("rel_path", "part", "length", "file_length", "content")
               .repartition(n, "rel_path").sortWithinPartitions("rel_path", "part"))
    root = dest_root.rstrip("/")

    def writer(rows):
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        fs, base = pafs.FileSystem.from_uri(root)
        # file systems with atomic rename get a temp name first; object
        # stores publish an object only when its upload completes
        via_tmp = fs.type_name in ("local", "hdfs")
        tc = TaskContext.get()
        attempt = f"{tc.stageId()}-{tc.partitionId()}-{tc.attemptNumber()}" if tc else "0"
        cur, out, expect_part, written, total, target, tmp = None, None, 0, 0, 0, None, None

        def close():
            if out is not None:
                out.close()
                if written != total:
                    raise IOError(f"{cur}: wrote {written} of {total} bytes")
                if via_tmp:
                    fs.move(tmp, target)

        try:
            for r in rows:
                if r.rel_path != cur:
                    close()
                    cur = r.rel_path
                    target = posixpath.join(base, safe_rel(cur))
                    parent, name = posixpath.split(target)
                    fs.create_dir(parent, recursive=True)
                    tmp = (posixpath.join(parent, f".{name}.inprogress-{attempt}") if via_tmp
                           else target)
                    out = fs.open_output_stream(tmp, compression=None)
                    expect_part, written, total = 0, 0, int(r.file_length)
                if r.part != expect_part:
                    raise IOError(f"{cur}: part {r.part} where {expect_part} was expected")
                if r.content:
                    out.write(r.content)
                    written += len(r.content)
                expect_part += 1
            close()
        except BaseException:
            # a failed attempt takes its unfinished file along
            if out is not None and via_tmp and tmp is not None:
                out.close()
                if fs.get_file_info(tmp).type == pafs.FileType.File:
                    fs.delete_file(tmp)
            raise

    ordered.foreachPartition(writer)


def checked(chunks: DataFrame) -> DataFrame:
    """``chunks``, or an error that names files whose parts are not all there exactly once.

    Only the columns beside the contents are read."""
    bad = check_chunks(chunks).orderBy("rel_path").take(20)
    if bad:
        raise IOError("; ".join(f"{r.rel_path}: {r.problem}" for r in bad))
    return chunks


def unpack(spark: SparkSession, store_path: str, dest_root: str) -> None:
    """Restore every file of the archive at ``store_path`` under ``dest_root``."""
    write_files(checked(read_archive(spark, store_path)), dest_root)


def archive_files(spark: SparkSession, store_path: str) -> DataFrame:
    """The files in an archive: ``rel_path, n_bytes, n_chunks`` (no content read)."""
    a = read_archive(spark, store_path)
    return a.groupBy("rel_path").agg(F.sum(F.col("length").cast("long")).alias("n_bytes"),
                                     F.count(F.lit(1)).cast("int").alias("n_chunks"))


def _name_matches(path_col: str, globs: list[str]):
    from runvault.functions.names import glob_regex
    name = F.element_at(F.split(path_col, "/"), -1)
    cond = F.lit(False)
    for g in globs:
        cond = cond | name.rlike(glob_regex(g))
    return cond


def pack_selected(spark: SparkSession, folder: str, globs: list[str] | str, store_path: str,
                  row_size: int = DEFAULT_ROW_SIZE, block_size: int = DEFAULT_BLOCK_SIZE,
                  mode: str = "errorifexists") -> None:
    """Archive the files directly in ``folder`` that match any glob (no sub-folders).

    Raises when no file matches.
    """
    from runvault.sources.files import select_files
    globs = [globs] if isinstance(globs, str) else list(globs)
    chunks = pack_frame(spark, folder, row_size, block_size, files=select_files(spark, folder, globs))
    _write(chunks, store_path, row_size, block_size, mode)


def unpack_selected(spark: SparkSession, store_path: str, dest_root: str,
                    globs: list[str] | str) -> None:
    """Restore only the archived files whose names match any glob.

    Raises when no file matches.
    """
    globs = [globs] if isinstance(globs, str) else list(globs)
    chunks = read_archive(spark, store_path).filter(_name_matches("rel_path", globs))
    if chunks.select("rel_path").isEmpty():
        raise FileNotFoundError(f"no archived file matches {globs}")
    write_files(checked(chunks), dest_root)
