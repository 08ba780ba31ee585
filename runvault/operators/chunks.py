"""File archive operators: split files into bounded chunks and put them back.

A *file row* is ``(rel_path string, length bigint, content binary
[, modification_time timestamp])``.  A *chunk row* is

    rel_path string, part int, offset bigint, length int,
    file_length bigint, content binary

``part`` is a number (not a zero-padded name), so files of any part count
reassemble in the right order.  Every file, including an empty one, has at
least part 0.

Scale notes
-----------
* Chunking is a narrow ``explode`` inside one stage; it never shuffles.
* Chunks are at most ``row_size`` bytes, so byte ranges of an archive are
  near-equal partitions regardless of file-size skew.
* :func:`restore_files` gathers one file's chunks into one group.  It is meant
  for files that fit in a task: its hex string ends at 1 GiB, and a larger file
  is an error that says so.  :func:`runvault.sinks.archive.write_files` restores files
  of any size without building them.
* :func:`chunk_digests` never builds a file: it hashes chunks in parallel and
  combines them with a per-file hash list (32 bytes per chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed defaults (settable per call): max chunk bytes and Parquet block size.
DEFAULT_ROW_SIZE = 1024 * 1024
DEFAULT_BLOCK_SIZE = 10 * 1024 * 1024
# Bytes of a partition of a large archive, apart from the row groups in it.
DEFAULT_PARTITION_SIZE = 256 * 1024 * 1024
# Largest file that is put together in memory: its hex string must fit in 2 GiB.
MAX_RESTORED = (1 << 30) - 64
# Parallelism floor used when sizing an archive: partitions >= 3 x cores.
PARTITIONS_PER_CORE = 3
DEFAULT_CORES = 5

CHUNK_SCHEMA = T.StructType([
    T.StructField("rel_path", T.StringType(), False),
    T.StructField("part", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("length", T.IntegerType(), False),
    T.StructField("file_length", T.LongType(), False),
    T.StructField("modification_time", T.TimestampType(), True),
    T.StructField("content", T.BinaryType(), True),
])


def part_count(length: str | Column, row_size: int) -> Column:
    """Number of chunks of a file: ``max(1, ceil(length / row_size))``."""
    n = F.col(length) if isinstance(length, str) else length
    return F.greatest(F.lit(1), ((n + F.lit(row_size - 1)) / F.lit(row_size)).cast("long")
                      .cast("int"))


def exclude_split_helpers(files: DataFrame, path_col: str = "rel_path") -> DataFrame:
    """Drop ``*.parts`` folders and their children (helpers of older archives)."""
    return files.filter(~F.col(path_col).rlike(r"\.parts(/|$)"))


def chunk_files(files: DataFrame, row_size: int = DEFAULT_ROW_SIZE) -> DataFrame:
    """Split file rows into chunk rows of at most ``row_size`` bytes.

    One ``explode`` over ``sequence(0, parts - 1)`` and a binary ``substring``:
    a narrow, codegen'd projection.
    """
    if row_size <= 0:
        raise ValueError("row_size must be positive")
    has_mtime = "modification_time" in files.columns
    base = files.select(
        "rel_path", F.col("length").cast("long").alias("file_length"), "content",
        (F.col("modification_time") if has_mtime
         else F.lit(None).cast("timestamp")).alias("modification_time"))
    parts = F.sequence(F.lit(0), part_count("file_length", row_size) - 1)
    exploded = base.select("*", F.explode(parts).alias("part"))
    offset = F.col("part").cast("long") * F.lit(row_size)
    return exploded.select(
        "rel_path",
        F.col("part").cast("int").alias("part"),
        offset.alias("offset"),
        F.greatest(F.lit(0), F.least(F.lit(row_size).cast("long"),
                                     F.col("file_length") - offset)).cast("int").alias("length"),
        "file_length",
        "modification_time",
        F.substring("content", F.col("part") * F.lit(row_size) + 1, F.lit(row_size))
        .alias("content"),
    )


def chunk_plan(files: DataFrame, row_size: int = DEFAULT_ROW_SIZE) -> DataFrame:
    """Chunk rows *without* content: ``(path, rel_path, part, offset, length)``.

    Used for range reads of files that are listed but not loaded
    (:func:`runvault.sources.files.read_ranges`).
    """
    parts = F.sequence(F.lit(0), part_count("length", row_size) - 1)
    x = files.select(*[c for c in files.columns if c != "content"],
                     F.explode(parts).alias("part"))
    offset = F.col("part").cast("long") * F.lit(row_size)
    return x.select(
        *[c for c in files.columns if c not in ("content", "length")],
        F.col("part").cast("int").alias("part"),
        offset.alias("offset"),
        F.greatest(F.lit(0), F.least(F.lit(row_size).cast("long"),
                                     F.col("length").cast("long") - offset))
        .cast("int").alias("length"),
        F.col("length").cast("long").alias("file_length"),
    )


def archive_sizing(files: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE,
                   cores: int = DEFAULT_CORES) -> DataFrame:
    """One row: ``n_files, total_bytes, n_partitions``.

    ``n_partitions = max(total_bytes div block_size, 3 * cores)``; a global
    aggregate with map-side partial sums (one tiny shuffle).
    """
    agg = files.agg(F.count(F.lit(1)).alias("n_files"),
                    F.coalesce(F.sum(F.col("length").cast("long")), F.lit(0)).cast("long")
                    .alias("total_bytes"))
    return agg.select(
        "n_files", "total_bytes",
        F.greatest(F.expr(f"total_bytes div {int(block_size)}"),
                   F.lit(PARTITIONS_PER_CORE * cores).cast("long")).alias("n_partitions"))


def restore_files(chunks: DataFrame) -> DataFrame:
    """Reassemble chunk rows into file rows ``(rel_path, length, n_chunks, content)``.

    Parts are ordered numerically inside each group; bytes are concatenated in
    linear time through hex (``aggregate(concat)`` would be quadratic).  Every
    file gets its whole content, so a task holds several times its largest
    file; to restore or digest larger files use
    :func:`runvault.sinks.archive.write_files` and :func:`file_md5`, which
    stream the parts.
    """
    g = (chunks.groupBy("rel_path")
         .agg(F.sort_array(F.collect_list(F.struct("part", "content"))).alias("parts"),
              F.sum(F.col("length").cast("long")).alias("length"),
              F.count(F.lit(1)).alias("n_chunks"),
              F.max("modification_time").alias("modification_time")))
    content = F.when(F.col("length") <= MAX_RESTORED, F.unhex(F.array_join(
        F.transform("parts", lambda p: F.hex(p["content"])), ""))).otherwise(F.raise_error(F.concat(
            "rel_path", F.lit(" is too large to restore in memory: write it with write_files"))))
    return g.select("rel_path", "length", F.col("n_chunks").cast("int").alias("n_chunks"),
                    "modification_time", content.alias("content"))


def check_chunks(chunks: DataFrame) -> DataFrame:
    """Per-file integrity: parts 0..n-1 present once, lengths add up.

    Returns only files that fail (``problem`` says why); empty means whole.
    """
    g = chunks.groupBy("rel_path").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("part").alias("n_distinct"),
        F.min("part").alias("lo"), F.max("part").alias("hi"),
        F.sum(F.col("length").cast("long")).alias("bytes"),
        F.max("file_length").alias("file_length"))
    problem = (F.when(F.col("n") != F.col("n_distinct"), "duplicate part")
               .when((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1), "missing part")
               .when(F.col("bytes") != F.col("file_length"), "length mismatch"))
    return g.select("rel_path", problem.alias("problem")).filter(F.col("problem").isNotNull())


def chunk_digests(chunks: DataFrame) -> DataFrame:
    """Per-file digest without building the file.

    ``digest = md5(concat of chunk md5s in part order)``; per-chunk hashing runs
    in parallel and the per-file list holds 32 bytes per chunk.
    """
    c = chunks.select("rel_path", "part", F.col("length").cast("long").alias("length"),
                      F.md5("content").alias("chunk_md5"))
    g = c.groupBy("rel_path").agg(
        F.sum("length").alias("n_bytes"),
        F.count(F.lit(1)).cast("int").alias("n_chunks"),
        F.sort_array(F.collect_list(F.struct("part", "chunk_md5"))).alias("hs"))
    return g.select("rel_path", "n_bytes", "n_chunks",
                    F.md5(F.array_join(F.transform("hs", lambda h: h["chunk_md5"]), ""))
                    .alias("digest"))


def file_manifest(files: DataFrame, row_size: int = DEFAULT_ROW_SIZE) -> DataFrame:
    """``rel_path, n_bytes, n_chunks, md5`` of file rows."""
    return files.select("rel_path", F.col("length").cast("long").alias("n_bytes"),
                        part_count("length", row_size).alias("n_chunks"),
                        F.md5("content").alias("md5"))


FILE_MD5_SCHEMA = "rel_path string, n_bytes long, n_chunks int, md5 string"


def file_md5(chunks: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Exact whole-file md5 for files of any size, without building them.

    Chunks are hash-partitioned by file and sorted by part; one pass per
    partition feeds each file's chunks in order into an incremental md5
    (state carries across Arrow batches).  Memory per task is one batch.
    Output: rel_path, n_bytes, n_chunks, md5.
    """
    spark = chunks.sparkSession
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (chunks.select("rel_path", "part", "content")
               .repartition(n, "rel_path").sortWithinPartitions("rel_path", "part"))

    def run(batches):
        import hashlib

        import pandas as pd
        cur, h, nbytes, nparts, expect = None, None, 0, 0, 0
        done = []
        for pdf in batches:
            for path, part, content in zip(pdf["rel_path"], pdf["part"], pdf["content"]):
                if path != cur:
                    if cur is not None:
                        done.append((cur, nbytes, nparts, h.hexdigest()))
                    cur, h, nbytes, nparts, expect = path, hashlib.md5(), 0, 0, 0
                if part != expect:
                    raise IOError(f"{path}: part {part} where {expect} was expected")
                if content is not None:
                    h.update(content)
                    nbytes += len(content)
                nparts += 1
                expect += 1
            if done:
                yield pd.DataFrame(done, columns=["rel_path", "n_bytes", "n_chunks", "md5"])
                done = []
        if cur is not None:
            yield pd.DataFrame([(cur, nbytes, nparts, h.hexdigest())],
                               columns=["rel_path", "n_bytes", "n_chunks", "md5"])

    return ordered.mapInPandas(run, FILE_MD5_SCHEMA)
