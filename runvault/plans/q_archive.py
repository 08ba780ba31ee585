"""Registered archive queries (documents and pages as files, ROW = 1000)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runvault.operators import chunks as ch
from runvault.plans import views as v
from runvault.plans.registry import query

ROW = v.QUERY_ROW_SIZE
_FILES = f"WITH files AS ({v.FILES_SQL})"


@query("archive_manifest", f"""{_FILES}
SELECT rel_path, length AS n_bytes,
       CAST(greatest(1, (length + {ROW - 1}) // {ROW}) AS INTEGER) AS n_chunks,
       md5(content) AS md5
FROM files""")
def archive_manifest(spark, sf_dir):
    """Flagship: files -> chunks -> reassembled files -> size, chunk count, md5."""
    chunks = ch.chunk_files(v.files(spark, sf_dir), ROW)
    restored = ch.restore_files(chunks)
    return restored.select("rel_path", F.col("length").alias("n_bytes"), "n_chunks",
                           F.md5("content").alias("md5"))


@query("archive_md5", f"""{_FILES}
SELECT rel_path, length AS n_bytes,
       CAST(greatest(1, (length + {ROW - 1}) // {ROW}) AS INTEGER) AS n_chunks,
       md5(content) AS md5
FROM files""")
def archive_md5(spark, sf_dir):
    """Whole-file md5 streamed over ordered chunks (any file size, no reassembly)."""
    return ch.file_md5(ch.chunk_files(v.files(spark, sf_dir), ROW))


@query("archive_roundtrip", f"""{_FILES}
SELECT rel_path, length AS n_bytes,
       CAST(greatest(1, (length + {ROW - 1}) // {ROW}) AS INTEGER) AS n_chunks,
       md5(content) AS md5
FROM files""")
def archive_roundtrip(spark, sf_dir):
    """Files written, listed, packed, unpacked, listed and read again."""
    from runvault.session import scratch_dir
    from runvault.sinks.archive import pack, unpack, write_files
    from runvault.sources.files import list_files, read_ranges
    root = scratch_dir(spark, "archive-roundtrip")
    write_files(ch.chunk_files(v.files(spark, sf_dir), ROW), f"{root}/files")
    pack(spark, f"{root}/files", f"{root}/archive", row_size=ROW)
    unpack(spark, f"{root}/archive", f"{root}/restored")
    plan = ch.chunk_plan(list_files(spark, f"{root}/restored"), ROW)
    return ch.file_md5(read_ranges(plan, f"{root}/restored"))


@query("archive_chunks", f"""{_FILES},
c AS (SELECT rel_path, length AS file_length, content,
             unnest(range(0, greatest(1, (length + {ROW - 1}) // {ROW}))) AS part
      FROM files)
SELECT rel_path, CAST(part AS INTEGER) AS part, CAST(part * {ROW} AS BIGINT) AS "offset",
       CAST(greatest(0, least({ROW}, file_length - part * {ROW})) AS INTEGER) AS length,
       file_length,
       md5(unhex(substr(hex(content), part * {2 * ROW} + 1, {2 * ROW}))) AS chunk_md5
FROM c""")
def archive_chunks(spark, sf_dir):
    """Chunk rows of every file (content shown as md5)."""
    c = ch.chunk_files(v.files(spark, sf_dir), ROW)
    return c.select("rel_path", "part", "offset", "length", "file_length",
                    F.md5("content").alias("chunk_md5"))


@query("archive_digest", f"""{_FILES},
c AS (SELECT rel_path, length AS file_length, content,
             unnest(range(0, greatest(1, (length + {ROW - 1}) // {ROW}))) AS part
      FROM files),
h AS (SELECT rel_path, part,
             CAST(greatest(0, least({ROW}, file_length - part * {ROW})) AS BIGINT) AS length,
             md5(unhex(substr(hex(content), part * {2 * ROW} + 1, {2 * ROW}))) AS chunk_md5
      FROM c)
SELECT rel_path, CAST(sum(length) AS BIGINT) AS n_bytes, CAST(count(*) AS INTEGER) AS n_chunks,
       md5(string_agg(chunk_md5, '' ORDER BY part)) AS digest
FROM h GROUP BY rel_path""")
def archive_digest(spark, sf_dir):
    """Per-file hash list digest computed from chunks, never building the file."""
    return ch.chunk_digests(ch.chunk_files(v.files(spark, sf_dir), ROW))


@query("archive_sizing", f"""{_FILES}
SELECT CAST(count(*) AS BIGINT) AS n_files, CAST(sum(length) AS BIGINT) AS total_bytes,
       CAST(greatest(sum(length) // 65536, 15) AS BIGINT) AS n_partitions
FROM files""")
def archive_sizing(spark, sf_dir):
    """Archive partition count from total bytes (64 KiB blocks, 5 cores)."""
    return ch.archive_sizing(v.files(spark, sf_dir), block_size=65536, cores=5)


@query("archive_subset", f"""{_FILES}
SELECT substr(rel_path, length('/en/') + 1) AS rel_path, length AS n_bytes, md5(content) AS md5
FROM files WHERE starts_with(rel_path, '/en/')""")
def archive_subset(spark, sf_dir):
    """Restore only the files under one folder (prefix filter + literal strip)."""
    from runvault.operators.artifacts import subset_by_prefix
    restored = ch.restore_files(ch.chunk_files(v.files(spark, sf_dir), ROW))
    sub = subset_by_prefix(restored, "/en/")
    return sub.select("rel_path", F.col("length").alias("n_bytes"), F.md5("content").alias("md5"))
