"""Diff reports in a store: files first, the commit marker last.

A report is a folder named by its manifest (``operators.diff.diff_manifest``):
the contents of added, removed and changed modules, a unified text of the line
changes for each changed module, ``diff_info.json`` with the two run paths, and
``_SUCCESS``.  Reports whose marker is in the store are left alone, so a second
run writes nothing; one that was broken off has no marker and is written
again.  Contents stay as they are stored: nothing is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runvault.functions.names import COMMIT_MARKER
from runvault.operators.chunks import chunk_files
from runvault.operators.diff import pending_diffs
from runvault.operators.ordered_diff import ordered_line_diff, unified_text
from runvault.sinks.archive import write_files
from runvault.sinks.publish import cut_lineage


def committed_reports(folders: DataFrame, root: str) -> DataFrame:
    """Rows of ``folders`` (diff_dir) whose marker is below ``root``; executors look for it."""
    def look(batches):
        from pyarrow import fs as pafs
        fs, base = pafs.FileSystem.from_uri(root.rstrip("/"))
        for pdf in batches:
            marks = fs.get_file_info([f"{base}/{d.strip('/')}/{COMMIT_MARKER}" for d in pdf["diff_dir"]])
            yield pdf[[m.type == pafs.FileType.File for m in marks]]
    return folders.select("diff_dir").distinct().mapInPandas(look, "diff_dir string")


def report_files(manifest: DataFrame, contents: DataFrame) -> DataFrame:
    """``rel_path, content`` (bytes) of all files but the markers of the reports in ``manifest``.

    ``contents`` has source and text, one row a source; an empty or null text gives an empty file.
    """
    is_diff = F.col("report_file").endswith(".diff.txt")
    is_old = F.col("report_file").rlike(r"\.(removed|target)\.html$")
    part = lambda side, source: F.struct(F.lit(side).alias("side"), F.col(source).alias("source"))
    curr, target = part("curr", "curr_source"), part("target", "target_source")
    wanted = manifest.select("report_file", is_diff.alias("is_diff"), F.inline(
        F.when(is_diff, F.array(curr, target)).when(is_old, F.array(target)).otherwise(F.array(curr))))
    texts = wanted.join(contents.select("source", F.coalesce("text", F.lit("")).alias("text")), "source")
    whole = texts.filter("not is_diff").select(F.col("report_file").alias("rel_path"), "text")
    script = ordered_line_diff(texts.filter("is_diff").select(F.col("report_file").alias("pair"), "side", "text"))
    changed = manifest.filter(is_diff).select(F.col("report_file").alias("pair")).join(
        unified_text(script).select("pair", "diff"), "pair", "left")
    info = manifest.groupBy("info_file").agg(F.to_json(F.struct(
        F.min("curr_run_path").alias("curr_run_path"), F.min("target_run_path").alias("target_run_path"))).alias("text"))
    rows = (whole.union(changed.select("pair", F.coalesce("diff", F.lit("")))).union(info.select("info_file", "text")))
    return rows.select("rel_path", F.col("text").cast("binary").alias("content"))


def publish_reports(diff: DataFrame, manifest: DataFrame, contents: DataFrame, root: str) -> int:
    """Write every report of ``manifest`` that has no marker below ``root``; returns how many.

    ``diff`` is what the manifest was made of (``module_diff``).  Pairs without both runs have no
    report.  A module that gives no file name, or a source that ``contents`` lacks, is an error before anything is
    written.
    """
    runs = diff.select("pair", "curr_run_path", "target_run_path").distinct()
    named = manifest.filter("diff_dir is not null").join(runs, "pair")
    pending = cut_lineage(pending_diffs(named, committed_reports(named, root), "diff_dir"))
    sources = pending.select(F.explode(F.array_compact(F.array("curr_source", "target_source"))).alias("source")).distinct()
    if lost := [r.source for r in sources.join(contents.select("source"), "source", "left_anti").limit(5).collect()]:
        raise FileNotFoundError(f"module contents missing: {lost}")
    if bad := [r.module for r in pending.filter("report_file is null").select("module").limit(5).collect()]:
        raise ValueError(f"module names without a second part: {bad}")
    folders = pending.select("diff_dir").distinct()
    n = folders.count()
    if n:
        files = report_files(pending, contents)
        _write(files, root)
        _write(folders.select(F.concat("diff_dir", F.lit(f"/{COMMIT_MARKER}")).alias("rel_path"),
                              F.lit(b"").alias("content")), root)
    return n


def _write(files: DataFrame, root: str) -> None:
    write_files(chunk_files(files.withColumn("length", F.octet_length("content"))), root)
