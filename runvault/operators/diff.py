"""Run-to-run diff: newest tagged run per branch, module set diff, line diffs.

Data shapes
-----------
commits   branch, commit_id, ts, seq           (one row per commit on a branch)
tags      commit_id, tag_name, message         (message = run path for run tags)
modules   pair, side ('curr'|'target'), run_id, run_path, module
texts     pair, side, text                     (module contents to compare)

Scale notes
-----------
* ``top_tagged_run`` keeps ``row_number() <= n`` per branch, which Spark
  turns into a partial window-group limit before the shuffle: a hot branch
  ships at most ``n`` commits per map task.
* The multiset line diff aggregates ``(pair, line)`` counts with map-side
  partial sums; a huge text is spread over many tasks by its lines.
* Ordered diffs are in ``ordered_diff``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN_TAG_PREFIX = "run-"
# Default look-back when searching a branch for its newest tagged run.
DEFAULT_LOOKBACK = 100


# ------------------------------------------------------------------ W1

def top_tagged_run(commits: DataFrame, tags: DataFrame,
                   lookback: int = DEFAULT_LOOKBACK) -> DataFrame:
    """Newest run-tagged commit among the last ``lookback`` commits of each branch.

    Ties (several run tags on that commit) go to the greatest tag name.
    Output: branch, run_id, run_path, commit_id, pos (1 = branch head).
    """
    w = Window.partitionBy("branch").orderBy(F.col("ts").desc(), F.col("seq").desc())
    recent = (commits.withColumn("pos", F.row_number().over(w))
              .filter(F.col("pos") <= lookback))
    run_tags = tags.filter(F.col("tag_name").startswith(RUN_TAG_PREFIX))
    j = recent.join(run_tags, "commit_id")
    best = j.groupBy("branch").agg(F.max_by(
        F.struct("tag_name", "message", "commit_id", "pos"),
        F.struct((-F.col("pos")).alias("npos"), F.col("tag_name"))).alias("b"))
    return best.select("branch", F.col("b.tag_name").alias("run_id"),
                       F.col("b.message").alias("run_path"),
                       F.col("b.commit_id").alias("commit_id"), F.col("b.pos").alias("pos"))


# ------------------------------------------------------------------ A9 / D1 / D3

def module_names(modules: DataFrame) -> DataFrame:
    """Distinct module names per (pair, side)."""
    return modules.select("pair", "side", "module").distinct()


def module_diff(modules: DataFrame) -> DataFrame:
    """Added / removed / changed modules of each pair.

    One aggregation on (pair, module) with side flags (combined map-side)
    replaces the two set differences and the intersection; run ids and paths
    per pair come from a second aggregation joined on pair.
    Output: pair, module, status, curr_run, target_run, curr_run_path,
    target_run_path.  ``changed`` = present in both runs.
    """
    is_c, is_t = F.col("side") == "curr", F.col("side") == "target"
    runs = modules.groupBy("pair").agg(
        F.max(F.when(is_c, F.col("run_id"))).alias("curr_run"),
        F.max(F.when(is_t, F.col("run_id"))).alias("target_run"),
        F.max(F.when(is_c, F.col("run_path"))).alias("curr_run_path"),
        F.max(F.when(is_t, F.col("run_path"))).alias("target_run_path"))
    sides = modules.groupBy("pair", "module").agg(F.max(is_c).alias("in_c"),
                                                  F.max(is_t).alias("in_t"))
    status = (F.when(F.col("in_c") & F.col("in_t"), "changed")
              .when(F.col("in_c"), "added").otherwise("removed"))
    return sides.select("pair", "module", status.alias("status")).join(runs, "pair", "left")


def diff_manifest(diff: DataFrame) -> DataFrame:
    """Files of a diff report, one row per file: diff id, folder, sources, file.

    ``diff.{curr_run}.{target_run}`` under the current run path; module files
    are ``{short}.added.html``, ``{short}.removed.html``, or all of
    ``{short}.curr.html``, ``.target.html`` and ``.diff.txt`` for a changed
    module, where ``short`` is the second dotted part of the module name.
    ``info_file`` holds the two run paths.
    """
    diff_id = F.concat(F.lit("diff."), "curr_run", F.lit("."), "target_run")
    diff_dir = F.concat(F.col("curr_run_path"), F.lit("/"), diff_id)
    short = F.try_element_at(F.split("module", r"\."), F.lit(2))
    src_curr = F.concat(F.col("curr_run_path"), F.lit("/"), "module", F.lit("/report.ipynb"))
    src_target = F.concat(F.col("target_run_path"), F.lit("/"), "module",
                          F.lit("/report.ipynb"))
    st = F.col("status")
    return diff.select(
        "pair", "module", "status", diff_id.alias("diff_id"), diff_dir.alias("diff_dir"),
        F.when(st != "removed", src_curr).alias("curr_source"),
        F.when(st != "added", src_target).alias("target_source"),
        F.concat(diff_dir, F.lit("/diff_info.json")).alias("info_file"),
        F.concat(diff_dir, F.lit("/"), short).alias("stem"),
        F.explode(F.when(st == "added", F.array(F.lit(".added.html")))
                  .when(st == "removed", F.array(F.lit(".removed.html")))
                  .otherwise(F.array(F.lit(".curr.html"), F.lit(".target.html"),
                                     F.lit(".diff.txt")))).alias("ending")).select(
        "pair", "module", "status", "diff_id", "diff_dir", "curr_source", "target_source",
        "info_file", F.concat("stem", "ending").alias("report_file"))


def pending_diffs(requested: DataFrame, existing: DataFrame, key: str = "diff_id") -> DataFrame:
    """Requested diffs that are not already committed (left anti join)."""
    return requested.join(existing.select(key).distinct(), key, "left_anti")


# ------------------------------------------------------------------ J5 / D2

def paired_texts(texts: DataFrame) -> DataFrame:
    """Current and target content side by side for modules present in both."""
    c = texts.filter(F.col("side") == "curr").select("pair", F.col("text").alias("curr_text"))
    t = texts.filter(F.col("side") == "target").select("pair",
                                                       F.col("text").alias("target_text"))
    return c.join(t, "pair")


def _body_lines(text_col: str = "text", drop_last: bool = False):
    """Lines of a text; with ``drop_last`` without its final line."""
    lines = F.split(F.col(text_col), "\n")
    if drop_last:
        lines = F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0)))
    return lines


def line_multiset_diff(texts: DataFrame, drop_last: bool = False) -> DataFrame:
    """Order-free line diff per pair: lines added, removed and kept.

    A line occurring c times in the current text and t times in the target
    counts max(c - t, 0) added, max(t - c, 0) removed, min(c, t) kept.  A pair
    without any line stays, with zeros.
    """
    lines = texts.select("pair", "side", F.explode_outer(_body_lines("text", drop_last)).alias("line"))
    per_line = lines.groupBy("pair", "line").agg(
        F.count_if((F.col("side") == "curr") & F.col("line").isNotNull()).alias("c"),
        F.count_if((F.col("side") == "target") & F.col("line").isNotNull()).alias("t"))
    return per_line.groupBy("pair").agg(
        F.sum(F.greatest(F.col("c") - F.col("t"), F.lit(0))).alias("lines_added"),
        F.sum(F.greatest(F.col("t") - F.col("c"), F.lit(0))).alias("lines_removed"),
        F.sum(F.least("c", "t")).alias("lines_kept"))


def cell_multiset_diff(cells: DataFrame) -> DataFrame:
    """Order-free diff of two notebooks' cells: ``cells`` has pair, side, pos, cell_type, source.

    The last cell of each notebook does not count, nor do outputs.  A pair
    without other cells stays, with zeros.  Only one row per notebook and one
    per distinct cell are shuffled after partial aggregation.
    """
    last = cells.groupBy("pair", "side").agg(F.max("pos").alias("last"))
    body = cells.join(last, ["pair", "side"]).withColumn("counts", F.col("pos") < F.col("last"))
    per_cell = body.groupBy("pair", "cell_type", "source").agg(
        F.count_if((F.col("side") == "curr") & F.col("counts")).alias("c"),
        F.count_if((F.col("side") == "target") & F.col("counts")).alias("t"))
    return per_cell.groupBy("pair").agg(
        F.sum(F.greatest(F.col("c") - F.col("t"), F.lit(0))).alias("cells_added"),
        F.sum(F.greatest(F.col("t") - F.col("c"), F.lit(0))).alias("cells_removed"),
        F.sum(F.least("c", "t")).alias("cells_kept"))
