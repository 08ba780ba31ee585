"""Newest tagged run on a commit graph.

    heads     branch, commit_id
    commits   commit_id, ts
    parents   commit_id, parent_id      (several rows for a merge)
    tags      commit_id, tag_name, message

A branch's history is what its head reaches through parents.  It is walked from the newest
commit on: a commit comes when it is the newest of those reached, so one with a
clock ahead of its child comes right after that child.  Its place is therefore given by
the oldest date on the way to it (the best way counts), then by the number of steps.

The walk is bounded: every round joins the commits found so far to their
ancestors within ``2 ** DOUBLINGS`` steps and keeps the first ``lookback`` of each branch, which is
exact, as nothing beyond a commit comes before it.  So a branch has ``lookback`` rows at
most, whatever the length of its history, and history that many branches share is
looked up, not copied.  It ends when no branch changes.  The ancestors are found once for all
branches, by joining the table of near ancestors with itself.  That table grows with the history:
it is written once, and a round reads it past the commits found so far, which are broadcast, and
shuffles only those (with more than ``BROADCAST_ROWS`` of them to be kept, it is shuffled, too).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runvault.operators.diff import DEFAULT_LOOKBACK, RUN_TAG_PREFIX
from runvault.session import scratch_dir
from runvault.sinks.publish import cut_lineage

# Each doubling halves the rounds and more than doubles the table of near ancestors.
DOUBLINGS = 2
# Most rows that a round may broadcast.
BROADCAST_ROWS = 500_000


def _order():
    return [F.col("since").desc(), "steps", F.col("ts").desc(), F.col("commit_id").desc()]


def _nearest(found: DataFrame, *key: str) -> DataFrame:
    """The best way to each commit: the one whose oldest date is newest, then the shortest."""
    best = found.groupBy(*key).agg(F.max(F.struct("since", (-F.col("steps")).alias("less"), "ts")).alias("b"))
    return best.select(*key, "b.since", (-F.col("b.less")).alias("steps"), "b.ts")


def _written(near: DataFrame) -> DataFrame:
    """``near`` as Parquet in the checkpoint folder: rounds read it again and again, and by columns."""
    folder = scratch_dir(near.sparkSession, "near-ancestors")
    near.write.parquet(folder)
    return near.sparkSession.read.parquet(folder)


def near_ancestors(commits: DataFrame, parents: DataFrame, doublings: int = DOUBLINGS) -> DataFrame:
    """``commit_id, ancestor, since, steps, ts``: ancestors within ``2 ** doublings`` steps, with the oldest date on
    the way (the commit itself not counted)."""
    dated = commits.select(F.col("commit_id").alias("ancestor"), F.col("ts").alias("since"), F.lit(1).alias("steps"), "ts")
    near = _written(parents.withColumnRenamed("parent_id", "ancestor").distinct().join(dated, "ancestor").select(
        "commit_id", "ancestor", "since", "steps", "ts"))
    for _ in range(doublings):
        on = near.toDF("ancestor", "further", "since2", "steps2", "ts2")
        more = near.join(on, "ancestor").select(
            "commit_id", F.col("further").alias("ancestor"), F.least("since", "since2").alias("since"),
            (F.col("steps") + F.col("steps2")).alias("steps"), F.col("ts2").alias("ts"))
        near = _written(_nearest(near.unionByName(more), "commit_id", "ancestor"))
    return near


def branch_history(heads: DataFrame, commits: DataFrame, parents: DataFrame,
                   lookback: int = DEFAULT_LOOKBACK) -> DataFrame:
    """``branch, commit_id, ts, pos``: the first ``lookback`` commits of every branch, the head first.

    Commits without a row in ``commits``, or with a null date, end the walk there, as
    the border of a shallow clone does.
    """
    commits = commits.filter("ts is not null")
    near = near_ancestors(commits, parents)
    first = Window.partitionBy("branch").orderBy(*_order())

    def kept(found: DataFrame) -> DataFrame:
        return (_nearest(found, "branch", "commit_id").withColumn("pos", F.row_number().over(first))
                .filter(F.col("pos") <= lookback).drop("pos"))

    def mark(found: DataFrame):
        return found.agg(F.count("*"), F.sum(F.xxhash64("branch", "commit_id", "since", "steps").cast("decimal(38,0)"))).first()
    state = cut_lineage(kept(heads.select("branch", "commit_id").distinct().join(commits, "commit_id").select(
        "branch", "commit_id", F.col("ts").alias("since"), F.lit(0).alias("steps"), "ts")))
    small = state.count() * lookback <= BROADCAST_ROWS  # a row a branch so far
    before = None
    while (now := mark(state)) != before:
        before = now
        found = F.broadcast(state) if small else state
        step = found.alias("s").join(near.alias("n"), "commit_id").select(
            "branch", F.col("n.ancestor").alias("commit_id"), F.least("s.since", "n.since").alias("since"),
            (F.col("s.steps") + F.col("n.steps")).alias("steps"), "n.ts")
        state = cut_lineage(kept(state.unionByName(step)))
    return state.select("branch", "commit_id", "ts", F.row_number().over(first).alias("pos"))


def newest_tagged_run(heads: DataFrame, commits: DataFrame, parents: DataFrame, tags: DataFrame,
                      lookback: int = DEFAULT_LOOKBACK) -> DataFrame:
    """``branch, run_id, run_path, commit_id, pos``: the first commit with a run tag among the first
    ``lookback`` of each branch; of several run tags on it the greatest name."""
    run_tags = tags.filter(F.col("tag_name").startswith(RUN_TAG_PREFIX)).select("commit_id", "tag_name", "message")
    tagged = branch_history(heads, commits, parents, lookback).join(run_tags, "commit_id")
    best = tagged.groupBy("branch").agg(F.max_by(
        F.struct("tag_name", "message", "commit_id", "pos"), F.struct((-F.col("pos")).alias("n"), "tag_name")).alias("b"))
    return best.select("branch", F.col("b.tag_name").alias("run_id"), F.col("b.message").alias("run_path"),
                       "b.commit_id", "b.pos")
