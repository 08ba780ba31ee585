"""Bounded walk over a commit graph against a queue of commits by date."""

import heapq
import random
from datetime import datetime, timedelta

import pytest

from runvault.operators import history as hi

T0 = datetime(2024, 1, 1)


def plain(head, dates, parents, n):
    """Commits as they leave a queue ordered by date."""
    queue, seen, out = [], set(), []
    if head in dates:
        queue, seen = [(-dates[head].timestamp(), head)], {head}
    while queue and len(out) < n:
        _, c = heapq.heappop(queue)
        out.append(c)
        for p in parents.get(c, ()):
            if p in dates and p not in seen:
                seen.add(p)
                heapq.heappush(queue, (-dates[p].timestamp(), p))
    return out


@pytest.mark.parametrize("lookback", [1, 7, 25])
def test_history_of_merges_and_shared_commits(spark, lookback):
    rng = random.Random(lookback)
    dates = {f"c{i}": T0 + timedelta(minutes=i * 3 + rng.randrange(3)) for i in range(160)}
    parents = {f"c{i}": sorted({f"c{rng.randrange(max(0, i - 9), i)}" for _ in range(rng.choice([1, 1, 2, 3]))}) for i in range(1, 160)}
    parents["c90"] = ["c20", "lost"]  # the border of a shallow clone
    heads = {f"b{k}": f"c{rng.randrange(100, 160)}" for k in range(12)} | {"main": "c159", "also": "c159", "gone": "c999", "root": "c0"}
    got = hi.branch_history(spark.createDataFrame([*heads.items()], "branch string, commit_id string"),
                            spark.createDataFrame([*dates.items()], "commit_id string, ts timestamp"),
                            spark.createDataFrame([(c, p) for c, ps in parents.items() for p in ps], "commit_id string, parent_id string"),
                            lookback).collect()
    for branch, head in heads.items():
        mine = [r.commit_id for r in sorted((r for r in got if r.branch == branch), key=lambda r: r.pos)]
        assert mine == plain(head, dates, parents, lookback)


def test_clocks_ahead_and_long_chains(spark):
    dates = {i: T0 - timedelta(minutes=i) for i in range(60)} | {40: T0 + timedelta(days=9)}
    frames = (spark.createDataFrame([("b", 0), ("other", 20)], "branch string, commit_id long"),
              spark.createDataFrame([*dates.items()], "commit_id long, ts timestamp"),
              spark.createDataFrame([(i, i + 1) for i in range(59)], "commit_id long, parent_id long"))
    rows = hi.branch_history(*frames, 50).collect()
    assert [r.commit_id for r in sorted((r for r in rows if r.branch == "b"), key=lambda r: r.pos)] == list(range(50))
    assert len([r for r in rows if r.branch == "other"]) == 40
    tags = spark.createDataFrame([(40, "run-2", "/p2"), (40, "run-3", "/p3"), (45, "run-9", "/p9"), (3, "diff.x", "")],
                                 "commit_id long, tag_name string, message string")
    got = {tuple(r) for r in hi.newest_tagged_run(*frames, tags, 50).collect()}
    assert got == {("b", "run-3", "/p3", 40, 41), ("other", "run-3", "/p3", 40, 21)}
    assert hi.newest_tagged_run(*frames, tags, 30).count() == 1
    assert hi.newest_tagged_run(*(f.limit(0) for f in frames), tags).collect() == []


def test_rounds_shuffle_none_of_the_history(spark, monkeypatch):
    plans, real = [], hi.cut_lineage

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)
    monkeypatch.setattr(hi, "cut_lineage", planned)
    frames = (spark.createDataFrame([("b", 59), ("other", 20)], "branch string, commit_id long"),
              spark.createDataFrame([(i, T0 + timedelta(minutes=i)) for i in range(60)], "commit_id long, ts timestamp"),
              spark.createDataFrame([(i, i - 1) for i in range(1, 60)], "commit_id long, parent_id long"))
    rows = hi.branch_history(*frames, 30).collect()
    assert sorted(r.commit_id for r in rows if r.branch == "b") == list(range(30, 60))
    assert len([r for r in rows if r.branch == "other"]) == 21
    rounds = plans[-3:]
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in rounds)
    monkeypatch.setattr(hi, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in hi.branch_history(*frames, 30).collect()} == {tuple(r) for r in rows}
