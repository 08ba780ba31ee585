"""Incremental merge of the run ledger."""

import os
from datetime import datetime

from runvault.sinks import publish as pub

SCHEMA = "pipeline string, run_id string, module string, status string, start_time timestamp, stop_time timestamp"


def run(pipeline, k, month, ended=None, module="m"):
    return (pipeline, f"run-{k}", module, ended or "RUNNING", datetime(2024, month, 1 + k % 20),
            datetime(2024, month, 25) if ended else None)


def files(ledger):
    return {os.path.relpath(os.path.join(d, n), ledger) for d, _, names in os.walk(f"{ledger}/merged") for n in names
            if n.endswith(".parquet")}


def test_merge_rewrites_touched_partitions_only(spark, tmp_path):
    ledger, everything = str(tmp_path / "ledger"), []

    def append(rows):
        everything.extend(rows)
        pub.append_runs(spark.createDataFrame(rows, SCHEMA).repartition(6), ledger)

    def same():
        want = {tuple(r) for r in pub.current_records(spark.createDataFrame(everything, SCHEMA)).collect()}
        got = [tuple(r) for r in pub.read_ledger(spark, ledger).collect()]
        assert len(got) == len(want) and set(got) == want
        only = [tuple(r) for r in pub.read_ledger(spark, ledger, "007").collect()]
        assert sorted(only, key=str) == sorted((r for r in got if r[0] == "007"), key=str)

    append([run(p, k, m) for p in ("a", "b", "007") for m in (1, 2) for k in range(m * 100, m * 100 + 30)] + [run(None, 1, 1)])
    same()
    pub.merge_ledger(spark, ledger)
    same()
    first = files(ledger)
    places = {os.path.dirname(f) for f in first}
    assert len(places) == 7 and len(first) == 7  # one file a partition
    assert not [n for n in os.listdir(f"{ledger}/tail") if n.endswith(".parquet")]
    append([run("a", 205, 2, "COMPLETE"), run("a", 999, 2), run("c", 1, 3)])
    append([run("a", 205, 2, "COMPLETE")])  # a repeated job
    same()
    pub.merge_ledger(spark, ledger)
    same()
    second = files(ledger)
    assert {os.path.dirname(f) for f in first - second} == {"merged/p_pipeline=p-a/p_month=m-2024-02"}
    assert {os.path.dirname(f) for f in second - first} == {
        "merged/p_pipeline=p-a/p_month=m-2024-02", "merged/p_pipeline=p-c/p_month=m-2024-03"}
    append([("a", "run-205", "m", "RUNNING", datetime(2024, 5, 1), None)])  # older news, in another month
    append([("b", "run-100", "m", "FAILED", datetime(2024, 6, 1), datetime(2024, 6, 2))])  # a run stays where it was
    pub.merge_ledger(spark, ledger)
    same()
    assert {os.path.dirname(f) for f in files(ledger)} == {os.path.dirname(f) for f in second}
    pub.merge_ledger(spark, ledger)  # nothing to do
    same()


def test_a_merge_that_ended_early_changes_nothing(spark, tmp_path):
    """The merged records are written, the tail is still there."""
    ledger = str(tmp_path / "ledger")
    rows = [run("a", k, 1, "COMPLETE" if k % 2 else None) for k in range(20)]
    pub.append_runs(spark.createDataFrame(rows, SCHEMA), ledger)
    pub.merge_ledger(spark, ledger)
    pub.append_runs(spark.createDataFrame(rows, SCHEMA), ledger)
    assert sorted((tuple(r) for r in pub.read_ledger(spark, ledger).collect()), key=str) == sorted(rows, key=str)
    pub.merge_ledger(spark, ledger)
    assert sorted((tuple(r) for r in pub.read_ledger(spark, ledger).collect()), key=str) == sorted(rows, key=str)


def test_runs_named_once_are_read_without_a_shuffle(spark, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ledger")
    rows = [run(p, k, 1) for p in ("a", None) for k in range(20)]
    pub.append_runs(spark.createDataFrame(rows, SCHEMA), ledger)
    once = pub.read_ledger(spark, ledger)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted((tuple(r) for r in once.collect()), key=str) == sorted(rows, key=str)
    ended = [run(None, 3, 1, "COMPLETE"), run("a", 5, 1, "FAILED"), run("a", 5, 1)]
    pub.append_runs(spark.createDataFrame(ended, SCHEMA), ledger)
    want = [r for r in rows if r[:2] not in ((None, "run-3"), ("a", "run-5"))] + ended[:2]
    assert sorted((tuple(r) for r in pub.read_ledger(spark, ledger).collect()), key=str) == sorted(want, key=str)
    monkeypatch.setattr(pub, "BROADCAST_KEYS", 0)
    assert sorted((tuple(r) for r in pub.read_ledger(spark, ledger).collect()), key=str) == sorted(want, key=str)


def test_run_records_are_stored_compressed(spark, tmp_path, monkeypatch):
    from runvault.plans import q_ledger
    monkeypatch.setattr(q_ledger, "scratch_dir", lambda spark, name: str(tmp_path / name))
    assert q_ledger.ledger_records(spark, "/root/testdata/sf0.001").count() > 0
    names = [n for n in os.listdir(tmp_path / "ledger-records" / "records") if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
