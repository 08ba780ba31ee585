"""Versioned publish -> marker scan -> resolution -> read; ledger; records; logs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from runvault.operators import entities as en
from runvault.sinks import publish as pub
from runvault.sources import versions as vs


@pytest.fixture()
def store(spark, tmp_path):
    env_path = str(tmp_path / "user")
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    for run in ("run-24-01-01-000001", "run-24-01-02-000001", "run-24-01-03-000001"):
        pub.publish(df.withColumn("run", F.lit(run)), f"{env_path}/pipe/zone/step_a/{run}/ent_1")
    pub.publish(df, f"{env_path}/pipe/zone/step_a/run-24-01-01-000001/ent_2")
    # an unfinished version: folder without the commit marker
    os.makedirs(f"{env_path}/pipe/zone/step_a/run-24-01-09-000001/ent_1")
    with open(f"{env_path}/pipe/zone/step_a/run-24-01-09-000001/ent_1/part-0", "w") as f:
        f.write("partial")
    return env_path


def test_scan_and_resolve(spark, store):
    versions = vs.scan_versions(spark, "user", store)
    rows = {(r.entity, r.run_id): r.committed for r in versions.collect()}
    assert rows[("ent_1", "run-24-01-09-000001")] is False
    assert rows[("ent_1", "run-24-01-03-000001")] is True
    latest = {r.entity: r.run_id for r in en.latest_committed(versions).collect()}
    assert latest == {"ent_1": "run-24-01-03-000001", "ent_2": "run-24-01-01-000001"}
    req = spark.createDataFrame(
        [("c", "user", "pipe", "zone", "step_a", "ent.1", None, None, None, None, None, None,
          None, None),
         ("c", "user", "pipe", "zone", "step_a", "ent_2", None, None, None,
          "run-24-01-01-000001", None, None, None, None),
         ("c", "user", "pipe", "zone", "step_a", "ent_3", None, None, None, None, None, None,
          None, None)],
        "consumer string, cur_env string, cur_pipeline string, cur_zone string, "
        "step_name string, entity string, env string, pipeline string, zone string, "
        "run_id string, f_env string, f_pipeline string, f_zone string, f_run string")
    res = en.resolve_inputs(req, versions, en.env_paths_frame(spark, base={"user": store}))
    got = {r.entity: (r.status, r.url) for r in res.collect()}
    assert got["ent.1"] == ("resolved", f"{store}/pipe/zone/step_a/run-24-01-03-000001/ent_1")
    assert got["ent_2"][0] == "resolved"
    assert got["ent_3"] == ("missing", None)
    assert spark.read.parquet(got["ent.1"][1]).count() == 5
    assert [r.run_id for r in vs.committed_run_ids(
        spark, f"{store}/pipe/zone/step_a", "ent_1").orderBy("run_id").collect()][-1] \
        == "run-24-01-03-000001"
    assert "run-24-01-09-000001" in {r.run_id for r in vs.tmp_run_ids(
        spark, f"{store}/pipe/zone/step_a", "ent_1").collect()}


def test_publish_is_immutable(spark, store):
    with pytest.raises(Exception):
        pub.publish(spark.range(1), f"{store}/pipe/zone/step_a/run-24-01-01-000001/ent_1")


def test_ledger_append_and_records(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    runs = spark.createDataFrame(
        [("run-1", "p1", "2024-01-01 00:00:00", "2024-01-01 00:01:30", "COMPLETE"),
         ("run-2", "p2", "2024-01-01 00:00:00", None, None)],
        "run_id string, pipeline string, start_time string, stop_time string, status string")
    recs = pub.run_records(runs)
    got = {r.run_id: (r.status, r.duration_s) for r in recs.collect()}
    assert got["run-1"] == ("COMPLETE", 90.0) and got["run-2"][0] == "RUNNING"
    pub.append_runs(recs, ledger)
    pub.append_runs(recs, ledger)
    ended = recs.filter("run_id = 'run-2'").withColumn("stop_time", F.lit("2024-01-01 00:00:09"))
    pub.append_runs(pub.run_records(ended.drop("status").withColumn("status", F.lit("FAILED"))), ledger)
    now = {r.run_id: r.status for r in pub.read_ledger(spark, ledger).collect()}
    assert now == {"run-1": "COMPLETE", "run-2": "FAILED"}
    assert pub.read_ledger(spark, ledger).count() == 2
    # run-record JSON files
    d = tmp_path / "tmp"
    d.mkdir()
    for i in range(3):
        (d / f"run-{i}_nb.runinfo.json").write_text(json.dumps(
            {"run_id": f"run-{i}", "inputs": {"a": "/x"}, "outputs": {"b": f"/y/{i}"},
             "pipeline_params": {"env_name": "user"}, "status": "COMPLETE"}))
    rr = vs.read_run_records(spark, str(d / "*.runinfo.json"))
    assert rr.count() == 3 and rr.filter(F.col("outputs")["b"] == "/y/2").count() == 1
    p = tmp_path / "params.json"
    p.write_text(json.dumps({"pipeline_params": {"env_name": "user", "pipeline_name": "p"},
                             "step_params": {}, "substeps_params": ["a"]}))
    assert vs.read_params_files(spark, [str(p)]).first().pipeline_params["pipeline_name"] == "p"
    with pytest.raises(ValueError):
        vs.read_params_files(spark, [str(tmp_path / "params.toml")])


def test_yaml_parameter_files(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yml").write_text(
        "pipeline_params:\n  pipeline_name: p\n  day: 2024-01-02\n  n: 3\nstep_params: {k: \"a: b\"}\n"
        "substeps_params:\n- first\n- second\n")
    (tmp_path / "b.json").write_text(json.dumps({"pipeline_params": {"pipeline_name": "q"}, "step_params": {}}))
    (tmp_path / "empty.YAML").write_text("# nothing\n")
    paths = [str(tmp_path / x) for x in ("a.yml", "b.json", "empty.YAML")]
    rows = {r.source_file.rsplit("/", 1)[1]: r for r in vs.read_params_files(spark, paths).collect()}
    assert rows["a.yml"].pipeline_params == {"pipeline_name": "p", "day": "2024-01-02", "n": "3"}
    assert rows["a.yml"].step_params == {"k": "a: b"} and rows["a.yml"].substeps_params == ["first", "second"]
    assert rows["b.json"].pipeline_params == {"pipeline_name": "q"}
    assert rows["empty.YAML"].pipeline_params is None
    shared = vs.read_params_files(spark, paths[1:2], paths[0]).first()
    assert shared.pipeline_params["day"] == "2024-01-02" and shared.step_params == {}
    for broken in ("a: [1", "- only\n- a list\n"):
        (tmp_path / "bad.yml").write_text(broken)
        with pytest.raises(Exception):
            vs.read_params_files(spark, [str(tmp_path / "bad.yml")]).collect()


def test_metrics_lines_follow_each_other(spark, tmp_path):
    """Of two writes in one file the later line wins, also in a file of many splits."""
    from runvault.operators import ledger as lg
    lines = [json.dumps({"run_id": f"run-{i % 7}", "acc": i, "pad": "x" * (i % 50)}) for i in range(3000)]
    (tmp_path / "m.json").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        writes = vs.read_metrics_files(spark, str(tmp_path / "m.json"), lines=True).cache()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.seq, r.value) for r in writes.filter("name = 'acc'").collect()} == {(i, float(i)) for i in range(3000)}
    last = {r.run_id: r.value for r in lg.last_metrics(writes.filter("name = 'acc'")).collect()}
    assert last == {f"run-{k}": float(max(range(k, 3000, 7))) for k in range(7)}
    writes.unpersist()


def test_run_files_to_ledger(spark, tmp_path):
    """Record and metrics files -> ledger -> last metrics, summary, report check, lineage."""
    from runvault.operators import ledger as lg
    for run, module, stop, status in (("run-24-01-01-000001", "my_nb", "2024-01-01 00:01:30.5", "COMPLETE"),
                                      ("run-24-01-02-000001", "job", "2024-01-02 00:00:09", "RUNNING")):
        suffix = ".ipynb" if module == "my_nb" else ".py"
        (tmp_path / f"{run}_{module}.runinfo.json").write_text(json.dumps(
            {"start_time": f"20{run[4:12]} 00:00:00", "stop_time": stop, "status": status, "step_name": "s",
             "commit": "c", "pipeline_params": {"pipeline_name": "p"}, "substeps_params": ["a"],
             "tool_version": "7", "inputs": {"i": "/in"},
             "outputs": {f"user.p.z.s.reports.{module}{suffix}": f"/store/{run}/reports"}}))
        (tmp_path / f"{run}_{module}.metrics.json").write_text(json.dumps({"run_id": run, "acc": 0.5, "note": "x"}, indent=1))
    records = vs.read_run_records(spark, str(tmp_path / "*.runinfo.json"), extra=("tool_version",))
    assert {r.tool_version for r in records.collect()} == {"7"}
    ledger, metrics = str(tmp_path / "ledger"), str(tmp_path / "metrics")
    pub.append_runs(lg.from_records(records), ledger)
    pub.append_runs(lg.from_records(records), ledger)
    runs = pub.read_ledger(spark, ledger)
    assert {(r.run_id, r.module, r.pipeline, r.status, r.duration_s) for r in runs.collect()} == {
        ("run-24-01-01-000001", "my_nb", "p", "COMPLETE", 90.5), ("run-24-01-02-000001", "job", "p", "RUNNING", None)}
    assert {(r.run_id, r.ok, r.report_url) for r in lg.report_outputs(runs).collect()} == {
        (r, True, f"/store/{r}/reports") for r in ("run-24-01-01-000001", "run-24-01-02-000001")}
    assert lg.run_summary(runs).filter("header like '%p/s/c%'").count() == 2
    custom = spark.createDataFrame(
        [("run-24-01-01-000001", "input", "raw", "/custom/a"), ("run-24-01-01-000001", "input", "raw", "/custom/b"),
         ("run-24-01-01-000001", "output", "table", "/custom/t"), ("run-24-01-01-000001", "input", "i", "/new")],
        "run_id string, direction string, name string, url string")
    got = {(r.run_id[-13:], r.direction, r.name, r.url) for r in lg.lineage(lg.with_custom(runs, custom)).collect()
           if "reports" not in r.name}
    assert got == {("24-01-01-000001"[-13:], "input", "i", "/new"), ("24-01-01-000001"[-13:], "input", "raw", "/custom/b"),
                   ("24-01-01-000001"[-13:], "output", "table", "/custom/t"), ("24-01-02-000001"[-13:], "input", "i", "/in")}
    pub.append_metrics(vs.read_metrics_files(spark, str(tmp_path / "*.metrics.json")), metrics)
    pub.append_metrics(vs.read_metrics_files(spark, str(tmp_path / "*.metrics.json")), metrics)
    last = {(r.run_id, r.name, r.value, r.n_writes) for r in lg.last_metrics(pub.read_metrics(spark, metrics)).collect()}
    assert last == {(r, n, x, 1) for r in ("run-24-01-01-000001", "run-24-01-02-000001")
                    for n, x in (("acc", 0.5), ("note", None))}
    (tmp_path / "run-3_x.metrics.json").write_text("{broken")
    with pytest.raises(Exception):
        vs.read_metrics_files(spark, str(tmp_path / "*.metrics.json")).collect()


def test_pipeline_parameter_file(spark, tmp_path):
    for name, pipeline in (("a", "one"), ("b", "two"), ("shared", "three")):
        (tmp_path / f"{name}.json").write_text(json.dumps(
            {"pipeline_params": {"pipeline_name": pipeline}, "step_params": {"k": name}, "substeps_params": []}))
    paths = [str(tmp_path / "a.json"), str(tmp_path / "b.json")]
    rows = vs.read_params_files(spark, paths, str(tmp_path / "shared.json")).collect()
    assert {(r.pipeline_params["pipeline_name"], r.step_params["k"]) for r in rows} == {("three", "a"), ("three", "b")}


def test_event_logs(spark, tmp_path):
    src = tmp_path / "logs"
    for log in ("train", "eval"):
        for run in ("run-1", "run-2"):
            p = src / "zone" / log / run
            p.mkdir(parents=True)
            (p / "events.out.tfevents.1").write_bytes(f"{log}-{run}".encode() * 100)
    (src / "zone" / "train" / "run-1" / "other.txt").write_text("ignored")
    logs = vs.event_logs(spark, str(src))
    assert {(r.log_name, r.run_id) for r in logs.collect()} == {
        ("train", "run-1"), ("train", "run-2"), ("eval", "run-1"), ("eval", "run-2")}
    dest = tmp_path / "out"
    pub.collect_event_logs(spark, str(src), str(dest), row_size=64)
    assert (dest / "eval" / "run-2" / "events.out.tfevents.1").read_bytes() == b"eval-run-2" * 100
    # into the store and back
    store, back = tmp_path / "store", tmp_path / "back"
    pub.collect_event_logs(spark, str(src), str(store), dest_layout="stored")
    assert (store / "run-1" / "tensorboard" / "train" / "events.out.tfevents.1").exists()
    got = vs.event_logs(spark, str(store), layout="stored").collect()
    assert {(r.log_name, r.run_id) for r in got} == {
        ("train", "run-1"), ("train", "run-2"), ("eval", "run-1"), ("eval", "run-2")}
    pub.collect_event_logs(spark, str(store), str(back), src_layout="stored")
    assert (back / "eval" / "run-2" / "events.out.tfevents.1").read_bytes() == b"eval-run-2" * 100
    # two zones with the same log, run and file name would overwrite each other
    twin = src / "zone2" / "train" / "run-1"
    twin.mkdir(parents=True)
    (twin / "events.out.tfevents.1").write_bytes(b"x")
    with pytest.raises(ValueError):
        pub.collect_event_logs(spark, str(src), str(tmp_path / "no"))


def test_failed_write_leaves_no_file(spark, tmp_path):
    from runvault.sinks.archive import write_files
    rows = spark.createDataFrame([("/a.bin", 1, 3, 3, b"abc")],
                                 "rel_path string, part int, length int, file_length long, content binary")
    good = spark.createDataFrame([("/b.gz", 0, 3, 3, b"abc")], rows.schema)
    write_files(good, str(tmp_path / "good"), 1)
    assert (tmp_path / "good" / "b.gz").read_bytes() == b"abc"
    with pytest.raises(Exception, match="part 1 where 0"):
        write_files(rows, str(tmp_path / "bad"), 1)
    assert [p for p in (tmp_path / "bad").rglob("*") if p.is_file()] == []


def test_select_files(spark, tmp_path):
    from runvault.sources.files import select_files
    for n in ("a.csv", "b.csv", "c.txt", "_d.csv"):
        (tmp_path / n).write_text(n)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.csv").write_text("e")
    got = {r.rel_path for r in select_files(spark, str(tmp_path), ["*.csv", "a.*"]).collect()}
    assert got == {"/a.csv", "/b.csv", "/_d.csv"}
    with pytest.raises(FileNotFoundError):
        select_files(spark, str(tmp_path), ["*.nothing"])


def test_checkpoint_cut(spark):
    df = spark.range(10).withColumn("y", F.col("id") + 1)
    assert pub.cut_lineage(df).count() == 10


def test_bundle_publish_load_export(spark, tmp_path):
    from runvault.operators import artifacts as ar
    arts = spark.createDataFrame(
        [("svc", "v1", "model", "binary", ".bin", "/svc/artifacts/model.bin", b"\x00\x01"),
         ("svc", "v1", "cfg", "json", ".json", "/svc/artifacts/cfg.json", b"{}")],
        "bundle string, version string, name string, kind string, ext string, "
        "file_path string, content binary")
    url = str(tmp_path / "bundles" / "svc" / "v1")
    ar.publish_bundle(arts, url)
    back = ar.load_bundle(spark, url)
    assert back.count() == 2
    os.makedirs(str(tmp_path / "uncommitted"))
    with pytest.raises(FileNotFoundError):
        ar.load_bundle(spark, str(tmp_path / "uncommitted"))
    ar.export_artifacts(ar.subset_by_prefix(back.withColumnRenamed("file_path", "rel_path"),
                                            "/svc/artifacts/")
                        .withColumnRenamed("rel_path", "file_path"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "model.bin").read_bytes() == b"\x00\x01"
    assert ar.latest_bundles(back).first().n_artifacts == 2


def test_restore_copies_no_batch(tmp_path):
    import tracemalloc

    import pyarrow as pa
    from runvault.sinks.files import COLUMNS, StagedWriter
    n, size = 32, 1 << 20
    content = pa.array([bytes([i]) * size for i in range(n)] + [None], pa.binary())
    batch = pa.RecordBatch.from_arrays([
        pa.array([f"/f/{i}" for i in range(n + 1)]), pa.array([0] * (n + 1), pa.int64()), pa.array([size] * n + [0], pa.int32()),
        pa.array([size] * n + [0], pa.int64()), content], COLUMNS)
    writer = StagedWriter(str(tmp_path / "out"))
    tracemalloc.start()
    done = writer.write(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    writer.commit([done])
    assert done.whole == n + 1 and peak < 4 * size
    assert all((tmp_path / "out" / "f" / str(i)).read_bytes() == bytes([i]) * size for i in range(n))
    assert (tmp_path / "out" / "f" / str(n)).read_bytes() == b""
