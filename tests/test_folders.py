"""The folder source: rows, pruned walks, pushed filters."""

import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringStartsWith

from runvault.sources import folders as fo


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    root = tmp_path_factory.mktemp("env")
    for p, z, s, r, e in itertools.product("ab", ("z0", "z1"), ("s1", "s2", "s3"), range(4), ("e0", "e1")):
        folder = root / p / z / s / f"run-{r}" / e
        folder.mkdir(parents=True)
        if r % 2:
            (folder / "_SUCCESS").write_text("")
    log = root / "a" / "z0" / "s1" / "run-1" / "tensorboard" / "train"
    log.mkdir(parents=True)
    (log / "events.out.1").write_bytes(b"12345")
    (root / "stray file").write_text("not a folder")
    return str(root)


def walk(store, monkeypatch, filters, **options):
    listed = []
    real = fo.list_folder
    monkeypatch.setattr(fo, "list_folder", lambda fs, folder: listed.append(folder) or real(fs, folder))
    reader = fo.FolderSource({"root": store, "levels": fo.VERSION_LEVELS, **options}).reader(None)
    rest = list(reader.pushFilters(filters))
    rows = [row for part in reader.partitions() for row in reader.read(part)]
    return rows, rest, listed


def test_filters_prune_folders_before_they_are_listed(store, monkeypatch):
    rows, rest, listed = walk(store, monkeypatch, [])
    # run-1 of a/z0/s1 also holds the event logs' folder, which is a folder of the last level like any other
    assert len(rows) == 2 * 2 * 3 * 4 * 2 + 1 and not rest
    assert len(listed) == 1 + 2 + 4 + 12 + 48
    rows, rest, listed = walk(store, monkeypatch, [EqualTo(("step",), "s2"), IsNotNull(("step",)), EqualTo(("committed",), True)])
    assert len(rows) == 32 and [type(f) for f in rest] == [EqualTo] and rest[0].attribute == ("committed",)
    assert len(listed) == 1 + 2 + 0 + 4 + 16  # zones are not listed: the step is looked up
    rows, _, listed = walk(store, monkeypatch, [EqualTo(("pipeline",), "b"), In(("zone",), ("z1", "none", "a/b")), EqualTo(("step",), "s3"),
                                                GreaterThan(("run_id",), "run-2"), EqualTo(("entity",), "e1")])
    assert [r[:5] for r in rows] == [("b", "z1", "s3", "run-3", "e1")] and len(listed) == 1  # the runs of one step
    rows, _, listed = walk(store, monkeypatch, [StringStartsWith(("pipeline",), "x")])
    assert not rows and len(listed) == 1


@pytest.mark.parametrize("ahead, splits", [("0", "1"), ("1", "3"), ("3", "2"), ("9", "1")])
def test_rows_do_not_depend_on_the_partitions(store, monkeypatch, ahead, splits):
    rows, _, _ = walk(store, monkeypatch, [], ahead=ahead, splits=splits)
    want, _, _ = walk(store, monkeypatch, [])
    assert sorted(rows) == sorted(want)


def test_source_as_a_table(spark, store):
    found = fo.stored_versions(spark, store)
    assert found.columns == ["pipeline", "zone", "step", "run_id", "entity", "url", "committed"]
    some = found.filter((F.col("step") == "s1") & (F.col("run_id") >= "run-2") & F.col("committed") & F.col("entity").like("e%"))
    got = some.collect()
    assert sorted((r.pipeline, r.zone, r.run_id, r.entity) for r in got) == sorted(
        itertools.product("ab", ("z0", "z1"), ["run-3"], ("e0", "e1")))
    assert all(r.url == f"{store}/{r.pipeline}/{r.zone}/s1/{r.run_id}/{r.entity}" for r in got)
    latest = found.filter("committed").groupBy("pipeline", "zone", "step", "entity").agg(F.max("run_id").alias("r"))
    assert {r.r for r in latest.collect()} == {"run-3"} and latest.count() == 24
    assert fo.stored_versions(spark, store + "/none").collect() == []


def test_event_logs_by_level(spark, store):
    got = fo.event_log_files(spark, store, "stored").filter("log_name = 'train'").collect()
    assert [(r.run_id, r.file_name, r.length) for r in got] == [("run-1", "events.out.1", 5)]
    assert fo.event_log_files(spark, f"{store}/a/z0/s1/run-1").count() == 1
    with pytest.raises(ValueError):
        fo.event_log_files(spark, store, "other")
