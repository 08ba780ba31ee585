"""Archives in path order: row-group skipping, byte-range partitions, restore by many tasks."""

import hashlib
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from runvault.operators import chunks as ch
from runvault.operators.artifacts import subset_by_prefix
from runvault.sinks import archive

CHUNK = "rel_path string, part int, offset long, length int, file_length long, content binary"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for service in range(12):
        for k in range(25):
            path = root / f"svc_{service:02}" / f"file_{k:02}.bin"
            path.parent.mkdir(exist_ok=True)
            path.write_bytes(os.urandom(500 + 37 * k) if k else b"")
    (root / "svc_03" / "large.bin").write_bytes(os.urandom(150_000))
    return str(root)


@pytest.fixture(scope="module")
def store(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "a")
    archive.pack(spark, folder, path, row_size=1000, block_size=8192, cores=2, most=60_000)
    return path


def groups(store):
    """(file, first path, last path, rows) of every row group, from the footers."""
    out = []
    for name in sorted(os.listdir(store)):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(os.path.join(store, name)).metadata
            at = meta.schema.names.index("rel_path")
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(at).statistics
                out.append((name, s.min, s.max, meta.row_group(g).num_rows))
    return out


def tree(root):
    return {os.path.relpath(os.path.join(d, n), root): hashlib.md5(open(os.path.join(d, n), "rb").read()).hexdigest()
            for d, _, names in os.walk(root) for n in names}


def test_partitions_are_byte_ranges_in_path_order(spark, folder, store):
    total = sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(folder) for n in names)
    found = groups(store)
    files = sorted({g[0] for g in found})
    assert len(files) == -(-(total + 301) // 60_000)  # one byte of order a file is counted as well
    spans = [(min(g[1] for g in found if g[0] == f), max(g[2] for g in found if g[0] == f)) for f in files]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert len(found) > 3 * len(files)  # row groups are smaller than partitions
    sizes = spark.read.parquet(store).groupBy(F.input_file_name()).agg(F.sum("length")).collect()
    assert max(r[1] for r in sizes) <= 61_000


def test_prefix_filter_reads_few_row_groups(spark, store):
    found = groups(store)
    hit = [g for g in found if g[1] < "/svc_05/￿" and g[2] >= "/svc_05/"]
    assert len(hit) <= len(found) // 6
    subset = subset_by_prefix(archive.read_archive(spark, store).select("rel_path", "length", "content"), "/svc_05/")
    plan = subset._jdf.queryExecution().executedPlan()
    assert "StringStartsWith(rel_path,/svc_05/)" in plan.toString()
    assert len({r.rel_path for r in subset.collect()}) == 25
    leaf = subset._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numOutputRows").value() <= sum(g[3] for g in hit) < sum(g[3] for g in found)


def test_large_archives_get_large_partitions():
    assert archive.partition_size(10 ** 14, 10 << 20, 1000) == ch.DEFAULT_PARTITION_SIZE >= 256 << 20
    assert archive.partition_size(0) == ch.DEFAULT_BLOCK_SIZE
    assert archive.partition_size(300 << 20, 10 << 20, 5) == 20 << 20


def test_restore_is_written_by_many_tasks_without_a_shuffle(spark, folder, store, tmp_path):
    chunks = archive.read_archive(spark, store)
    holders = chunks.filter("rel_path = '/svc_03/large.bin'").select(F.spark_partition_id()).distinct().count()
    assert holders >= 2  # one file, several tasks
    archive.unpack(spark, store, str(tmp_path / "dest"))
    assert tree(tmp_path / "dest") == tree(folder)
    assert os.listdir(tmp_path) == ["dest"]  # no staging folder is left


def test_twenty_parts_by_twenty_tasks(spark, tmp_path):
    body = os.urandom(20 * 64)
    rows = [("/big", k, 64 * k, 64, len(body), body[64 * k:64 * k + 64]) for k in range(20)] + [("/none", 0, 0, 0, 0, None)]
    frame = spark.createDataFrame(rows, CHUNK).repartitionByRange(20, "part")
    archive.write_files(frame, str(tmp_path / "d"))
    assert (tmp_path / "d" / "big").read_bytes() == body and (tmp_path / "d" / "none").read_bytes() == b""
    archive.write_files(frame.filter("rel_path = '/none'").withColumn("rel_path", F.lit("/more/x")), str(tmp_path / "d"))
    assert sorted(tree(tmp_path / "d")) == ["big", "more/x", "none"]


@pytest.mark.parametrize("spoil, message", [
    (lambda c: c.filter("part <> 7"), "wrote 1216 of 1280"),
    (lambda c: c.union(c.filter("part = 3")), "wrote 1344 of 1280|written twice"),
    (lambda c: c.withColumn("length", F.when(F.col("part") == 5, 9).otherwise(F.col("length"))), "were expected"),
    (lambda c: c.withColumn("rel_path", F.when(F.col("part") == 19, F.lit("/a/../../x")).otherwise(F.col("rel_path"))), "unsafe path"),
    (lambda c: c.withColumn("file_length", F.col("file_length") + F.when(F.col("part") == 2, 1).otherwise(0)), "file length"),
])
def test_an_aborted_restore_leaves_nothing(spark, tmp_path, spoil, message):
    body = os.urandom(20 * 64)
    rows = [("/big", k, 64 * k, 64, len(body), body[64 * k:64 * k + 64]) for k in range(20)] + [("/ok", 0, 0, 2, 2, b"ok")]
    with pytest.raises(Exception, match=message):
        archive.write_files(spoil(spark.createDataFrame(rows, CHUNK)).repartition(6, "part"), str(tmp_path / "d"))
    assert os.listdir(tmp_path) == []


def test_unpack_names_broken_files(spark, store, tmp_path):
    spark.read.parquet(store).filter("not (rel_path = '/svc_03/large.bin' and part = 9)").write.parquet(str(tmp_path / "cut"))
    with pytest.raises(IOError, match="large.bin: missing part"):
        archive.unpack(spark, str(tmp_path / "cut"), str(tmp_path / "dest"))
    assert not (tmp_path / "dest").exists()


def test_streamed_files_agree(spark, folder, store, tmp_path):
    archive.stream_files(archive.read_archive(spark, store), str(tmp_path / "s"))
    assert tree(tmp_path / "s") == tree(folder)


def test_files_too_large_for_memory_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(ch, "MAX_RESTORED", 3)
    c = spark.createDataFrame([("/f", 0, 0, 4, 4, b"abcd")], CHUNK).withColumn("modification_time", F.lit(None).cast("timestamp"))
    with pytest.raises(Exception, match="too large to restore"):
        ch.restore_files(c).collect()
