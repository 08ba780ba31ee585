"""Pack -> unpack round trips on real folders (FIXTURES.md section 4 file cases)."""

import hashlib
import os
import random

import pytest

from runvault.sinks import archive
from runvault.operators import chunks as ch
from runvault.sources.files import list_files

ROW = 64


def _write(root, rel, data):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def _tree(root):
    out = {}
    for d, _, fs in os.walk(root):
        for f in fs:
            p = os.path.join(d, f)
            out["/" + os.path.relpath(p, root)] = hashlib.md5(open(p, "rb").read()).hexdigest()
    return out


@pytest.fixture()
def src(tmp_path):
    root = str(tmp_path / "src")
    rnd = random.Random(7)
    cases = {
        "empty.bin": b"",
        "one.bin": b"x",
        "row.bin": bytes(rnd.getrandbits(8) for _ in range(ROW)),
        "row_plus.bin": bytes(rnd.getrandbits(8) for _ in range(ROW + 1)),
        "ten_rows.bin": bytes(rnd.getrandbits(8) for _ in range(10 * ROW)),
        "_hidden_underscore": b"underscore",
        ".hidden_dot": b"dot",
        "_folder/inner.txt": b"inside underscore folder",
        "a/same.txt": b"same name A",
        "b/same.txt": b"same name B",
        "name with blank %20 and =eq.txt": b"odd name",
        "re[gex](chars)+$.txt": b"regex chars",
        "deep/er/and/deeper/file.txt": b"deep",
    }
    for rel, data in cases.items():
        _write(root, rel, data)
    return root


def test_listing_keeps_hidden_and_empty(spark, src):
    rows = {r.rel_path: r.length for r in list_files(spark, src).collect()}
    assert rows["/empty.bin"] == 0
    assert "/_hidden_underscore" in rows and "/.hidden_dot" in rows
    assert "/_folder/inner.txt" in rows
    assert len(rows) == 13


def test_roundtrip(spark, src, tmp_path):
    store = str(tmp_path / "store")
    dest = str(tmp_path / "dest")
    archive.pack(spark, src, store, row_size=ROW, block_size=4096, cores=2)
    chunks = archive.read_archive(spark, store)
    assert ch.check_chunks(chunks).count() == 0
    n = {r.rel_path: r.n_chunks for r in archive.archive_files(spark, store).collect()}
    assert n["/empty.bin"] == 1 and n["/row.bin"] == 1 and n["/row_plus.bin"] == 2
    assert n["/ten_rows.bin"] == 10
    archive.unpack(spark, store, dest)
    assert _tree(dest) == _tree(src)


def test_refuses_overwrite(spark, src, tmp_path):
    store = str(tmp_path / "store")
    archive.pack(spark, src, store, row_size=ROW)
    with pytest.raises(Exception):
        archive.pack(spark, src, store, row_size=ROW)


def test_many_parts_numeric_order(spark, tmp_path):
    """More than 10,000 parts: order must be numeric, not textual."""
    root = str(tmp_path / "big")
    data = bytes(random.Random(3).getrandbits(8) for _ in range(10_050 * 4))
    _write(root, "big.bin", data)
    store, dest = str(tmp_path / "store"), str(tmp_path / "dest")
    archive.pack(spark, root, store, row_size=4, cores=2)
    assert archive.archive_files(spark, store).first().n_chunks == 10_050
    m = ch.file_md5(archive.read_archive(spark, store)).first()
    assert (m.n_bytes, m.n_chunks, m.md5) == (len(data), 10_050, hashlib.md5(data).hexdigest())
    archive.unpack(spark, store, dest)
    assert open(os.path.join(dest, "big.bin"), "rb").read() == data


def test_rejects_parent_paths(spark, tmp_path):
    from pyspark.sql import functions as F
    bad = spark.createDataFrame([("/../escape.txt", b"x")], "rel_path string, content binary")
    bad = bad.select("rel_path", F.lit(1).cast("long").alias("length"), "content")
    with pytest.raises(Exception):
        archive.write_files(ch.chunk_files(bad, 10), str(tmp_path / "d"))
    assert not os.path.exists(str(tmp_path / "escape.txt"))


def test_restore_in_memory_matches_source(spark, src):
    from runvault.sources.files import read_ranges
    files = list_files(spark, src)
    chunks = read_ranges(ch.chunk_plan(files, ROW), src)
    restored = {r.rel_path: hashlib.md5(r.content).hexdigest()
                for r in ch.restore_files(chunks).collect()}
    assert restored == _tree(src)


def test_chunk_property(spark):
    """chunk count = max(1, ceil(n/ROW)); lengths add to n; offsets contiguous."""
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.integers(min_value=0, max_value=700), min_size=1, max_size=6),
           st.integers(min_value=1, max_value=97))
    def prop(sizes, row):
        rows = [(f"/f{i}", bytes(i % 251 for i in range(n))) for i, n in enumerate(sizes)]
        df = spark.createDataFrame(rows, "rel_path string, content binary")
        from pyspark.sql import functions as F
        df = df.select("rel_path", F.octet_length("content").cast("long").alias("length"),
                       "content")
        got = {}
        for r in ch.chunk_files(df, row).collect():
            got.setdefault(r.rel_path, []).append((r.part, r.offset, r.length, bytes(r.content)))
        for (path, data), n in zip(rows, sizes):
            parts = sorted(got[path])
            assert len(parts) == max(1, -(-n // row))
            assert sum(p[2] for p in parts) == n
            assert b"".join(p[3] for p in parts) == data
            assert [p[1] for p in parts] == [i * row for i in range(len(parts))]
    prop()


def test_restore_gives_every_file_whole(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("/small", b"abc"), ("/large", b"x" * 50_000)],
                               "rel_path string, content binary")
    df = df.select("rel_path", F.octet_length("content").cast("long").alias("length"), "content")
    out = {r.rel_path: r for r in ch.restore_files(ch.chunk_files(df, 8)).collect()}
    assert bytes(out["/small"].content) == b"abc"
    assert bytes(out["/large"].content) == b"x" * 50_000 and out["/large"].n_chunks == 6250


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_any_file_name_survives(spark, tmp_path, scheme):
    names = ["a b.txt", "c%20d.txt", "e#f.txt", "g?h.txt", "i=j.txt", ".hidden", "empty", "model.parts", "set.parts/x.bin"]
    root = tmp_path / "src"
    for n in names:
        (root / n).parent.mkdir(parents=True, exist_ok=True)
        (root / n).write_bytes(b"" if n == "empty" else n.encode() * 40)
    archive.pack(spark, f"{scheme}{root}", f"{scheme}{tmp_path}/store", row_size=64)
    archive.unpack(spark, f"{scheme}{tmp_path}/store", f"{scheme}{tmp_path}/dest")
    for n in names:
        assert (tmp_path / "dest" / n).read_bytes() == (root / n).read_bytes()


def test_pack_and_unpack_selected(spark, tmp_path):
    root = tmp_path / "flat"
    root.mkdir()
    for n in ("a.csv", "b.csv", "c.txt"):
        (root / n).write_text(n * 50)
    (root / "sub").mkdir()
    (root / "sub" / "d.csv").write_text("nested")
    store, dest = str(tmp_path / "store"), str(tmp_path / "dest")
    archive.pack_selected(spark, str(root), ["*.csv"], store, row_size=16)
    assert {r.rel_path for r in archive.archive_files(spark, store).collect()} == {
        "/a.csv", "/b.csv"}
    archive.unpack_selected(spark, store, dest, "a.*")
    assert sorted(os.listdir(dest)) == ["a.csv"]
    assert open(os.path.join(dest, "a.csv")).read() == "a.csv" * 50
    with pytest.raises(FileNotFoundError):
        archive.pack_selected(spark, str(root), ["*.none"], str(tmp_path / "s2"))
    with pytest.raises(FileNotFoundError):
        archive.unpack_selected(spark, store, dest, ["*.none"])
