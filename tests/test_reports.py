"""Diff reports in a store: files, marker last, a second run writes nothing."""

import json

import pytest

from runvault.operators import diff
from runvault.sinks import archive, reports


def tree(root):
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()}


def frames(spark):
    rows = [("p", "curr", "run-2", "/r/run-2", "step.a"), ("p", "target", "run-1", "/r/run-1", "step.a"),
            ("p", "curr", "run-2", "/r/run-2", "step.b"), ("p", "target", "run-1", "/r/run-1", "step.c"),
            ("q", "curr", "run-3", "/r/run-3", "step.a"), ("q", "target", "run-2", "/r/run-2", "step.a"),
            ("half", "curr", "run-4", "/r/run-4", "step.a")]
    texts = [("/r/run-2/step.a/report.ipynb", "one\ntwo\nthree"), ("/r/run-1/step.a/report.ipynb", "one\nthree"),
             ("/r/run-2/step.b/report.ipynb", "b"), ("/r/run-1/step.c/report.ipynb", None),
             ("/r/run-3/step.a/report.ipynb", "one\ntwo\nthree"), ("/r/run-9/unused", "x")]
    d = diff.module_diff(spark.createDataFrame(rows, "pair string, side string, run_id string, run_path string, module string"))
    return d, diff.diff_manifest(d), spark.createDataFrame(texts, "source string, text string")


def test_reports_are_published_once(spark, tmp_path):
    d, manifest, contents = frames(spark)
    root = tmp_path / "store"
    assert reports.publish_reports(d, manifest, contents, str(root)) == 2
    got = tree(root)
    first, second = "r/run-2/diff.run-2.run-1", "r/run-3/diff.run-3.run-2"
    assert json.loads(got.pop(f"{first}/diff_info.json")) == {"curr_run_path": "/r/run-2", "target_run_path": "/r/run-1"}
    assert json.loads(got.pop(f"{second}/diff_info.json")) == {"curr_run_path": "/r/run-3", "target_run_path": "/r/run-2"}
    text = "one\ntwo\nthree"
    assert got == {f"{first}/a.curr.html": text, f"{first}/a.target.html": "one\nthree",
                   f"{first}/a.diff.txt": "@@ -1 +1 @@\n one\n+two\n three", f"{first}/b.added.html": "b",
                   f"{first}/c.removed.html": "", f"{first}/_SUCCESS": "",
                   f"{second}/a.curr.html": text, f"{second}/a.target.html": text, f"{second}/a.diff.txt": "",
                   f"{second}/_SUCCESS": ""}
    # committed reports are left alone, one without marker is written again
    (root / f"{first}/b.added.html").write_text("changed by hand")
    assert reports.publish_reports(d, manifest, contents, str(root)) == 0
    assert (root / f"{first}/b.added.html").read_text() == "changed by hand"
    (root / f"{first}/_SUCCESS").unlink()
    assert reports.publish_reports(d, manifest, contents, str(root)) == 1
    assert (root / f"{first}/b.added.html").read_text() == "b" and (root / f"{first}/_SUCCESS").exists()


def test_broken_off_report_has_no_marker(spark, tmp_path, monkeypatch):
    d, manifest, contents = frames(spark)
    with pytest.raises(FileNotFoundError, match="run-2/step.b"):
        reports.publish_reports(d, manifest, contents.filter("source not like '%step.b%'"), str(tmp_path / "store"))
    assert not (tmp_path / "store").exists()
    write, calls = reports.write_files, []

    def once(chunks, root):
        calls.append(root)
        if len(calls) > 1:
            raise IOError("stopped before the markers")
        write(chunks, root)
    monkeypatch.setattr(reports, "write_files", once)
    with pytest.raises(IOError, match="stopped"):
        reports.publish_reports(d, manifest, contents, str(tmp_path / "store"))
    names = set(tree(tmp_path / "store"))
    assert any(n.endswith("a.diff.txt") for n in names) and not any(n.endswith("_SUCCESS") for n in names)
    monkeypatch.setattr(reports, "write_files", archive.write_files)
    assert reports.publish_reports(d, manifest, contents, str(tmp_path / "store")) == 2
    assert reports.publish_reports(d, manifest.filter("1 = 0"), contents, str(tmp_path / "empty")) == 0
