"""Semantics of individual operators on small hand-made inputs.

Hand-made rows here only pin down rules (edge cases the driver tables do not
reach); the registered queries run on the driver tables.
"""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from runvault.functions import names as nm
from runvault.operators import artifacts as ar
from runvault.operators import cells as ce
from runvault.operators import diff as df_
from runvault.operators import ordered_diff as od
from runvault.operators import entities as en
from runvault.operators import ledger as lg
from runvault.operators import params as pa

REQ = ("consumer string, cur_env string, cur_pipeline string, cur_zone string, "
       "step_name string, entity string, env string, pipeline string, zone string, "
       "run_id string, f_env string, f_pipeline string, f_zone string, f_run string")
VER = ("env string, pipeline string, zone string, step string, entity string, run_id string, "
       "committed boolean")


def _versions(spark):
    return spark.createDataFrame([
        ("user", "p", "z0", "s", "e", "run-24-01-01-000000", True),
        ("user", "p", "z0", "s", "e", "run-24-01-02-000000", True),
        ("user", "p", "z0", "s", "e", "run-24-01-03-000000", False),
        ("user", "p", "z1", "s", "e", "run-24-01-05-000000", True),
        ("prod", "p", "z0", "s", "e", "run-24-02-01-000000", True),
    ], VER)


def _resolve(spark, rows):
    req = spark.createDataFrame(rows, REQ)
    paths = en.env_paths_frame(spark, base={"user": "/u", "prod": "/p"})
    return {(r.entity, r.zone, r.env): (r.status, r.run_id, r.url)
            for r in en.resolve_inputs(req, _versions(spark), paths).collect()}


def test_resolve_latest_committed_skips_uncommitted(spark):
    got = _resolve(spark, [("c", "user", "p", "z0", "s", "e") + (None,) * 8])
    assert got[("e", "z0", "user")] == ("resolved", "run-24-01-02-000000",
                                        "/u/p/z0/s/run-24-01-02-000000/e")


def test_resolve_zone_ambiguity_keeps_current_zone(spark):
    rows = [("c", "user", "p", "z0", "s", "e", None, None, "z0", None, None, None, None, None),
            ("c", "user", "p", "z0", "s", "e", None, None, "z1", None, None, None, None, None)]
    got = _resolve(spark, rows)
    assert got[("e", "z0", "user")][0] == "resolved"
    assert got[("e", "z1", "user")][0] == "zone_dropped"


def test_resolve_zone_ambiguity_without_current_zone_is_flagged(spark):
    rows = [("c", "user", "p", "z9", "s", "e", None, None, "z0", None, None, None, None, None),
            ("c", "user", "p", "z9", "s", "e", None, None, "z1", None, None, None, None, None)]
    assert {v[0] for v in _resolve(spark, rows).values()} == {"ambiguous"}


def test_resolve_or_filters_and_defaults(spark):
    # env filter 'prod' matches the undeclared-env request (takes the filter value)
    rows = [("c", "user", "p", "z0", "s", "e", None, None, None, None, "prod", None, None, None),
            ("c", "user", "p", "z0", "s", "e", "user", None, None, None, "prod", None, None, None)]
    got = _resolve(spark, rows)
    assert list(got) == [("e", "z0", "prod")]
    assert got[("e", "z0", "prod")][1] == "run-24-02-01-000000"


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan):
    return plan.count("Exchange hashpartitioning")


def test_version_slots_answer_latest_and_pins(spark):
    rows = [tuple(r) for r in _versions(spark).collect()]
    odd = [("user", "p", "z0", "s", "e", None, True), ("user", "p", "z0", "s", "e", "latest", None)]
    got = {(r.env, r.zone, r.slot): r.run
           for r in en.version_slots(spark.createDataFrame(rows + rows + odd, VER)).collect()}
    assert got[("user", "z0", "latest")] == "run-24-01-02-000000"
    assert got[("user", "z0", "=run-24-01-01-000000")] == "run-24-01-01-000000"
    assert ("user", "z0", "=run-24-01-03-000000") not in got
    assert len(got) == 7


def test_resolve_plans(spark, tmp_path):
    rows = [("c", "user", "p", "z0", "s", "e") + (None,) * 8,
            ("c", "user", "p", "z0", "s", "e", None, None, None, "run-24-01-01-000000", None, None, None, None),
            ("d", "user", "p", "z0", "s", "e", None, None, None, "run-24-01-03-000000", None, None, None, None)]
    paths = en.env_paths_frame(spark, base={"user": "/u", "prod": "/p"})
    settings = {"spark.sql.adaptive.enabled": "false",
                "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    bucketed = en.bucket_versions(_versions(spark), "resolve_versions", 4, str(tmp_path / "v"))
    requests = spark.createDataFrame(rows, REQ)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plain = en.resolve_inputs(requests, _versions(spark), paths)
        fixed = en.resolve_inputs(requests, bucketed, paths)
        assert _exchanges(_plan(plain)) <= 4
        assert _exchanges(_plan(fixed)) < _exchanges(_plan(plain))
        assert _exchanges(_plan(en.version_slots(bucketed))) == 0
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, fixed.collect()), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("drop table resolve_versions")


def test_resolve_pins(spark):
    rows = [("c", "user", "p", "z0", "s", "e", None, None, None, "run-24-01-01-000000",
             None, None, None, None),
            ("c", "user", "p", "z0", "s", "e.x", None, None, None, "run-24-01-03-000000",
             None, None, None, None)]
    got = _resolve(spark, rows)
    assert got[("e", "z0", "user")][:2] == ("resolved", "run-24-01-01-000000")
    # pinned version exists but is not committed -> missing
    assert got[("e.x", "z0", "user")][0] == "missing"
    rows = [("c", "user", "p", "z0", "s", "e", None, None, None, "run-24-01-01-000000",
             None, None, None, "run-24-01-02-000000")]
    assert _resolve(spark, rows)[("e", "z0", "user")][0] == "pin_mismatch"


def test_resolve_unknown_env_and_bad_name(spark):
    rows = [("c", "dev", "p", "z0", "s", "e") + (None,) * 8,
            ("c", "user", "p", "z0", "s", "a/b") + (None,) * 8]
    got = _resolve(spark, rows)
    assert got[("e", "z0", "dev")][0] == "unknown_env"
    assert got[("a/b", "z0", "user")][0] == "invalid_name"


def test_last_versions_rank(spark):
    rows = en.last_versions(_versions(spark), 1).collect()
    assert {(r.zone, r.env, r.run_id) for r in rows} == {
        ("z0", "user", "run-24-01-02-000000"), ("z1", "user", "run-24-01-05-000000"),
        ("z0", "prod", "run-24-02-01-000000")}


def test_declaration_violations(spark):
    d = spark.createDataFrame([("inputs", {"ENTITY_NAME": "e"}),
                               ("outputs", {"ENTITY_NAME": "e", "RUN_ID": "r"}),
                               ("custom_inputs", {"ENTITY_NAME": "a/b", "ENTITY_PATH": "/x"}),
                               ("weird", {"ENTITY_NAME": "e"})],
                              "kind string, decl map<string,string>")
    got = {(r.kind, r.problem, r.key) for r in en.declaration_violations(d).collect()}
    assert got == {("inputs", "missing key", "STEP_NAME"), ("outputs", "key not allowed", "RUN_ID"),
                   ("custom_inputs", "slash in name", "ENTITY_NAME"),
                   ("weird", "unknown kind", "weird")}


def test_merge_layers_right_wins_and_replace(spark):
    df = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": "2"}, None, {"c": "3"}, False),
                                ({"a": "1"}, {"b": "2"}, {"x": "9"}, None, True)],
                               "d map<string,string>, f map<string,string>, "
                               "s map<string,string>, o map<string,string>, r boolean")
    out = df.select(pa.params_text(pa.merge_with_replace("d", "f", "s", "o", "r")).alias("t"))
    assert [r.t for r in out.collect()] == ["a=1;b=2;c=3", "a=1;x=9"]


def test_first_set_false_wins(spark):
    df = spark.createDataFrame([(False, True), (None, True), (None, None)], "s boolean, t boolean")
    assert [r.v for r in df.select(pa.first_set("s", "t").alias("v")).collect()] == [
        False, True, False]


def test_missing_required(spark):
    df = spark.createDataFrame([(1, {"env_name": "u", "pipeline_name": ""}), (2, {})],
                               "id int, p map<string,string>")
    got = {(r.id, r.missing_key) for r in pa.missing_required(df, "p").collect()}
    assert got == {(1, "pipeline_name"), (2, "env_name"), (2, "pipeline_name")}


def test_top_tagged_run_ties_and_lookback(spark):
    t0 = datetime(2024, 1, 1)
    commits = spark.createDataFrame(
        [("main", i, t0.replace(hour=i), i) for i in range(1, 6)],
        "branch string, commit_id long, ts timestamp, seq long")
    tags = spark.createDataFrame(
        [(3, "run-a", "/a"), (3, "run-b", "/b"), (3, "zzz-not-run", ""), (1, "run-old", "/o")],
        "commit_id long, tag_name string, message string")
    got = df_.top_tagged_run(commits, tags, lookback=3).collect()
    assert [(r.run_id, r.run_path, r.pos) for r in got] == [("run-b", "/b", 3)]
    assert df_.top_tagged_run(commits, tags, lookback=2).count() == 0


def test_module_diff_and_manifest(spark):
    m = spark.createDataFrame(
        [("p", "curr", "run-2", "/r/run-2", "reports.a"), ("p", "curr", "run-2", "/r/run-2",
                                                           "reports.b"),
         ("p", "target", "run-1", "/r/run-1", "reports.b"), ("p", "target", "run-1", "/r/run-1",
                                                             "reports.c")],
        "pair string, side string, run_id string, run_path string, module string")
    got = {(r.module, r.status, r.report_file)
           for r in df_.diff_manifest(df_.module_diff(m)).collect()}
    assert got == {("reports.a", "added", "/r/run-2/diff.run-2.run-1/a.added.html"),
                   *[("reports.b", "changed", f"/r/run-2/diff.run-2.run-1/b{e}")
                     for e in (".curr.html", ".target.html", ".diff.txt")],
                   ("reports.c", "removed", "/r/run-2/diff.run-2.run-1/c.removed.html")}


def test_cell_diff(spark):
    rows = [(1, "curr", 0, "code", "a"), (1, "curr", 1, "code", "a"), (1, "curr", 2, "code", "last"),
            (1, "target", 0, "code", "a"), (1, "target", 1, "markdown", "a"), (1, "target", 2, "code", None),
            (1, "target", 3, "code", "a"), (2, "curr", 0, "code", "x"), (2, "target", 0, "code", "y")]
    c = spark.createDataFrame(rows, "pair long, side string, pos int, cell_type string, source string")
    got = {r.pair: tuple(r)[1:] for r in df_.cell_multiset_diff(c).collect()}
    assert got == {1: (1, 2, 1), 2: (0, 0, 0)}


def test_line_diffs(spark):
    t = spark.createDataFrame([(1, "curr", "a\nb\nb\nx\ntrailer"),
                               (1, "target", "a\nb\nc\ntrailer2")],
                              "pair long, side string, text string")
    r = df_.line_multiset_diff(t, drop_last=True).first()
    assert (r.lines_added, r.lines_removed, r.lines_kept) == (2, 1, 2)
    u = od.unified_text(od.ordered_line_diff(t, drop_last=True)).first()
    assert (u.n_added, u.n_removed) == (2, 1)
    assert u.diff == "@@ -2 +2 @@\n b\n-c\n+b\n+x"


def test_line_diff_keeps_every_pair_and_line(spark):
    t = spark.createDataFrame([(1, "curr", "only"), (1, "target", "only"), (2, "curr", None), (2, "target", None),
                               (3, "curr", "a\nb"), (3, "target", "a\nc")], "pair long, side string, text string")
    got = {r.pair: (r.lines_added, r.lines_removed, r.lines_kept) for r in df_.line_multiset_diff(t).collect()}
    assert got == {1: (0, 0, 1), 2: (0, 0, 0), 3: (1, 1, 1)}


def test_malformed_parameters_are_an_error(spark):
    df = spark.createDataFrame([("{bad",)], "j string")
    with pytest.raises(Exception, match="(?i)malformed"):
        df.select(pa.parse_params("j")).collect()


def test_last_metrics_last_write_wins(spark):
    t = datetime(2024, 1, 1)
    log = spark.createDataFrame([("r", "acc", 0.1, t, 1), ("r", "acc", 0.9, t, 2),
                                 ("r", "acc", 0.5, t.replace(hour=0, minute=0, second=0), 0)],
                                "run_id string, name string, value double, ts timestamp, seq long")
    r = lg.last_metrics(log).first()
    assert (r.value, r.n_writes) == (0.9, 3)
    s = lg.metric_snapshot(lg.last_metrics(log)).first()
    assert s.snapshot == "acc=0.90" and s.metrics == {"acc": 0.9}


def test_report_outputs_and_base_path(spark):
    runs = spark.createDataFrame(
        [("run-1", "nb", {"u.p.z.s.reports.nb": "/x/run-1/reports_nb", "o": "/x/run-1/o"}),
         ("run-2", "nb", {"o": "/x/run-2/o"})],
        "run_id string, module string, outputs map<string,string>")
    got = {r.run_id: (r.n_reports, r.report_url, r.ok)
           for r in lg.report_outputs(runs).collect()}
    assert got == {"run-1": (1, "/x/run-1/reports_nb", True), "run-2": (0, None, False)}
    b = runs.select(lg.run_base_path(F.col("outputs")["o"], F.col("run_id")).alias("b")).collect()
    assert [r.b for r in b] == ["/x/run-1", "/x/run-2"]


def test_cells(spark):
    c = spark.createDataFrame([
        (1, 0, "markdown", ["intro"], "# t", []),
        (1, 1, "code", ["Parameters"], "a = 1", []),
        (1, 2, "code", ["parameters"], "b = 2", ["out2"]),
        (1, 3, "code", ["business_report"], "plot()", ["fig"]),
        (1, 4, "code", [], "x", ["last"]),
    ], "nb_id long, pos long, cell_type string, tags array<string>, source string, "
       "outputs array<string>")
    assert ce.first_cell_by_tag(c, "PARAMETERS").first().source == "a = 1"
    assert ce.tag_violations(c).count() == 0
    assert ce.last_output(c).first().result == "last"
    b = ce.business_view(c).orderBy("pos").collect()
    assert [(r.pos, r.source) for r in b] == [(0, "# t"), (3, "")]
    cl = {r.pos: r.source for r in ce.clear_source_by_tag(c, "parameters").collect()}
    assert cl[2] == "" and cl[1] == "a = 1"


def test_names(spark):
    df = spark.createDataFrame([("prefix-my-step", "/a/b/c/d", "x.y", "doc #1!.v")],
                               "f string, p string, e string, n string")
    r = df.select(nm.step_from_folder("f").alias("s"), nm.path_part("p", -2).alias("pp"),
                  nm.normalize_entity("e").alias("ne"), nm.clean_file_name("n").alias("cn"),
                  nm.strip_prefix("p", "/a/").alias("sp"),
                  nm.run_id_of(F.lit(datetime(2024, 3, 5, 7, 8, 9))).alias("rid")).first()
    assert (r.s, r.pp, r.ne, r.cn, r.sp) == ("my-step", "c", "x_y", "doc 1.v", "b/c/d")
    assert r.rid == "run-24-03-05-070809"
    assert df.select(nm.step_from_folder(F.lit("nodash")).alias("s")).first().s is None


def test_artifact_helpers(spark):
    df = spark.createDataFrame([(None, "str", "", "/b", "m", None),
                                ("binary", "dict", "onnx", "/b/model.onnx", "m", "v1"),
                                (None, "bytes", ".pkl", "/b", "we!rd name", None)],
                               "k string, t string, e string, b string, n string, g string")
    r = df.select(ar.artifact_kind("k", "t").alias("kind"),
                  ar.artifact_file_path("b", "n", "e").alias("fp"),
                  ar.service_version("g", F.lit("u"), F.lit("p"), F.lit("z"), "n",
                                     F.lit("run-1")).alias("ver")).collect()
    assert [(x.kind, x.fp, x.ver) for x in r] == [
        ("text", "/b/m", "u.p.z.m.run-1"), ("binary", "/b/model.onnx", "v1"),
        ("binary", "/b/werd name.pkl", "u.p.z.we!rd name.run-1")]
    none = spark.range(1).select(ar.service_version(F.lit(None).cast("string"), F.lit("u"),
                                                    F.lit(None).cast("string"), F.lit("z"),
                                                    F.lit("n"), F.lit("r")).alias("v"))
    assert none.first().v is None


def test_model_size_check(spark, monkeypatch):
    feats = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, [1.0, 0.0], 1)],
                                  "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(ar, "MAX_MODEL_CELLS", 1)
    with pytest.raises(ValueError):
        ar.pack_centroid_model(ar.train_centroids(feats))


def test_last_result_is_the_first_text_output_parsed(spark):
    plain = lambda x: {"text/plain": x}
    image = {"image/png": "AA"}
    rows = [("a", 1, [plain("1")]), ("a", 2, [image, plain("9")]), ("a", 3, [None]), ("a", 4, []), ("a", 5, None),
            ("b", 1, [plain("'x'")]), ("b", 2, [plain(" -12 "), image]), ("b", 3, [{}]),
            ("c", 1, [plain(r"'it\'s \\n \n\\'")]), ("d", 1, [plain('"a\'b"')]), ("e", 1, [plain("'a' + 'b'")]),
            ("f", 1, [plain("1e3")]), ("g", 1, [plain("True")]), ("h", 1, [plain("None")]), ("i", 1, [plain("9" * 30)]),
            ("j", 1, [plain("'")]), ("k", 1, [plain("")]), ("l", 1, [plain("'" + "\\'" * 100_000 + "'")]),
            ("m", 1, [image]), ("n", 1, [plain("x")]), ("n", 1, [plain("y")]), (None, 1, [plain("3.")])]
    df = spark.createDataFrame(rows, "nb_id string, pos int, data array<map<string,string>>")
    out = {r.nb_id: r for r in ce.last_result(df).collect()}
    got = {k: (r.pos, r.kind, next((x for x in r[4:] if x is not None), None)) for k, r in out.items()}
    assert got == {"a": (1, "int", 1), "b": (2, "int", -12), "c": (1, "str", "it's \\n \n\\"), "d": (1, "str", "a'b"),
                   "e": (1, "other", None), "f": (1, "float", 1000.0), "g": (1, "bool", True), "h": (1, "none", None),
                   "i": (1, "other", None), "j": (1, "other", None), "k": (1, "other", None),
                   "l": (1, "str", "'" * 100_000), "n": (1, "other", None), None: (1, "float", 3.0)}
    assert out["n"].result == "y" and ce.last_result(df.filter("1 = 0")).collect() == []


def test_many_models_score_their_own_rows(spark):
    models = [("hot", 1, 7, [1.0, 0.0]), ("hot", 1, 3, [0.0, 1.0]), ("hot", 2, 5, [0.0, 0.0]), ("cold", 1, 9, [2.0, 2.0]),
              (None, 1, 4, [0.0, 0.0]), ("unused", 1, 1, [1.0])]
    m = spark.createDataFrame(models, "bundle string, version int, label int, centroid array<double>")
    rows = [(i, "hot", 1, [float(i % 3 == 0), float(i % 3 == 1)]) for i in range(1000)]
    rows += [(2000, "hot", 2, [1.0, 5.0]), (2001, "cold", 1, [1.0, 0.0]), (2001, "cold", 1, [1.0, 0.0]), (2002, "none", 1, [1.0, 0.0]),
             (2003, None, 1, [1.0, 0.0]), (2004, "hot", 1, None), (2005, "hot", 1, [1.0]), (2006, "hot", None, [1.0, 0.0])]
    f = spark.createDataFrame(rows, "vec_id long, bundle string, version int, embedding array<float>")
    score = lambda **kw: ar.score_many(m, f, keep=("vec_id",), **kw)
    got = sorted(map(tuple, score(rows_per_group=64).collect()), key=str)
    # ties between the two classes go to the smaller label
    want = [(i, "hot", 1, 7 if i % 3 == 0 else 3, -0.5 if i % 3 == 2 else 0.5) for i in range(1000)]
    want += [(2000, "hot", 2, 5, 0.0), (2001, "cold", 1, 9, -2.0), (2001, "cold", 1, 9, -2.0), (2002, "none", 1, None, None),
             (2003, None, 1, None, None), (2004, "hot", 1, None, None), (2005, "hot", 1, None, None), (2006, "hot", None, None, None)]
    assert got == sorted(want, key=str) == sorted(map(tuple, score().collect()), key=str)
    assert ar.score_many(m, f.filter("1 = 0"), keep=("vec_id",)).collect() == []
    assert ar.score_many(m.filter("1 = 0"), f, keep=("vec_id",)).filter("predicted is not null").collect() == []
    with pytest.raises(Exception, match="model too large"):
        score(max_cells=3).collect()
