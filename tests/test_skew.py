"""Hot keys: one key holding a third of all rows.

Checks that results stay whole and exact, and that plans combine or limit
map-side before the shuffle (so a hot key does not ship all its rows).
"""

from pyspark.sql import functions as F

from runvault.operators import diff as df_
from runvault.operators import entities as en
from runvault.operators import ledger as lg

N = 30_000


def _plan(spark, df):
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(),
                                                                "formatted")


def _skewed(spark):
    # a third of the rows on key 0, the rest spread over 1000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id"))


def test_hot_run_metrics_exact_and_partial(spark):
    s = _skewed(spark)
    log = s.select(F.concat(F.lit("run-"), F.col("k").cast("string")).alias("run_id"),
                   F.lit("loss").alias("name"), F.col("id").cast("double").alias("value"),
                   F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("seq"))
    out = lg.last_metrics(log)
    hot = out.filter("run_id = 'run-0'").first()
    assert hot.n_writes == N // 3 and hot.value == float(N - 3)
    assert out.count() == 1001
    assert "partial_max_by" in _plan(spark, out)


def test_hot_branch_top_tag_uses_group_limit(spark):
    s = _skewed(spark)
    commits = s.select(F.concat(F.lit("b"), F.col("k").cast("string")).alias("branch"),
                       F.col("id").alias("commit_id"), F.timestamp_seconds("id").alias("ts"),
                       F.col("id").alias("seq"))
    tags = s.filter(F.col("id") % 7 == 0).select(
        F.col("id").alias("commit_id"),
        F.concat(F.lit("run-"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("tag_name"),
        F.lit("/p").alias("message"))
    top = df_.top_tagged_run(commits, tags, lookback=100)
    hot = top.filter("branch = 'b0'").first()
    assert hot.run_id == f"run-{(N - 3) // 21 * 21:08d}"
    plan = _plan(spark, top)
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange")


def test_hot_entity_versions(spark):
    s = _skewed(spark)
    v = s.select(F.lit("user").alias("env"), F.lit("p").alias("pipeline"),
                 F.lit("z").alias("zone"), F.lit("s").alias("step"),
                 F.concat(F.lit("e"), F.col("k").cast("string")).alias("entity"),
                 F.concat(F.lit("run-"), F.lpad(F.col("id").cast("string"), 8, "0"))
                 .alias("run_id"), (F.col("id") % 2 == 0).alias("committed"))
    latest = {r.entity: r.run_id for r in en.latest_committed(v).collect()}
    assert latest["e0"] == f"run-{N - 6:08d}"
    assert en.last_versions(v, 3).filter("entity = 'e0'").count() == 3


def test_hot_url_dependencies_whole(spark):
    s = _skewed(spark)
    runs = s.select(
        F.concat(F.lit("run-"), F.col("id").cast("string")).alias("run_id"),
        F.create_map(F.lit("in"), F.concat(F.lit("/u/"), F.col("k").cast("string")))
        .alias("inputs"),
        F.when(F.col("id") <= 1000, F.create_map(
            F.lit("out"), F.concat(F.lit("/u/"), F.col("id").cast("string"))))
        .otherwise(F.create_map().cast("map<string,string>")).alias("outputs"))
    d = lg.dependencies(runs)
    assert d.count() == N
    # run-0 writes what a third of all runs read; it is no producer of its own input
    assert d.filter("url = '/u/0' AND producer_run = 'run-0'").count() == N // 3 - 1
    assert d.filter("producer_run >= consumer_run").isEmpty()


def test_shared_custom_url_has_one_producer(spark):
    """Many runs write one fixed path and many read it: one edge for each reader."""
    runs = spark.createDataFrame(
        [(f"run-{i:03}", {"in": "/fixed"}, {"out": "/fixed"}) for i in range(40)] + [("run-x", None, {"o": "/own"})],
        "run_id string, inputs map<string,string>, outputs map<string,string>")
    edges = lg.dependencies(runs).collect()
    assert {e.consumer_run: (e.producer_run, e.output_name) for e in edges} == {
        f"run-{i:03}": (f"run-{i - 1:03}", "out") if i else (None, None) for i in range(40)}
    assert lg.lineage(runs).count() == 81
