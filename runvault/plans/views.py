"""Views that map the driver tables onto the library's record shapes.

Each view has a Spark form (DataFrame from the parquet tables) and a DuckDB
form (a CTE body over the pre-registered views) used by the oracles.  The
mapping is documented in FIXTURES.md section 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runvault.functions.names import normalize_entity, run_id_of

# Chunk size used by the registered archive queries, so that the driver's
# small documents really split.
QUERY_ROW_SIZE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- files

def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File rows: documents as ``/lang/source/doc_id.txt``, pages as ``/page_id.html``."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/"), "lang", F.lit("/"), "source", F.lit("/"),
                 F.col("doc_id").cast("string"), F.lit(".txt")).alias("rel_path"),
        F.encode("text", "UTF-8").alias("content"))
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/"), F.col("page_id").cast("string"), F.lit(".html")).alias("rel_path"),
        F.encode("html", "UTF-8").alias("content"))
    both = docs.unionByName(pages)
    return both.select("rel_path", F.octet_length("content").cast("long").alias("length"),
                       "content")


FILES_SQL = """
    SELECT '/' || lang || '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS rel_path,
           encode(text) AS content, CAST(octet_length(encode(text)) AS BIGINT) AS length
    FROM documents
    UNION ALL
    SELECT '/' || CAST(page_id AS VARCHAR) || '.html', encode(html),
           CAST(octet_length(encode(html)) AS BIGINT)
    FROM pages
"""


# ---------------------------------------------------------------- entities

def _env_by_user():
    return F.element_at(F.array(F.lit("user"), F.lit("test"), F.lit("prod")),
                        (F.col("user_id") % 3 + 1).cast("int"))


def entity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, keyed as a versioned-entity write."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(
        _env_by_user().alias("env"),
        F.col("event_type").alias("pipeline"),
        F.concat(F.lit("zone_"), (F.col("user_id") % 2).cast("string")).alias("zone"),
        F.concat(F.lit("step_"), (F.col("user_id") % 10).cast("string")).alias("step"),
        # a few producers declare dotted names; storage keeps them with '_'
        F.when(k % 5 == 0, F.concat(F.lit("ent."), (k % 3).cast("string")))
         .otherwise(F.concat(F.lit("ent_"), (k % 3).cast("string"))).alias("entity_decl"),
        run_id_of("ts").alias("run_id"),
        F.col("ts"),
        (F.col("value") >= 20).alias("committed"),
        "event_id", "user_id", "value")


def entity_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (env, pipeline, zone, step, entity, run_id); committed if any write was."""
    e = entity_events(spark, sf_dir).withColumn("entity", normalize_entity("entity_decl"))
    return (e.groupBy("env", "pipeline", "zone", "step", "entity", "run_id")
            .agg(F.max(F.col("committed").cast("int")).cast("boolean").alias("committed"),
                 F.max("ts").alias("written_at")))


ENTITY_EVENTS_SQL = """
    SELECT ['user','test','prod'][CAST(user_id % 3 AS INTEGER) + 1] AS env,
           event_type AS pipeline,
           'zone_' || CAST(user_id % 2 AS VARCHAR) AS zone,
           'step_' || CAST(user_id % 10 AS VARCHAR) AS step,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 = 0
                THEN 'ent.' ELSE 'ent_' END
             || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR) AS entity_decl,
           strftime(ts, 'run-%y-%m-%d-%H%M%S') AS run_id,
           ts, value >= 20 AS committed, event_id, user_id, value
    FROM events
"""

ENTITY_VERSIONS_SQL = f"""
    SELECT env, pipeline, zone, step, replace(entity_decl, '.', '_') AS entity, run_id,
           bool_or(committed) AS committed, max(ts) AS written_at
    FROM ({ENTITY_EVENTS_SQL}) ee
    GROUP BY ALL
"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared inputs of consumer substeps, with the consumer's call arguments.

    Consumer = a pipeline's reporting substep (``report_<pipeline>``) running
    in env ``user``, zone ``zone_0``.  It declares every distinct key of the
    producers (raw, possibly dotted, entity names), leaving optional keys
    unset by rule and pinning one run of ``step_7``; some ``step_5`` / ``step_3``
    declarations name another zone so the zone rule applies.  Its call to
    ``inputs(step_name=...)`` carries filters that differ per pipeline.
    """
    e = entity_events(spark, sf_dir)
    keys = e.groupBy("env", "pipeline", "zone", "step", "entity_decl").agg(
        F.min("run_id").alias("first_run"))
    stepn = F.substring("step", 6, 4).cast("int")
    ent_n = F.substring("entity_decl", 5, 4).cast("int")
    return keys.select(
        F.concat(F.lit("report_"), "pipeline").alias("consumer"),
        F.lit("user").alias("cur_env"),
        F.col("pipeline").alias("cur_pipeline"),
        F.lit("zone_0").alias("cur_zone"),
        F.col("step").alias("step_name"),
        F.col("entity_decl").alias("entity"),
        F.when(stepn % 3 != 0, F.col("env")).alias("env"),
        F.when(ent_n != 1, F.col("pipeline")).alias("pipeline"),
        F.when(stepn % 4 == 0, F.lit(None))
         .when((stepn == 5) & (ent_n == 2), F.lit("zone_0"))
         .when((stepn == 3) & (ent_n == 0), F.lit("zone_2"))
         .otherwise(F.col("zone")).alias("zone"),
        F.when(stepn == 7, F.col("first_run")).alias("run_id"),
        F.when(F.col("pipeline") == "click", F.lit("prod")).alias("f_env"),
        F.when(F.col("pipeline") == "view", F.lit("view")).alias("f_pipeline"),
        F.when(F.col("pipeline") == "purchase", F.lit("zone_1")).alias("f_zone"),
        F.when((F.col("pipeline") == "signup") & (stepn == 7),
               F.lit("run-24-01-02-000000")).alias("f_run"),
    )


REQUESTS_SQL = f"""
    SELECT 'report_' || pipeline AS consumer, 'user' AS cur_env, pipeline AS cur_pipeline,
           'zone_0' AS cur_zone, step AS step_name, entity_decl AS entity,
           CASE WHEN CAST(substr(step, 6) AS INTEGER) % 3 <> 0 THEN env END AS env,
           CASE WHEN CAST(substr(entity_decl, 5) AS INTEGER) <> 1 THEN pipeline END AS pipeline,
           CASE WHEN CAST(substr(step, 6) AS INTEGER) % 4 = 0 THEN NULL
                WHEN CAST(substr(step, 6) AS INTEGER) = 5
                     AND CAST(substr(entity_decl, 5) AS INTEGER) = 2 THEN 'zone_0'
                WHEN CAST(substr(step, 6) AS INTEGER) = 3
                     AND CAST(substr(entity_decl, 5) AS INTEGER) = 0 THEN 'zone_2'
                ELSE zone END AS zone,
           CASE WHEN CAST(substr(step, 6) AS INTEGER) = 7 THEN first_run END AS run_id,
           CASE WHEN pipeline = 'click' THEN 'prod' END AS f_env,
           CASE WHEN pipeline = 'view' THEN 'view' END AS f_pipeline,
           CASE WHEN pipeline = 'purchase' THEN 'zone_1' END AS f_zone,
           CASE WHEN pipeline = 'signup' AND CAST(substr(step, 6) AS INTEGER) = 7
                THEN 'run-24-01-02-000000' END AS f_run
    FROM (SELECT env, pipeline, zone, step, entity_decl, min(run_id) AS first_run
          FROM ({ENTITY_EVENTS_SQL}) ee GROUP BY ALL) k
"""

# Environment base paths: built-ins plus an override table (env.json style).
ENV_PATHS = {"user": "/data/user", "test": "/data/test", "prod": "/data/prod"}
ENV_PATHS_SQL = ("(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in ENV_PATHS.items())
                 + ") AS env_paths(env, env_path)")


# ---------------------------------------------------------------- ledger

_STATUS = {"F": "COMPLETE", "O": "RUNNING", "P": "FAILED"}


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records: one per order; its lineitems give the run's entities.

    inputs   ``supp_<s>`` -> ``/store/run-<s>/main``   (main output of run s)
    outputs  ``part_<p>`` -> ``/store/<run_id>/part_<p>``, ``main`` -> ``/store/<run_id>/main``
             and ``<pipeline>.reports.<module>`` -> ``/store/<run_id>/reports_<module>``
             (orders with key % 7 = 0 have no report, key % 11 = 0 have two).
    """
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    run_key = lambda c: F.concat(F.lit("run-"), F.lpad(F.col(c).cast("string"), 19, "0"))
    ent = li.groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("supps"),
                                       F.collect_set("l_partkey").alias("parts"))
    rid_of = lambda k: F.concat(F.lit("run-"), F.lpad(k.cast("string"), 19, "0"))
    inputs = F.map_from_arrays(
        F.transform("supps", lambda s: F.concat(F.lit("supp_"), s.cast("string"))),
        F.transform("supps", lambda s: F.concat(F.lit("/store/"), rid_of(s), F.lit("/main"))))
    parts = F.map_from_arrays(
        F.transform("parts", lambda p: F.concat(F.lit("part_"), p.cast("string"))),
        F.transform("parts", lambda p: F.concat(F.lit("/store/"), rid_of(F.col("o_orderkey")),
                                                F.lit("/part_"), p.cast("string"))))
    status = F.create_map(*[x for k, s in _STATUS.items() for x in (F.lit(k), F.lit(s))])
    empty = F.create_map().cast("map<string,string>")
    r = o.join(ent, o.o_orderkey == ent.l_orderkey, "left").select(
        run_key("o_orderkey").alias("run_id"),
        F.concat(F.lit("m"), (F.col("o_custkey") % 4).cast("string")).alias("module"),
        F.col("o_orderpriority").alias("pipeline"),
        F.concat(F.lit("step_"), (F.col("o_custkey") % 10).cast("string")).alias("step"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("commit"),
        status[F.col("o_orderstatus")].alias("status"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_totalprice") / 100).alias("duration_s"),
        F.coalesce(inputs, empty).alias("inputs"),
        F.coalesce(parts, empty).alias("parts"),
        "o_orderkey")
    rid, mod = F.col("run_id"), F.col("module")
    main = F.create_map(F.lit("main"), F.concat(F.lit("/store/"), rid, F.lit("/main")))
    rep_key = F.concat(F.col("pipeline"), F.lit(".reports."), mod)
    rep_url = F.concat(F.lit("/store/"), rid, F.lit("/reports_"), mod)
    reports = (F.when(F.col("o_orderkey") % 7 == 0, empty)
               .when(F.col("o_orderkey") % 11 == 0,
                     F.create_map(rep_key, rep_url, F.concat(F.lit("copy."), rep_key),
                                  F.concat(rep_url, F.lit("_copy"))))
               .otherwise(F.create_map(rep_key, rep_url)))
    return r.select(*[c for c in r.columns if c not in ("parts", "o_orderkey")],
                    F.map_concat("parts", main, reports).alias("outputs"))


RUNS_SQL = """
    SELECT 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0') AS run_id,
           'm' || CAST(o_custkey % 4 AS VARCHAR) AS module,
           o_orderpriority AS pipeline,
           'step_' || CAST(o_custkey % 10 AS VARCHAR) AS step,
           'c' || CAST(o_custkey AS VARCHAR) AS commit,
           CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'RUNNING'
                WHEN 'P' THEN 'FAILED' END AS status,
           o_orderdate AS start_time, o_totalprice / 100 AS duration_s, o_orderkey
    FROM orders
"""

def shared_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs over fixed paths, one per event: each reads two and writes one of 21 paths, a third of
    them ``/custom/0``."""
    e = table(spark, sf_dir, "events")
    path = lambda k, n: F.concat(F.lit("/custom/"), F.when(k % 3 == 0, F.lit(0)).otherwise(n % 20 + 1).cast("string"))
    return e.select(
        F.concat(F.lit("run-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_id"),
        F.col("ts").alias("start_time"),
        F.create_map(F.lit("in"), path(F.col("event_id"), F.col("user_id")),
                     F.lit("also"), path(F.col("event_id") + 1, F.col("event_id"))).alias("inputs"),
        F.create_map(F.lit("out"), path(F.col("event_id") + 2, F.col("user_id"))).alias("outputs"))


def _path_sql(k, n):
    return f"'/custom/' || CAST(CASE WHEN {k} % 3 = 0 THEN 0 ELSE {n} % 20 + 1 END AS VARCHAR)"


SHARED_RUNS_SQL = f"""
    SELECT 'run-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id, ts,
           {_path_sql('event_id', 'user_id')} AS read, {_path_sql('(event_id + 1)', 'event_id')} AS read2,
           {_path_sql('(event_id + 2)', 'user_id')} AS written
    FROM events
"""

# (run_id, direction, name, url) of every run entity, as plain rows.
RUN_ENTITIES_SQL = """
    SELECT DISTINCT 'run-' || lpad(CAST(l_orderkey AS VARCHAR), 19, '0') AS run_id,
           'input' AS direction, 'supp_' || CAST(l_suppkey AS VARCHAR) AS name,
           '/store/run-' || lpad(CAST(l_suppkey AS VARCHAR), 19, '0') || '/main' AS url
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    UNION ALL
    SELECT DISTINCT 'run-' || lpad(CAST(l_orderkey AS VARCHAR), 19, '0'), 'output',
           'part_' || CAST(l_partkey AS VARCHAR),
           '/store/run-' || lpad(CAST(l_orderkey AS VARCHAR), 19, '0') || '/part_'
             || CAST(l_partkey AS VARCHAR)
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    UNION ALL
    SELECT 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0'), 'output', 'main',
           '/store/run-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0') || '/main'
    FROM orders
    UNION ALL
    SELECT 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0'), 'output',
           o_orderpriority || '.reports.m' || CAST(o_custkey % 4 AS VARCHAR),
           '/store/run-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0') || '/reports_m'
             || CAST(o_custkey % 4 AS VARCHAR)
    FROM orders WHERE o_orderkey % 7 <> 0
    UNION ALL
    SELECT 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0'), 'output',
           'copy.' || o_orderpriority || '.reports.m' || CAST(o_custkey % 4 AS VARCHAR),
           '/store/run-' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0') || '/reports_m'
             || CAST(o_custkey % 4 AS VARCHAR) || '_copy'
    FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0
"""


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric writes: run = user, name = event type, ordered by (ts, event_id)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("run-"), F.lpad(F.col("user_id").cast("string"), 19, "0")).alias("run_id"),
        F.col("event_type").alias("name"), "value", "ts", F.col("event_id").alias("seq"))


METRIC_LOG_SQL = """
    SELECT 'run-' || lpad(CAST(user_id AS VARCHAR), 19, '0') AS run_id, event_type AS name,
           value, ts, event_id AS seq
    FROM events
"""


# ---------------------------------------------------------------- diff

def _branch():
    return F.concat(F.col("event_type"), F.lit("-u"), (F.col("user_id") % 30).cast("string"))


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits: one per event, on branch ``<event_type>-u<user % 30>``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(_branch().alias("branch"), F.col("event_id").alias("commit_id"), "ts",
                     F.col("event_id").alias("seq"))


def commit_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(heads, commits, parents) over shared history: a commit per event, one to four events after its
    parent; every sixth also merges one 7 to 17 events before it.  A head per branch: its newest event."""
    ev = table(spark, sf_dir, "events")
    commit = F.col("event_id")
    heads = ev.groupBy(_branch().alias("branch")).agg(F.max("event_id").alias("commit_id"))
    parent = F.explode(F.array_compact(F.array(
        commit - 1 - commit % 4, F.when(commit % 6 == 0, commit - 7 - commit % 11)))).alias("parent_id")
    parents = ev.select(commit.alias("commit_id"), parent).filter("parent_id >= 0")
    return heads, ev.select(commit.alias("commit_id"), "ts"), parents


COMMIT_GRAPH_SQL = """
    heads AS (SELECT event_type || '-u' || CAST(user_id % 30 AS VARCHAR) AS branch, max(event_id) AS commit_id
              FROM events GROUP BY 1),
    parents AS (SELECT event_id AS commit_id, unnest([event_id - 1 - event_id % 4,
                  CASE WHEN event_id % 6 = 0 THEN event_id - 7 - event_id % 11 END]) AS parent_id FROM events)
"""


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags: value >= 95 tags a run; >= 200 adds a second run tag on the same
    commit; >= 150 adds a non-run ``diff.`` tag."""
    ev = table(spark, sf_dir, "events")
    rid = run_id_of("ts")
    path = F.concat(F.lit("/data/user/"), F.col("event_type"), F.lit("/zone/"), rid)
    a = ev.filter(F.col("value") >= 95).select(
        F.col("event_id").alias("commit_id"), rid.alias("tag_name"), path.alias("message"))
    b = ev.filter(F.col("value") >= 200).select(
        F.col("event_id").alias("commit_id"), F.concat(rid, F.lit("b")).alias("tag_name"),
        F.concat(path, F.lit("b")).alias("message"))
    c = ev.filter(F.col("value") >= 150).select(
        F.col("event_id").alias("commit_id"),
        F.concat(F.lit("diff."), F.col("event_id").cast("string")).alias("tag_name"),
        F.lit("").alias("message"))
    return a.unionByName(b).unionByName(c)


COMMITS_SQL = """
    SELECT event_type || '-u' || CAST(user_id % 30 AS VARCHAR) AS branch,
           event_id AS commit_id, ts, event_id AS seq
    FROM events
"""
TAGS_SQL = """
    SELECT event_id AS commit_id, strftime(ts, 'run-%y-%m-%d-%H%M%S') AS tag_name,
           '/data/user/' || event_type || '/zone/' || strftime(ts, 'run-%y-%m-%d-%H%M%S') AS message
    FROM events WHERE value >= 95
    UNION ALL
    SELECT event_id, strftime(ts, 'run-%y-%m-%d-%H%M%S') || 'b',
           '/data/user/' || event_type || '/zone/' || strftime(ts, 'run-%y-%m-%d-%H%M%S') || 'b'
    FROM events WHERE value >= 200
    UNION ALL
    SELECT event_id, 'diff.' || CAST(event_id AS VARCHAR), '' FROM events WHERE value >= 150
"""


def modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report modules of two runs per pair (every event is one module write):
    pair = ``pair_<user % 10>``; value > 55 -> current run, else target run;
    module = ``reports.<event_type>_v<value div 10>``, so the sides overlap in
    one value band and differ elsewhere."""
    ev = table(spark, sf_dir, "events")
    side = F.when(F.col("value") > 55, "curr").otherwise("target")
    pair = F.concat(F.lit("pair_"), (F.col("user_id") % 10).cast("string"))
    x = ev.select(pair.alias("pair"), side.alias("side"), run_id_of("ts").alias("run_id"),
                  F.concat(F.lit("reports."), F.col("event_type"), F.lit("_v"),
                           F.floor(F.col("value") / 10).cast("long").cast("string"))
                  .alias("module"))
    return x.select("pair", "side", "run_id",
                    F.concat(F.lit("/data/user/diffs/zone/"), F.col("pair"), F.lit("/"),
                             F.col("run_id")).alias("run_path"), "module")


MODULES_SQL = """
    SELECT pair, side, run_id, '/data/user/diffs/zone/' || pair || '/' || run_id AS run_path, module
    FROM (SELECT 'pair_' || CAST(user_id % 10 AS VARCHAR) AS pair,
                 CASE WHEN value > 55 THEN 'curr' ELSE 'target' END AS side,
                 strftime(ts, 'run-%y-%m-%d-%H%M%S') AS run_id,
                 'reports.' || event_type || '_v' || CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)
                   AS module
          FROM events)
"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Module contents: documents paired by ``doc_id div 2`` (even = current)."""
    d = table(spark, sf_dir, "documents")
    return d.select((F.col("doc_id") / 2).cast("long").alias("pair"),
                    F.when(F.col("doc_id") % 2 == 0, "curr").otherwise("target").alias("side"),
                    "text")


TEXTS_SQL = """
    SELECT doc_id // 2 AS pair, CASE WHEN doc_id % 2 = 0 THEN 'curr' ELSE 'target' END AS side, text
    FROM documents
"""


def diff_requests(spark: SparkSession, sf_dir: str, only_type: str | None = None) -> DataFrame:
    """Diff requests: each event asks for its run against the run one day earlier."""
    ev = table(spark, sf_dir, "events")
    if only_type:
        ev = ev.filter(F.col("event_type") == only_type)
    cur = run_id_of("ts")
    tgt = run_id_of(F.col("ts") - F.expr("INTERVAL 1 DAY"))
    return ev.select(F.concat(F.lit("pair_"), (F.col("user_id") % 10).cast("string")).alias("pair"),
                     cur.alias("curr_run"), tgt.alias("target_run"),
                     F.concat(F.lit("diff."), cur, F.lit("."), tgt).alias("diff_id"))


def _diff_requests_sql(where: str = "") -> str:
    return f"""
    SELECT 'pair_' || CAST(user_id % 10 AS VARCHAR) AS pair,
           strftime(ts, 'run-%y-%m-%d-%H%M%S') AS curr_run,
           strftime(ts - INTERVAL 1 DAY, 'run-%y-%m-%d-%H%M%S') AS target_run,
           'diff.' || strftime(ts, 'run-%y-%m-%d-%H%M%S') || '.'
             || strftime(ts - INTERVAL 1 DAY, 'run-%y-%m-%d-%H%M%S') AS diff_id
    FROM events {where}
"""


DIFF_REQUESTS_SQL = _diff_requests_sql()
DIFF_EXISTING_SQL = _diff_requests_sql("WHERE event_type = 'signup'")


# ---------------------------------------------------------------- params / cells

def param_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter layers per event: defaults < file (props) < sent < override.

    sent: click -> {k: user % 7}; signup -> {pipeline_name: signup_pipe} and
    replaces the file layer.  override: value > 200 -> zone; user % 13 = 0 ->
    empty env_name.
    """
    from runvault.operators.params import parse_params
    ev = table(spark, sf_dir, "events")
    defaults = F.create_map(F.lit("env_name"), F.lit("user"), F.lit("k"), F.lit("0"),
                            F.lit("zone"), F.lit("zone"))
    sent = (F.when(F.col("event_type") == "click",
                   F.create_map(F.lit("k"), (F.col("user_id") % 7).cast("string")))
            .when(F.col("event_type") == "signup",
                  F.create_map(F.lit("pipeline_name"), F.lit("signup_pipe"))))
    zone = F.when(F.col("value") > 200, F.create_map(
        F.lit("zone"), F.concat(F.lit("zone_"), (F.col("user_id") % 2).cast("string"))))
    env = F.when(F.col("user_id") % 13 == 0, F.create_map(F.lit("env_name"), F.lit("")))
    from runvault.operators.params import merge_layers
    return ev.select(
        "event_id", "event_type", "user_id", "value",
        defaults.alias("defaults"), parse_params("props").alias("file_params"),
        sent.alias("sent_params"), merge_layers(zone, env).alias("override_params"),
        (F.col("event_type") == "signup").alias("replace_file"))


PARAMS_MERGED_SQL = """
    SELECT event_id,
           CASE WHEN user_id % 13 = 0 THEN '' ELSE 'user' END AS env_name,
           CASE WHEN event_type = 'signup' THEN '0'
                WHEN event_type = 'click' THEN CAST(user_id % 7 AS VARCHAR)
                ELSE coalesce(json_extract_string(props, '$.k'), '0') END AS k,
           CASE WHEN value > 200 THEN 'zone_' || CAST(user_id % 2 AS VARCHAR) ELSE 'zone' END AS zone,
           CASE WHEN event_type = 'signup' THEN 'signup_pipe' END AS pipeline_name
    FROM events
"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notebook cells: one per conversation turn (see FIXTURES.md)."""
    c = table(spark, sf_dir, "conversations")
    tag_opts = F.array(
        F.col("role"),
        F.when((F.col("turn") == 1) & (F.col("conv_id") % 7 != 0),
               F.when(F.col("conv_id") % 3 == 0, F.lit("PARAMETERS")).otherwise(F.lit("parameters"))),
        F.when((F.col("turn") == 3) & (F.col("conv_id") % 5 == 0), F.lit("parameters")),
        F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1),
               F.lit("business_report")))
    return c.select(
        F.col("conv_id").alias("nb_id"), F.col("turn").alias("pos"),
        F.when(F.col("role") == "system", "markdown").otherwise("code").alias("cell_type"),
        F.filter(tag_opts, lambda x: x.isNotNull()).alias("tags"),
        F.col("text").alias("source"),
        F.when(F.col("role") == "assistant", F.array(F.col("text")))
        .otherwise(F.array().cast("array<string>")).alias("outputs"))


CELLS_SQL = """
    SELECT conv_id AS nb_id, turn AS pos,
           CASE WHEN role = 'system' THEN 'markdown' ELSE 'code' END AS cell_type,
           list_filter([role,
                        CASE WHEN turn = 1 AND conv_id % 7 <> 0 THEN
                             CASE WHEN conv_id % 3 = 0 THEN 'PARAMETERS' ELSE 'parameters' END END,
                        CASE WHEN turn = 3 AND conv_id % 5 = 0 THEN 'parameters' END,
                        CASE WHEN role = 'assistant' AND turn % 4 = 1 THEN 'business_report' END],
                       lambda x: x IS NOT NULL) AS tags,
           text AS source,
           CASE WHEN role = 'assistant' THEN [text] ELSE []::VARCHAR[] END AS outputs
    FROM conversations
"""


# ---------------------------------------------------------------- artefacts

def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model artefacts: one per document, bundled by source (see FIXTURES.md)."""
    from runvault.operators import artifacts as ar
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    kind = ar.artifact_kind(F.when(did % 10 == 0, F.lit("binary")),
                            F.when(F.col("lang") == "en", "str")
                            .when(F.col("lang") == "fr", "dict").otherwise("bytes"))
    raw_ext = F.when(F.col("lang") == "de", F.lit("bin")).otherwise(F.lit(".dat"))
    base = F.concat(F.lit("/bundles/"), F.col("source"), F.lit("/artifacts"),
                    F.when(did % 4 == 0, F.lit("/model.onnx")).otherwise(F.lit("")))
    name = F.concat(F.lit("doc "), did.cast("string"), F.lit("#v1"))
    x = d.select("doc_id", F.col("source").alias("bundle"), name.alias("name"),
                 kind.alias("kind"), raw_ext.alias("raw_ext"), base.alias("base_path"),
                 F.when(did % 3 == 0, F.concat(F.lit("v"), did.cast("string"))).alias("given"),
                 F.concat(F.lit("run-"), F.lpad((did % 50).cast("string"), 19, "0")).alias("run_id"),
                 F.element_at(F.array(*[F.lit(p) for p in ("onnx_service", "pytorch_service", "binary_service")]),
                              (did % 3 + 1).cast("int")).alias("profile_name"),
                 F.concat(F.lit('{"doc": '), did.cast("string"), F.lit("}")).alias("profile_params"),
                 F.encode("text", "UTF-8").alias("content"))
    ext = (F.when(F.col("kind") == "text", F.lit(".txt"))
           .when(F.col("kind") == "json", F.lit(".json"))
           .otherwise(ar.normalize_extension("raw_ext")))
    return x.select(
        "doc_id", "bundle", "name", "kind", ext.alias("ext"),
        ar.artifact_file_path("base_path", "name", ext).alias("file_path"),
        ar.service_version("given", F.lit("user"), F.lit("models"), F.lit("zone"), "bundle",
                           "run_id").alias("version"),
        ar.profile("profile_name", "profile_params").alias("profile"), "content")


ARTIFACTS_SQL = """
    SELECT doc_id, bundle, name, kind, ext,
           CASE WHEN instr(split_part(base_path, '/', -1), '.') > 0 THEN base_path
                ELSE base_path || '/' || regexp_replace(name, '[^-a-zA-Z0-9_.() ]+', '', 'g') || ext
           END AS file_path,
           coalesce(given, 'user.models.zone.' || bundle || '.' || run_id) AS version,
           profile_name, encode(text) AS content
    FROM (SELECT doc_id, text, source AS bundle, 'doc ' || CAST(doc_id AS VARCHAR) || '#v1' AS name,
                 CASE WHEN doc_id % 10 = 0 THEN 'binary' WHEN lang = 'en' THEN 'text'
                      WHEN lang = 'fr' THEN 'json' ELSE 'binary' END AS kind,
                 CASE WHEN doc_id % 10 <> 0 AND lang = 'en' THEN '.txt'
                      WHEN doc_id % 10 <> 0 AND lang = 'fr' THEN '.json'
                      WHEN lang = 'de' THEN '.bin' ELSE '.dat' END AS ext,
                 '/bundles/' || source || '/artifacts'
                   || CASE WHEN doc_id % 4 = 0 THEN '/model.onnx' ELSE '' END AS base_path,
                 CASE WHEN doc_id % 3 = 0 THEN 'v' || CAST(doc_id AS VARCHAR) END AS given,
                 'run-' || lpad(CAST(doc_id % 50 AS VARCHAR), 19, '0') AS run_id,
                 ['onnx_service', 'pytorch_service', 'binary_service'][CAST(doc_id % 3 AS INTEGER) + 1] AS profile_name
          FROM documents) a
"""
