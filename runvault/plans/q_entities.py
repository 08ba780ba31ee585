"""Registered versioned-entity queries over ``events`` (see FIXTURES.md)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runvault.functions.names import path_part
from runvault.operators import entities as en
from runvault.plans import views as v
from runvault.plans.registry import query
from runvault.session import scratch_dir
from runvault.sinks.publish import publish
from runvault.functions.names import COMMIT_MARKER
from runvault.sinks.archive import write_files
from runvault.sources.folders import VERSION_LEVELS, folders
from runvault.sources.versions import scan_versions

_V = f"WITH v AS ({v.ENTITY_VERSIONS_SQL})"
_OVERRIDE = {"prod": "/mnt/prod"}


def _env_paths(spark):
    return en.env_paths_frame(spark, overrides=_OVERRIDE, base=v.ENV_PATHS)


def _env_paths_sql():
    merged = {**v.ENV_PATHS, **_OVERRIDE}
    return ("(SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{p}')" for k, p in merged.items())
            + ") t(env, env_path))")


@query("entity_latest", f"""{_V}
SELECT env, pipeline, zone, step, entity, max(run_id) AS run_id, count(*) AS n_versions
FROM v WHERE committed GROUP BY ALL""")
def entity_latest(spark, sf_dir):
    """A1: latest committed run per entity key."""
    return en.latest_committed(v.entity_versions(spark, sf_dir))


@query("entity_latest_tmp", f"""{_V}
SELECT env, pipeline, zone, step, entity, max(run_id) AS run_id, count(*) AS n_versions
FROM v GROUP BY ALL""")
def entity_latest_tmp(spark, sf_dir):
    """A2: latest run per key without the commit marker (temporary entities)."""
    return en.latest_any(v.entity_versions(spark, sf_dir))


@query("entity_last_versions", f"""{_V}
SELECT * FROM (
  SELECT env, pipeline, zone, step, entity, run_id, committed, written_at,
         CAST(row_number() OVER (PARTITION BY env, pipeline, zone, step, entity
                                 ORDER BY run_id DESC) AS INTEGER) AS version_rank
  FROM v WHERE committed) WHERE version_rank <= 3""")
def entity_last_versions(spark, sf_dir):
    """The three newest committed versions of every entity with their rank."""
    return en.last_versions(v.entity_versions(spark, sf_dir), 3)


@query("entity_urls", f"""{_V}
SELECT v.*, concat_ws('.', v.env, pipeline, zone, step, replace(entity, '.', '_')) AS full_name,
       CASE WHEN e.env_path IS NOT NULL THEN concat_ws('/', e.env_path, pipeline, zone, step,
            run_id, replace(entity, '.', '_')) END AS url,
       e.env_path IS NOT NULL AS env_known
FROM v LEFT JOIN {_env_paths_sql()} e ON e.env = v.env""")
def entity_urls(spark, sf_dir):
    """Full name and storage URL of every version (env paths with override)."""
    return en.with_urls(v.entity_versions(spark, sf_dir), _env_paths(spark))


_RESOLVE_SQL = f"""
WITH v AS ({v.ENTITY_VERSIONS_SQL}),
r0 AS ({v.REQUESTS_SQL}),
r AS (SELECT consumer, step_name, entity,
             coalesce(env, f_env, cur_env) AS r_env,
             coalesce(pipeline, f_pipeline, cur_pipeline) AS r_pipeline,
             coalesce(zone, f_zone, cur_zone) AS r_zone,
             coalesce(f_zone, cur_zone) AS call_zone,
             run_id AS decl_run, f_env, f_pipeline, f_zone, f_run
      FROM r0),
r2 AS (SELECT *, (f_env IS NULL AND f_pipeline IS NULL AND f_zone IS NULL)
                 OR (f_env IS NOT NULL AND r_env = f_env)
                 OR (f_pipeline IS NOT NULL AND r_pipeline = f_pipeline)
                 OR (f_zone IS NOT NULL AND r_zone = f_zone) AS passes
       FROM r),
pc AS (SELECT consumer, step_name, count(DISTINCT r_zone) AS n_zones,
              max(CASE WHEN passes AND r_zone = call_zone THEN 1 ELSE 0 END) AS has_cur_zone
       FROM r2 GROUP BY ALL),
lat AS (SELECT env, pipeline, zone, step, entity, max(run_id) AS latest_run
        FROM v WHERE committed GROUP BY ALL),
cv AS (SELECT DISTINCT env, pipeline, zone, step, entity, run_id FROM v WHERE committed),
x AS (SELECT r2.*, pc.n_zones, pc.has_cur_zone, replace(r2.entity, '.', '_') AS entity_key,
             coalesce(f_run, decl_run) AS pin
      FROM r2 JOIN pc USING (consumer, step_name) WHERE passes),
y AS (SELECT x.*, lat.latest_run, cv.run_id AS pinned_run, ep.env_path,
             CASE WHEN x.pin IS NOT NULL THEN cv.run_id ELSE lat.latest_run END AS run
      FROM x
      LEFT JOIN lat ON lat.env = x.r_env AND lat.pipeline = x.r_pipeline AND lat.zone = x.r_zone
                   AND lat.step = x.step_name AND lat.entity = x.entity_key
      LEFT JOIN cv ON cv.env = x.r_env AND cv.pipeline = x.r_pipeline AND cv.zone = x.r_zone
                  AND cv.step = x.step_name AND cv.entity = x.entity_key AND cv.run_id = x.pin
      LEFT JOIN {_env_paths_sql()} ep ON ep.env = x.r_env),
z AS (SELECT y.*,
             CASE WHEN instr(entity, '/') > 0 THEN 'invalid_name'
                  WHEN env_path IS NULL THEN 'unknown_env'
                  WHEN n_zones > 1 AND r_zone <> call_zone AND has_cur_zone = 1 THEN 'zone_dropped'
                  WHEN n_zones > 1 AND has_cur_zone = 0 THEN 'ambiguous'
                  WHEN f_run IS NOT NULL AND coalesce(decl_run, '') <> f_run THEN 'pin_mismatch'
                  WHEN run IS NULL THEN 'missing'
                  ELSE 'resolved' END AS status
      FROM y)
SELECT consumer, step_name, entity, r_env AS env, r_pipeline AS pipeline, r_zone AS zone,
       CASE WHEN status = 'resolved' THEN run END AS run_id,
       concat_ws('.', r_env, r_pipeline, r_zone, step_name, entity_key) AS full_name,
       CASE WHEN status = 'resolved'
            THEN concat_ws('/', env_path, r_pipeline, r_zone, step_name, run, entity_key) END AS url,
       status
FROM z"""


@query("entity_resolve", _RESOLVE_SQL)
def entity_resolve(spark, sf_dir):
    """J1 + P8 + P9 + A8: every declared input resolved to a version and URL."""
    return en.resolve_inputs(v.requests(spark, sf_dir), v.entity_versions(spark, sf_dir),
                             _env_paths(spark))


# Declarations: the requests above as key maps, with a few deliberately bad ones:
# step_5 declared as outputs (keys not allowed), step_8 as custom_inputs
# (ENTITY_PATH missing), step_9 without STEP_NAME, step_6 of report_error
# with a '/' in the entity name.
_DECL_COLS = {"ENTITY_NAME": "d_entity", "STEP_NAME": "d_step", "ENV_NAME": "env",
              "PIPELINE_NAME": "pipeline", "ZONE_NAME": "zone", "RUN_ID": "run_id",
              "ENTITY_PATH": "d_path"}


def _declarations(spark, sf_dir):
    r = v.requests(spark, sf_dir)
    kind = (F.when(F.col("step_name") == "step_5", "outputs")
            .when(F.col("step_name") == "step_8", "custom_inputs").otherwise("inputs"))
    d = r.select(
        "consumer", "step_name", "entity", kind.alias("kind"),
        F.when((F.col("step_name") == "step_6") & (F.col("consumer") == "report_error"),
               F.concat("entity", F.lit("/v2"))).otherwise(F.col("entity")).alias("d_entity"),
        F.when(F.col("step_name") != "step_9", F.col("step_name")).alias("d_step"),
        "env", "pipeline", "zone", "run_id", F.lit(None).cast("string").alias("d_path"))
    return en.declaration_map(d, _DECL_COLS)


def _violations_sql():
    base = f"""(SELECT consumer, step_name, entity,
        CASE WHEN step_name = 'step_5' THEN 'outputs' WHEN step_name = 'step_8'
             THEN 'custom_inputs' ELSE 'inputs' END AS kind,
        CASE WHEN step_name = 'step_6' AND consumer = 'report_error' THEN entity || '/v2'
             ELSE entity END AS d_entity,
        CASE WHEN step_name <> 'step_9' THEN step_name END AS d_step,
        env, pipeline, zone, run_id, CAST(NULL AS VARCHAR) AS d_path
      FROM ({v.REQUESTS_SQL}) r0) d"""
    parts = []
    for kind, (req, allowed) in en.DECLARATION_KEYS.items():
        for key, col in _DECL_COLS.items():
            if key in req:
                parts.append(f"SELECT consumer, step_name, entity, kind, 'missing key' AS problem, "
                             f"'{key}' AS key FROM {base} WHERE kind = '{kind}' AND {col} IS NULL")
            if key not in allowed:
                parts.append(f"SELECT consumer, step_name, entity, kind, 'key not allowed', "
                             f"'{key}' FROM {base} WHERE kind = '{kind}' AND {col} IS NOT NULL")
    parts.append(f"SELECT consumer, step_name, entity, kind, 'slash in name', 'ENTITY_NAME' "
                 f"FROM {base} WHERE instr(d_entity, '/') > 0")
    return "\nUNION ALL\n".join(parts)


@query("declaration_violations", _violations_sql())
def declaration_violations(spark, sf_dir):
    """Required and allowed keys per declaration kind, names without '/'."""
    out = en.declaration_violations(_declarations(spark, sf_dir))
    return out.select("consumer", "step_name", "entity", "kind", "problem", "key")


@query("published_scan", f"""
SELECT env, 'writes' AS entity, 'run-24-01-02-000000' AS run_id, CAST(2 AS BIGINT) AS n_versions,
       count(*) FILTER (committed) AS n_rows, sum(event_id) FILTER (committed) AS id_sum
FROM ({v.ENTITY_EVENTS_SQL}) ee GROUP BY env""")
def published_scan(spark, sf_dir):
    """Two versions per environment published, found by their markers, the newest read back."""
    root = scratch_dir(spark, "published-scan")
    writes = v.entity_events(spark, sf_dir)
    folder = "events/zone/step"
    for env in v.ENV_PATHS:  # a version is one write job; the number of environments is fixed
        for run, committed in (("run-24-01-01-000000", False), ("run-24-01-02-000000", True)):
            part = writes.filter((F.col("env") == env) & (F.col("committed") == committed))
            publish(part.select("event_id", "value"), f"{root}/{env}/{folder}/{run}/writes")
    found = reduce(DataFrame.unionByName, [scan_versions(spark, e, f"{root}/{e}") for e in v.ENV_PATHS])
    latest = en.latest_committed(found)
    path = F.col("_metadata.file_path")
    rows = spark.read.parquet(f"{root}/*/{folder}/*/writes").select(
        path_part(path, -7).alias("env"), path_part(path, -3).alias("run_id"), "event_id")
    sums = rows.groupBy("env", "run_id").agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("id_sum"))
    return latest.join(sums, ["env", "run_id"]).select("env", "entity", "run_id", "n_versions", "n_rows", "id_sum")


@query("version_folders", f"""
WITH k AS (SELECT env, pipeline, zone, step, entity, max(run_id) AS newest,
                  max(run_id) FILTER (committed) AS newest_committed
           FROM ({v.ENTITY_VERSIONS_SQL}) GROUP BY ALL)
SELECT DISTINCT env, pipeline, zone, step, entity, run_id, run_id = newest_committed IS TRUE AS committed
FROM (SELECT *, unnest([newest, newest_committed]) AS run_id FROM k)
WHERE run_id IS NOT NULL AND step = 'step_3' AND env IN ('user', 'prod') AND pipeline >= 'p'""")
def version_folders(spark, sf_dir):
    """The newest and the newest committed version of every entity as folders (the former
    often without a marker), read as a table whose filters prune the walk."""
    versions = v.entity_versions(spark, sf_dir)
    key = ["env", "pipeline", "zone", "step", "entity"]
    newest = versions.groupBy(*key).agg(
        F.max("run_id").alias("any"), F.max(F.when(F.col("committed"), F.col("run_id"))).alias("done"))
    kept = newest.select(*key, "done", F.explode(F.array_distinct(F.array_compact(F.array("any", "done")))).alias("run_id"))
    name = F.when(F.col("run_id") == F.col("done"), COMMIT_MARKER).otherwise("part-0")
    files = kept.select(F.concat(F.lit("/"), F.concat_ws("/", "env", "pipeline", "zone", "step", "run_id", "entity", name)).alias("rel_path"),
                        F.lit(0).alias("part"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("length"),
                        F.lit(0).cast("long").alias("file_length"), F.lit(b"").alias("content"))
    root = scratch_dir(spark, "version-folders")
    write_files(files, root)
    found = folders(spark, root, f"env/{VERSION_LEVELS}", ahead=4)
    return found.filter("step = 'step_3' and env in ('user', 'prod') and pipeline >= 'p'").select(*key, "run_id", "committed")
