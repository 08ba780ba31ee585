"""Versioned entities: latest versions, declared-input resolution, URLs.

Data shapes
-----------
versions   env, pipeline, zone, step, entity, run_id, committed [, written_at]
           one row per stored version; entity names already normalised
requests   consumer, cur_env, cur_pipeline, cur_zone, step_name, entity,
           env?, pipeline?, zone?, run_id?   (declared keys, null = unset)
           f_env?, f_pipeline?, f_zone?, f_run?   (the consumer's call filters)
env_paths  env, env_path

Resolution is one plan: one aggregation of the versions, which answers latest
and pinned requests alike, one equi-join with it and a per-call zone count.
Nothing is collected; AQE picks broadcast for the small sides at run time from
measured sizes and falls back to sort-merge joins beyond the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runvault.functions.names import entity_full_name, entity_url, normalize_entity

KEY = ["env", "pipeline", "zone", "step", "entity"]

# Fixed declaration key names and the key sets of each declaration kind.
ENV_NAME, PIPELINE_NAME, ZONE_NAME = "ENV_NAME", "PIPELINE_NAME", "ZONE_NAME"
STEP_NAME, RUN_ID, ENTITY_NAME, ENTITY_PATH = "STEP_NAME", "RUN_ID", "ENTITY_NAME", "ENTITY_PATH"
DECLARATION_KEYS = {
    # kind: (required, allowed)
    "inputs": ([STEP_NAME, ENTITY_NAME],
               [STEP_NAME, ENTITY_NAME, ENV_NAME, PIPELINE_NAME, ZONE_NAME, RUN_ID]),
    "outputs": ([ENTITY_NAME], [ENTITY_NAME]),
    "custom_inputs": ([ENTITY_NAME, ENTITY_PATH], [ENTITY_NAME, ENTITY_PATH]),
    "custom_outputs": ([ENTITY_NAME, ENTITY_PATH], [ENTITY_NAME, ENTITY_PATH]),
    "tmp_inputs": ([ENTITY_NAME], [ENTITY_NAME]),
    "tmp_outputs": ([ENTITY_NAME], [ENTITY_NAME]),
    "tmp_entities": ([ENTITY_NAME], [ENTITY_NAME]),
}


# ------------------------------------------------------------------ A1 / A2 / W2

def latest_committed(versions: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Latest committed run per key (run ids order as text)."""
    return (versions.filter(F.col("committed"))
            .groupBy(*key)
            .agg(F.max("run_id").alias("run_id"),
                 F.count(F.lit(1)).alias("n_versions")))


def latest_any(versions: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Latest run per key ignoring the commit marker (temporary entities)."""
    return versions.groupBy(*key).agg(F.max("run_id").alias("run_id"),
                                      F.count(F.lit(1)).alias("n_versions"))


def last_versions(versions: DataFrame, n: int, key: list[str] = KEY,
                  committed_only: bool = True) -> DataFrame:
    """The ``n`` newest versions per key with their rank (1 = newest).

    ``row_number() <= n`` lets Spark insert a partial window-group limit
    before the shuffle, so a hot key ships at most ``n`` rows per map task.
    """
    v = versions.filter(F.col("committed")) if committed_only else versions
    w = Window.partitionBy(*key).orderBy(F.col("run_id").desc())
    return (v.withColumn("version_rank", F.row_number().over(w))
            .filter(F.col("version_rank") <= n))


# ------------------------------------------------------------------ P4 / P5 / J2

def env_paths_frame(spark: SparkSession, base: dict[str, str],
                    overrides: dict[str, str] | None = None) -> DataFrame:
    """Environment -> base path table: ``base``, then overrides (right wins).

    Built from a driver-side config dict, so its size is bounded by the
    number of configured environments; joins may broadcast it safely.
    """
    merged = dict(base)
    merged.update(overrides or {})
    return spark.createDataFrame(sorted(merged.items()), "env string, env_path string")


def with_urls(versions: DataFrame, env_paths: DataFrame) -> DataFrame:
    """Add ``full_name`` and ``url``; unknown environments get a null url
    and ``env_known = false`` (the reference raises)."""
    j = versions.join(F.broadcast(env_paths), "env", "left")
    return j.select(
        *versions.columns,
        entity_full_name("env", "pipeline", "zone", "step", normalize_entity("entity"))
        .alias("full_name"),
        F.when(F.col("env_path").isNotNull(),
               entity_url("env_path", "pipeline", "zone", "step", "run_id", "entity"))
        .alias("url"),
        F.col("env_path").isNotNull().alias("env_known"))


# ------------------------------------------------------------------ P6 / P7

def declaration_map(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Pack declaration columns into ``decl map<string,string>`` keeping set keys."""
    kv = []
    for key, col in columns.items():
        kv += [F.lit(key), F.col(col)]
    return df.withColumn("decl", F.map_filter(F.create_map(*kv), lambda k, v: v.isNotNull()))


def declaration_violations(decls: DataFrame, kind_col: str = "kind",
                           decl_col: str = "decl") -> DataFrame:
    """Rows ``(*, problem, key)`` for every missing required key, every key
    outside the allowed set, and every entity name containing ``/``."""
    req = F.create_map(*[x for k, (r, _) in DECLARATION_KEYS.items()
                         for x in (F.lit(k), F.array(*map(F.lit, r)))])
    allowed = F.create_map(*[x for k, (_, a) in DECLARATION_KEYS.items()
                             for x in (F.lit(k), F.array(*map(F.lit, a)))])
    keys = F.map_keys(decl_col)
    kind = F.col(kind_col)
    missing = F.array_except(F.coalesce(req[kind], F.array().cast("array<string>")), keys)
    extra = F.when(allowed[kind].isNotNull(), F.array_except(keys, allowed[kind])).otherwise(
        F.array().cast("array<string>"))
    bad_name = F.when(F.instr(F.col(decl_col)[ENTITY_NAME], "/") > 0,
                      F.array(F.lit(ENTITY_NAME))).otherwise(F.array().cast("array<string>"))
    unknown_kind = F.when(req[kind].isNull(), F.array(kind)).otherwise(
        F.array().cast("array<string>"))
    probs = F.concat(
        F.transform(unknown_kind, lambda k: F.struct(F.lit("unknown kind").alias("problem"),
                                                     k.alias("key"))),
        F.transform(missing, lambda k: F.struct(F.lit("missing key").alias("problem"),
                                                k.alias("key"))),
        F.transform(extra, lambda k: F.struct(F.lit("key not allowed").alias("problem"),
                                              k.alias("key"))),
        F.transform(bad_name, lambda k: F.struct(F.lit("slash in name").alias("problem"),
                                                 k.alias("key"))))
    out = decls.select("*", F.explode(probs).alias("p"))
    return out.select(*decls.columns, F.col("p.problem").alias("problem"),
                      F.col("p.key").alias("key"))


# ------------------------------------------------------------------ P8 P9 A8 J1

LATEST = "latest"


def _run_slot(run_id: Column | str) -> Column:
    return F.concat(F.lit("="), run_id)


def version_slots(versions: DataFrame) -> DataFrame:
    """(key, slot, run): what a request of a key gets, pinned to a run or for the latest one.

    Every committed version offers itself under its own run id and under
    ``latest``, and one aggregation by (key, slot) answers both: the latest run
    combines to one row per task and key before the shuffle.  Over a version
    table bucketed by the key (``bucket_versions``) there is no shuffle.
    """
    v = versions.filter(F.col("committed") & F.col("run_id").isNotNull())
    return (v.select(*KEY, "run_id", F.explode(F.array(F.lit(LATEST), _run_slot("run_id"))).alias("slot"))
            .groupBy(*KEY, "slot").agg(F.max("run_id").alias("run")))


def bucket_versions(versions: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``versions`` as table ``name``, bucketed by the key, and read it.

    ``resolve_inputs`` then neither shuffles the table to aggregate it nor, with
    ``spark.sql.requireAllClusterKeysForCoPartition=false``, to join it; leave
    that setting alone where one key holds a large share of the requests.
    """
    w = versions.write.format("parquet").bucketBy(buckets, *KEY).mode("overwrite")
    (w.option("path", path) if path else w).saveAsTable(name)
    return versions.sparkSession.table(name)


def resolve_inputs(requests: DataFrame, versions: DataFrame,
                   env_paths: DataFrame) -> DataFrame:
    """Resolve declared inputs to concrete versions and URLs.

    Rules, per call (consumer, step_name):
    * unset declared env / pipeline / zone take the call's filter value when
      given, else the consumer's current value;
    * env / pipeline / zone filters combine with OR; no filter keeps all;
    * when the step's declared inputs span more than one zone, only the
      current zone is kept (``zone_dropped``); if none is in the current
      zone the call is ``ambiguous``;
    * a run filter keeps requests whose declared run id equals it
      (``pin_mismatch`` otherwise); a declared run id pins the version;
    * otherwise the latest committed run is used; none -> ``missing``.

    Output: consumer, step_name, entity, env, pipeline, zone, run_id,
    full_name, url, status (``resolved`` or the reason it is not).
    """
    r = requests
    cur_env = F.coalesce("f_env", "cur_env")
    cur_pipe = F.coalesce("f_pipeline", "cur_pipeline")
    cur_zone = F.coalesce("f_zone", "cur_zone")
    r = r.select(
        "consumer", "step_name", "entity",
        F.coalesce("env", cur_env).alias("r_env"),
        F.coalesce("pipeline", cur_pipe).alias("r_pipeline"),
        F.coalesce("zone", cur_zone).alias("r_zone"),
        cur_zone.alias("call_zone"),
        F.col("run_id").alias("decl_run"), "f_env", "f_pipeline", "f_zone", "f_run")
    any_filter = (F.col("f_env").isNotNull() | F.col("f_pipeline").isNotNull()
                  | F.col("f_zone").isNotNull())
    passes = (~any_filter
              | (F.col("f_env").isNotNull() & (F.col("r_env") == F.col("f_env")))
              | (F.col("f_pipeline").isNotNull() & (F.col("r_pipeline") == F.col("f_pipeline")))
              | (F.col("f_zone").isNotNull() & (F.col("r_zone") == F.col("f_zone"))))
    r = r.withColumn("passes", passes).withColumn("entity_key", normalize_entity("entity"))
    key_l = [F.col("r_env"), F.col("r_pipeline"), F.col("r_zone"), F.col("step_name"),
             F.col("entity_key")]
    call = ["consumer", "step_name"]
    per_call = r.groupBy(*call).agg(
        F.size(F.collect_set("r_zone")).alias("n_zones"),
        F.max((F.col("passes") & (F.col("r_zone") == F.col("call_zone"))).cast("int"))
        .alias("has_cur_zone"))
    pin = F.coalesce("f_run", "decl_run")
    r = (r.filter("passes").join(per_call, call, "left")
         .withColumn("slot", F.when(pin.isNull(), F.lit(LATEST)).otherwise(_run_slot(pin))))

    a = version_slots(versions).select(*[F.col(c).alias(f"a_{c}") for c in (*KEY, "slot")], "run")
    asked = [F.col("r_env"), F.col("r_pipeline"), F.col("r_zone"), F.col("step_name"),
             F.col("entity_key"), F.col("slot")]
    j = (r.join(a, [x == F.col(f"a_{c}") for x, c in zip(asked, (*KEY, "slot"))], "left")
         .join(F.broadcast(env_paths.withColumnRenamed("env", "r_env")), "r_env", "left"))

    run = F.col("run")
    status = (F.when(F.instr("entity", "/") > 0, "invalid_name")
              .when(F.col("env_path").isNull(), "unknown_env")
              .when((F.col("n_zones") > 1) & (F.col("r_zone") != F.col("call_zone"))
                    & (F.col("has_cur_zone") == 1), "zone_dropped")
              .when((F.col("n_zones") > 1) & (F.col("has_cur_zone") == 0), "ambiguous")
              .when(F.col("f_run").isNotNull()
                    & (F.coalesce("decl_run", F.lit("")) != F.col("f_run")), "pin_mismatch")
              .when(run.isNull(), "missing")
              .otherwise("resolved"))
    ok = status == "resolved"
    return j.select(
        "consumer", "step_name", "entity",
        F.col("r_env").alias("env"), F.col("r_pipeline").alias("pipeline"),
        F.col("r_zone").alias("zone"),
        F.when(ok, run).alias("run_id"),
        entity_full_name("r_env", "r_pipeline", "r_zone", "step_name", "entity_key")
        .alias("full_name"),
        F.when(ok, entity_url("env_path", "r_pipeline", "r_zone", "step_name", run,
                              "entity_key")).alias("url"),
        status.alias("status"))
