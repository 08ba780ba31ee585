"""Scans of versioned entity folders and other stored records.

Versioned layout: ``{env_path}/{pipeline}/{zone}/{step}/{run_id}/{entity}``;
a version is committed when its folder holds the ``_SUCCESS`` marker.

DataFrame readers skip ``_``-names, so markers are found by walking the
folder levels on executors (:func:`scan_versions`), for one entity too
(:func:`committed_run_ids`).  The scan is the repair / bootstrap path; the catalogue at scale is
the ledger table written by :mod:`runvault.sinks.publish`.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runvault.functions.names import COMMIT_MARKER, path_part

VERSION_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("committed", T.BooleanType(), False),
])


def scan_versions(spark: SparkSession, env: str, env_path: str, pipeline: str = "*",
                  zone: str = "*", step: str = "*", entity: str = "*") -> DataFrame:
    """Stored versions under one environment as ``entity_versions`` rows.

    The driver lists only the pipeline folders; executors walk
    zone / step / run / entity folders level by level and stat each commit
    marker, so no data file is listed and no version row passes through the
    driver.  A root that pyarrow cannot open is an error.
    Output: env, pipeline, zone, step, entity, run_id, committed, url.
    """
    base = env_path.rstrip("/")
    from pyarrow import fs as pafs
    fs, root = pafs.FileSystem.from_uri(base)
    import fnmatch
    prefix = base[: len(base) - len(root)] if base.endswith(root) else ""
    tops = [i.path for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
            if i.type == pafs.FileType.Directory
            and fnmatch.fnmatchcase(i.base_name, pipeline)]
    n = max(1, spark.sparkContext.defaultParallelism * 4)

    def walker(pats, final):
        def walk(batches):
            import pandas as pd
            from pyarrow import fs as pafs2
            fs2, _ = pafs2.FileSystem.from_uri(base)
            for pdf in batches:
                level = list(pdf["dir"])
                for pat in pats:
                    nxt = []
                    for d in level:
                        for i in fs2.get_file_info(pafs2.FileSelector(d, allow_not_found=True)):
                            if (i.type == pafs2.FileType.Directory
                                    and fnmatch.fnmatchcase(i.base_name, pat)):
                                nxt.append(i.path)
                    level = nxt
                if not level:
                    continue
                if not final:
                    yield pd.DataFrame({"dir": level})
                    continue
                marks = fs2.get_file_info([f"{d}/{COMMIT_MARKER}" for d in level])
                yield pd.DataFrame({"path": [prefix + d for d in level],
                                    "committed": [m.type == pafs2.FileType.File for m in marks]})
        return walk

    # stage 1: pipeline -> zone -> step folders; stage 2 (rebalanced): run ->
    # entity folders and their markers, so a large pipeline spreads over tasks
    dirs = spark.createDataFrame([(t,) for t in tops], "dir string").repartition(
        max(1, min(len(tops), n)))
    steps = dirs.mapInPandas(walker([zone, step], False), "dir string").repartition(n)
    found = steps.mapInPandas(walker(["*", entity], True), "path string, committed boolean")
    return _version_columns(found, env)


def _version_columns(df: DataFrame, env: str) -> DataFrame:
    return df.select(
        F.lit(env).alias("env"), path_part("path", -5).alias("pipeline"),
        path_part("path", -4).alias("zone"), path_part("path", -3).alias("step"),
        path_part("path", -1).alias("entity"), path_part("path", -2).alias("run_id"),
        "committed", F.col("path").alias("url"))


def _run_ids(spark: SparkSession, step_path: str, entity: str, committed: bool) -> DataFrame:
    """Run ids of the entity's versions: a task lists the runs, many check them."""
    root = step_path.rstrip("/")

    def runs(batches):
        import pandas as pd
        from pyarrow import fs as pafs
        fs, base = pafs.FileSystem.from_uri(root)
        for _ in batches:
            found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
            yield pd.DataFrame({"run_id": [i.base_name for i in found
                                           if i.type == pafs.FileType.Directory]}, dtype=object)

    def check(batches):
        from pyarrow import fs as pafs
        fs, base = pafs.FileSystem.from_uri(root)
        for pdf in batches:
            ending = f"{entity}/{COMMIT_MARKER}" if committed else entity
            infos = fs.get_file_info([f"{base}/{r}/{ending}" for r in pdf["run_id"]])
            yield pdf[[i.type != pafs.FileType.NotFound for i in infos]]

    n = max(1, spark.sparkContext.defaultParallelism * 4)
    listed = spark.range(1, numPartitions=1).mapInPandas(runs, "run_id string")
    return listed.repartition(n).mapInPandas(check, "run_id string")


def committed_run_ids(spark: SparkSession, step_path: str, entity: str) -> DataFrame:
    """Run ids of ``{step_path}/*/{entity}`` that carry the commit marker."""
    return _run_ids(spark, step_path, entity, committed=True)


def tmp_run_ids(spark: SparkSession, step_cache_path: str, entity: str) -> DataFrame:
    """Run ids of ``{step_cache_path}/*/{entity}`` (no marker needed)."""
    return _run_ids(spark, step_cache_path, entity, committed=False)


def read_run_records(spark: SparkSession, pattern: str, extra: tuple[str, ...] = (),
                     lines: bool = False) -> DataFrame:
    """Run-record JSON files (one object per file) with a fixed schema.

    ``extra`` names further text fields, such as versions of the tools used.
    With ``lines`` a file holds one record per line, as after compaction.
    Malformed files are an error.
    """
    from runvault.sinks.publish import RUN_RECORD_SCHEMA
    schema = T.StructType(RUN_RECORD_SCHEMA.fields + [T.StructField(x, T.StringType()) for x in extra])
    return (spark.read.schema(schema).option("multiLine", not lines).option("mode", "FAILFAST")
            .json(pattern).withColumn("source_file", F.input_file_name()))


def read_metrics_files(spark: SparkSession, pattern: str, lines: bool = False) -> DataFrame:
    """Metrics files of many runs as metric writes.

    A file (with ``lines``: a line) is one JSON object of metric values and the
    key ``run_id``; without it the run id is taken from the file name.  A later
    file of a run is a later write, and so is a later line of a file: ``seq`` is
    the line's number (whole files: 0), the same in every reading.  Lines are
    shuffled by file for it.  Malformed files are an error.
    Output: run_id, module (where the file name holds it), name, value (null if
    not a number), text (as stored), ts, seq.
    """
    from runvault.operators.ledger import module_from_file_name, run_id_from_file_name
    from runvault.operators.params import parse_params
    path = F.col("_metadata.file_path")
    blank_is_null = lambda c: F.nullif(c, F.lit(""))
    line = F.row_number().over(Window.partitionBy(path).orderBy("block", "at"))
    rows = spark.read.text(pattern, wholetext=not lines).select(
        "value", "_metadata", F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at")).select(
        parse_params("value").alias("m"), blank_is_null(module_from_file_name(path)).alias("module"),
        blank_is_null(run_id_from_file_name(path)).alias("named"),
        F.col("_metadata.file_modification_time").alias("ts"), (line - 1 if lines else F.lit(0)).cast("long").alias("seq"))
    return rows.select(
        F.coalesce(F.col("m")["run_id"], "named").alias("run_id"), "module", "ts", "seq",
        F.explode(F.map_filter("m", lambda k, v: k != "run_id")).alias("name", "text")).select(
        "run_id", "module", "name", F.col("text").try_cast("double").alias("value"), "text", "ts",
        "seq")


PARAMS_SCHEMA = ("pipeline_params map<string,string>, step_params map<string,string>, "
                 "substeps_params array<string>")


def _yaml_as_json(text: pd.Series) -> pd.Series:
    """YAML documents as JSON objects; dates as ISO text, an empty document as ``{}``."""
    import yaml

    def convert(doc: str) -> str:
        found = yaml.safe_load(doc)
        if not isinstance(found, (dict, type(None))):
            raise ValueError(f"parameter file is no mapping: {doc[:80]!r}")
        return json.dumps(found or {}, default=lambda x: x.isoformat())
    return text.map(convert)


def _params(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(*PARAMS_SCHEMA, source_file), one row per file."""
    as_json = [p for p in paths if p.lower().endswith(".json")]
    as_yaml = [p for p in paths if p.lower().endswith((".yml", ".yaml"))]
    bad = sorted(set(paths) - set(as_json) - set(as_yaml))
    if bad:
        raise ValueError(f"unsupported parameter file type: {bad}")
    source = F.col("_metadata.file_path").alias("source_file")
    found = []
    if as_json:
        files = spark.read.schema(PARAMS_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
        found.append(files.json(as_json).select("*", source))
    if as_yaml:
        try:
            import yaml  # noqa: F401
        except ImportError as missing:
            raise ValueError(f"YAML parameter files need PyYAML: {as_yaml}") from missing
        one = F.from_json(F.pandas_udf(_yaml_as_json, "string")("value"), PARAMS_SCHEMA, {"mode": "FAILFAST"})
        found.append(spark.read.text(as_yaml, wholetext=True).select(one.alias("p"), source)
                     .select("p.*", "source_file"))
    return reduce(DataFrame.unionByName, found)


def read_params_files(spark: SparkSession, paths: list[str], pipeline_path: str | None = None) -> DataFrame:
    """Parameter files: JSON or YAML objects with ``pipeline_params``, ``step_params`` and
    ``substeps_params``.  Other extensions are refused, malformed files are an error;
    a file without a byte gives no row.

    The pipeline section of the file at ``pipeline_path`` replaces that of all others.
    """
    rows = _params(spark, paths + ([pipeline_path] if pipeline_path and not paths else []))
    if pipeline_path:
        rows = rows.withColumn("pipeline_params", _params(spark, [pipeline_path]).select("pipeline_params").scalar())
    return rows


def read_custom(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A custom entity given by explicit path."""
    return spark.read.format(fmt).options(**options).load(path)


# Fixed value: folder that holds a run's event logs in the store.
EVENT_FOLDER = "tensorboard"


def event_logs(spark: SparkSession, root: str, pattern: str = "events.out*",
               layout: str = "tmp") -> DataFrame:
    """Event-log files under ``root``, of the ``tmp`` layout ``.../{log}/{run_id}/{file}``
    or the ``stored`` layout ``.../{run_id}/tensorboard/{log}/{file}``.

    Metadata only (content is never read here).  Output: path, rel_path,
    length, log_name, run_id, file_name.
    """
    from runvault.sources.files import list_files
    if layout not in ("tmp", "stored"):
        raise ValueError(f"unknown event-log layout: {layout}")
    files = list_files(spark, root, glob=pattern)
    log, run = (-3, -2) if layout == "tmp" else (-2, -4)
    if layout == "stored":
        files = files.filter(path_part("rel_path", -3) == EVENT_FOLDER)
    return files.select("path", "rel_path", "length",
                        path_part("rel_path", log).alias("log_name"),
                        path_part("rel_path", run).alias("run_id"),
                        path_part("rel_path", -1).alias("file_name"))
