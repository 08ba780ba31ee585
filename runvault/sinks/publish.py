"""Publishing versions, temporary outputs, the run ledger and event logs.

* :func:`publish` writes a DataFrame as an immutable version; the output
  committer writes ``_SUCCESS`` last, which is what readers require.
* :func:`write_tmp` writes under the shared temporary root (overwrite
  allowed); :func:`cut_lineage` checkpoints into ``spark.checkpoint.dir``.
* :func:`append_runs` appends run records to a ledger's tail, :func:`merge_ledger` folds
  the tail into partitions of current records by pipeline and month, rewriting those it touches.
* :func:`read_ledger` gives the current record of each run, from both.
* :func:`append_metrics` and :func:`read_metrics` do the same for metric writes.
* :func:`collect_event_logs` copies event logs between the tmp and the stored
  layout through range reads + ordered writes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runvault.session import ensure_checkpoint_dir

# Most keys (one long each) that are broadcast to tell rows apart.
BROADCAST_KEYS = 2_000_000

RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("step_name", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("stop_time", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("commit", T.StringType()),
    T.StructField("pipeline_params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("step_params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("substeps_params", T.ArrayType(T.StringType())),
    T.StructField("input_nb_name", T.StringType()),
    T.StructField("output_nb_name", T.StringType()),
    T.StructField("inputs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("outputs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("tmp", T.MapType(T.StringType(), T.StringType())),
    T.StructField("outputs_url", T.StringType()),
    T.StructField("notebook_report_url", T.StringType()),
])


def publish(df: DataFrame, url: str, fmt: str = "parquet", partition_by=None) -> str:
    """Write ``df`` as a new, immutable version at ``url`` (fails if it exists)."""
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(url)
    return url


def write_tmp(df: DataFrame, url: str, fmt: str = "parquet") -> str:
    """Temporary output of a run: overwritten freely."""
    df.write.mode("overwrite").format(fmt).save(url)
    return url


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """``_key``: hashes (``xxhash64``) of the values of ``key`` that several rows share, kept in the checkpoint folder.

    One long a row is shuffled.  Keys that differ may share a hash, so these are candidates.
    """
    return cut_lineage(rows.groupBy(F.xxhash64(*key).alias("_key")).count().filter("count > 1").select("_key"))


def run_records(runs: DataFrame) -> DataFrame:
    """Normalise ledger rows: ``RUNNING`` until a stop time is known, duration in seconds."""
    stop = F.col("stop_time") if "stop_time" in runs.columns else F.lit(None).cast("timestamp")
    status = F.when(stop.isNull(), F.lit("RUNNING")).otherwise(F.coalesce("status", F.lit(
        "COMPLETE")))
    out = runs.withColumn("status", status)
    if "start_time" in runs.columns and "stop_time" in runs.columns:
        out = out.withColumn("duration_s", (F.unix_micros(F.col("stop_time").cast("timestamp"))
                                            - F.unix_micros(F.col("start_time").cast("timestamp")))
                             / 1e6)
    return out


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether ``folder`` exists and holds more than marker files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(at))


def append_runs(runs: DataFrame, ledger_path: str) -> None:
    """Append run records to the ledger's tail.

    A run may be appended again, e.g. at its start and at its end, or by a
    repeated job: :func:`read_ledger` keeps its current record.  Small tasks share a file;
    rows are dealt by run, as dealing them in turn would sort every task's rows first.
    """
    runs.hint("rebalance", *_run_key(runs)).write.mode("append").parquet(f"{ledger_path}/tail")


def _run_key(records: DataFrame) -> list[str]:
    return [c for c in ("pipeline", "run_id", "module") if c in records.columns]


def current_records(records: DataFrame) -> DataFrame:
    """One record per run (and pipeline and module, where present).

    A finished record beats an unfinished one, a later stop an earlier one.
    Partial maxima are taken before the shuffle.
    """
    key = _run_key(records)
    order = [F.col(c) for c in ("stop_time", "start_time") if c in records.columns]
    done = order[0].isNotNull() if "stop_time" in records.columns else F.lit(True)
    last = records.groupBy(*key).agg(F.max_by(F.struct(*records.columns), F.struct(
        done.alias("done"), *order)).alias("r"))
    return last.select("r.*")


def _current_of_stored(records: DataFrame) -> DataFrame:
    """:func:`current_records` of records that can be read twice: those of runs named once, which
    are most, are passed on as they are, and only the others are shuffled."""
    key = _run_key(records)
    again = repeated_keys(records, key)
    n = again.count()
    if n > BROADCAST_KEYS:
        return current_records(records)
    if n == 0:
        return records
    keyed, again = records.withColumn("_key", F.xxhash64(*key)), F.broadcast(again)
    return keyed.join(again, "_key", "left_anti").drop("_key").unionByName(
        current_records(keyed.join(again, "_key", "left_semi").drop("_key")))


# Partition columns of merged records; the prefixes keep Spark from reading numbers out of them.
_PLACE = ["p_pipeline", "p_month"]


def _pipeline_place(pipeline):
    return F.concat(F.lit("p-"), F.coalesce(pipeline, F.lit("")))


def _same_run(left: DataFrame, right: DataFrame, key: list[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_{c}"]) for c in key])


def _keys(records: DataFrame, key: list[str]) -> DataFrame:
    return records.select(*[F.col(c).alias(f"_{c}") for c in key])


def _part(spark: SparkSession, ledger_path: str, name: str, pipeline: str | None) -> DataFrame | None:
    if not has_data(spark, f"{ledger_path}/{name}"):
        return None
    rows = spark.read.parquet(f"{ledger_path}/{name}")
    if pipeline is None:
        return rows
    if name == "merged":
        rows = rows.filter(F.col("p_pipeline") == f"p-{pipeline}")
    return rows.filter(F.col("pipeline") == pipeline)


def read_ledger(spark: SparkSession, ledger_path: str, pipeline: str | None = None) -> DataFrame:
    """Current record of every run in the ledger, or of one pipeline's runs.

    Of a tail alone, only runs that it names several times are shuffled, found by one long a record.
    Merged records are current already, one a run: only runs that the tail names again are
    aggregated with it, the others are read without a shuffle where the tail is small.
    """
    tail, merged = (_part(spark, ledger_path, n, pipeline) for n in ("tail", "merged"))
    if merged is None:
        if tail is None:
            raise FileNotFoundError(f"no ledger at {ledger_path}")
        return _current_of_stored(tail)
    merged = merged.drop(*_PLACE)
    if tail is None:
        return merged
    key = _run_key(merged)
    named = _keys(tail, key).distinct()
    again = merged.join(named, _same_run(merged, named, key), "left_semi")
    rest = merged.join(named, _same_run(merged, named, key), "left_anti")
    return rest.unionByName(current_records(again.unionByName(tail)))


def merge_ledger(spark: SparkSession, ledger_path: str) -> None:
    """Fold the tail into the merged records: one current record a run, partitioned by pipeline and month.

    Only partitions that the tail's runs belong to are rewritten (dynamic partition
    overwrite); the others keep their files.  A run stays in the partition of the
    month in which it was first known to start.  The tail's files are removed last, and
    those appended meanwhile are left: a merge that ends early, or is run
    again, changes no result, as readers take the current record of both.  One merge at a
    time; a reader that runs while partitions are replaced should be run again.
    """
    if not has_data(spark, f"{ledger_path}/tail"):
        return
    files = spark.read.parquet(f"{ledger_path}/tail").inputFiles()
    if not files:
        return
    new = cut_lineage(_current_of_stored(spark.read.parquet(*files)))
    key = _run_key(new)
    month = F.coalesce(F.date_format("start_time", "yyyy-MM"), F.lit("")) if "start_time" in new.columns else F.lit("")
    pipeline = F.col("pipeline") if "pipeline" in new.columns else F.lit("")
    placed = new.withColumn("p_pipeline", _pipeline_place(pipeline)).withColumn("p_month", F.concat(F.lit("m-"), month))
    if has_data(spark, f"{ledger_path}/merged"):
        old = spark.read.parquet(f"{ledger_path}/merged")
        named = _keys(new, key)
        again = cut_lineage(old.join(named, _same_run(old, named, key), "left_semi"))
        homes = again.select(*[F.col(c).alias(f"_{c}") for c in key], *[F.col(c).alias(f"_{c}") for c in _PLACE])
        first = placed.join(homes, _same_run(placed, homes, key), "left").select(
            *new.columns, *[F.coalesce(f"_{c}", c).alias(c) for c in _PLACE])
        now = current_records(first.unionByName(again))
        touched = first.select(*_PLACE).distinct()
        rest = old.join(touched, _PLACE, "left_semi")
        placed = cut_lineage(now.unionByName(rest.join(named, _same_run(rest, named, key), "left_anti").select(*now.columns)))
    (placed.hint("rebalance", *_PLACE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*_PLACE).parquet(f"{ledger_path}/merged"))
    for f in files:
        at = spark._jvm.org.apache.hadoop.fs.Path(f)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False)


def append_metrics(metrics: DataFrame, ledger_path: str) -> None:
    """Append metric rows (run_id, name, value, ts, seq and more) to the metrics ledger."""
    metrics.write.mode("append").parquet(ledger_path)


def read_metrics(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Metric writes in the ledger; rows appended again by a repeated job count once."""
    return spark.read.parquet(ledger_path).distinct()


def collect_event_logs(spark: SparkSession, src_root: str, dest_root: str,
                       row_size: int = 1024 * 1024, src_layout: str = "tmp",
                       dest_layout: str = "tmp") -> None:
    """Copy event logs from one layout to another: ``tmp`` is ``{log}/{run_id}/{file}``,
    ``stored`` is ``{run_id}/tensorboard/{log}/{file}``.

    Files that meet in one target (one log, run and name below several folders) are an error.
    """
    from runvault.operators.chunks import chunk_plan
    from runvault.sinks.archive import write_files
    from runvault.sources.files import read_ranges
    from runvault.sources.versions import EVENT_FOLDER, event_logs
    if dest_layout not in ("tmp", "stored"):
        raise ValueError(f"unknown event-log layout: {dest_layout}")
    parts = (["log_name", "run_id"] if dest_layout == "tmp"
             else ["run_id", F.lit(EVENT_FOLDER), "log_name"])
    logs = event_logs(spark, src_root, layout=src_layout).select(
        "path", F.concat_ws("/", F.lit(""), *parts, "file_name").alias("rel_path"), "length")
    if not logs.groupBy("rel_path").count().filter("count > 1").isEmpty():
        raise ValueError(f"several event logs below {src_root} have the same log, run and name")
    plan = chunk_plan(logs, row_size).repartition(max(1, spark.sparkContext.defaultParallelism))
    write_files(read_ranges(plan, src_root), dest_root)
