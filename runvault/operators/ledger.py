"""Run ledger: run records, metrics, lineage and summaries.

Data shapes
-----------
runs        run_id, module, pipeline, step, commit, status, start_time,
            duration_s, inputs map<string,string>, outputs map<string,string>
            (one row per run record; map key = entity name, value = url)
metric_log  run_id, name, value, ts, seq   (one row per metric write)

Every operator is linear in its input: lineage is exploded to one row per
(run, entity) rather than input x output pairs, and producer -> consumer
edges are window values over one table of inputs and outputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runvault.operators.params import merge_layers
from runvault.operators.ranges import PART, range_parts
from runvault.session import scratch_dir
from runvault.sinks.publish import BROADCAST_KEYS, cut_lineage, repeated_keys

# Report entity prefix and the summary header / line formats.
REPORTS_PREFIX = "reports."
SUMMARY_START, SUMMARY_END = "#### Step ", " has been built and checked"

# Endings of a module's report name, and of its input file.
REPORT_SUFFIXES = ("", ".ipynb", ".py")


# ------------------------------------------------------------------ S7 / K5

def from_records(records: DataFrame) -> DataFrame:
    """Stored run records (``sources.versions.read_run_records``) as ``runs`` rows.

    The pipeline is ``pipeline_params['pipeline_name']``; run id and module come
    from the record, else from the file name ``{run_id}_{module}.runinfo.json``.
    A record without a status is ``RUNNING``.  ``duration_s`` and ``stop_time``
    are null until the run has stopped.
    """
    start, stop = F.col("start_time").cast("timestamp"), F.col("stop_time").cast("timestamp")
    source = F.col("source_file")
    named = F.nullif(module_from_file_name(source), F.lit(""))
    status = F.coalesce("status", F.lit("RUNNING"))
    ended = F.when(status != "RUNNING", stop)
    return records.select(
        F.coalesce("run_id", F.nullif(run_id_from_file_name(source), F.lit(""))).alias("run_id"),
        F.coalesce(named, F.regexp_replace("input_nb_name", r"\.(ipynb|py)$", "")).alias("module"),
        F.col("pipeline_params")["pipeline_name"].alias("pipeline"),
        F.col("step_name").alias("step"), "commit", status.alias("status"),
        start.alias("start_time"), ended.alias("stop_time"),
        ((F.unix_micros(ended) - F.unix_micros(start)) / 1e6).alias("duration_s"),
        "inputs", "outputs")


def with_custom(runs: DataFrame, custom: DataFrame) -> DataFrame:
    """Runs whose lineage also holds custom entities under their bare names.

    ``custom`` has run_id, direction ('input' | 'output'), name, url; one url per
    name is kept (the greatest), and a custom name replaces an equal one.
    """
    one = custom.groupBy("run_id", "direction", "name").agg(F.max("url").alias("url"))
    maps = one.groupBy("run_id").agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("direction") == d, F.struct("name", "url")))).alias(f"_{d}")
        for d in ("input", "output")])
    joined = runs.join(maps, "run_id", "left")
    return joined.select(*[merge_layers(c, f"_{c[:-1]}").alias(c) if c in ("inputs", "outputs") else c
                           for c in runs.columns])


# ------------------------------------------------------------------ A5 / A6

def last_metrics(metric_log: DataFrame, key=("run_id", "name")) -> DataFrame:
    """Last write wins per (run, name), ordered by (ts, seq).

    ``max_by`` is a declarative aggregate: partial results combine map-side,
    so a hot run ships one row per map task.
    """
    return (metric_log.groupBy(*key)
            .agg(F.max_by("value", F.struct("ts", "seq")).alias("value"),
                 F.count(F.lit(1)).alias("n_writes")))


def metric_snapshot(last: DataFrame, decimals: int = 2) -> DataFrame:
    """One record per run: ``metrics map<string,double>`` plus a stable text
    form ``name=value;...`` sorted by name."""
    g = last.groupBy("run_id").agg(
        F.sort_array(F.collect_list(F.struct("name", "value"))).alias("kv"))
    return g.select(
        "run_id",
        F.map_from_entries("kv").alias("metrics"),
        F.size("kv").alias("n_metrics"),
        F.array_join(F.transform("kv", lambda e: F.concat(
            e["name"], F.lit("="),
            e["value"].cast(f"decimal(18,{decimals})").cast("string"))), ";").alias("snapshot"))


# ------------------------------------------------------------------ J4

def lineage(runs: DataFrame) -> DataFrame:
    """``run_id, direction ('input'|'output'), name, url`` for every entity."""
    def entries(direction, m):
        rows = F.transform(F.map_entries(m), lambda e: F.struct(
            F.lit(direction).alias("direction"), e["key"].alias("name"), e["value"].alias("url")))
        return F.coalesce(rows, F.array().cast(
            "array<struct<direction:string,name:string,url:string>>"))
    return runs.select("run_id", F.inline(F.concat(entries("input", "inputs"),
                                                   entries("output", "outputs"))))


def _begun(stored: DataFrame, timed: bool) -> DataFrame:
    """``stored`` with each run's earliest ``_at``; only run ids with several records are aggregated."""
    again = repeated_keys(stored, ["run_id"]) if timed else None
    n = again.count() if timed else 0
    if n == 0:
        return stored
    named = stored
    if small := n <= BROADCAST_KEYS:
        named = stored.withColumn("_key", F.xxhash64("run_id")).join(F.broadcast(again), "_key", "left_semi")
    first = named.groupBy(F.col("run_id").alias("_run")).agg(F.min("_at").alias("_first"))
    at = F.when(F.col("_run").isNull(), F.col("_at")).otherwise(F.col("_first")).alias("_at")
    return stored.join(F.broadcast(first) if small else first, F.col("run_id") == F.col("_run"), "left").select(
        "run_id", at, "inputs", "outputs")


def dependencies(runs: DataFrame) -> DataFrame:
    """Producer -> consumer edges: a run's input url and the run that had written it by then.

    ``consumer_run, input_name, url, producer_run, output_name``.  Runs are ordered
    by their earliest ``start_time`` (where the column exists), then run id.  The
    producer of an input is the last run before its consumer that wrote the url
    (of several outputs with that url the one with the greatest name); a run never
    produces its own input.  Inputs without one keep a null producer, as do null urls.

    An as-of join without a theta join: inputs and outputs are one table in the
    order (url, run), and the last output before an input is a window value.
    A url with a third of all rows lies in many range parts; each part hands its
    last output on to the parts after it (one row a part).

    The runs are evaluated once, into the checkpoint folder.  Where up to ``BROADCAST_KEYS`` urls are
    read, only outputs that some run reads and inputs that some run writes are ordered: their
    hashes are broadcast, and inputs that no run writes go to the result without a shuffle.
    """
    spark, folder = runs.sparkSession, scratch_dir(runs.sparkSession, "dependencies")
    timed = "start_time" in runs.columns
    runs.select("run_id", (F.col("start_time") if timed else F.lit(0)).alias("_at"), "inputs", "outputs").write.parquet(folder)
    stored = spark.read.parquet(folder)
    begun = _begun(stored.filter("run_id is not null"), timed)
    ends = [begun.select("_at", "run_id", F.lit(k).alias("_out"), F.explode(m).alias("name", "url")).filter("url is not null")
            for k, m in ((0, "inputs"), (1, "outputs"))]
    url = F.xxhash64("url").alias("_key")
    read = cut_lineage(ends[0].select(url).distinct())
    unwritten = None
    if read.count() <= BROADCAST_KEYS:
        outputs = ends[1].withColumn("_key", url).join(F.broadcast(read), "_key", "left_semi").drop("_key")
        written = F.broadcast(cut_lineage(outputs.select(url).distinct()))
        keyed = ends[0].withColumn("_key", url)
        unwritten = keyed.join(written, "_key", "left_anti")
        ends = [keyed.join(written, "_key", "left_semi").drop("_key"), outputs]
    rows = ends[0].unionByName(ends[1])
    order = ["_at", "run_id", "_out", "name"]  # a run's inputs come before its outputs
    first = [F.asc_nulls_first(c) for c in ["url", *order]]
    parts = range_parts(rows, first)
    output = F.when(F.col("_out") == 1, F.struct("url", "run_id", "name"))
    position = F.struct("url", *order)
    summary = parts.groupBy(PART).agg(
        F.min("url").alias("_first"), F.max_by(output, F.when(F.col("_out") == 1, position)).alias("_last"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    heads = summary.select(PART, "_first", F.last("_last", ignorenulls=True).over(earlier).alias("_head"))
    before = (Window.partitionBy(PART, "url").orderBy(*[F.asc_nulls_first(c) for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    found = (parts.withColumn("_p", F.last(output, ignorenulls=True).over(before)).filter("_out = 0")
             .join(F.broadcast(heads), PART))
    head = F.when((F.col("url") == F.col("_first")) & (F.col("_head.url") == F.col("url")), F.col("_head"))
    producer = F.coalesce("_p", head)
    edges = found.select(F.col("run_id").alias("consumer_run"), F.col("name").alias("input_name"), "url",
                         producer["run_id"].alias("producer_run"), producer["name"].alias("output_name"))
    none = stored.select("run_id", F.explode("inputs").alias("name", "url")).filter("url is null")
    for alone in [none] if unwritten is None else [none, unwritten]:
        edges = edges.unionByName(alone.select(
            F.col("run_id").alias("consumer_run"), F.col("name").alias("input_name"), "url",
            F.lit(None).cast("string").alias("producer_run"), F.lit(None).cast("string").alias("output_name")))
    return edges


# ------------------------------------------------------------------ A7

def _entries_text(m):
    return F.array_join(
        F.transform(F.sort_array(F.map_entries(m)),
                    lambda e: F.concat(F.lit("- "), e["key"], F.lit(" : "), e["value"])), "\n")


def run_summary(runs: DataFrame) -> DataFrame:
    """One summary per run: header, input / output lists, start, duration."""
    header = F.concat(F.lit(SUMMARY_START), "pipeline", F.lit("/"), "step", F.lit("/"),
                      F.coalesce("commit", F.lit("")), F.lit(SUMMARY_END))
    return runs.select(
        "run_id", header.alias("header"),
        _entries_text("inputs").alias("inputs_text"),
        _entries_text("outputs").alias("outputs_text"),
        F.size("inputs").alias("n_inputs"), F.size("outputs").alias("n_outputs"),
        "start_time", "duration_s")


# ------------------------------------------------------------------ L1 / P12

def runinfo_file_name(run_id="run_id", module="module"):
    return F.concat(F.col(run_id), F.lit("_"), F.col(module), F.lit(".runinfo.json"))


def run_id_from_file_name(name) -> F.Column:
    """Run id cut out of ``.../{run_id}_{module}.runinfo.json``."""
    return F.regexp_extract(name, r".*(run-.*?)_", 1)


def module_from_file_name(name) -> F.Column:
    """Module cut out of ``.../{run_id}_{module}.runinfo.json`` or ``.metrics.json``; else empty."""
    return F.regexp_extract(name, r"run-[^/]*?_([^/]+?)\.(?:runinfo|metrics)\.json$", 1)


def last_run(file_names: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Newest run id by file name order (globally or per ``by`` group)."""
    x = file_names.withColumn("run_id", run_id_from_file_name(F.col("file_name")))
    if not by:
        return x.agg(F.max_by("run_id", "file_name").alias("run_id"),
                     F.max("file_name").alias("file_name"))
    return x.groupBy(*by).agg(F.max_by("run_id", "file_name").alias("run_id"),
                              F.max("file_name").alias("file_name"))


def report_outputs(runs: DataFrame, suffixes=REPORT_SUFFIXES) -> DataFrame:
    """Per run: the output named ``*.reports.{module}`` with one of the file
    ``suffixes``; exactly one is required.

    ``run_id, module, n_reports, report_url`` (url only when exactly one),
    ``ok``.
    """
    def is_report(name, _url):
        ends = [name.endswith(F.concat(F.lit("." + REPORTS_PREFIX), F.col("module"), F.lit(s))) for s in suffixes]
        return reduce(lambda a, b: a | b, ends)
    matches = F.map_filter("outputs", is_report)
    x = runs.select("run_id", "module", matches.alias("m"))
    n = F.size("m")
    return x.select("run_id", "module", n.alias("n_reports"),
                    F.when(n == 1, F.element_at(F.map_values("m"), 1)).alias("report_url"),
                    (n == 1).alias("ok"))


def run_base_path(url, run_id) -> F.Column:
    """Shortest prefix of ``url`` that ends with ``run_id`` (the run's folder)."""
    idx = F.instr(url, run_id)
    return F.when(idx > 0, F.substring(url, F.lit(1), idx + F.length(run_id) - 1))
