"""Registered run-ledger queries (orders + lineitem as runs, events as metric writes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runvault.operators import chunks as ch
from runvault.operators import ledger as lg
from runvault.plans import views as v
from runvault.plans.registry import query
from runvault.session import scratch_dir
from runvault.sinks import publish as pub
from runvault.sinks.archive import write_files
from runvault.sources import versions as vs

_E = f"WITH e AS ({v.RUN_ENTITIES_SQL})"


@query("ledger_lineage", v.RUN_ENTITIES_SQL)
def ledger_lineage(spark, sf_dir):
    """Every input and output entity of every run."""
    return lg.lineage(v.runs(spark, sf_dir))


# the view's inputs are main outputs, so the edge joins on the order key alone
@query("ledger_dependencies", """
SELECT 'run-' || lpad(CAST(x.l_orderkey AS VARCHAR), 19, '0') AS consumer_run,
       'supp_' || CAST(x.l_suppkey AS VARCHAR) AS input_name,
       '/store/run-' || lpad(CAST(x.l_suppkey AS VARCHAR), 19, '0') || '/main' AS url,
       'run-' || lpad(CAST(p.o_orderkey AS VARCHAR), 19, '0') AS producer_run,
       CASE WHEN p.o_orderkey IS NOT NULL THEN 'main' END AS output_name
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) x
JOIN orders c ON c.o_orderkey = x.l_orderkey
LEFT JOIN orders p ON p.o_orderkey = x.l_suppkey
  AND (p.o_orderdate, p.o_orderkey) < (c.o_orderdate, c.o_orderkey)""")
def ledger_dependencies(spark, sf_dir):
    """Producer -> consumer edges through shared entity urls, as of the consumer's start."""
    return lg.dependencies(v.runs(spark, sf_dir))


@query("ledger_producers", f"""
WITH r AS ({v.SHARED_RUNS_SQL}),
e AS (SELECT url, ts, run_id, 0 AS k, unnest(['in', 'also']) AS name, unnest([read, read2]) AS u FROM r, (SELECT '' AS url)
      UNION ALL SELECT '', ts, run_id, 1, 'out', written FROM r),
o AS (SELECT *, last_value(CASE WHEN k = 1 THEN run_id END IGNORE NULLS) OVER (
        PARTITION BY u ORDER BY ts, run_id, k, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS producer FROM e)
SELECT run_id AS consumer_run, name AS input_name, u AS url, producer AS producer_run,
       CASE WHEN producer IS NOT NULL THEN 'out' END AS output_name FROM o WHERE k = 0""")
def ledger_producers(spark, sf_dir):
    """Producers of paths that many runs write and read."""
    return lg.dependencies(v.shared_runs(spark, sf_dir))


@query("run_summary", f"""{_E},
t AS (SELECT run_id, direction,
             string_agg('- ' || name || ' : ' || url, chr(10) ORDER BY name) AS txt,
             CAST(count(*) AS INTEGER) AS n
      FROM e GROUP BY ALL)
SELECT r.run_id,
       '#### Step ' || r.pipeline || '/' || r.step || '/' || r.commit
         || ' has been built and checked' AS header,
       coalesce(i.txt, '') AS inputs_text, coalesce(o.txt, '') AS outputs_text,
       coalesce(i.n, 0) AS n_inputs, coalesce(o.n, 0) AS n_outputs,
       r.start_time, r.duration_s
FROM ({v.RUNS_SQL}) r
LEFT JOIN t i ON i.run_id = r.run_id AND i.direction = 'input'
LEFT JOIN t o ON o.run_id = r.run_id AND o.direction = 'output'""")
def run_summary(spark, sf_dir):
    """One summary record per run (header, entity lists, start, duration)."""
    return lg.run_summary(v.runs(spark, sf_dir))


@query("ledger_last_run", f"""
SELECT pipeline, regexp_extract(max(file_name), '.*(run-.*?)_', 1) AS run_id,
       max(file_name) AS file_name
FROM (SELECT pipeline, run_id || '_' || module || '.runinfo.json' AS file_name
      FROM ({v.RUNS_SQL}) r) GROUP BY pipeline""")
def ledger_last_run(spark, sf_dir):
    """L1: newest run per pipeline by run-info file name."""
    r = v.runs(spark, sf_dir).select("pipeline", lg.runinfo_file_name().alias("file_name"))
    return lg.last_run(r, by=["pipeline"])


@query("report_check", f"""{_E},
m AS (SELECT r.run_id, r.module, e.url
      FROM ({v.RUNS_SQL}) r LEFT JOIN e ON e.run_id = r.run_id AND e.direction = 'output'
           AND ends_with(e.name, '.reports.' || r.module))
SELECT run_id, module, CAST(count(url) AS INTEGER) AS n_reports,
       CASE WHEN count(url) = 1 THEN max(url) END AS report_url, count(url) = 1 AS ok
FROM m GROUP BY run_id, module""")
def report_check(spark, sf_dir):
    """Every run must carry exactly one ``*.reports.<module>`` output."""
    return lg.report_outputs(v.runs(spark, sf_dir))


@query("metric_last", f"""
SELECT run_id, name, arg_max(value, (ts, seq)) AS value, count(*) AS n_writes
FROM ({v.METRIC_LOG_SQL}) m GROUP BY run_id, name""")
def metric_last(spark, sf_dir):
    """A5: last write wins per (run, metric)."""
    return lg.last_metrics(v.metric_log(spark, sf_dir))


@query("metric_snapshot", f"""
SELECT run_id, CAST(count(*) AS INTEGER) AS n_metrics,
       string_agg(name || '=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ';'
                  ORDER BY name) AS snapshot
FROM (SELECT run_id, name, arg_max(value, (ts, seq)) AS value
      FROM ({v.METRIC_LOG_SQL}) m GROUP BY run_id, name) GROUP BY run_id""")
def metric_snapshot(spark, sf_dir):
    """Each run's final metrics as one record."""
    snap = lg.metric_snapshot(lg.last_metrics(v.metric_log(spark, sf_dir)))
    return snap.select("run_id", "n_metrics", "snapshot")


@query("ledger_records", f"""{_E},
n AS (SELECT run_id, count(*) FILTER (direction = 'input') AS n_in,
             count(*) FILTER (direction = 'output') AS n_out FROM e GROUP BY run_id)
SELECT r.run_id, r.module, r.pipeline, r.step, r.commit, r.status,
       CAST(r.start_time AS TIMESTAMP) AS start_time,
       CASE WHEN r.status <> 'RUNNING' THEN floor(r.duration_s) END AS duration_s,
       CAST(coalesce(n.n_in, 0) AS INTEGER) AS n_inputs, CAST(coalesce(n.n_out, 0) AS INTEGER) AS n_outputs
FROM ({v.RUNS_SQL}) r LEFT JOIN n USING (run_id)""")
def ledger_records(spark, sf_dir):
    """Runs written as JSON records, read back, appended to a ledger, current record of each."""
    folder = scratch_dir(spark, "ledger-records")
    start = F.col("start_time").cast("timestamp")
    stop = F.timestamp_micros(F.unix_micros(start) + F.floor("duration_s") * 1_000_000)
    v.runs(spark, sf_dir).select(
        "run_id", F.concat("module", F.lit(".ipynb")).alias("input_nb_name"), F.col("step").alias("step_name"),
        "commit", "status", start.cast("string").alias("start_time"), stop.cast("string").alias("stop_time"),
        F.create_map(F.lit("pipeline_name"), "pipeline").alias("pipeline_params"),
        "inputs", "outputs").write.json(f"{folder}/records", compression="gzip")
    runs = lg.from_records(vs.read_run_records(spark, f"{folder}/records", lines=True))
    pub.append_runs(runs, f"{folder}/ledger")
    return pub.read_ledger(spark, f"{folder}/ledger").select(
        "run_id", "module", "pipeline", "step", "commit", "status", "start_time", "duration_s",
        F.size("inputs").alias("n_inputs"), F.size("outputs").alias("n_outputs"))


@query("ledger_merged", f"""
WITH r AS ({v.RUNS_SQL}), phase AS (SELECT unnest(['appended', 'merged', 'appended again']) AS phase)
SELECT phase, pipeline, strftime(start_time, '%Y-%m') AS month, status, count(*) AS n_runs,
       CAST(sum(CASE WHEN status <> 'RUNNING' THEN floor(duration_s) END) AS DOUBLE) AS seconds
FROM r, phase GROUP BY ALL""")
def ledger_merged(spark, sf_dir):
    """K5: runs appended as running, merged, appended again when they have ended; the ledger read
    from the tail beside merged records, after a second merge, and with repeated records after it."""
    ledger = f"{scratch_dir(spark, 'ledger-merged')}/runs"
    start = F.col("start_time").cast("timestamp")
    runs = v.runs(spark, sf_dir).select("run_id", "module", "pipeline", "status", start.alias("start_time"),
                                        F.timestamp_micros(F.unix_micros(start) + F.floor("duration_s") * 1_000_000).alias("stop_time"))
    pub.append_runs(runs.withColumn("status", F.lit("RUNNING")).withColumn("stop_time", F.lit(None).cast("timestamp")), ledger)
    pub.merge_ledger(spark, ledger)
    ended = runs.filter("status <> 'RUNNING'")
    pub.append_runs(ended, ledger)

    def counted(phase):
        rows = pub.read_ledger(spark, ledger)
        return pub.cut_lineage(rows.groupBy(
            F.lit(phase).alias("phase"), "pipeline", F.date_format("start_time", "yyyy-MM").alias("month"), "status").agg(
            F.count("*").alias("n_runs"), F.sum(F.unix_seconds("stop_time") - F.unix_seconds("start_time")).cast("double").alias("seconds")))
    before = counted("appended")
    pub.merge_ledger(spark, ledger)
    merged = counted("merged")
    pub.append_runs(ended, ledger)
    return before.union(merged).union(counted("appended again"))


@query("metric_files", f"""
SELECT run_id, name, arg_max(value, (ts, seq)) AS value
FROM ({v.METRIC_LOG_SQL}) m GROUP BY run_id, name""")
def metric_files(spark, sf_dir):
    """Each run's metrics written as JSON, read back, appended to the ledger, last writes."""
    folder = scratch_dir(spark, "metric-files")
    runs = lg.metric_snapshot(lg.last_metrics(v.metric_log(spark, sf_dir)))
    values = F.transform_values("metrics", lambda k, x: x.cast("string"))
    runs.select(F.to_json(F.map_concat(F.create_map(F.lit("run_id"), "run_id"), values))).write.text(
        f"{folder}/metrics")
    pub.append_metrics(vs.read_metrics_files(spark, f"{folder}/metrics", lines=True), f"{folder}/ledger")
    return lg.last_metrics(pub.read_metrics(spark, f"{folder}/ledger")).select("run_id", "name", "value")


@query("event_log_store", """
SELECT source AS log_name, 'run-' || CAST(doc_id % 10 AS VARCHAR) AS run_id,
       'events.out.' || CAST(doc_id AS VARCHAR) AS file_name,
       CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS length
FROM documents""")
def event_log_store(spark, sf_dir):
    """Documents as event logs, collected from the tmp into the stored layout and found there."""
    root = scratch_dir(spark, "event-logs")
    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    number = F.col("doc_id").cast("string")
    logs = v.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/"), "source", F.lit("/run-"), (F.col("doc_id") % 10).cast("string"),
                 F.lit("/events.out."), number).alias("rel_path"),
        F.octet_length(content).cast("long").alias("length"), content.alias("content"))
    write_files(ch.chunk_files(logs, 1 << 20), f"{root}/tmp")
    pub.collect_event_logs(spark, f"{root}/tmp", f"{root}/store", dest_layout="stored")
    return vs.event_logs(spark, f"{root}/store", layout="stored").select("log_name", "run_id", "file_name", "length")
