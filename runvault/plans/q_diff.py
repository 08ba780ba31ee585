"""Registered run-diff queries (events as commits / modules, documents as texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runvault.operators import diff as df_
from runvault.operators import history as hi
from runvault.operators import ordered_diff as od
from runvault.plans import views as v
from runvault.plans.registry import query
from runvault.session import scratch_dir
from runvault.sinks import reports as rp

LOOKBACK = df_.DEFAULT_LOOKBACK

_TOP_TAG_SQL = f"""
WITH c AS (SELECT * FROM (
             SELECT *, row_number() OVER (PARTITION BY branch ORDER BY ts DESC, seq DESC) AS pos
             FROM ({v.COMMITS_SQL})) WHERE pos <= {LOOKBACK}),
t AS (SELECT * FROM ({v.TAGS_SQL}) WHERE starts_with(tag_name, 'run-')),
j AS (SELECT c.branch, c.pos, t.* FROM c JOIN t USING (commit_id))
SELECT branch,
       arg_max(tag_name, (-pos, tag_name)) AS run_id,
       arg_max(message, (-pos, tag_name)) AS run_path,
       arg_max(commit_id, (-pos, tag_name)) AS commit_id,
       CAST(arg_max(pos, (-pos, tag_name)) AS INTEGER) AS pos
FROM j GROUP BY branch"""


@query("diff_top_tag", _TOP_TAG_SQL)
def diff_top_tag(spark, sf_dir):
    """Newest run-tagged commit in the last 100 commits of every branch."""
    return df_.top_tagged_run(v.commits(spark, sf_dir), v.tags(spark, sf_dir), LOOKBACK)


@query("history_top_tag", f"""
WITH RECURSIVE {v.COMMIT_GRAPH_SQL},
reach AS (SELECT branch, commit_id FROM heads
          UNION SELECT r.branch, p.parent_id FROM reach r JOIN parents p ON p.commit_id = r.commit_id
          WHERE p.parent_id >= 0),
c AS (SELECT branch, commit_id, row_number() OVER (PARTITION BY branch ORDER BY ts DESC) AS pos
      FROM reach JOIN events ON event_id = commit_id),
j AS (SELECT c.branch, c.pos, t.* FROM c JOIN ({v.TAGS_SQL}) t USING (commit_id)
      WHERE pos <= {LOOKBACK} AND starts_with(tag_name, 'run-'))
SELECT branch, arg_max(tag_name, (-pos, tag_name)) AS run_id, arg_max(message, (-pos, tag_name)) AS run_path,
       arg_max(commit_id, (-pos, tag_name)) AS commit_id, CAST(arg_max(pos, (-pos, tag_name)) AS INTEGER) AS pos
FROM j GROUP BY branch""")
def history_top_tag(spark, sf_dir):
    """Newest run-tagged commit of every branch on a graph with merges and shared history."""
    return hi.newest_tagged_run(*v.commit_graph(spark, sf_dir), v.tags(spark, sf_dir), LOOKBACK)


_MOD_DIFF_SQL = f"""
WITH m AS ({v.MODULES_SQL}),
n AS (SELECT DISTINCT pair, side, module FROM m),
r AS (SELECT pair, max(CASE WHEN side = 'curr' THEN run_id END) AS curr_run,
             max(CASE WHEN side = 'target' THEN run_id END) AS target_run,
             max(CASE WHEN side = 'curr' THEN run_path END) AS curr_run_path,
             max(CASE WHEN side = 'target' THEN run_path END) AS target_run_path
      FROM m GROUP BY pair),
d AS (SELECT pair, module, 'added' AS status FROM n WHERE side = 'curr'
        AND (pair, module) NOT IN (SELECT (pair, module) FROM n WHERE side = 'target')
      UNION ALL
      SELECT pair, module, 'removed' FROM n WHERE side = 'target'
        AND (pair, module) NOT IN (SELECT (pair, module) FROM n WHERE side = 'curr')
      UNION ALL
      SELECT pair, module, 'changed' FROM n WHERE side = 'curr'
        AND (pair, module) IN (SELECT (pair, module) FROM n WHERE side = 'target'))
SELECT d.pair, d.module, d.status, r.curr_run, r.target_run, r.curr_run_path, r.target_run_path
FROM d LEFT JOIN r USING (pair)"""


@query("diff_modules", _MOD_DIFF_SQL)
def diff_modules(spark, sf_dir):
    """Modules added, removed and present in both runs of each pair."""
    return df_.module_diff(v.modules(spark, sf_dir))


@query("diff_manifest", f"""
WITH x AS ({_MOD_DIFF_SQL})
SELECT pair, module, status, 'diff.' || curr_run || '.' || target_run AS diff_id,
       curr_run_path || '/diff.' || curr_run || '.' || target_run AS diff_dir,
       CASE WHEN status <> 'removed' THEN curr_run_path || '/' || module || '/report.ipynb' END
         AS curr_source,
       CASE WHEN status <> 'added' THEN target_run_path || '/' || module || '/report.ipynb' END
         AS target_source,
       curr_run_path || '/diff.' || curr_run || '.' || target_run || '/diff_info.json' AS info_file,
       curr_run_path || '/diff.' || curr_run || '.' || target_run || '/'
         || split_part(module, '.', 2) || ending AS report_file
FROM x JOIN (VALUES ('added', '.added.html'), ('removed', '.removed.html'),
                    ('changed', '.curr.html'), ('changed', '.target.html'),
                    ('changed', '.diff.txt')) AS f(kind, ending) ON f.kind = x.status""")
def diff_manifest(spark, sf_dir):
    """D3: diff id, folder and per-module report files."""
    return df_.diff_manifest(df_.module_diff(v.modules(spark, sf_dir)))


@query("diff_pending", f"""
SELECT DISTINCT pair, curr_run, target_run, diff_id FROM ({v.DIFF_REQUESTS_SQL}) r
WHERE diff_id NOT IN (SELECT diff_id FROM ({v.DIFF_EXISTING_SQL}) e)""")
def diff_pending(spark, sf_dir):
    """Requested diffs not already committed."""
    req = v.diff_requests(spark, sf_dir).distinct()
    return df_.pending_diffs(req, v.diff_requests(spark, sf_dir, only_type="signup"))


@query("diff_pairs", f"""
WITH t AS ({v.TEXTS_SQL})
SELECT c.pair, md5(c.text) AS curr_md5, md5(g.text) AS target_md5, c.text = g.text AS same
FROM t c JOIN t g ON c.pair = g.pair AND c.side = 'curr' AND g.side = 'target'""")
def diff_pairs(spark, sf_dir):
    """Current and target contents of every module common to both runs."""
    p = df_.paired_texts(v.texts(spark, sf_dir))
    return p.select("pair", F.md5("curr_text").alias("curr_md5"),
                    F.md5("target_text").alias("target_md5"),
                    (F.col("curr_text") == F.col("target_text")).alias("same"))


@query("diff_lines", f"""
WITH t AS ({v.TEXTS_SQL}),
b AS (SELECT pair, side, string_split(text, chr(10)) AS ls FROM t),
l AS (SELECT pair, side, unnest(coalesce(ls, [NULL])) AS line FROM b),
pl AS (SELECT pair, line, count(line) FILTER (WHERE side = 'curr') AS c,
              count(line) FILTER (WHERE side = 'target') AS t
       FROM l GROUP BY pair, line)
SELECT pair, CAST(sum(greatest(c - t, 0)) AS BIGINT) AS lines_added,
       CAST(sum(greatest(t - c, 0)) AS BIGINT) AS lines_removed,
       CAST(sum(least(c, t)) AS BIGINT) AS lines_kept
FROM pl GROUP BY pair""")
def diff_lines(spark, sf_dir):
    """Order-free line diff of every text pair."""
    return df_.line_multiset_diff(v.texts(spark, sf_dir))


@query("diff_cells", f"""
WITH x AS (SELECT nb_id // 2 AS pair, CASE WHEN nb_id % 2 = 0 THEN 'curr' ELSE 'target' END AS side,
             pos, cell_type, source FROM ({v.CELLS_SQL})),
l AS (SELECT *, pos < max(pos) OVER (PARTITION BY pair, side) AS counts FROM x),
p AS (SELECT pair, cell_type, source, count(*) FILTER (WHERE counts AND side = 'curr') AS c,
             count(*) FILTER (WHERE counts AND side = 'target') AS t
      FROM l GROUP BY pair, cell_type, source)
SELECT pair, CAST(sum(greatest(c - t, 0)) AS BIGINT) AS cells_added,
       CAST(sum(greatest(t - c, 0)) AS BIGINT) AS cells_removed,
       CAST(sum(least(c, t)) AS BIGINT) AS cells_kept
FROM p GROUP BY pair""")
def diff_cells(spark, sf_dir):
    """Order-free cell diff of paired notebooks, without last cells and outputs."""
    c = v.cells(spark, sf_dir).select(
        F.expr("nb_id div 2").alias("pair"),
        F.when(F.col("nb_id") % 2 == 0, "curr").otherwise("target").alias("side"),
        "pos", "cell_type", "source")
    return df_.cell_multiset_diff(c)


@query("diff_ordered")
def diff_ordered(spark, sf_dir):
    """Edit script of every text pair, line by line (``diff_replayed`` has its SQL)."""
    return od.ordered_line_diff(v.texts(spark, sf_dir))


@query("diff_replayed", f"""
WITH t AS ({v.TEXTS_SQL})
SELECT pair, md5(coalesce(max(text) FILTER (WHERE side = 'curr'), '')) AS curr_md5,
       md5(coalesce(max(text) FILTER (WHERE side = 'target'), '')) AS target_md5, true AS in_order,
       true AS no_fewer
FROM t GROUP BY pair HAVING count(text) > 0""")
def diff_replayed(spark, sf_dir):
    """The edit scripts put together again, both sides; none has fewer changes than the
    order-free diff."""
    texts = v.texts(spark, sf_dir)
    script = od.ordered_line_diff(texts)
    counts = script.groupBy("pair").agg(F.count_if(F.col("op") == "add").alias("added"),
                                        F.count_if(F.col("op") == "remove").alias("removed"))
    few = df_.line_multiset_diff(texts)
    return od.replay(script).join(counts, "pair").join(few, "pair").select(
        "pair", F.md5("curr_text").alias("curr_md5"), F.md5("target_text").alias("target_md5"), "in_order",
        ((F.col("added") >= F.col("lines_added")) & (F.col("removed") >= F.col("lines_removed"))).alias("no_fewer"))


@query("diff_cells_replayed", f"""
WITH x AS (SELECT nb_id // 2 AS pair, CASE WHEN nb_id % 2 = 0 THEN 'curr' ELSE 'target' END AS side,
             pos, coalesce(cell_type, '') || ':' || coalesce(source, '') AS cell,
             max(pos) OVER (PARTITION BY nb_id) AS last FROM ({v.CELLS_SQL}))
SELECT pair, md5(coalesce(string_agg(cell, chr(1) ORDER BY pos) FILTER (WHERE side = 'curr'), '')) AS curr_md5,
       md5(coalesce(string_agg(cell, chr(1) ORDER BY pos) FILTER (WHERE side = 'target'), '')) AS target_md5,
       true AS in_order
FROM x WHERE pos < last GROUP BY pair""")
def diff_cells_replayed(spark, sf_dir):
    """Edit scripts of paired notebooks, without last cells and outputs, put together again."""
    c = v.cells(spark, sf_dir).select(
        F.expr("nb_id div 2").alias("pair"),
        F.when(F.col("nb_id") % 2 == 0, "curr").otherwise("target").alias("side"),
        "pos", "cell_type", "source")
    script = od.ordered_cell_diff(c).withColumn(
        "cell", F.concat(F.coalesce("cell_type", F.lit("")), F.lit(":"), F.coalesce("source", F.lit(""))))
    return od.replay(script, "cell", "\x01").select(
        "pair", F.md5("curr_text").alias("curr_md5"), F.md5("target_text").alias("target_md5"), "in_order")


@query("diff_reports", f"""
WITH x AS ({_MOD_DIFF_SQL}),
c AS (SELECT pair, side, module, string_agg(DISTINCT run_id, chr(10) ORDER BY run_id) AS text,
             list(DISTINCT run_id) AS ids FROM ({v.MODULES_SQL}) GROUP BY pair, side, module),
f AS (SELECT x.*, x.curr_run_path || '/diff.' || x.curr_run || '.' || x.target_run AS dir,
             a.text AS curr_text, b.text AS target_text,
             len(list_filter(a.ids, lambda i: NOT list_contains(b.ids, i))) AS n_added,
             len(list_filter(b.ids, lambda i: NOT list_contains(a.ids, i))) AS n_removed
      FROM x LEFT JOIN c a ON a.pair = x.pair AND a.module = x.module AND a.side = 'curr'
             LEFT JOIN c b ON b.pair = x.pair AND b.module = x.module AND b.side = 'target')
SELECT dir || '/' || split_part(module, '.', 2) || ending AS report_file,
       CASE WHEN ending IN ('.added.html', '.curr.html') THEN md5(curr_text)
            WHEN ending <> '.diff.txt' THEN md5(target_text) END AS md5,
       CASE WHEN ending = '.diff.txt' THEN CAST(n_added AS BIGINT) END AS n_added,
       CASE WHEN ending = '.diff.txt' THEN CAST(n_removed AS BIGINT) END AS n_removed
FROM f JOIN (VALUES ('added', '.added.html'), ('removed', '.removed.html'), ('changed', '.curr.html'),
                    ('changed', '.target.html'), ('changed', '.diff.txt')) AS e(kind, ending) ON e.kind = f.status
UNION ALL
SELECT DISTINCT dir || '/diff_info.json',
       md5('{{"curr_run_path":"' || curr_run_path || '","target_run_path":"' || target_run_path || '"}}'), NULL, NULL
FROM f""")
def diff_reports(spark, sf_dir):
    """D3 / K3: reports of all pairs published to a store and read back; a module's contents are the
    runs that wrote it, a line each."""
    modules = v.modules(spark, sf_dir)
    diff = df_.module_diff(modules)
    manifest = df_.diff_manifest(diff)
    lines = F.array_join(F.sort_array(F.collect_set("run_id")), "\n").alias("text")
    paths = manifest.select("pair", "module", F.inline(F.array(
        F.struct(F.lit("curr").alias("side"), F.col("curr_source").alias("source")),
        F.struct(F.lit("target").alias("side"), F.col("target_source").alias("source"))))).distinct()
    contents = modules.groupBy("pair", "side", "module").agg(lines).join(paths, ["pair", "side", "module"])
    root = scratch_dir(spark, "reports")
    rp.publish_reports(diff, manifest, contents.select("source", "text"), root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    text, is_diff = F.col("content").cast("string"), F.col("path").endswith(".diff.txt")
    count = lambda sign: F.when(is_diff, F.size(F.filter(
        F.split(text, "\n"), lambda x: x.startswith(sign))).cast("long"))
    return files.select(F.substring_index("path", root.rsplit("/", 1)[1], -1).alias("report_file"),
                        F.when(~is_diff, F.md5("content")).alias("md5"),
                        count("+").alias("n_added"), count("-").alias("n_removed"))
