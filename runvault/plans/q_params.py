"""Registered parameter and tagged-cell queries (events.props, conversations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runvault.operators import cells as ce
from runvault.operators import params as pa
from runvault.plans import views as v
from runvault.plans.registry import query


def _merged(spark, sf_dir):
    p = v.param_layers(spark, sf_dir)
    return p.withColumn("params", pa.merge_with_replace(
        "defaults", "file_params", "sent_params", "override_params", "replace_file"))


@query("params_merge", f"""
SELECT event_id, env_name, k, zone, pipeline_name,
       CAST(3 + (pipeline_name IS NOT NULL)::INTEGER AS INTEGER) AS n_keys,
       'env_name=' || env_name || ';k=' || k || coalesce(';pipeline_name=' || pipeline_name, '')
         || ';zone=' || zone AS params
FROM ({v.PARAMS_MERGED_SQL}) m""")
def params_merge(spark, sf_dir):
    """M1: defaults < file < sent < override, sent replacing the file on request."""
    m = _merged(spark, sf_dir)
    return m.select("event_id", F.col("params")["env_name"].alias("env_name"),
                    F.col("params")["k"].alias("k"), F.col("params")["zone"].alias("zone"),
                    F.col("params")["pipeline_name"].alias("pipeline_name"),
                    F.size("params").alias("n_keys"), pa.params_text("params").alias("params"))


@query("params_check", f"""
SELECT event_id, 'env_name' AS missing_key FROM ({v.PARAMS_MERGED_SQL}) m WHERE env_name = ''
UNION ALL
SELECT event_id, 'pipeline_name' FROM ({v.PARAMS_MERGED_SQL}) m
WHERE coalesce(pipeline_name, '') = ''""")
def params_check(spark, sf_dir):
    """P10: required pipeline parameters (env_name, pipeline_name) present and non-empty."""
    return pa.missing_required(_merged(spark, sf_dir), "params").select("event_id", "missing_key")


@query("params_precedence", """
SELECT event_id,
       coalesce(CASE WHEN value < 5 THEN false WHEN value > 400 THEN true END,
                CASE WHEN event_type = 'view' THEN user_id % 2 = 0 END, false) AS verbose_output
FROM events""")
def params_precedence(spark, sf_dir):
    """M2: substep value, else step value, else the default (false)."""
    ev = v.table(spark, sf_dir, "events")
    sub = F.when(F.col("value") < 5, F.lit(False)).when(F.col("value") > 400, F.lit(True))
    step = F.when(F.col("event_type") == "view", F.col("user_id") % 2 == 0)
    return ev.select("event_id", pa.first_set(sub, step, default=False).alias("verbose_output"))


_C = f"WITH c AS ({v.CELLS_SQL})"


@query("cells_first_by_tag", f"""{_C}
SELECT nb_id, min(pos) AS pos, arg_min(source, pos) AS source FROM c
WHERE cell_type = 'code' AND list_contains(list_transform(tags, lambda x: lower(x)), 'parameters')
GROUP BY nb_id""")
def cells_first_by_tag(spark, sf_dir):
    """M3: first code cell tagged 'parameters' (any case) per notebook."""
    return ce.first_cell_by_tag(v.cells(spark, sf_dir), "parameters")


@query("cells_tag_check", f"""{_C}
SELECT nb_id, 'parameters' AS tag, n,
       CASE WHEN n > 1 THEN 'applied more than once' ELSE 'missing' END AS problem
FROM (SELECT nb_id, count(*) FILTER (WHERE list_contains(tags, 'parameters')) AS n
      FROM c GROUP BY nb_id) WHERE n <> 1""")
def cells_tag_check(spark, sf_dir):
    """M4: the 'parameters' tag must be on exactly one cell."""
    return ce.tag_violations(v.cells(spark, sf_dir))


@query("cells_cleared", f"""{_C}
SELECT nb_id, pos, CASE WHEN list_contains(tags, 'parameters') THEN '' ELSE source END AS source
FROM c""")
def cells_cleared(spark, sf_dir):
    """M5: sources of 'parameters' cells blanked."""
    return ce.clear_source_by_tag(v.cells(spark, sf_dir), "parameters").select(
        "nb_id", "pos", "source")


@query("cells_removed", f"""{_C}
SELECT nb_id, pos, md5(source) AS source_md5 FROM c
WHERE NOT list_contains(tags, 'business_report')""")
def cells_removed(spark, sf_dir):
    """M5: cells tagged 'business_report' removed."""
    return ce.remove_cells_by_tag(v.cells(spark, sf_dir), "business_report").select(
        "nb_id", "pos", F.md5("source").alias("source_md5"))


@query("cells_business", f"""{_C}
SELECT nb_id, -1 AS pos, 'markdown' AS cell_type, '' AS tags,
       '#### Step conversations/nb' || CAST(nb_id AS VARCHAR) || '/c' || CAST(nb_id AS VARCHAR)
         || ' has been built and checked' AS source, 0 AS n_outputs
FROM (SELECT DISTINCT nb_id FROM c)
UNION ALL
SELECT nb_id, pos, cell_type, array_to_string(tags, ','),
       CASE WHEN cell_type = 'code' THEN '' ELSE source END, CAST(len(outputs) AS INTEGER)
FROM c WHERE cell_type <> 'code' OR (len(outputs) > 0 AND list_contains(tags, 'business_report'))""")
def cells_business(spark, sf_dir):
    """M6: business view with a summary cell first."""
    c = v.cells(spark, sf_dir)
    summ = c.select("nb_id").distinct().select(
        "nb_id", F.concat(F.lit("#### Step conversations/nb"), F.col("nb_id").cast("string"),
                          F.lit("/c"), F.col("nb_id").cast("string"),
                          F.lit(" has been built and checked")).alias("source"))
    b = ce.business_view(c, summ)
    return b.select("nb_id", F.col("pos").cast("long").alias("pos"), "cell_type",
                    F.array_join("tags", ",").alias("tags"), "source",
                    F.size("outputs").alias("n_outputs"))


@query("cells_last_output", f"""{_C}
SELECT nb_id, max(pos) AS pos, arg_max(outputs[1], pos) AS result FROM c
WHERE len(outputs) > 0 GROUP BY nb_id""")
def cells_last_output(spark, sf_dir):
    """M7: first output of the last cell with output, per notebook."""
    return ce.last_output(v.cells(spark, sf_dir))


#: outputs of assistant turns: a whole number, a quoted text, an image before a text, a fraction, a list
_DATA_SQL = f"""
WITH o AS (SELECT nb_id, pos, source, (nb_id + pos) % 5 AS form FROM ({v.CELLS_SQL})
           WHERE len(outputs) > 0 AND source IS NOT NULL AND (nb_id + pos) % 5 <> 2),
l AS (SELECT nb_id, max(pos) AS pos, arg_max(source, pos) AS source, arg_max(form, pos) AS form FROM o GROUP BY nb_id)"""


@query("cells_last_result", f"""{_DATA_SQL}
SELECT nb_id, pos, CASE form WHEN 0 THEN 'int' WHEN 1 THEN 'str' WHEN 3 THEN 'float' ELSE 'other' END AS kind,
       CASE WHEN form = 0 THEN CAST(length(source) AS BIGINT) END AS int_value,
       CASE WHEN form = 3 THEN length(source) + 0.25::DOUBLE END AS float_value,
       CASE WHEN form = 1 THEN md5(source) END AS str_md5
FROM l""")
def cells_last_result(spark, sf_dir):
    """M7: text result of the last cell that has one as its first output, parsed."""
    n, form = F.length("source").cast("string"), (F.col("nb_id") + F.col("pos")) % 5
    escaped = F.col("source")
    for char, sign in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(char), F.lit(sign))
    quoted = F.concat(F.lit("'"), escaped, F.lit("'"))
    text = F.when(form == 0, n).when(form == 1, quoted).when(form == 3, F.concat(n, F.lit(".25"))).otherwise(
        F.concat(F.lit("["), n, F.lit("]")))
    plain, image = F.create_map(F.lit("text/plain"), text), F.create_map(F.lit("image/png"), F.lit("iVBORw0KGgo="))
    data = F.when(F.size("outputs") == 0, F.array().cast("array<map<string,string>>")).when(
        form == 2, F.array(image, plain)).otherwise(F.array(plain))
    cells = v.cells(spark, sf_dir).withColumn("data", data)
    return ce.last_result(cells).select("nb_id", "pos", "kind", "int_value", "float_value", F.md5("str_value").alias("str_md5"))
