"""Registered model-artefact queries (documents as artefacts, embeddings as features)."""

from __future__ import annotations

from pyspark.sql import functions as F

from runvault.operators import artifacts as ar
from runvault.plans import views as v
from runvault.plans.registry import query
from runvault.session import scratch_dir

_A = f"WITH a AS ({v.ARTIFACTS_SQL})"


@query("artifact_table", f"""{_A}
SELECT bundle, name, kind, ext, file_path, version, profile_name,
       CAST(octet_length(content) AS BIGINT) AS n_bytes, md5(content) AS md5
FROM a""")
def artifact_table(spark, sf_dir):
    """Kind dispatch, extension, file path, service version, profile, bytes."""
    a = v.artifacts(spark, sf_dir)
    return a.select("bundle", "name", "kind", "ext", "file_path", "version",
                    F.col("profile.bentoservice_profile.name").alias("profile_name"),
                    F.octet_length("content").cast("long").alias("n_bytes"),
                    F.md5("content").alias("md5"))


@query("artifact_extract", f"""{_A}
SELECT substr(file_path, length('/bundles/src3/artifacts/') + 1) AS rel_path,
       CAST(octet_length(content) AS BIGINT) AS n_bytes, md5(content) AS md5
FROM a WHERE starts_with(file_path, '/bundles/src3/artifacts/')""")
def artifact_extract(spark, sf_dir):
    """Only the artefacts of one service, paths relative to its folder."""
    a = v.artifacts(spark, sf_dir).select(F.col("file_path").alias("rel_path"), "content")
    sub = ar.subset_by_prefix(a, "/bundles/src3/artifacts/")
    return sub.select("rel_path", F.octet_length("content").cast("long").alias("n_bytes"),
                      F.md5("content").alias("md5"))


@query("model_score", """
WITH x AS (SELECT vec_id, label, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings),
x2 AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS v FROM x),
cen AS (SELECT label AS cl, i, avg(v) AS c FROM x2 GROUP BY label, i),
nrm AS (SELECT cl, sum(c * c) AS n2 FROM cen GROUP BY cl),
sc AS (SELECT x2.vec_id, cen.cl, sum(x2.v * cen.c) AS dot FROM x2 JOIN cen ON x2.i = cen.i
       GROUP BY x2.vec_id, cen.cl)
SELECT e.vec_id, e.label, CAST(arg_max(sc.cl, sc.dot - 0.5 * nrm.n2) AS BIGINT) AS predicted
FROM embeddings e JOIN sc ON sc.vec_id = e.vec_id JOIN nrm ON nrm.cl = sc.cl
GROUP BY e.vec_id, e.label""")
def model_score(spark, sf_dir):
    """Nearest-centroid model trained on embeddings, shipped as bytes, batch-scored."""
    feats = v.table(spark, sf_dir, "embeddings")
    model = ar.pack_centroid_model(ar.train_centroids(feats))
    return ar.score_linear(spark, feats, model).select("vec_id", "label", "predicted")


@query("model_score_many", """
WITH f AS (SELECT vec_id, label, embedding, vec_id % 4 AS fold FROM embeddings),
x AS (SELECT vec_id, label, fold, embedding, generate_subscripts(embedding, 1) AS i FROM f),
x2 AS (SELECT vec_id, label, fold, i, CAST(embedding[i] AS DOUBLE) AS v FROM x),
cen AS (SELECT (fold + 1) % 4 AS scored, label AS cl, i, avg(v) AS c FROM x2 GROUP BY fold, label, i),
nrm AS (SELECT scored, cl, sum(c * c) AS n2 FROM cen GROUP BY scored, cl),
sc AS (SELECT x2.vec_id, x2.fold, cen.cl, sum(x2.v * cen.c) AS dot
       FROM x2 JOIN cen ON x2.i = cen.i AND x2.fold = cen.scored GROUP BY x2.vec_id, x2.fold, cen.cl)
SELECT f.vec_id, f.label, 'fold' || f.fold AS bundle, 'v1' AS version,
       CAST(arg_max(sc.cl, sc.dot - 0.5 * nrm.n2) AS BIGINT) AS predicted
FROM f LEFT JOIN sc ON sc.vec_id = f.vec_id LEFT JOIN nrm ON nrm.cl = sc.cl AND nrm.scored = sc.fold
GROUP BY f.vec_id, f.label, f.fold""")
def model_score_many(spark, sf_dir):
    """A model for each of four folds, trained on the fold before it, scores all rows of its fold."""
    feats = v.table(spark, sf_dir, "embeddings").withColumn("version", F.lit("v1"))
    fold = lambda n: F.concat(F.lit("fold"), (n % 4).cast("string"))
    models = ar.train_centroids(feats.withColumn("bundle", fold(F.col("vec_id") + 1)), by=("bundle", "version"))
    scored = ar.score_many(models, feats.withColumn("bundle", fold(F.col("vec_id"))))
    return scored.select("vec_id", "label", "bundle", "version", "predicted")


@query("bundle_latest", f"""{_A}
SELECT bundle, arg_max(version, version) AS version, arg_max(n, version) AS n_artifacts
FROM (SELECT bundle, version, count(*) AS n FROM a GROUP BY bundle, version)
GROUP BY bundle""")
def bundle_latest(spark, sf_dir):
    """K7: newest version of every artefact bundle."""
    return ar.latest_bundles(v.artifacts(spark, sf_dir))


@query("bundle_roundtrip", f"""{_A}
SELECT bundle, name, kind, file_path, version, CAST(octet_length(content) AS BIGINT) AS n_bytes,
       md5(content) AS md5
FROM a""")
def bundle_roundtrip(spark, sf_dir):
    """K7: every artefact published in a bundle, the committed bundle loaded again."""
    url = ar.publish_bundle(v.artifacts(spark, sf_dir), f"{scratch_dir(spark, 'bundles')}/all")
    return ar.load_bundle(spark, url).select(
        "bundle", "name", "kind", "file_path", "version",
        F.octet_length("content").cast("long").alias("n_bytes"), F.md5("content").alias("md5"))
