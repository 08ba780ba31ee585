"""Model artefact operators (bundles, kinds, names, scoring)."""

from __future__ import annotations

import hashlib
import io
import threading

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runvault.functions.names import clean_file_name, strip_prefix


def subset_by_prefix(files: DataFrame, prefix: str, path_col: str = "rel_path") -> DataFrame:
    """Keep file rows under a literal folder prefix and make paths relative to it."""
    return (files.filter(F.col(path_col).startswith(prefix))
            .withColumn(path_col, strip_prefix(path_col, prefix)))


# Fixed artefact kinds and profile names.
KIND_TEXT, KIND_JSON, KIND_BINARY = "text", "json", "binary"
PROFILE_KEY = "bentoservice_profile"
# Default upper bound on classes x features of a model that is shipped by broadcast.
MAX_MODEL_CELLS = 50_000_000
# Feature rows that one task scores at once with a model of its own.
ROWS_PER_GROUP = 20_000


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def artifact_kind(explicit: str | Column, value_type: str | Column) -> Column:
    """Kind: an explicit kind wins; else str -> text, dict -> json, anything else binary."""
    vt = _c(value_type)
    return F.coalesce(_c(explicit), F.when(vt == "str", KIND_TEXT)
                      .when(vt == "dict", KIND_JSON).otherwise(KIND_BINARY))


def normalize_extension(ext: str | Column) -> Column:
    """Binary file extensions carry a leading dot; empty stays empty."""
    e = F.coalesce(_c(ext), F.lit(""))
    return F.when((e == "") | e.startswith("."), e).otherwise(F.concat(F.lit("."), e))


def artifact_file_path(base_path: str | Column, name: str | Column,
                       ext: str | Column) -> Column:
    """A base path whose last part has a dot is a file path and is used as is;
    otherwise ``base/clean(name) + ext``."""
    b = _c(base_path)
    last = F.element_at(F.split(b, "/"), -1)
    return F.when(F.instr(last, ".") > 0, b).otherwise(
        F.concat(b, F.lit("/"), clean_file_name(name), normalize_extension(ext)))


def service_version(given: str | Column, env, pipeline, zone, name, run_id) -> Column:
    """Given version, else ``env.pipeline.zone.name.run_id``; null when neither."""
    parts = [_c(x) for x in (env, pipeline, zone, name, run_id)]
    derived = F.when(F.greatest(*[p.isNull().cast("int") for p in parts]) == 0,
                     F.concat_ws(".", *parts))
    return F.coalesce(_c(given), derived)


def profile(name: str | Column, params: str | Column) -> Column:
    """``{bentoservice_profile: {name, params}}`` as a struct column."""
    return F.struct(F.struct(_c(name).alias("name"), _c(params).alias("params"))
                    .alias(PROFILE_KEY))


# ------------------------------------------------------------------ G6 model

def train_centroids(features: DataFrame, vec: str = "embedding", label: str = "label",
                    by: tuple[str, ...] = ()) -> DataFrame:
    """Nearest-centroid model: mean feature vector per label, one model for each value of ``by``.

    ``(label, i)`` means aggregate with map-side partials; each label's
    vector is then gathered from ``dim`` values.
    """
    x = features.select(*by, label, F.posexplode(vec).alias("i", "v"))
    m = x.groupBy(*by, label, "i").agg(F.avg(F.col("v").cast("double")).alias("c"))
    return m.groupBy(*by, label).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "c"))), lambda s: s["c"])
        .alias("centroid"))


def pack_centroid_model(centroids: DataFrame, label: str = "label",
                        max_cells: int | None = None) -> bytes:
    """Serialise a centroid table to model bytes (``npz``: labels, W, b).

    The table is trained once and read partition by partition; a model of more
    than ``max_cells`` numbers (default ``MAX_MODEL_CELLS``) is an error as soon
    as the bound is passed, so the driver never holds more.
    """
    limit = MAX_MODEL_CELLS if max_cells is None else max_cells
    rows, cells = [], 0
    for r in centroids.toLocalIterator():
        cells += len(r["centroid"])
        if cells > limit:
            raise ValueError(f"model too large to ship (more than {limit} numbers)")
        rows.append(r)
    rows.sort(key=lambda r: r[label])
    dim = max((len(r["centroid"]) for r in rows), default=0)
    labels = np.array([r[label] for r in rows], dtype=np.int64)
    w = np.array([r["centroid"] for r in rows], dtype=np.float64).reshape(len(rows), dim)
    b = -0.5 * (w * w).sum(axis=1)
    buf = io.BytesIO()
    np.savez(buf, labels=labels, w=w, b=b)
    return buf.getvalue()


_MODEL_CACHE: dict = {}
_MODEL_LOCK = threading.Lock()


def _load_model(key, payload: bytes):
    """One decoded model per worker process, shared by its tasks."""
    with _MODEL_LOCK:
        m = _MODEL_CACHE.get(key)
        if m is None:
            z = np.load(io.BytesIO(payload))
            m = (z["labels"], z["w"], z["b"])
            _MODEL_CACHE[key] = m
        return m


def score_linear(spark: SparkSession, features: DataFrame, model: bytes,
                 vec: str = "embedding", keep: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """Batch-score ``features`` with a linear model: ``argmax(W x + b)``.

    Model bytes travel once per executor as a broadcast variable and are
    decoded once per Python worker; rows move as Arrow batches through
    ``mapInPandas``.
    """
    bc = spark.sparkContext.broadcast(model)
    key = ("linear", hashlib.sha1(model).hexdigest())
    cols = list(keep)
    fields = ", ".join(f"{c} {features.schema[c].dataType.simpleString()}" for c in cols)
    schema = f"{fields}, predicted long, score double"

    def run(batches):
        labels, w, b = _load_model(key, bc.value)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf[vec].to_numpy()).astype(np.float64)
            s = x @ w.T + b
            k = s.argmax(axis=1)
            out = pdf[cols].copy()
            out["predicted"] = labels[k]
            out["score"] = s[np.arange(len(k)), k]
            yield out

    return features.select(*cols, vec).mapInPandas(run, schema)


def score_many(models: DataFrame, features: DataFrame, by: tuple[str, ...] = ("bundle", "version"),
               vec: str = "embedding", label: str = "label", keep: tuple[str, ...] = ("vec_id", "label"),
               rows_per_group: int = ROWS_PER_GROUP, max_cells: int = MAX_MODEL_CELLS) -> DataFrame:
    """Score every feature row with the model of its ``by`` columns: ``keep, by, predicted, score``.

    ``models`` has a row for each class of each model (``by``, label, centroid);
    models stay rows and meet their feature rows in a cogroup, nothing passes
    through the driver.  The rows of a model are counted and dealt to as many
    groups of about ``rows_per_group`` as it needs, each with its own copy of
    the model, so a hot model is scored by many tasks and a group's size is
    bounded.  A model of more than ``max_cells`` numbers is an error.

    A class counts ``w.x - |w|^2 / 2``; ties go to the smallest label.  Rows
    without a model, with a null vector or key, or with a vector of another length
    than the model's stay, with null results; repeated rows stay repeated.  Rows are dealt by their
    place, so ``features`` should be a stored table, whose rows a repeated task finds in the same order.
    """
    out = [f"{c} {features.schema[c].dataType.simpleString()}" for c in (*keep, *by)]
    schema = ", ".join(out) + ", predicted long, score double"
    names = [f"k{i}" for i in range(len(by))]
    kept = [f"r{i}" for i in range(len(keep))]
    rows = features.select(*[F.col(c).alias(n) for c, n in zip(by, names)],
                           *[F.col(c).alias(n) for c, n in zip(keep, kept)], F.col(vec).alias("x")).withColumn(
        "at", F.monotonically_increasing_id())
    classes = models.select(*[F.col(c).alias(n) for c, n in zip(by, names)],
                            F.col(label).cast("long").alias("class"), F.col("centroid").alias("w"))
    groups = rows.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / rows_per_group).cast("int").alias("n_groups"))
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]
    both = rows.alias("a").join(groups.alias("b"), same, "left").select("a.*", "b.n_groups")
    dealt = both.withColumn("part", F.pmod(F.xxhash64("at"), "n_groups").cast("int")).drop("n_groups", "at")
    copies = classes.alias("a").join(groups.alias("b"), [F.col(f"a.{n}") == F.col(f"b.{n}") for n in names]).select(
        "a.*", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)).alias("part"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        result = left[kept + names].copy()
        result["predicted"] = pd.array([None] * len(left), dtype="Int64")
        result["score"] = pd.array([None] * len(left), dtype="Float64")
        result.columns = [*keep, *by, "predicted", "score"]
        model = right[right["w"].notna()].sort_values("class")
        if not len(model) or not len(left):
            return result
        w = np.stack(model["w"].to_numpy()).astype(np.float64)
        if w.size > max_cells:
            raise ValueError(f"model too large to score with (more than {max_cells} numbers)")
        fits = np.array([x is not None and len(x) == w.shape[1] for x in left["x"]])
        if fits.any():
            s = np.stack(left["x"].to_numpy()[fits]).astype(np.float64) @ w.T - 0.5 * (w * w).sum(axis=1)
            best = s.argmax(axis=1)
            result.loc[fits, "predicted"] = model["class"].to_numpy()[best]
            result.loc[fits, "score"] = s[np.arange(len(best)), best]
        return result

    return dealt.groupBy(*names, "part").cogroup(copies.groupBy(*names, "part")).applyInPandas(run, schema)


# ------------------------------------------------------------------ K7 / G4 bundles

ARTIFACT_COLUMNS = ("bundle", "version", "name", "kind", "ext", "file_path", "content")


def publish_bundle(artifacts: DataFrame, url: str) -> str:
    """Publish an artefact table as one immutable bundle version at ``url``.

    Written with the output committer, so ``_SUCCESS`` marks it complete.
    """
    from runvault.sinks.publish import publish
    cols = [c for c in ARTIFACT_COLUMNS if c in artifacts.columns]
    return publish(artifacts.select(*cols), url)


def load_bundle(spark: SparkSession, url: str) -> DataFrame:
    """Read a bundle; refuses one without the commit marker."""
    from runvault.functions.names import COMMIT_MARKER
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{url.rstrip('/')}/{COMMIT_MARKER}")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(f"bundle at {url} is not committed")
    return spark.read.parquet(url)


def latest_bundles(artifacts: DataFrame) -> DataFrame:
    """Newest version of every bundle and its artefact count."""
    per = artifacts.groupBy("bundle", "version").agg(F.count(F.lit(1)).alias("n_artifacts"))
    return per.groupBy("bundle").agg(F.max_by(F.struct("version", "n_artifacts"), "version")
                                     .alias("b")).select(
        "bundle", F.col("b.version").alias("version"), F.col("b.n_artifacts").alias("n_artifacts"))


def export_artifacts(artifacts: DataFrame, dest_root: str, row_size: int = 1024 * 1024) -> None:
    """Write artefact bytes to ``dest_root/<file_path>`` (chunked, ordered writes)."""
    from runvault.operators.chunks import chunk_files
    from runvault.sinks.archive import write_files
    files = artifacts.select(F.col("file_path").alias("rel_path"),
                             F.octet_length("content").cast("long").alias("length"), "content")
    write_files(chunk_files(files, row_size), dest_root)
