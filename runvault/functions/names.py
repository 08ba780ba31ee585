"""Column-expression helpers for run ids, paths and names.

Every helper returns a ``Column`` built from built-in Spark SQL functions, so
it stays inside whole-stage codegen.  Pure-Python helpers here only translate
literal arguments (a glob, a prefix) on the driver.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for compatible paths and ids.
# Run id: "run-" + two-digit year, month, day, "-", hours, minutes, seconds.
RUN_ID_PATTERN = "'run-'yy-MM-dd-HHmmss"
# Characters kept in artefact file names; everything else is removed.
FILE_NAME_DROP = r"[^-a-zA-Z0-9_.() ]+"
# Defaults when a substep does not set them.
DEFAULT_ENV = "user"
DEFAULT_ZONE = "zone"
# Commit marker written by the output committer.
COMMIT_MARKER = "_SUCCESS"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def run_id_of(ts: str | Column) -> Column:
    """Run id of a timestamp: ``run-yy-MM-dd-HHmmss`` (second resolution)."""
    return F.date_format(col_(ts), RUN_ID_PATTERN)


def path_part(path: str | Column, k: int) -> Column:
    """``path.split('/')[k]`` with Python-style negative ``k``."""
    idx = k + 1 if k >= 0 else k
    return F.try_element_at(F.split(col_(path), "/"), F.lit(idx))


def strip_slashes(c: str | Column) -> Column:
    return F.btrim(col_(c), F.lit("/"))


def strip_prefix(c: str | Column, prefix: str) -> Column:
    """Drop a *literal* prefix (no regex semantics) when present."""
    c = col_(c)
    return F.when(c.startswith(prefix),
                  F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def step_from_folder(c: str | Column) -> Column:
    """Step name from a folder ``<prefix>-<step parts...>``: everything after
    the first ``-``; null when there is none."""
    parts = F.split(col_(c), "-")
    return F.when(F.size(parts) > 1,
                  F.array_join(F.slice(parts, 2, F.size(parts) - 1), "-"))


def normalize_entity(c: str | Column) -> Column:
    """Dots in an entity name are stored as underscores."""
    return F.replace(col_(c), F.lit("."), F.lit("_"))


def entity_full_name(env, pipeline, zone, step, entity) -> Column:
    return F.concat_ws(".", *(col_(x) for x in (env, pipeline, zone, step, entity)))


def entity_url(env_path, pipeline, zone, step, run_id, entity) -> Column:
    """``{env_path}/{pipeline}/{zone}/{step}/{run_id}/{entity}``."""
    return F.concat_ws("/", *(col_(x) for x in (env_path, pipeline, zone, step, run_id)),
                       normalize_entity(entity))


def clean_file_name(c: str | Column) -> Column:
    return F.regexp_replace(col_(c), FILE_NAME_DROP, "")


def glob_regex(pattern: str) -> str:
    """Java-compatible regex for a shell glob (``fnmatch`` semantics)."""
    return fnmatch.translate(pattern)


def glob_match(c: str | Column, pattern: str) -> Column:
    return col_(c).rlike(glob_regex(pattern))


def quote_regex(text: str) -> str:
    """Literal text inside a Java regex."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"
