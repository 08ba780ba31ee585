"""Parameters: layered merge, first-non-null precedence, required keys.

Parameters are ``map<string,string>`` columns (JSON values as text), one map
per layer.  All operators are row-local expressions: no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed: keys every pipeline parameter set must define.
REQUIRED_PIPELINE_PARAMS = ("env_name", "pipeline_name")
EMPTY_MAP = "map<string,string>"


def parse_params(json_col: str | Column) -> Column:
    """JSON object text -> ``map<string,string>`` (nested values stay JSON text); malformed
    text is an error, null stays null."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    return F.from_json(c, EMPTY_MAP, {"mode": "FAILFAST"})


def _m(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.create_map().cast(EMPTY_MAP))


def merge_layers(*layers: str | Column) -> Column:
    """Merge parameter maps left to right; a later layer wins per key.

    ``map_zip_with`` + ``coalesce`` needs no session conf (``map_concat``
    would need ``mapKeyDedupPolicy=LAST_WIN``).  Null layers count as empty.
    """
    return reduce(lambda a, b: F.map_zip_with(a, b, lambda k, v1, v2: F.coalesce(v2, v1)),
                  [_m(x) for x in layers])


def merge_with_replace(defaults, file_layer, sent, override, replace: str | Column) -> Column:
    """The full precedence chain; with ``replace`` the sent layer replaces the file."""
    r = F.col(replace) if isinstance(replace, str) else replace
    body = F.when(F.coalesce(r, F.lit(False)), _m(sent)).otherwise(merge_layers(file_layer, sent))
    return merge_layers(defaults, body, override)


def first_set(*cols: str | Column, default=False) -> Column:
    """First non-null value: e.g. substep > step > default."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols], F.lit(default))


def params_text(m: str | Column) -> Column:
    """Stable text form ``k=v;...`` sorted by key."""
    c = F.col(m) if isinstance(m, str) else m
    return F.array_join(F.transform(F.sort_array(F.map_entries(c)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def missing_required(df: DataFrame, params_col: str,
                     required=REQUIRED_PIPELINE_PARAMS) -> DataFrame:
    """One row per missing or empty required key: ``(*, missing_key)``."""
    req = F.array(*[F.lit(k) for k in required])
    present = F.map_keys(F.map_filter(params_col, lambda k, v: F.length(v) > 0))
    return (df.select("*", F.explode(F.array_except(req, present)).alias("missing_key")))
