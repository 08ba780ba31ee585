"""Tagged records (notebook cells): select, check, blank, filter, summarise.

Data shape: cells(nb_id, pos, cell_type, tags array<string>, source string,
outputs array<string>).  Per-notebook results use ``min_by`` / ``max_by`` /
``count_if`` aggregates, which combine partially before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed tag names.
PARAMETERS_TAG = "parameters"
BUSINESS_REPORT_TAG = "business_report"


def has_tag(tag: str, case_insensitive: bool = False, tags: str = "tags") -> Column:
    if case_insensitive:
        t = tag.lower()
        return F.exists(F.coalesce(F.col(tags), F.array().cast("array<string>")),
                        lambda x: F.lower(x) == F.lit(t))
    return F.coalesce(F.array_contains(tags, tag), F.lit(False))


def first_cell_by_tag(cells: DataFrame, tag: str) -> DataFrame:
    """First code cell per notebook carrying ``tag`` (case-insensitive)."""
    hit = cells.filter((F.col("cell_type") == "code") & has_tag(tag, case_insensitive=True))
    return hit.groupBy("nb_id").agg(F.min("pos").alias("pos"),
                                    F.min_by("source", "pos").alias("source"))


def tag_violations(cells: DataFrame, known=(PARAMETERS_TAG,),
                   required=(PARAMETERS_TAG,)) -> DataFrame:
    """Per notebook and known tag: missing required tag or tag used more than once.

    Output: nb_id, tag, n, problem.
    """
    counts = cells.groupBy("nb_id").agg(
        *[F.count_if(has_tag(t)).alias(f"n_{i}") for i, t in enumerate(known)])
    per_tag = counts.select("nb_id", F.explode(F.array(*[
        F.struct(F.lit(t).alias("tag"), F.col(f"n_{i}").alias("n"))
        for i, t in enumerate(known)])).alias("x"))
    req = F.array(*[F.lit(t) for t in required])
    problem = (F.when(F.col("x.n") > 1, "applied more than once")
               .when((F.col("x.n") == 0) & F.array_contains(req, F.col("x.tag")), "missing"))
    return (per_tag.select("nb_id", F.col("x.tag").alias("tag"), F.col("x.n").alias("n"),
                           problem.alias("problem"))
            .filter(F.col("problem").isNotNull()))


def clear_source_by_tag(cells: DataFrame, tag: str) -> DataFrame:
    """Blank the source of cells carrying ``tag``."""
    return cells.withColumn("source", F.when(has_tag(tag), F.lit("")).otherwise(F.col("source")))


def remove_cells_by_tag(cells: DataFrame, tag: str) -> DataFrame:
    return cells.filter(~has_tag(tag))


def business_view(cells: DataFrame, summaries: DataFrame | None = None,
                  tag: str = BUSINESS_REPORT_TAG) -> DataFrame:
    """Non-code cells, plus code cells with outputs and ``tag`` (source blanked).

    ``summaries(nb_id, source)`` rows are prepended at ``pos = -1`` as
    markdown cells.
    """
    is_code = F.col("cell_type") == "code"
    keep = ~is_code | ((F.size(F.coalesce("outputs", F.array().cast("array<string>"))) > 0)
                       & has_tag(tag))
    body = cells.filter(keep).withColumn(
        "source", F.when(is_code, F.lit("")).otherwise(F.col("source")))
    body = body.select("nb_id", "pos", "cell_type", "tags", "source", "outputs")
    if summaries is None:
        return body
    head = summaries.select("nb_id", F.lit(-1).cast(body.schema["pos"].dataType).alias("pos"),
                            F.lit("markdown").alias("cell_type"),
                            F.array().cast("array<string>").alias("tags"), "source",
                            F.array().cast("array<string>").alias("outputs"))
    return head.unionByName(body)


def last_output(cells: DataFrame) -> DataFrame:
    """Per notebook: the first output of the last cell that has any output."""
    with_out = cells.filter(F.size(F.coalesce("outputs", F.array().cast("array<string>"))) > 0)
    return with_out.groupBy("nb_id").agg(
        F.max("pos").alias("pos"),
        F.max_by(F.element_at("outputs", 1), "pos").alias("result"))


def _unescaped(piece: Column) -> Column:
    """A piece of a quoted text between escaped backslashes, its other escapes resolved."""
    for sign, char in (("n", "\n"), ("r", "\r"), ("t", "\t"), ("'", "'"), ('"', '"')):
        piece = F.replace(piece, F.lit("\\" + sign), F.lit(char))
    return piece


def last_result(cells: DataFrame, data: str = "data", mime: str = "text/plain") -> DataFrame:
    """Per notebook: the result of the last cell whose first output has data of ``mime``, and its value.

    ``data`` is an array with a map (mime type -> text) for each output of a
    cell; outputs without data (logs, errors) are null or empty maps.  Cells whose first output
    has no such data are passed over, whatever their later outputs hold.

    Output: nb_id, pos, result (the text), kind (``int``, ``float``, ``bool``,
    ``none``, ``str`` or ``other``: not one of these literals, say a list)
    and the value in the column of its kind (``int_value``, ``float_value``,
    ``bool_value``, ``str_value``).  Whole numbers beyond 64 bits are ``other``.  Of equal positions
    the greatest text is taken.  Of the escapes in a quoted text ``\\\\``, ``\\'``,
    ``\\"``, ``\\n``, ``\\r`` and ``\\t`` are resolved, others stay as they are.
    """
    text = F.try_element_at(F.get(data, F.lit(0)), F.lit(mime))
    last = (cells.withColumn("_text", text).filter(F.col("_text").isNotNull())
            .groupBy("nb_id").agg(F.max(F.struct("pos", "_text")).alias("l"))
            .select("nb_id", "l.pos", F.col("l._text").alias("result")))
    t = F.trim("result")
    whole, real = r"^[+-]?[0-9]+$", r"^[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+|[0-9]+(?=[eE]))(?:[eE][+-]?[0-9]+)?$"
    number = F.when(t.rlike(whole), t.try_cast("long"))
    quote, inner = F.substring(t, 1, 1), F.substring(t, F.lit(2), F.length(t) - 2)
    bare = F.regexp_replace(inner, r"(?s)\\.", "")
    quoted = (quote.isin("'", '"') & (F.length(t) > 1) & (F.right(t, F.lit(1)) == quote)
              & ~F.contains(bare, quote) & ~F.contains(bare, F.lit("\\")))
    plain = F.array_join(F.transform(F.split(inner, r"\\\\"), _unescaped), "\\")
    kind = (F.when(number.isNotNull(), "int").when(t.rlike(real), "float").when(t.isin("True", "False"), "bool")
            .when(t == "None", "none").when(quoted, "str").otherwise("other"))
    return last.withColumn("kind", kind).select(
        "nb_id", "pos", "result", "kind", number.alias("int_value"),
        F.when(F.col("kind") == "float", t.try_cast("double")).alias("float_value"),
        F.when(F.col("kind") == "bool", t == "True").alias("bool_value"),
        F.when(F.col("kind") == "str", plain).alias("str_value"))
