"""Mixing sources to target weights by Poisson replication.

Every source gets a repetition rate: its target weight of the whole mass (text
characters) over its own mass.  A document's number of copies is the Poisson
distribution with that mean, inverted at a uniform number hashed from the seed
and the doc_id, so runs agree and no state is shared.  The inversion adds up exact
terms from a place 12 standard deviations below the mean (what lies below is less than a
double tells from 0) to as far above, so its work is the root of the number of
copies and no table is kept.  Documents are exploded by their counts, and all copies are
sorted by a hash of seed, doc_id and copy: a global shuffle.  Where a source's
counts can pass SPREAD, ranges of that many copies are dealt to tasks first.

Weights are relative; ``None`` means equal weights, and sources not named get
no copies.  A null source is a source of its own (named ``NULL_SOURCE``).  A
source without any text has no mass to weigh; its documents stay exactly once.  Null
doc_ids and equal doc_ids hash alike and so get equal counts.  Repeated rows are
documents of their own, texts are never cut, and an empty table gives no rows.
Other columns are kept, but for ``copy`` and ``shuffle_key``, which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from runvault.llm.common import cut, hinted, let, pick
from runvault.llm.registry import query, table

SEED = "mix-1"
NULL_SOURCE = "\x00"
SPREAD = 1000  # copies of a document that one row explodes to


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of a SHA-256."""
    text = F.concat_ws("|", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(1 << 52)


def bracket(rate: Column) -> tuple[Column, Column]:
    """The first and the last count of a Poisson variable that a double tells from never."""
    width = 12 * F.sqrt(rate) + 40
    return F.greatest(F.lit(0), F.floor(rate - width)).cast("long"), F.ceil(rate + width).cast("long")


def poisson_inverse(rate: Column, u: Column) -> Column:
    """The smallest k with P(X <= k) >= u, for X ~ Poisson(rate), rate > 0 (a long)."""
    low, high = bracket(rate)
    k = F.greatest(low, F.lit(1)).cast("double")
    off = (rate - k) / k
    # ln P(X = low): Stirling's series around low, which loses no digits for large rates
    first = F.when(low == 0, -rate).otherwise(
        k * (F.log1p(off) - off) - 0.5 * F.log(2 * math.pi * k) - 1 / (12 * k) + 1 / (360 * k * k * k))
    start = F.struct(first.alias("log"), F.exp(first).alias("sum"), (F.exp(first) < u).cast("long").alias("below"))

    def step(a: Column, n: Column) -> Column:
        log = a["log"] + F.log(rate) - F.log(n.cast("double"))
        total = a["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), (a["below"] + (total < u).cast("long")).alias("below"))
    return F.aggregate(F.sequence(low + 1, high), start, step, lambda a: low + a["below"])


def rates(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None) -> DataFrame:
    """(src, rate), one row per source of ``docs``; ``total`` is the target mass (default: the present
    one).  The rate of a source without mass is null: its documents stay."""
    rows = pick(docs, "source", "text").select(
        F.coalesce("source", F.lit(NULL_SOURCE)).alias("src"), F.length(F.coalesce("text", F.lit(""))).alias("mass"))
    per = cut(rows.groupBy("src").agg(F.sum("mass").cast("double").alias("mass")))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("src") == name, F.lit(float(w))).otherwise(weight)
    per = per.withColumn("weight", F.when(F.col("mass") > 0, weight).otherwise(0.0))
    sums = per.agg(F.sum("mass").alias("all_mass"), F.sum("weight").alias("all_weight"))
    target = F.col("all_mass") if total is None else F.lit(float(total))
    rate = F.when(F.col("mass") > 0, F.coalesce(F.col("weight") / F.expr("nullif(all_weight, 0.0)"), F.lit(0.0))
                  * target / F.col("mass"))
    return cut(per.crossJoin(F.broadcast(sums)).select("src", rate.alias("rate")))  # times one row


def copies(doc_id: Column | str, rate: Column, seed: str = SEED) -> Column:
    """How often a document stands in the mix."""
    return F.when(rate.isNull(), 1).when(rate > 0, let(uniform(F.lit(seed), doc_id), lambda u: poisson_inverse(rate, u))).otherwise(0)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None,
        seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` (doc_id, source, text among them), with ``copy`` (from 1) and
    ``shuffle_key``, in the order of the key.  Columns of these names are replaced."""
    names = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    rate = rates(docs, weights, total).withColumn("most", F.coalesce(bracket(F.col("rate"))[1], F.lit(1)))
    n_sources, most = rate.agg(F.count("*"), F.coalesce(F.max("most"), F.lit(0))).first()
    rows = pick(docs, *names).toDF(*[f"_in{i}" for i in range(len(names))])
    doc_id, source = (F.col(f"_in{names.index(n)}") for n in ("doc_id", "source"))
    rows = rows.join(hinted(rate, n_sources), F.coalesce(source, F.lit(NULL_SOURCE)) == F.col("src"))
    counted = lambda df: df.withColumn("_n", copies(doc_id, F.col("rate"), seed).cast("long")).filter("_n > 0")
    copy = lambda first, last: F.explode(F.sequence(first, last))
    out = counted(rows.filter(F.col("most") <= SPREAD)).withColumn("copy", copy(F.lit(1).cast("long"), F.col("_n")))
    if most > SPREAD:
        many = counted(rows.filter(F.col("most") > SPREAD)).withColumn(
            "_range", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / SPREAD)))).repartition(doc_id, F.col("_range"))
        out = out.unionByName(many.withColumn("copy", copy(
            F.col("_range") * SPREAD + 1, F.least(F.col("_n"), (F.col("_range") + 1) * SPREAD))).drop("_range"))
    key = F.sha2(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), F.col("copy")), 256)
    rows = out.withColumn("shuffle_key", key).orderBy("shuffle_key")
    return rows.select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(names)], F.col("copy").cast("int").alias("copy"), "shuffle_key")


SQL = f"""
WITH d AS (SELECT *, coalesce(source, chr(0)) AS src, coalesce(length(text), 0) AS mass FROM documents),
per AS (SELECT src, sum(mass)::DOUBLE AS mass FROM d GROUP BY src),
lam AS (SELECT src, CASE WHEN mass > 0 THEN 1.0 / count(*) FILTER (WHERE mass > 0) OVER () * sum(mass) OVER () / mass
          END AS rate FROM per),
ks AS (SELECT src, rate, unnest(range(0, ceil(rate + 12*sqrt(rate) + 40)::INT + 1)) AS k FROM lam WHERE rate IS NOT NULL),
cdf AS (SELECT src, k, sum(exp(-rate + k*ln(rate) - lgamma(k + 1))) OVER (PARTITION BY src ORDER BY k) AS c FROM ks),
u AS (SELECT *, ('0x' || substr(sha256('{SEED}|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM d),
n AS (SELECT u.doc_id, u.lang, u.source, u.text, CASE WHEN lam.rate IS NULL THEN 1
          ELSE (SELECT count(*) FROM cdf WHERE cdf.src = u.src AND cdf.c < u.u) END::INT AS n FROM u JOIN lam ON lam.src = u.src),
x AS (SELECT doc_id, source, lang, text, unnest(range(1, n + 1))::INT AS copy FROM n WHERE n > 0)
SELECT doc_id, source, lang, text, copy,
  sha256('{SEED}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy) AS shuffle_key FROM x
"""


@query("op6_poisson_mix", SQL)
def op6_poisson_mix(spark, sf_dir):
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "source", "lang", "text")
    return mix(docs)
