"""Quality rules with risk-controlled thresholds.

Each rule compares two counts of a text with a cutoff from a fixed grid that
runs from lenient to strict.  Configurations of all rules form one fixed
sequence: from all rules off, one rule after the other goes one cutoff further.  A
text is rejected if any rule rejects it.  On labelled documents of good quality
(all labels count, none is used to fit anything else) that pass the base rule
the false rejections of every configuration are counted per stratum.  A configuration
passes if the exact binomial test rejects "false rejection rate above ``risk``" at level
``error`` / strata: the chance of as few or fewer false rejections, had the rate
been that high, is below the level (a Clopper-Pearson bound).  Configurations are
tested in their order up to the first failure, a fixed sequence that needs no
further correction; across strata the level is divided (Bonferroni).  So with
probability 1 - ``error`` no stratum loses more than ``risk`` of its good documents
that pass the base rule.  A stratum with too few labels keeps its documents: with
four strata and no false rejection 217 labels turn the rules on.

Null texts have no words and fail the base rule.  Strata include null.
A document is good if all its labels say so; labels without document count for
nothing.  Repeated rows are judged alike and stay.  Ratios equal to a cutoff
pass.  Texts are counted whole, whatever their length.  Repeated three-word
windows are found by 64-bit hashes of their words.  Empty tables give no rows;
extra columns are not read, or kept as they are by ``keep_good``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from runvault.llm.common import cut, hinted, let, pick
from runvault.llm.registry import query, table

SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
#: name, numerator, denominator, whether the ratio may be too high (or too low), cutoffs per thousand
RULES = (
    ("symbols", "n_symbols", "n_words", True, (2000, 1000, 500, 300, 200, 100, 50, 20)),
    ("dup_lines", "n_dup_lines", "n_lines", True, (900, 700, 500, 400, 300, 200, 100, 50)),
    ("repeats", "n_repeat_words", "n_words", True, (450, 400, 350, 300, 250, 200, 150, 100)),
    ("long_words", "word_chars", "n_words", True, (50000, 30000, 20000, 15000, 12000, 10000, 9000, 8000)),
    ("short_words", "word_chars", "n_words", False, (1000, 1500, 2000, 2500, 3000, 3300, 3600, 4000)),
)
RISK, ERROR = 0.02, 0.05
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


# -- counts of a text -----------------------------------------------------------
def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text."""
    last = F.size(words) - 3
    windows = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(
            F.array().cast("array<bigint>"))

    def places(h: Column) -> Column:
        in_order = F.sort_array(h)
        twice = let(in_order, lambda s: F.array_distinct(F.filter(s, lambda x, j: (j > 0) & (x == F.get(s, j - 1)))))
        few = lambda d: F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(d, F.get(h, i)))
        many = let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: F.sort_array(
            F.transform(F.filter(s, lambda e, j: F.coalesce(e.h == F.get(s, j - 1).h, F.lit(False))
                                 | F.coalesce(e.h == F.get(s, j + 1).h, F.lit(False))), lambda e: e.i)))
        return let(twice, lambda d: F.when(F.size(d) <= 16, few(d)).otherwise(many))

    covered = lambda p: F.aggregate(
        p, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("sum")),
        lambda a, x: F.struct(x.alias("last"), (a["sum"] + F.least(F.lit(3), x - a["last"])).alias("sum")),
        lambda a: a["sum"])
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
        let(places(h), covered)))


def text_counts(text: Column) -> Column:
    """Struct of the counts FEATURES (long) of a text."""
    def of(t: Column) -> Column:
        body = F.btrim(t, F.lit(SPACE))
        words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACES))
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        return let(words, lambda w: let(lines, lambda ln: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(t, SPACES, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(ln).cast("long").alias("n_lines"))))
    return let(F.coalesce(text, F.lit("")), of)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _rejects(rule: tuple, cutoff: Column | int) -> Column:
    _, top, under, high, _ = rule
    value, limit = 1000 * F.col(top), cutoff * F.col(under)
    return value > limit if high else value < limit


# -- exact binomial bound ---------------------------------------------------------
def _log_gamma(x: Column) -> Column:
    """ln Gamma for x >= 1: Stirling's series at x + 7."""
    y = x + 7
    low = F.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6))
    return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7))) - low)


def binomial_cdf(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X ~ Bin(n, p) where k < n p; 1 where k is not below the mean.

    Below the mean the terms fall from k downwards; those further than 20
    standard deviations (and 200 terms) add nothing to a double.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(p) + (n - k) * F.log(1 - p))
    steps = F.sequence(F.lit(0), F.least(k, 200 + 20 * F.sqrt(n * p)).cast("int"))
    terms = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, d: F.struct((a["term"] * (k - d) / (n - k + d + 1) * (1 - p) / p).alias("term"),
                              (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(top * terms)


def good_ids(labels: DataFrame) -> DataFrame:
    """The doc_ids whose labels all say good."""
    return (pick(labels, "doc_id", "quality").groupBy("doc_id").agg(F.min("quality").alias("quality"))
            .filter("quality = 1").select("doc_id"))


def configurations(counted: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK,
                   error: float = ERROR) -> DataFrame:
    """One row per stratum with labelled good documents: (stratum, <rule>_cutoff per rule, null: rule off).

    ``counted`` has doc_id, the stratum and the counts; labels (doc_id, quality).  Step t of the
    sequence moves rule t % rules to its cutoff t // rules."""
    turns = len(RULES)
    first = F.least(*[F.coalesce(*[F.when(_rejects(rule, c), F.lit(j * turns + r)) for j, c in enumerate(rule[4])])
                      for r, rule in enumerate(RULES)])  # the step that rejects a text first; null: none does
    steps = [F.struct(F.lit(t).alias("t"), F.count_if(F.col("_first") <= t).alias("k"))
             for t in range(turns * len(RULES[0][4]))]
    held = counted.filter(~base_failed()).join(good_ids(labels), "doc_id", "left_semi")
    per = cut(held.withColumn("_first", first).groupBy(F.col(stratum).alias("stratum"))
              .agg(F.count("*").alias("n"), F.array(*steps).alias("steps")))
    tests = (per.crossJoin(F.broadcast(per.agg(F.count("*").alias("strata"))))  # times one row
             .select("stratum", "n", "strata", F.inline("steps")))
    fails = binomial_cdf(F.col("k"), F.col("n"), F.lit(risk)) > F.lit(error) / F.col("strata")
    passed = tests.groupBy("stratum").agg(F.coalesce(F.min(F.when(fails, F.col("t"))), F.count("*").cast("int")).alias("p"))
    return cut(passed.select("stratum", *[
        F.get(F.array(*[F.lit(c).cast("long") for c in rule[4]]), F.ceil((F.col("p") - r) / turns).cast("int") - 1)
        .alias(f"{rule[0]}_cutoff") for r, rule in enumerate(RULES)]))


def judge(counted: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept``."""
    few = hinted(limits.withColumnRenamed("stratum", "_stratum"), limits.count())
    rows = counted.join(few, counted[stratum].eqNullSafe(F.col("_stratum")), "left")
    bad = F.lit(False)
    for rule in RULES:
        bad = bad | F.coalesce(_rejects(rule, F.col(f"{rule[0]}_cutoff")), F.lit(False))
    return (rows.withColumn("base_failed", base_failed()).withColumn("kept", ~(F.col("base_failed") | bad))
            .select(*counted.columns, "base_failed", "kept"))


def counted_once(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the counts of a text column.  They come out of a generator of one row, through
    which the optimizer moves no filter, so later conditions do not count a text again."""
    return rows.withColumn("_c", F.explode(F.array(text_counts(F.col(text))))).select(
        *[c for c in rows.columns], *[f"_c.{f}" for f in FEATURES])


def count_texts(docs: DataFrame, *keep: str) -> DataFrame:
    return counted_once(pick(docs, *keep, "text"), "text").drop("text")


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK,
                     error: float = ERROR) -> DataFrame:
    """(doc_id, stratum, counts, base_failed, kept) for every row of ``docs``; counts are made once."""
    counted = cut(count_texts(docs, "doc_id", stratum))
    return judge(counted, configurations(counted, labels, stratum, risk, error), stratum)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK,
              error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    labelled = pick(docs, "doc_id", stratum, "text").join(good_ids(labels), "doc_id", "left_semi")
    limits = configurations(count_texts(labelled, "doc_id", stratum), labels, stratum, risk, error)
    whole = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    text, by = (f"_in{docs.columns.index(n)}" for n in ("text", stratum))
    counted = counted_once(whole.withColumn("_by", F.col(by)), text)
    kept = judge(counted, limits, "_by").filter("kept")
    return kept.select(*[F.col(f"_in{i}").alias(n) for i, n in enumerate(docs.columns)])


def _sql() -> str:
    op = {True: ">", False: "<"}
    turns, steps = len(RULES), len(RULES) * len(RULES[0][4])
    first = ", ".join(f"CASE WHEN 1000*{x[1]} {op[x[3]]} {c}*{x[2]} THEN {j * turns + r} END"
                      for r, x in enumerate(RULES) for j, c in enumerate(x[4]))
    cdf = (f"list_sum(list_transform(range(0, k+1), lambda i: exp(lgamma(n+1) - lgamma(i+1) - lgamma(n-i+1) "
           f"+ i*ln({RISK}) + (n-i)*ln(1-{RISK}))))")
    bad = " OR ".join(f"coalesce(1000*{x[1]} {op[x[3]]} c{r}*{x[2]}, false)" for r, x in enumerate(RULES))
    cutoffs = ", ".join(f"[{', '.join(map(str, x[4]))}][ceil((p - {r}) / {turns}.0)::INT] AS c{r}" for r, x in enumerate(RULES))
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT rid, unnest(range(1, len(ws)-1)) AS i, unnest(list_transform(range(1, len(ws)-1),
        lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])) AS g FROM w WHERE len(ws) >= 3),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + d) AS n FROM rep, (SELECT unnest([0,1,2]) AS d) GROUP BY rid),
f AS (SELECT w.rid, doc_id, lang, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov ON w.rid = cov.rid),
b AS (SELECT *, n_words < 50 OR 100*n_repeat_words > 50*n_words AS base_failed FROM f),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT lang, list_min([{first}]) AS first FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
per AS (SELECT lang, count(*) AS n, list(first) AS firsts, count(*) OVER () AS strata FROM held GROUP BY lang),
tests AS (SELECT lang, n, strata, t, len(list_filter(firsts, lambda x: x <= t)) AS k FROM per, (SELECT unnest(range({steps})) AS t)),
lim AS (SELECT lang, {cutoffs} FROM (SELECT lang,
        coalesce(min(t) FILTER (WHERE NOT (k < n*{RISK} AND {cdf} <= {ERROR}/strata)), {steps}) AS p FROM tests GROUP BY lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {bad}) AS kept FROM b LEFT JOIN lim ON b.lang IS NOT DISTINCT FROM lim.lang
"""


@query("op5_quality", _sql())
def op5_quality(spark, sf_dir):
    rows = quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")
