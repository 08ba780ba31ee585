"""Filter interaction audit by a Gray-code walk over all subsets of filters.

Each document gets the mask of the filters that it fails.  Documents of one
part with equal masks form a cell, so k filters leave at most 2^k cells a part,
whatever the size of the table.  A walk in Gray-code order toggles one filter
at a time; every cell has a counter of the active filters that it fails, and
when that counter leaves or reaches zero the cell leaves or joins the running
survivors.  The 2^k survivor states are stored, and every step of every order
is a difference of two of them: what a step keeps is the state of the filters
applied so far.

The five filters of the query: few words, few distinct words, many capitals,
symbols, copies of an earlier document.  A copy is found by the SHA-256 of its
text: per digest only the smallest doc_id is gathered, with partial sums before
the shuffle, and it is joined back on (digest, doc_id), so a text that a third
of all rows share is no hot key.

Null texts count as empty.  Null and empty languages are one part.  Rows with
a null doc_id are no copies, make no copies and have no labels.  Rows with equal
doc_id and text are not copies of one another.  A document is good (toxic) if
any of its labels says so.  Repeated rows count as often as they occur.  Very
long texts are taken in slices; a worker holds a text and its distinct words.
An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runvault.llm.common import cut, pick
from runvault.llm.registry import query, table

NAMES = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 200, 50, 3, b"#$%&*|"
COPY = NAMES.index("E")
SLICE = 1 << 22  # bytes of text that are split into words at once
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_INSIDE = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
_SPACES = b" \t\n\x0b\x0c\r"


def _slices(body: bytes) -> Iterator[bytes]:
    """The text in pieces that end with a word."""
    start = 0
    while len(body) - start > SLICE:
        end = start + SLICE
        while end < len(body) and body[end] not in _SPACES:
            end += 1
        yield body[start:end]
        start = end
    yield body[start:]


def text_mask(body: bytes) -> int:
    """Bits 0 to 3: whether a UTF-8 text fails filters A to D."""
    n_words, distinct = 0, set()
    for piece in _slices(body):
        words = piece.split()  # of bytes: at the six ASCII spaces
        n_words += len(words)
        distinct.update(words)
    capitals = len(body) - len(body.translate(None, _CAPITALS))
    points = len(body.translate(None, _INSIDE))
    symbols = len(body.translate(None, SYMBOLS)) < len(body)
    fails = (n_words < MIN_WORDS, 100 * len(distinct) < MIN_DISTINCT * n_words,
             100 * capitals > MAX_CAPITALS * points, symbols)
    return sum(failed << bit for bit, failed in enumerate(fails))


def text_failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, digest, mask) for every row of ``docs`` (doc_id, text and the part's column)."""
    rows = pick(docs, "doc_id", "text", part).select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [x.as_buffer().to_pybytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
                 pa.array([text_mask(b) for b in bodies], pa.int32())], names=["doc_id", "part", "digest", "mask"])
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {doc_id}, part string, digest binary, mask int")


def failure_cells(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each part that fail exactly the filters of the mask."""
    ids = cut(text_failures(docs, part).groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n")))
    first = cut(ids.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")
                .withColumn("original", F.lit(True)))
    marks = cut(pick(labels, "doc_id", "quality", "toxic").filter("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")).filter("good + toxic > 0"))
    named = (ids.filter("doc_id is not null").join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
             .select("part", (F.col("mask") + F.when(F.col("original"), 0).otherwise(1 << COPY)).alias("mask"), "n",
                     F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    unnamed = ids.filter("doc_id is null").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return named.union(unnamed).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def survivor_states(cells: np.ndarray) -> np.ndarray:
    """Row s: the sums of the cells (one row a mask) that fail no filter of subset s."""
    masks = np.arange(len(cells))
    active_failures = np.zeros(len(cells), dtype=np.int64)
    alive, active = cells.sum(axis=0), 0
    states = np.empty_like(cells)
    states[0] = alive
    for turn in range(1, len(cells)):
        bit = turn & -turn  # the filter that the Gray code toggles
        active ^= bit
        failing = masks & bit > 0
        if active & bit:
            alive = alive - cells[failing & (active_failures == 0)].sum(axis=0)
            active_failures[failing] += 1
        else:
            active_failures[failing] -= 1
            alive = alive + cells[failing & (active_failures == 0)].sum(axis=0)
        states[active] = alive
    return states


def audit_rows(cells: np.ndarray, names: str) -> pd.DataFrame:
    """Every step of every order of the filters, from the cells of one part (columns n, good, toxic)."""
    k, states = len(names), survivor_states(cells)
    full = (1 << k) - 1
    failing = [int(states[0, 0] - states[1 << f, 0]) for f in range(k)]
    unique = [int(states[full ^ 1 << f, 0] - states[full, 0]) for f in range(k)]
    shapley = [sum(factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) * int(states[s, 0] - states[s | 1 << f, 0])
                   for s in range(1 << k) if not s >> f & 1) for f in range(k)]
    rows = []
    for order in permutations(range(k)):
        applied = 0
        for step, f in enumerate(order, 1):
            before, after = states[applied], states[applied | 1 << f]
            applied |= 1 << f
            removed, good, toxic = (int(x) for x in before - after)
            rows.append(("".join(names[g] for g in order), step, int(after[0]), removed, failing[f] - removed,
                         unique[f], good, toxic, shapley[f]))
    return pd.DataFrame(rows, columns=["filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                       "good_lost", "toxic_lost", "shapley"])


def audit(cells: DataFrame, names: str = NAMES) -> DataFrame:
    """All orders and steps of each part, from ``cells`` (part, mask, n, good, toxic); one letter a filter.

    A part has 2^k cells at most, and k! * k rows come back for it."""
    if not 1 <= len(names) <= 8:
        raise ValueError("one to eight filters can be audited in all orders")
    columns = ["mask", "n", "good", "toxic"]
    parts = cells.groupBy("part").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("c")).select(
        "part", *[F.col(f"c.{c}").cast("array<bigint>").alias(c) for c in columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, mask, *counts in pdf.itertuples(index=False):
                dense = np.zeros((1 << len(names), len(counts)), dtype=np.int64)
                dense[np.asarray(mask)] = np.column_stack([np.asarray(c) for c in counts])
                rows = audit_rows(dense, names)
                rows.insert(0, "part", part)
                yield rows
    return parts.mapInPandas(run, "part string, filter_order string, step int, kept long, removed long, redundant long, "
                                  "unique_fails long, good_lost long, toxic_lost long, shapley long")


def _sql() -> str:
    letters = range(len(NAMES))
    differ = " AND ".join(f"f{i}.bit <> f{j}.bit" for i in letters for j in letters if i < j)
    order = " || ".join(f"f{i}.name" for i in letters)
    steps = " UNION ALL ".join(
        f"SELECT o, {i + 1} AS step, b{i} AS bit, {' + '.join(f'b{j}' for j in range(i)) or '0'} AS done FROM orders"
        for i in letters)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
m AS (SELECT doc_id, part, (len(ws) < {MIN_WORDS})::INT + 2 * (100 * len(list_distinct(ws)) < {MIN_DISTINCT} * len(ws))::INT
    + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > {MAX_CAPITALS} * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask FROM w),
cells AS (SELECT part, mask, count(*) AS n,
    count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
    count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic FROM m GROUP BY ALL),
states AS (SELECT part, s, coalesce(sum(n) FILTER (WHERE mask & s = 0), 0) AS n,
    coalesce(sum(good) FILTER (WHERE mask & s = 0), 0) AS good, coalesce(sum(toxic) FILTER (WHERE mask & s = 0), 0) AS toxic
    FROM cells, (SELECT unnest(range(32))::INT AS s) GROUP BY ALL),
f AS (SELECT unnest(range({len(NAMES)})) AS i, substr('{NAMES}', i + 1, 1) AS name, (1 << i)::INT AS bit),
orders AS (SELECT {order} AS o, {", ".join(f"f{i}.bit AS b{i}" for i in letters)}
    FROM {", ".join(f"f AS f{i}" for i in letters)} WHERE {differ}),
steps AS ({steps}),
rows AS (SELECT a.part, o AS filter_order, step, bit, b.n AS kept, a.n - b.n AS removed, a.good - b.good AS good_lost,
    a.toxic - b.toxic AS toxic_lost FROM steps JOIN states a ON a.s = done JOIN states b ON b.s = done + bit AND b.part = a.part)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
    (coalesce((SELECT sum(n) FROM cells c WHERE c.part = rows.part AND c.mask & bit > 0), 0) - removed)::BIGINT AS redundant,
    coalesce((SELECT sum(n) FROM cells c WHERE c.part = rows.part AND c.mask = bit), 0)::BIGINT AS unique_fails,
    good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM rows
"""


@query("op11_filter_audit", _sql())
def op11_filter_audit(spark, sf_dir):
    return audit(failure_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
