"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0 .. n-1 in the order of doc_id.  A Feistel network over the
smallest even number of bits that holds n is a permutation of that range; a
row number is encrypted again while the result is n or more (cycle walking),
which gives a permutation of 0 .. n-1.  A row's place p goes to shard
p mod shards, slot p div shards, so shard sizes differ by one row at most,
slots have no gaps, and both directions can be computed from n and the key
alone (``place_of``, ``row_at``).

Rows without doc_id are numbered first; rows with equal doc_id follow by
checksum and size, and rows equal in all of these are interchangeable.  An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from runvault.llm.common import pick, with_row_number
from runvault.llm.registry import query, table

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """Keyed 64-bit mixer."""
    x = x + np.uint64(key & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _round_keys(key: int) -> list[int]:
    return [(key + 1 + k) * 0x9E3779B97F4A7C15 % 2**64 for k in range(ROUNDS)]


def _network(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    low = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & low
    if back:
        for k in reversed(_round_keys(key)):
            left, right = right ^ (_mix(left, k) & low), left
    else:
        for k in _round_keys(key):
            left, right = right, left ^ (_mix(right, k) & low)
    return left << np.uint64(half) | right


def permute(rows, n: int, key: int, back: bool = False) -> np.ndarray:
    """The place of each row number below ``n``; ``back`` inverts it."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    out = np.asarray(rows, dtype=np.int64).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        out[walking] = _network(out[walking], half, key, back)
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def place_of(row: int, n: int, shards: int, key: int) -> tuple[int, int]:
    """(shard, slot) of a row number."""
    place = int(permute([row], n, key)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int, key: int) -> int:
    """The row number at a shard's slot."""
    return int(permute([slot * shards + shard], n, key, back=True)[0])


def shard_rows(docs: DataFrame, shards: int, key: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot) for every row of ``docs`` (doc_id, text);
    size is the text's UTF-8 bytes (null: none) plus 8.  Texts are not shuffled."""
    body = F.coalesce("text", F.lit("")).cast("binary")
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", (F.length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows, n = with_row_number(rows, ["doc_id", "text_crc32", "size"], "row")

    @F.pandas_udf(T.LongType())
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, key))

    rows = rows.withColumn("place", place("row"))
    return rows.select("doc_id", "size", "text_crc32", "row", (F.col("place") % shards).cast("int").alias("shard"),
                       F.floor(F.col("place") / shards).cast("long").alias("slot"))


@query("op7_feistel_shards")
def op7_feistel_shards(spark, sf_dir):
    rows = shard_rows(table(spark, sf_dir, "documents"), 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
