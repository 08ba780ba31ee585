"""Document fingerprints from content-defined chunks.

A gear hash rolls over the UTF-8 bytes; a chunk ends where the hash has zeros
under a mask.  Chunking is normalised: the mask is strict until the normal
size and loose after it, between a minimum and a maximum size, and a chunk
never splits a character.  The hash sees the last 32 bytes only, so borders
move with the text and an edit changes chunks near it alone.

A fingerprint is the sorted set of chunk digests, each packed with its chunk's
length.  Containment of one text in another is the length of its chunks found
there over the length of all its chunks (each distinct chunk once).

Null texts count as empty.  An empty text has an empty fingerprint; its
containment is 1 in an empty text and 0 in any other.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from runvault.llm.common import let, pick
from runvault.llm.registry import query, table

MIN, NORMAL, MAX = 48, 128, 512
STRICT, LOOSE = np.uint32(0xFF << 24), np.uint32(0x3F << 26)
#: one pseudo-random word for each byte value
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte: the sum of GEAR over the last 32 bytes, each shifted by its age."""
    h = GEAR[data]
    for age in (1, 2, 4, 8, 16):
        older = h[:-age] << np.uint32(age)
        h[age:] += older
    return h


def chunk_ends(data: bytes) -> list[int]:
    """End of each chunk."""
    n = len(data)
    if n == 0:
        return []
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = (raw & 0xC0) == 0x80  # a chunk may not end before such a byte
    whole = np.append(~inside[1:], True)
    h = gear_hashes(raw)
    strict = np.flatnonzero(((h & STRICT) == 0) & whole).tolist()
    loose = np.flatnonzero(((h & LOOSE) == 0) & whole).tolist()
    ends, start = [], 0
    while n - start > MIN:
        k = bisect_left(strict, start + MIN - 1)
        if k < len(strict) and strict[k] < start + NORMAL:
            end = strict[k] + 1
        else:
            k = bisect_left(loose, start + NORMAL - 1)
            end = loose[k] + 1 if k < len(loose) and loose[k] < start + MAX else min(start + MAX, n)
        while end < n and inside[end]:
            end -= 1
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def fingerprint(text: str | None) -> np.ndarray:
    """Sorted distinct (48 bits of digest, 16 bits of length), packed into longs."""
    data, out, start = (text or "").encode(), [], 0
    digest = xxhash.xxh3_64_intdigest
    for end in chunk_ends(data):
        out.append(digest(data[start:end]) & ~0xFFFF | end - start)
        start = end
    return np.unique(np.array(out, dtype=np.uint64).view(np.int64))


def fingerprint_column(text: Column | str) -> Column:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(fingerprint)
    return fingerprints(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _length(fp: Column) -> Column:
    return F.aggregate(fp, F.lit(0).cast("long"), lambda s, x: s + x.bitwiseAND(F.lit(0xFFFF)))


def containment(a: Column, b: Column) -> Column:
    """Share of fingerprint ``a``, by length, that ``b`` has."""
    total = _length(a)
    return F.when(F.size(a) == 0, (F.size(b) == 0).cast("double")).otherwise(
        _length(F.array_intersect(a, b)) / total)


def fingerprint_text(fp: Column) -> Column:
    """A fingerprint as one string of 16 hex digits for each chunk."""
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fp) for every row of ``docs``; a null text becomes empty."""
    rows = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("fp", fingerprint_column("text"))


def with_next(rows: DataFrame, key: str, tie: Column, carry: list[str]) -> DataFrame:
    """``rows`` with ``next_<c>`` of the row that follows in descending ``key`` (null last;
    the last row is followed by the first) for each c of ``carry``.

    The keys' quantiles cut the order into ranges; each range is one window
    group and holds a copy of the next range's first row.  Only the quantiles
    and one first key for each range, a number set by the shuffle partitions,
    reach the driver.  The rows are shuffled once.
    """
    spark = rows.sparkSession
    lowest = -(1 << 63)
    rows = rows.withColumn("_key", F.coalesce(F.col(key), F.lit(lowest))).withColumn("_tie", tie)
    keys = rows.select("_key", "_tie")
    ranges = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = keys.agg(F.percentile_approx("_key", shares, 20 * ranges)).first()[0] or []
    cuts = np.unique(np.array(cuts, dtype=np.int64))

    @F.pandas_udf(T.IntegerType())
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), side="left").astype(np.int32))

    firsts = (keys.withColumn("_range", range_of("_key")).groupBy("_range")
              .agg(F.max(F.struct("_key", (-F.col("_tie").cast("decimal(20,0)")).alias("t"), "_tie")).alias("f"))
              .select("_range", "f._key", "f._tie").collect())
    firsts.sort(key=lambda r: -r._range)
    goes_to = {(f._key, f._tie): firsts[k - 1]._range for k, f in enumerate(firsts)}

    @F.pandas_udf(T.IntegerType())
    def copy_to(keys: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series([goes_to.get(x) for x in zip(keys, ties)], dtype="Int32")

    both = rows.withColumn("_to", F.explode(F.array_compact(F.array(
        F.struct(range_of("_key").alias("r"), F.lit(False).alias("copy")),
        let(copy_to("_key", "_tie"), lambda r: F.when(r.isNotNull(), F.struct(r.alias("r"), F.lit(True).alias("copy"))))))))
    order = Window.partitionBy("_to.r").orderBy("_to.copy", F.desc("_key"), "_tie")
    led = both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry])
    return led.filter("not _to.copy").drop("_key", "_tie", "_to")


def edited_copies(docs: DataFrame) -> DataFrame:
    """Every row with its fingerprint, its edited text (last third replaced by the start of the
    next document in descending doc_id) and the next document's fingerprint.

    Rows with one doc_id follow each other by a hash of their texts.
    """
    rows = with_next(fingerprints(docs), "doc_id", F.xxhash64("text"), ["text", "fp"])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    return rows.select("doc_id", "text", "fp", "next_fp", edited.alias("edited"))


@query("op2_cdc_fingerprint")
def op2_cdc_fingerprint(spark, sf_dir):
    rows = edited_copies(table(spark, sf_dir, "documents"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", "next_fp",
                       F.sha2("edited", 256).alias("edited_sha256"), fingerprint_column("edited").alias("edited_fp"))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("fp")).alias("fingerprint"),
                       fingerprint_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       containment(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       containment(F.col("fp"), F.col("next_fp")).alias("near_next"))
