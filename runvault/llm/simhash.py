"""SimHash near-duplicates by covering locality-sensitive hashing.

A 64-bit SimHash is taken of every whole text.  To find all pairs within
``radius`` bits, each bit position gets a non-zero vector of radius + 1 bits,
and for each non-zero vector v a mask keeps the positions whose vector has odd
overlap with v.  At most ``radius`` differing positions span too few
dimensions to hit every mask, so every pair within the radius agrees on all
kept bits of some mask: there are 2^(radius+1) - 1 tables and no pair is
missed.

Equal fingerprints are joined first, so a group of equal texts is one entry.
A bucket of one table with more than ``bucket`` distinct fingerprints is never
paired: its entries get further masks over the bits that its mask left out,
which keeps the guarantee, until buckets are small (distinct fingerprints in a
bucket differ in the left-out bits only, and every further mask keeps more of
them, so the bits run out).  Where too few bits are left out for their vectors
to span all dimensions, they are dealt to radius + 1 groups and each group is
kept once: at most ``radius`` differing bits miss one group.  A bucket with at
most ``radius`` bits left out is one star, whatever its size.  Within small
buckets the bit distance is checked and a spanning forest kept.  Components of
all links come from alternating large-star and small-star steps over
checkpointed edges.

Null texts count as empty; texts without a word have fingerprint zero and link
like any other.  Rows with the same doc_id stay rows.  A component without any
non-null doc_id has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from runvault.llm.common import cut, pick
from runvault.llm.registry import query, table

BITS, SEED = 64, 42


# -- fingerprints ---------------------------------------------------------------
def simhash(text: str | None, shingle: int = 4) -> int:
    """Bit i is set if more than half of the shingles' XXH64 hashes have it set.

    A-Z are lower-cased, words are runs of anything but ASCII white space
    (``bytes.split``), a shingle is ``shingle`` words joined by a space; a
    shorter text is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    first, last = [0, *ends[: n - 1]], ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        some = np.array([digest(line[a:b - 1], SEED) for a, b in
                         zip(first[at:at + (1 << 16)], last[at:at + (1 << 16)])], dtype="<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def simhash_column(text: str, shingle: int = 4) -> Column:
    """The fingerprint as a long with the same 64 bits."""
    @F.pandas_udf(T.LongType())
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return fingerprints(F.coalesce(F.col(text), F.lit("")))


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# -- covering masks -------------------------------------------------------------
def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over ``positions`` such that any ``radius`` of them are all left out of some mask."""
    vectors = (1 << radius + 1) - 1
    return [sum(1 << p for k, p in enumerate(positions) if ((k % vectors + 1) & v).bit_count() & 1)
            for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def _finer(positions: list[int], radius: int) -> list[int]:
    """Masks like covering_masks for more than ``radius`` positions, none of them empty."""
    if len(positions) >= 1 << radius:  # the vectors span all dimensions: each v overlaps one oddly
        return covering_masks(positions, radius)
    return [sum(1 << p for p in positions[g::radius + 1]) for g in range(radius + 1)]


def _refined(masks: list[int], radius: int) -> dict[int, list[int]]:
    """For each mask, itself with finer masks over the positions it leaves out (more than ``radius``)."""
    rest = {m: [p for p in range(BITS) if not m >> p & 1] for m in masks}
    return {m: sorted({m | x for x in _finer(rest[m], radius)}) for m in masks}


def _forest(radius: int):
    """Spanning forest of the links within one bucket's distinct fingerprints."""
    link = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))

    def links(bucket) -> list[tuple[int, int]]:
        fps = np.sort(np.asarray(bucket, dtype=np.int64))
        bits, out = fps.view(np.uint64), []
        alone = np.ones(len(fps), dtype=bool)
        for root in range(len(fps)):
            if not alone[root]:
                continue
            alone[root] = False
            todo = [root]
            while todo and alone.any():
                near = np.flatnonzero(alone & (np.bitwise_count(bits ^ bits[todo.pop()]) <= radius))
                alone[near] = False
                todo += near.tolist()
                out += [(int(fps[root]), int(fps[k])) for k in near]
        return out

    @F.pandas_udf(link)
    def forest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for buckets in batches:
            yield buckets.map(links)
    return forest


def covering_links(fps: DataFrame, radius: int, bucket: int = 512) -> DataFrame:
    """Links (a, b) between the distinct longs of column ``fp`` such that two of them are
    connected through links exactly if they are through pairs within ``radius`` bits."""
    masks = covering_masks(list(range(BITS)), radius)
    rows = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    found = []
    while True:
        keyed = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        shared = cut(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"))
        # with at most radius bits left out all are near: at most 2^radius, and their forest is a star
        pairable = (F.col("n") <= bucket) | (F.bit_count("mask") >= BITS - radius)
        small = shared.filter(pairable).select("mask", "key")
        buckets = keyed.join(small, ["mask", "key"]).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        found.append(cut(buckets.select(F.explode(_forest(radius)("fps")).alias("link")).select("link.*").distinct()))
        large = shared.filter(~pairable)
        if large.isEmpty():
            break
        # a list of masks, not of data: only those with a large bucket are refined
        finer = _refined(sorted(r.mask & (1 << BITS) - 1 for r in large.select("mask").distinct().collect()), radius)
        pairs = fps.sparkSession.createDataFrame(
            [(_signed(m), [_signed(x) for x in xs]) for m, xs in finer.items()], "mask long, finer array<long>")
        rows = cut(keyed.join(large.select("mask", "key"), ["mask", "key"]).join(F.broadcast(pairs), "mask")
                   .select("fp", F.explode("finer").alias("mask")).distinct())
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


# -- components -----------------------------------------------------------------
def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Each large-star step hangs a node's larger neighbours under its smallest
    one, each small-star step its smaller ones; the edges shrink to stars in
    about log n rounds.  Minima are pre-aggregated before each shuffle.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .union(least.select("u", "m")).distinct())
        edges = cut(edges)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, bucket: int = 512,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, fp, root, component_id) for every row of ``docs`` (doc_id, text)."""
    rows = cut(pick(docs, "doc_id", "text", *keep).select("doc_id", *keep, simhash_column("text", shingle).alias("fp")))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = cut(components(covering_links(fps.select("fp"), radius, bucket)))
    member = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = cut(member)
    # written, so that the join deals both sides anew and can split a large component
    heads = cut(member.groupBy("root").agg(F.min("first").alias("component_id")))
    return rows.join(cut(member.join(heads, "root").select("fp", "root", "component_id")), "fp").select(
        "doc_id", *keep, "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each component: the one with the smallest doc_id
    (null last), then the smallest hash of its text; of rows equal in both any one.

    Rows are named by what they hold, not by their place, so both scans of ``docs`` agree
    also if executors come or go between them.
    """
    whole = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    doc_id, text = (F.col(f"_in{docs.columns.index(n)}") for n in ("doc_id", "text"))
    named = whole.withColumn("_doc", doc_id).withColumn("_hash", F.xxhash64(F.coalesce(text, F.lit(""))))
    found = near_duplicates(named.select(doc_id.alias("doc_id"), text.alias("text"), "_hash"), shingle, radius, keep=("_hash",))
    rows = found.groupBy("root", "doc_id", "_hash").agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "n")).alias("s")
    stay = cut(rows.groupBy("root").agg(best).select(F.col("s.doc_id").alias("_d"), F.col("s._hash").alias("_h"), "s.n"))
    kept = named.join(stay, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")))
    out = kept.filter("n = 1").select(*whole.columns)
    if not stay.filter("n > 1").isEmpty():
        repeated = kept.filter("n > 1").groupBy("_doc", "_hash").agg(F.first(F.struct(*whole.columns)).alias("r"))
        out = out.union(repeated.select("r.*"))
    return out.toDF(*docs.columns)


@query("op10_simhash")
def op10_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")
