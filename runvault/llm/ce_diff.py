"""LM scoring by cross-entropy difference.

Two n-gram models, one of the target documents and one of all documents, share
one vocabulary: the 256 byte values, so nothing is unknown.  A token is a word
with the white space byte after it (more white space: tokens of one byte), and
has two n-grams to lean on:

* words: how often the token follows the token before it (pairs within a
  text), over how often it occurs at all.  Every distinct word and pair of the
  corpus is counted, with no cut-off, so these counts grow with it.
* spelling: the product of interpolated byte trigrams (at most 2^24 counts
  whatever the corpus), which also gives unseen words their share.

Words and trigrams use Witten-Bell smoothing; a pair leans on its word with the
weight of ``PRIOR`` occurrences (a Dirichlet prior), so pairs need no counts of
continuations.  The background is matched to the target's size: its counts are
thinned to the target's total in expectation (a count c becomes s c, and is
seen at all with chance 1 - (1 - s)^c), so that smoothing weighs both alike.  A
document's own words and pairs are left out of the counts when it is scored, so
rare ones do not give away which model has seen the document.  The score is the
mean over its tokens of target loss minus background loss, in bits: low scores
look like the target.

Documents are dealt by a hash of doc_id to blocks of about ``BLOCK`` bytes of
text (smaller ones where that gives fewer blocks than shuffle partitions; no
score depends on it).  Words and pairs are keyed by hashes of 16 bits more than
the corpus has bytes to tell apart (at most 63).  A block reports its distinct
keys once, sorted and as differences, in parts by their leading bits; a part is
summed over all blocks, and each block gets back the sums of its own keys, in
their order and without the keys.  A part holds a key no more often than there
are blocks, the number of parts grows with the corpus, and a block has no more
parts than keys.  Only the trigrams, bounded by the vocabulary, go to all
workers.

Null texts count as empty.  Texts without a token have null scores.  Repeated
rows count as often as they occur; rows of one doc_id share a block.  A null
doc_id is no target.  With no target document all scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from runvault.llm.common import pick
from runvault.llm.registry import query, table
from runvault.session import scratch_dir

SIZE, CELLS = 256, 256 ** 3
BLOCK = 16 << 20  # bytes of text in a block, on average
SLICE = 1 << 20   # bytes of text looked at at once
PART = 4 << 20    # bytes of text in the corpus for each part of the keys
PRIOR = 16.0      # occurrences a word's own chance weighs within a pair
GRAM, WORD, PAIR = 0, 1, 2
LEAD, END = b"\n\n", b"\n"  # what stands before and after every text
_SEPARATOR = np.isin(np.arange(SIZE), [32, *range(9, 14)])
_VALUE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, SIZE, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
REPORTS = "block int, kind int, part int, n int, keys binary, target binary, everything binary"
#: the first row of a part has no block: its words' totals, and how many words occur how often
SUMS = REPORTS + ", in_target long, in_all long, kinds long, often array<long>, words array<long>"
SCORES = "n_tokens long, target_loss double, background_loss double"


class Tokens:
    """Some texts as bytes: trigrams of every byte, and where tokens begin.

    ``doc`` is the place of a token's text among the texts, ``key`` its hash,
    ``pair`` that of it and the token before it where it ``follows`` one.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + len(END) if t else 0 for t in texts], dtype=np.int64)
        raw = np.frombuffer(b"".join(LEAD + t + END for t in texts if t), dtype=np.uint8)
        inside = np.ones(len(raw), dtype=bool)
        some = sizes[sizes > 0] + len(LEAD)
        heads = np.cumsum(some) - some
        inside[heads] = inside[heads + 1] = False
        at = np.flatnonzero(inside)
        here = raw[at]
        self.grams = raw[at - 2].astype(np.uint32) << np.uint32(16) | raw[at - 1].astype(np.uint32) << np.uint32(8) | here
        ends = np.flatnonzero(_SEPARATOR[here])
        self.begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        lengths = ends - self.begins + 1
        place = np.arange(len(here)) - np.repeat(self.begins, lengths)
        power = np.cumprod(np.full(lengths.max(initial=0) + 1, _STEP, dtype=np.uint64))
        self.key = self.sums(_VALUE[here] * power[place]).view(np.int64)
        self.doc = np.searchsorted(np.cumsum(sizes), self.begins, side="right")
        self.follows = np.diff(self.doc, prepend=-1) == 0
        word = self.key.view(np.uint64)
        before = np.roll(word, 1)
        pair = (before ^ before >> np.uint64(31)) * _STEP + word
        self.pair = (pair ^ pair >> np.uint64(32)) * _STEP

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Per token, the sum over its bytes."""
        return np.add.reduceat(per_byte, self.begins) if len(self.begins) else per_byte[:0]


def slices(texts: pa.ChunkedArray) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of consecutive texts of about ``SLICE`` bytes, none cut."""
    start, held, some = 0, 0, []
    for at, text in enumerate(texts):
        some.append(text.as_py().encode())
        held += len(some[-1])
        if held >= SLICE:
            yield start, some
            start, held, some = at + 1, 0, []
    if some:
        yield start, some


def texts_and_marks(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The texts of a block, and which of them the block's marks (rows without text) name."""
    is_text = pc.is_valid(rows["text"])
    found, marks = rows.filter(is_text), rows.filter(pc.invert(is_text))["doc_id"]
    return found, pc.is_in(found["doc_id"], value_set=marks.combine_chunks(), skip_nulls=True).to_numpy()


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as their count of bytes each, then all lowest bytes, all second ones and so on."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + planes.tobytes()


def unpack(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :raw[0]] = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(raw[0], n).T
    return out.view("<u8").ravel()


class Keys:
    """How keys are cut and dealt to parts in a corpus of ``total`` bytes."""

    def __init__(self, total: int, parts: int):
        word = min(63, total.bit_length() + 16)
        deep = max(parts, -(-total // PART)).bit_length()
        self.bits = {GRAM: 24, WORD: word, PAIR: word}
        self.deep = {kind: min(bits, deep) for kind, bits in self.bits.items()}

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes.view(np.uint64) >> np.uint64(64 - self.bits[WORD])

    def report(self, block: int, kind: int, keys: np.ndarray, target: np.ndarray, everything: np.ndarray) -> Iterator[tuple]:
        """Rows ``REPORTS`` of sorted distinct keys."""
        part = keys >> np.uint64(self.bits[kind] - self.deep[kind])
        ends = np.append(np.flatnonzero(np.diff(part)) + 1, len(keys))
        start = 0
        for end in ends[ends > 0].tolist():
            at = slice(start, end)
            yield (block, kind, int(part[start]), end - start, pack(np.diff(keys[at], prepend=np.uint64(0))),
                   pack(target[at]), pack(everything[at]))
            start = end

    def count_block(self, rows: pa.Table) -> pa.Table:
        """Rows ``REPORTS`` of one block."""
        found, is_target = texts_and_marks(rows)
        grams = np.zeros((2, CELLS), dtype=np.uint32)
        keys, hits = {WORD: [], PAIR: []}, {WORD: [], PAIR: []}
        for start, some in slices(found["text"]):
            tokens = Tokens(some)
            hit = is_target[start + tokens.doc]
            for kind, found_keys, of in ((WORD, tokens.key, hit), (PAIR, tokens.pair[tokens.follows], hit[tokens.follows])):
                keys[kind].append(self.cut(found_keys))
                hits[kind].append(of)
            spelled = np.repeat(hit, np.diff(tokens.begins, append=len(tokens.grams)))
            for which in (0, 1):
                np.add.at(grams[which], tokens.grams[spelled == which], np.uint32(1))
        block = rows["block"][0].as_py()
        seen = np.flatnonzero(grams.any(axis=0))
        out = list(self.report(block, GRAM, seen.astype(np.uint64), grams[1][seen], grams[:, seen].sum(axis=0, dtype=np.int64)))
        for kind in (WORD, PAIR):
            if keys[kind]:
                key, which = np.unique(np.concatenate(keys.pop(kind)), return_inverse=True)
                target = np.bincount(which, np.concatenate(hits.pop(kind)), len(key)).astype(np.int64)
                out += self.report(block, kind, key, target, np.bincount(which, minlength=len(key)))
        return _table(out, REPORTS)


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in ddl.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table({name: pa.array(c, types[kind]) for (name, kind), c in zip(fields, columns)})


def sum_part(rows: pa.Table) -> pa.Table:
    """Rows ``SUMS`` of one part: its sums without a block, and for words and pairs the answer to each report."""
    reports = rows.to_pylist()
    keys = np.concatenate([np.cumsum(unpack(r["keys"], r["n"]), dtype=np.uint64) for r in reports])
    key, which = np.unique(keys, return_inverse=True)
    target, everything = (np.bincount(which, np.concatenate([unpack(r[c], r["n"]) for r in reports])).astype(np.int64)
                          for c in ("target", "everything"))
    kind, part = reports[0]["kind"], reports[0]["part"]
    if kind == GRAM:
        return _table([(None, kind, part, len(key), pack(key), pack(target), pack(everything), *[None] * 5)], SUMS)
    often, words = np.unique(everything, return_counts=True)
    out = [(None, kind, part, len(key), None, None, None, int(target.sum()), int(everything.sum()),
            int((target > 0).sum()), often, words)]
    start = 0
    for r in reports:
        at = which[start:start + r["n"]]
        out.append((r["block"], kind, part, r["n"], None, pack(target[at]), pack(everything[at]), *[None] * 5))
        start += r["n"]
    return _table(out, SUMS)


class Losses:
    """Loss in bits of each trigram under one model; built in slices of the first byte."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, thinned: float):
        self.table = np.empty(CELLS, dtype=np.float32)
        mass, seen = counts * thinned, -np.expm1(counts * np.log1p(-thinned)) if thinned < 1 else np.ones(len(counts))
        single = np.bincount(grams & 255, mass, SIZE)
        p1 = (single + 1) / (single.sum() + SIZE)
        pairs = np.bincount(grams & 65535, mass, SIZE * SIZE).reshape(SIZE, SIZE)
        pair_seen = np.zeros(SIZE * SIZE)
        # a pair is seen if any of its trigrams is
        np.maximum.at(pair_seen, grams & 65535, seen)
        p2 = self._smooth(pairs, pair_seen.reshape(SIZE, SIZE), p1)
        first = grams >> 16
        for b in range(SIZE):
            lo, hi = np.searchsorted(first, [b, b + 1])
            cell = grams[lo:hi] & 65535
            c, s = np.zeros(SIZE * SIZE), np.zeros(SIZE * SIZE)
            c[cell], s[cell] = mass[lo:hi], seen[lo:hi]
            p3 = self._smooth(c.reshape(SIZE, SIZE), s.reshape(SIZE, SIZE), p2)
            self.table[b << 16:(b + 1) << 16] = -np.log2(p3).ravel()

    @staticmethod
    def _smooth(counts: np.ndarray, seen: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """(c(h w) + T(h) p(w)) / (c(h) + T(h)), T(h) the number of continuations seen."""
        types = seen.sum(axis=1, keepdims=True)
        total = counts.sum(axis=1, keepdims=True) + types
        return np.where(total > 0, (counts + types * lower) / np.where(total > 0, total, 1), lower)


class Model:
    """Sparse trigram counts, expanded once by each worker, and totals of the word counts.

    ``words`` and ``kinds`` are the tokens and distinct words of the target and
    of the thinned background; ``thinned`` is the share s.
    """

    def __init__(self, grams: np.ndarray, target: np.ndarray, everything: np.ndarray,
                 words: tuple[float, float], kinds: tuple[float, float], thinned: float, prior: float = PRIOR):
        order = np.argsort(grams)
        self.grams, self.target, self.everything = grams[order], target[order], everything[order]
        self.words, self.kinds, self.thinned, self.prior = words, kinds, thinned, prior
        self.tables = None

    def __getstate__(self):
        return self.__dict__ | {"tables": None}

    def losses(self) -> tuple[np.ndarray, np.ndarray]:
        if self.tables is None:
            hit = self.target > 0
            share = float(self.target.sum()) / max(float(self.everything.sum()), 1.0)
            self.tables = (Losses(self.grams[hit], self.target[hit], 1.0).table,
                           Losses(self.grams, self.everything, share).table if share else
                           Losses(self.grams[:0], self.everything[:0], 1.0).table)
        return self.tables

    def word_losses(self, which: int, counts: np.ndarray, left_out: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        """Loss in bits of tokens with these counts; ``left_out`` tokens are taken from the total."""
        kinds = self.kinds[which]
        if not kinds:
            return spelling
        total = np.maximum(self.words[which] - left_out, 0) + kinds
        p = (counts + kinds * np.exp2(-spelling)) / total
        unseen = spelling + np.log2(total / kinds)  # exact also where the spelling's chance is too small for a float
        return np.where(counts > 0, -np.log2(np.where(counts > 0, p, 1)), unseen)

    def pair_losses(self, counts: np.ndarray, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Loss in bits of tokens with these counts after a token with counts ``before``; ``word`` is their own loss."""
        total = before + self.prior
        p = (counts + self.prior * np.exp2(-word)) / total
        return np.where(counts > 0, -np.log2(np.where(counts > 0, p, 1)), word + np.log2(total / self.prior))

    def score_block(self, keys: Keys, rows: pa.Table, sums: pa.Table) -> pa.Table:
        """(doc_id, ``SCORES``) of one block's texts, given the corpus sums of its words and pairs."""
        found, is_target = texts_and_marks(rows)
        mine = {WORD: [], PAIR: []}
        for _, some in slices(found["text"]):
            tokens = Tokens(some)
            mine[WORD].append(np.unique(keys.cut(tokens.key)))
            mine[PAIR].append(np.unique(keys.cut(tokens.pair[tokens.follows])))
        answers = sorted(sums.to_pylist(), key=lambda r: (r["kind"], r["part"]))
        known = {}
        for kind in (WORD, PAIR):
            key = np.unique(np.concatenate(mine.pop(kind) or [np.empty(0, dtype=np.uint64)]))
            counts = [np.concatenate([unpack(r[c], r["n"]) for r in answers if r["kind"] == kind] or [key[:0]]).astype(np.float64)
                      for c in ("target", "everything")]
            if len(counts[0]) != len(key):
                raise ValueError(f"{len(key)} keys of kind {kind} in a block, {len(counts[0])} answers")
            known[kind] = key, *counts
        n, losses = np.zeros(len(found), dtype=np.int64), np.zeros((2, len(found)))
        for start, some in slices(found["text"]):
            tokens = Tokens(some)
            size = np.bincount(tokens.doc, minlength=len(some))
            hit = is_target[start + tokens.doc]
            words = self.others(*known[WORD], keys.cut(tokens.key), tokens.doc, hit)
            f = tokens.follows
            pairs = self.others(*known[PAIR], keys.cut(tokens.pair[f]), tokens.doc[f], hit[f])
            left_out = ((size * is_target[start:start + len(some)])[tokens.doc], size[tokens.doc] * self.thinned)
            for which, table in enumerate(self.losses()):
                spelling = tokens.sums(table[tokens.grams].astype(np.float64))
                loss = self.word_losses(which, words[which], left_out[which], spelling)
                loss[f] = self.pair_losses(pairs[which], np.roll(words[which], 1)[f], loss[f])
                losses[which, start:start + len(some)] = np.bincount(tokens.doc, loss, len(some))
            n[start:start + len(some)] = size
        mean = [pa.array(s / np.maximum(n, 1), mask=n == 0) for s in losses]
        return pa.table({"doc_id": found["doc_id"], "n_tokens": pa.array(n), "target_loss": mean[0], "background_loss": mean[1]})

    def others(self, key: np.ndarray, target: np.ndarray, everything: np.ndarray,
               wanted: np.ndarray, doc: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts under both models of the wanted keys outside their own document."""
        at = np.searchsorted(key, wanted)
        _, same, often = np.unique(doc * len(key) + at, return_inverse=True, return_counts=True)
        own = often[same]
        return target[at] - own * hit, (everything[at] - own) * self.thinned


def blocks(docs: DataFrame, target_ids: DataFrame) -> tuple[DataFrame, Keys]:
    """(block, doc_id, text): every text (null: empty), and a row without text for every target id."""
    texts = pick(docs, "doc_id", "text")
    kind = texts.schema["doc_id"].dataType
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(-(-total // BLOCK), parts)
    marks = pick(target_ids, "doc_id").select(F.col("doc_id").cast(kind)).where("doc_id is not null").distinct()
    rows = texts.withColumn("text", F.coalesce("text", F.lit(""))).unionByName(
        marks.withColumn("text", F.lit(None).cast("string")))
    by = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return rows.select(F.pmod(by, F.lit(n)).cast("int").alias("block"), "doc_id", "text"), Keys(total, parts)


def train(rows: DataFrame, keys: Keys, prior: float = PRIOR) -> tuple[Model, DataFrame]:
    """The model of ``blocks``, and (block, kind, part, n, target, everything): corpus counts of each block's words and pairs."""
    spark = rows.sparkSession

    def count(texts: pa.Table) -> pa.Table:
        return keys.count_block(texts)

    reports = rows.groupBy("block").applyInArrow(count, REPORTS)
    folder = scratch_dir(spark, "ce-counts")
    reports.groupBy("kind", "part").applyInArrow(sum_part, SUMS).write.parquet(folder)
    sums = spark.read.parquet(folder)
    whole = sums.filter("block is null")
    words = whole.filter(F.col("kind") == WORD)
    in_target, in_all, kinds = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("in_target", "in_all", "kinds")]).first()
    thinned = in_target / max(in_all, 1)
    spread = words.select(F.explode(F.arrays_zip("often", "words")).alias("s"))
    seen = spread.agg(F.sum(F.col("s.words") * (1 - F.pow(F.lit(1 - thinned), F.col("s.often"))))).first()[0] or 0.0
    grams = whole.filter(F.col("kind") == GRAM).select("n", "keys", "target", "everything").toArrow().to_pylist()  # 2^24 counts at most
    columns = [np.concatenate([unpack(r[c], r["n"]) for r in grams] or [np.empty(0)]).astype(np.int64)
               for c in ("keys", "target", "everything")]
    model = Model(*columns, (in_target, in_all * thinned), (kinds, seen), thinned, prior)
    return model, sums.filter("block is not null").select("block", "kind", "part", "n", "target", "everything")


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for every row of ``docs`` (doc_id, text).

    The target is the rows whose doc_id is in ``target_ids`` (doc_id); ``prior`` is the weight
    of a word's own chance within a pair, in occurrences."""
    rows, keys = blocks(docs, target_ids)
    model, sums = train(rows, keys, prior)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts: pa.Table, known: pa.Table) -> pa.Table:
        return sent.value.score_block(keys, texts, known)

    out = rows.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
        scores, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCORES}")
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))


@query("op9_ce_difference")
def op9_ce_difference(spark, sf_dir):
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)
