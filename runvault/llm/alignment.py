"""Alignment of two tokenizers by an associative fragment monoid.

Tokenizer A is a byte-level BPE, B a SentencePiece BPE.  Both cover the same
bytes (a space and the text).  Offsets where tokens of both end cut the tokens
into groups; inside a group every A token is linked to the B tokens whose bytes
it overlaps.

A byte range of a document holds the tokens that end in it, and becomes a
``Fragment``: the tokens up to its first common end (open prefix, as its group
may have begun further left), the closed groups, and the tokens after its last
common end (open suffix).  Joining two fragments closes the group of the left
suffix and the right prefix.  The operation is associative, so ranges can be
encoded anywhere and combined in any grouping.  Documents above
``piece_chars`` are cut into pieces that tasks encode apart, and their fragments are
reduced in a tree, FAN pieces a step, each step a Spark grouping.

A text is encoded word by word: neither tokenizer joins anything across a
single space between two other characters that are no white space, so there
both may be cut (A starts a pre-token there, B has no piece with a mark
inside).  Words are fragments with both ends closed, are kept in a bounded
cache, and are joined by concatenation.  Pieces begin at such places too; a
stretch without any is one piece.

For the counts corpus-wide, documents lie in blocks of about BLOCK bytes.  A
block reports its id pairs with its number of documents, the sums (and the
highest of each A id) go back to the blocks that hold the pair, and each block
scores its documents.  No table of pairs is broadcast or collected; a pair has
one row a block, and both join sides are plain rows that a skew join can split.

Texts that are null or empty, or whose joined token bytes differ from a space
and the text (a text with U+2581, which B turns into a space), have no tokens:
zeros and an empty digest, and add nothing to the counts.  Repeated rows are
documents of their own; null doc_ids are kept.  A document's groups are one
string in the task that ends its reduction, a few times the text; it must stay
below 2 GB.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from runvault.llm.common import cut, pick
from runvault.llm.registry import query, table

MARK = "▁"
PIECE = 1 << 16  # code points
FAN = 16
BLOCK, STEP = 32 << 20, 2 << 20  # code points of a block, and of a step inside it
CACHED_WORDS, CACHED_CHARS = 500_000, 64
LEARNT = 2000  # words that are encoded as one text
TOUCHING = re.compile(r"\s | \s|^ | $|^$")  # a space that white space or an end of the text touches


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# -- fragments -----------------------------------------------------------------
@dataclass
class Run:
    """Tokens in order: ids and last byte offsets (exclusive ends) of A and of B."""
    a: list[int] = field(default_factory=list)
    a_end: list[int] = field(default_factory=list)
    b: list[int] = field(default_factory=list)
    b_end: list[int] = field(default_factory=list)

    def __add__(self, other: Run) -> Run:
        return Run(self.a + other.a, self.a_end + other.a_end, self.b + other.b, self.b_end + other.b_end)


@dataclass
class Fragment:
    """What a byte range knows: ``prefix`` up to its first common end, ``groups`` (their
    strings) and ``links`` (packed pair to occurrences) between common ends, ``suffix`` after the
    last one.  Without a common end all tokens are ``prefix`` and ``closed`` is false."""
    prefix: Run
    closed: bool = False
    groups: list[str] = field(default_factory=list)
    links: dict[tuple[int, int], int] = field(default_factory=dict)
    suffix: Run = field(default_factory=Run)

    def __add__(self, other: Fragment) -> Fragment:
        if not self.closed:
            return Fragment(self.prefix + other.prefix, other.closed, other.groups, other.links, other.suffix)
        if not other.closed:
            return Fragment(self.prefix, True, self.groups, self.links, self.suffix + other.prefix)
        seam, links = close(self.suffix + other.prefix)
        return Fragment(self.prefix, True, self.groups + seam + other.groups,
                        added(self.links, links, other.links), other.suffix)


def added(*counts: dict) -> dict:
    out = dict(counts[0])
    for more in counts[1:]:
        for k, v in more.items():
            out[k] = out.get(k, 0) + v
    return out


def close(run: Run) -> tuple[list[str], dict[tuple[int, int], int]]:
    """Groups and links of tokens that begin and end at common ends."""
    groups, links = [], {}
    i = j = first_i = first_j = 0
    a, b, a_end, b_end = run.a, run.b, run.a_end, run.b_end
    while i < len(a) and j < len(b):
        link = a[i], b[j]
        links[link] = links.get(link, 0) + 1
        x, y = a_end[i], b_end[j]
        if x <= y:
            i += 1
        if y <= x:
            j += 1
        if x == y:
            groups.append(f"{','.join(map(str, a[first_i:i]))}|{','.join(map(str, b[first_j:j]))}")
            first_i, first_j = i, j
    return groups, links


def fragment(run: Run) -> Fragment:
    """The fragment of the tokens that end in one byte range."""
    common = sorted(set(run.a_end).intersection(run.b_end))
    if not common:
        return Fragment(run)

    def part(after: float, upto: float) -> Run:
        def of(ids: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
            lo, hi = np.searchsorted(ends, [after, upto], side="right") if ends else (0, 0)
            return ids[lo:hi], ends[lo:hi]
        return Run(*of(run.a, run.a_end), *of(run.b, run.b_end))
    groups, links = close(part(common[0], common[-1]))
    return Fragment(part(-1, common[0]), True, groups, links, part(common[-1], math.inf))


# -- two tokenizers ------------------------------------------------------------------
class TwoTokenizers:
    """Both models and their token bytes, with a bounded cache of aligned words."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark uses the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte for c in token)
            self.a_bytes[i] = bytes(byte[c] for c in token) if known else token.encode()
        self.size_b = self.b.get_piece_size()
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()
                        for i in range(self.size_b) for piece in [self.b.id_to_piece(i)]]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        self.marks = [f"{i}{mark}" for side, end in ((self.a_bytes, "|"), (self.b_bytes, ";")) for i in range(len(side))
                      for mark in (",", end)]
        self.mark_sizes = np.array([len(x) for x in self.marks], dtype=np.int64)
        self.pair_type = np.dtype("<u4" if len(self.a_bytes) * self.size_b < 1 << 32 else "<u8")
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.odd: set[int] = set()  # words whose token bytes are not the word's
        self.counts = np.zeros((1024, 5), dtype=np.int64)  # n_a, n_b, n_groups, n_links, first link
        self.pairs = np.zeros(4096, dtype=np.int64)
        self.n_pairs = 0

    def runs(self, words: list[str]) -> list[Run]:
        """The tokens of a space and each text."""
        out = []
        encoded = self.a.encode_batch([" " + w for w in words], add_special_tokens=False)
        for a, b in zip((e.ids for e in encoded), self.b.encode(words, num_threads=1)):
            out.append(Run(a, np.cumsum([len(self.a_bytes[i]) for i in a], dtype=np.int64).tolist(),
                           b, np.cumsum([len(self.b_bytes[i]) for i in b], dtype=np.int64).tolist()))
        return out

    def whole(self, text: str, run: Run) -> bool:
        """Whether both token sequences give back a space and the text."""
        body = b" " + text.encode()
        return (b"".join(map(self.a_bytes.__getitem__, run.a)) == body
                and b"".join(map(self.b_bytes.__getitem__, run.b)) == body)

    def _learn(self, words: list[str]) -> None:
        """Adds the rows of words that neither begin nor end with white space; a run of them is
        encoded as one text, whose cuts at the spaces hold."""
        for start in range(0, len(words), LEARNT):
            some = words[start:start + LEARNT]
            if not self._learn_run(some):
                if len(some) == 1:
                    self._add(some, np.zeros((1, 4), dtype=np.int64), np.zeros(0, dtype=np.int64), [""], odd=True)
                else:  # an odd word among them
                    half = len(some) // 2
                    self._learn(some[:half])
                    self._learn(some[half:])

    def _learn_run(self, words: list[str]) -> bool:
        text = " ".join(words)
        a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, dtype=np.int64)
        b = np.array(self.b.encode(text, num_threads=1), dtype=np.int64)
        if not self.whole(text, Run(a.tolist(), [], b.tolist(), [])):
            return False
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        edges = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words)))
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        per_word = [np.diff(np.searchsorted(ends, edges, side="right"), prepend=0) for ends in (a_end, b_end, common)]
        first = np.searchsorted(b_end, a_end - self.a_sizes[a], side="right")
        n = np.searchsorted(b_end - self.b_sizes[b], a_end, side="left") - first  # B tokens that an A token overlaps
        links = np.concatenate([[0], np.cumsum(n)])
        pairs = np.repeat(a, n) * self.size_b + b[np.repeat(first - links[:-1], n) + np.arange(links[-1])]
        per_word.append(np.diff(links[np.cumsum(per_word[0])], prepend=0))
        self._add(words, np.column_stack(per_word), pairs, self._strings(a, a_end, b, b_end, common, edges))
        return True

    def _strings(self, a, a_end, b, b_end, common, edges) -> list[str]:
        """The groups of each word: ids with the mark that follows them (comma; bar or semicolon
        after the last of a side) in the order of the groups, cut at the words' ends."""
        of_a, of_b = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        last_a, last_b = (np.append(np.diff(g) > 0, True) for g in (of_a, of_b))
        code = np.empty(len(a) + len(b), dtype=np.int64)
        code[np.arange(len(a)) + np.searchsorted(of_b, of_a, side="left")] = 2 * a + last_a
        in_b = np.arange(len(b)) + np.searchsorted(of_a, of_b, side="right")
        code[in_b] = 2 * (len(self.a_bytes) + b) + last_b
        ends = np.searchsorted(of_b, np.searchsorted(common, edges), side="right") - 1  # each word's last B token
        upto = np.cumsum(self.mark_sizes[code])[in_b[ends]].tolist()
        whole = "".join(map(self.marks.__getitem__, code.tolist()))
        return [whole[lo:hi - 1] for lo, hi in zip([0, *upto], upto)]

    def _add(self, words: list[str], counts: np.ndarray, pairs: np.ndarray, strings: list[str], odd: bool = False) -> None:
        at = len(self.groups)
        while at + len(words) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        while self.n_pairs + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        rows = self.counts[at:at + len(words)]
        rows[:, :4] = counts
        rows[:, 4] = self.n_pairs + np.cumsum(counts[:, 3]) - counts[:, 3]
        self.pairs[self.n_pairs:self.n_pairs + len(pairs)] = pairs
        self.n_pairs += len(pairs)
        self.groups += strings
        self.place.update(zip(words, range(at, at + len(words))))
        if odd:
            self.odd.update(range(at, at + len(words)))

    def _learn_apart(self, word: str) -> None:
        """Adds the row of a word that begins or ends with white space."""
        run = self.runs([word])[0]
        groups, links = close(run) if self.whole(word, run) else ([], {})
        pairs = np.array([a * self.size_b + b for (a, b), n in links.items() for _ in range(n)], dtype=np.int64)
        self._add([word], np.array([[len(run.a), len(run.b), len(groups), len(pairs)]]), pairs, [";".join(groups)],
                  odd=not groups)

    def places(self, texts: list[str]) -> list[list[int]]:
        """The cache rows of each text's words; words that are missing are encoded together."""
        if len(self.groups) > CACHED_WORDS or self.n_pairs > 16 * CACHED_WORDS:
            self.clear()
        words = [t.split(" ") for t in texts]
        found = [list(map(self.place.get, w)) for w in words]
        # all words of a text are cached: none touches white space, so all cuts hold
        lacking = [k for k, f in enumerate(found) if None in f]
        missing: set[str] = set()
        for k in lacking:
            if TOUCHING.search(texts[k]):
                words[k] = joined(words[k])
            missing.update(words[k])
        missing -= self.place.keys()
        apart = {w for w in missing if not w or w[0].isspace() or w[-1].isspace()}
        self._learn([*(missing - apart)])
        for w in apart:
            self._learn_apart(w)
        for k in lacking:
            found[k] = list(map(self.place.__getitem__, words[k]))
        for w in missing:
            if w in apart or len(w) > CACHED_CHARS:
                del self.place[w]  # its row goes with the next clear
        return found


def joined(words: list[str]) -> list[str]:
    """The words of a split at single spaces, put together again where white space touches a cut."""
    out, open_end = [], False
    for k, w in enumerate(words):
        if k and (open_end or not w or w[0].isspace()):
            out[-1] = f"{out[-1]} {w}"
        else:
            out.append(w)
        open_end = not w or w[-1].isspace()
    return out


_LOADED: dict[tuple[str, str], TwoTokenizers] = {}


def tokenizers(a_path: str, b_path: str) -> TwoTokenizers:
    """One pair a worker."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = TwoTokenizers(a_path, b_path)
    return _LOADED[a_path, b_path]


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- documents in blocks ----------------------------------------------------------------
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class Blocks:
    """Rows of documents and of the blocks they lie in: a document row has its distinct pairs with
    their occurrences, a block row (``is_block``) its distinct pairs with their documents."""

    def __init__(self, side: int, id_type: pa.DataType, pair_type: np.dtype):
        self.base = TaskContext.get().partitionId() << 33 | side << 32
        self.id_type, self.pair_type = id_type, pair_type
        self.n_blocks = self.size = 0
        self.seen: list[np.ndarray] = []

    def documents(self, ids: list, counts: np.ndarray, digests: list[str], pairs: list[np.ndarray],
                  times: list[np.ndarray], size: int) -> pa.RecordBatch:
        self.size += size
        self.seen += pairs
        return self._batch(ids, counts, digests, [p.astype(self.pair_type).tobytes() for p in pairs],
                           [t.astype("<u4").tobytes() for t in times], False)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.size or self.seen:
            pairs, docs = np.unique(np.concatenate(self.seen), return_counts=True) if self.seen else ([], [])
            yield self._batch([None], np.zeros((1, 4), dtype=np.int64), [None],
                              [np.asarray(pairs).astype(self.pair_type).tobytes()], [np.asarray(docs).astype("<u4").tobytes()], True)
            self.n_blocks, self.size, self.seen = self.n_blocks + 1, 0, []

    def _batch(self, ids, counts, digests, pairs, times, is_block) -> pa.RecordBatch:
        n = len(digests)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.base + self.n_blocks] * n, pa.int64()), pa.array(ids, self.id_type),
             *[pa.array(counts[:, c], pa.int64()) for c in range(4)], pa.array(digests, pa.string()),
             pa.array(pairs, pa.binary()), pa.array(times, pa.binary()), pa.array([is_block] * n)],
            names=["block", "doc_id", *_COUNTS, "groups_sha256", "pairs", "times", "is_block"])


def _encode(paths: tuple[str, str]):
    """Arrow batches of (doc_id, text) to block rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, blocks = tokenizers(*paths), None
        for batch in batches:
            blocks = blocks or Blocks(0, batch.schema.field(0).type, model.pair_type)
            ids, texts, start = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and size <= STEP:
                    size += len(texts[end] or "")
                    end += 1
                yield blocks.documents(ids[start:end], *_aligned(model, [t or "" for t in texts[start:end]]), size)
                start = end
                if blocks.size > BLOCK:
                    yield from blocks.end()
        if blocks:
            yield from blocks.end()
    return run


def _aligned(model: TwoTokenizers, texts: list[str]):
    """Counts, digests, distinct pairs and their occurrences of each text."""
    found = model.places(texts)
    for k, text in enumerate(texts):
        if not text or model.odd and not model.odd.isdisjoint(found[k]):
            found[k] = []  # words are whole or not: joined bytes differ where a word's do
    sizes = np.array([len(f) for f in found])
    at = np.concatenate([np.asarray(f, dtype=np.int64) for f in found])
    of = np.repeat(np.arange(len(texts)), sizes)
    rows = model.counts[at]
    counts = np.zeros((len(texts), 4), dtype=np.int64)
    np.add.at(counts, of, rows[:, :4])
    n = rows[:, 3]
    link = np.repeat(rows[:, 4] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    span = len(model.a_bytes) * model.size_b
    packed, times = np.unique(np.repeat(of, n) * span + model.pairs[link], return_counts=True)
    edges = np.searchsorted(packed, np.arange(len(texts) + 1) * span)
    packed %= span
    cut_up = lambda x: [x[lo:hi] for lo, hi in zip(edges, edges[1:])]
    group = model.groups.__getitem__
    digests = [hashlib.sha256(";".join(map(group, f)).encode()).hexdigest() if f else "" for f in found]
    return counts, digests, cut_up(packed), cut_up(times)


# -- long documents -------------------------------------------------------------------------
def pieces(text: str, size: int) -> Iterator[str]:
    """Cuts a text at single spaces, which are left out, once a piece has ``size`` code points."""
    start, look = 0, size
    while (at := text.find(" ", look)) >= 0:
        if at > start and at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
            yield text[start:at]
            start, look = at + 1, at + 1 + size
        else:
            look = at + 1
    yield text[start:]


_RUN = "struct<a:array<int>,a_end:array<bigint>,b:array<int>,b_end:array<bigint>>"
_FRAGMENT = (f"prefix {_RUN}, closed boolean, groups string, n_groups long, pairs array<bigint>, times array<bigint>, "
             f"suffix {_RUN}, n_a long, n_b long, whole boolean, size long")


def _row(f: Fragment, span: int) -> dict:
    as_dict = lambda r: {"a": r.a, "a_end": r.a_end, "b": r.b, "b_end": r.b_end}
    return {"prefix": as_dict(f.prefix), "closed": f.closed, "groups": ";".join(f.groups), "n_groups": len(f.groups),
            "pairs": [a * span + b for a, b in f.links], "times": list(f.links.values()), "suffix": as_dict(f.suffix)}


def _of(row: dict, span: int) -> Fragment:
    return Fragment(Run(**row["prefix"]), row["closed"], row["groups"].split(";") if row["n_groups"] else [],
                    {divmod(p, span): n for p, n in zip(row["pairs"], row["times"])}, Run(**row["suffix"]))


def _batches(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def long_fragments(docs: DataFrame, paths: tuple[str, str], piece_chars: int) -> DataFrame:
    """One fragment for every row of ``docs`` (doc_id, text), reduced in a tree from its pieces."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, base = 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                offset = 0
                for part, piece in enumerate(pieces(text.as_py(), piece_chars)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([base + n]), pa.array([doc_id.as_py()], batch.schema.field(0).type), pa.array([part], pa.int64()),
                         pa.array([offset], pa.int64()), pa.array([piece])], names=["row", "doc_id", "part", "start", "piece"])
                    offset += len(piece.encode()) + 1
                n += 1
    parts = cut(docs.mapInArrow(cut_up, f"row long, doc_id {id_type}, part long, start long, piece string"))
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        most = 0
    schema = f"row long, doc_id {id_type}, part long, {_FRAGMENT}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizers(*paths)
        for batch in batches:
            for r in batch.to_pylist():
                run = model.runs([r["piece"]])[0]
                run.a_end, run.b_end = ([r["start"] + e for e in ends] for ends in (run.a_end, run.b_end))
                yield _batches([{c: r[c] for c in ("row", "doc_id", "part")} | _row(fragment(run), model.size_b) | {
                    "n_a": len(run.a), "n_b": len(run.b), "whole": model.whole(r["piece"], run), "size": len(r["piece"])}], arrow)
    spread = parts.repartition(F.col("row"), F.col("part"))
    found = cut(spread.mapInArrow(encode, schema))

    def reduce(group: pa.Table) -> pa.Table:
        span = tokenizers(*paths).size_b
        rows = sorted(group.to_pylist(), key=lambda r: r["part"])
        whole = _of(rows[0], span)
        for r in rows[1:]:
            whole = whole + _of(r, span)
        out = {"row": rows[0]["row"], "doc_id": rows[0]["doc_id"], "part": rows[0]["part"] // FAN} | _row(whole, span)
        out |= {c: sum(r[c] for r in rows) for c in ("n_a", "n_b", "size")} | {"whole": all(r["whole"] for r in rows)}
        return pa.Table.from_batches([_batches([out], arrow)])
    while most:
        found = cut(found.groupBy("row", (F.col("part") / FAN).cast("long").alias("turn")).applyInArrow(reduce, schema))
        most //= FAN
    return found


def _finish(paths: tuple[str, str]):
    """Arrow batches of whole documents' fragments to block rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, blocks = tokenizers(*paths), None
        for batch in batches:
            blocks = blocks or Blocks(1, batch.schema.field("doc_id").type, model.pair_type)
            for r in batch.to_pylist():
                counts, digest = np.zeros((1, 4), dtype=np.int64), ""
                pairs = times = np.zeros(0, dtype=np.int64)
                if r["whole"]:
                    f = _of(r, model.size_b)
                    head, links = close(f.prefix)  # nothing is further left: the prefix is a group
                    f = Fragment(Run(), True, head + f.groups, added(f.links, links), f.suffix)
                    done = sorted((a * model.size_b + b, n) for (a, b), n in f.links.items())
                    pairs, times = (np.array(x, dtype=np.int64) for x in zip(*done))
                    counts[0] = r["n_a"], r["n_b"], len(f.groups), times.sum()
                    digest = hashlib.sha256(";".join(f.groups).encode()).hexdigest()
                yield blocks.documents([r["doc_id"]], counts, [digest], [pairs], [times], r["size"])
                if blocks.size > BLOCK:
                    yield from blocks.end()
        if blocks:
            yield from blocks.end()
    return run


# -- counts corpus-wide -----------------------------------------------------------------------
def _explode(span: int, pair_type: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, docs in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.divmod(np.frombuffer(pairs, pair_type).astype(np.int64), span)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), block)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                     pa.array(np.frombuffer(docs, "<u4").astype(np.int64))], names=["block", "a", "b", "n"])
    return run


def _score(span: int, pair_type: np.dtype):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        ids = known.column("a").to_numpy().astype(np.int64) * span + known.column("b").to_numpy()
        order = np.argsort(ids)
        ids, count = ids[order], known.column("count").to_numpy()[order]
        best = known.column("best").to_numpy()[order]
        n_best, count_sum = [], []
        for pairs, times in zip(docs.column("pairs"), docs.column("times")):
            at = np.searchsorted(ids, np.frombuffer(pairs.as_buffer(), pair_type).astype(np.int64))
            n = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
            n_best.append(int(n[best[at]].sum()))
            count_sum.append(int((n * count[at]).sum()))
        return (docs.drop_columns(["block", "pairs", "times"]).append_column("n_best", pa.array(n_best, pa.int64()))
                .append_column("count_sum", pa.array(count_sum, pa.int64())))
    return run


def align(docs: DataFrame, paths: tuple[str, str] | None = None, piece_chars: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum), one row for every
    row of ``docs`` (doc_id, text), and links (a, b, count, best): in how many documents ids a
    and b are linked, and whether no b has more for that a."""
    paths = paths or default_paths()
    model = tokenizers(*paths)
    span, pair_type = model.size_b, model.pair_type
    rows = pick(docs, "doc_id", "text")
    is_long = F.coalesce(F.length("text"), F.lit(0)) > piece_chars
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"block long, doc_id {id_type}, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, "
              "pairs binary, times binary, is_block boolean")
    short = rows.filter(~is_long).mapInArrow(_encode(paths), schema)
    long = long_fragments(rows.filter(is_long), paths, piece_chars).mapInArrow(_finish(paths), schema)
    blocks = cut(short.union(long))
    seen = blocks.filter("is_block").select("block", "pairs", "times").mapInArrow(
        _explode(span, pair_type), "block long, a int, b int, n long")
    links = seen.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # an A id has one row a B id at most: bounded by the vocabulary
    links = cut(links.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a"))))
    known = seen.select("block", "a", "b").join(links.select(*[F.col(c).alias(c) for c in links.columns]), ["a", "b"]).select(
        "block", "a", "b", "count", "best")
    out = ["doc_id", *_COUNTS, "groups_sha256"]
    found = blocks.filter("not is_block").select("block", *out, "pairs", "times").groupBy("block").cogroup(
        known.groupBy("block")).applyInArrow(
            _score(span, pair_type),
            f"doc_id {id_type}, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, n_best long, count_sum long")
    return found, links


@query("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"))[0].select(
        "doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")
