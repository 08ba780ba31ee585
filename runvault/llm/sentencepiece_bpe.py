"""SentencePiece BPE encoding and decoding with a prefix table.

For every prefix of a text the BPE encoding of that prefix ends in exactly one
token.  The table of these last tokens is filled from left to right: an
automaton names the vocabulary pieces that end at a place, and a piece is the
last token there when BPE would keep it apart from the last token of the
prefix before it (pair compatibility).  The ids are then read backwards.  The
time is linear in the text, also without any spaces.

Texts are cut where no piece can cross: before a run of word-start marks,
around line feeds, and between a letter and a punctuation mark that follows it
in no piece.  The cuts change no id; they let equal words share a cached
result.  Cache and pair table keep a bounded number of entries, so memory is
bounded whatever the text.

Null texts count as empty: no ids, empty decoded text.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from runvault.llm.common import pick
from runvault.llm.registry import query, table

MARK = "▁"
CACHED_WORDS, CACHED_PAIRS = 200_000, 500_000
SLICE = 2 << 20  # bytes of text
_NEVER = float("inf")


class PieceBpe:
    """Encoder and decoder for one model file (``identity`` normalisation, byte fallback)."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_of = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.silent = {i for i in range(size) if model.is_control(i)}
        self.unknown = model.unk_id()
        special = {*self.byte_of, *self.silent, self.unknown}
        if len(self.id_of_byte) != 256 or any(model.is_unused(i) for i in range(size)):
            raise ValueError("the model needs byte fallback and no unused pieces")
        # a merge is the earlier the higher the score of what it makes
        self.rank = {p: -model.get_score(i) for i, p in enumerate(self.pieces) if i not in special}
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in special}
        if any(MARK in p.lstrip(MARK) or (len(p) > 1 and "\n" in p) for p in self.rank):
            raise ValueError("a piece crosses a word start or a line feed")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        border: dict[str, set] = {c: set() for c in string.punctuation}
        for letter, c in re.findall(r"(?=([^\W\d_])([^\w\s]))", "\n".join(self.rank)):
            border.setdefault(c, set()).add(letter)
        free = "".join(re.escape(c) for c, x in border.items() if not x)
        ends = "|".join([f"(?=[{free}])"] * bool(free) + [
            f"(?={re.escape(c)})(?<![{''.join(sorted(x))}])" for c, x in border.items() if x])
        word = f"{MARK}*[^\\W\\d_]++(?:{ends})|"
        self.segments = re.compile(f"{word}\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
        self._steps: dict[int, tuple] = {}
        self._pairs: dict[int, bool] = {}
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._bytes = [b"" if i in self.silent else bytes([self.byte_of[i]]) if i in self.byte_of
                       else " ⁇ ".encode() if i == self.unknown else p.replace(MARK, " ").encode()
                       for i, p in enumerate(self.pieces)]
        self._table = np.array(self._bytes, dtype=object)
        self._is_silent = np.array([i in self.silent for i in range(size)])

    # -- pair compatibility -------------------------------------------------
    def _grow(self, i: int) -> tuple:
        """How BPE builds piece ``i`` from characters: merge ranks in time order, with the
        first and last symbol after each; and whether it ends as the piece itself."""
        if i in self._steps:
            return self._steps[i]
        symbols, steps = list(self.pieces[i]), []
        first, last = symbols[0], symbols[-1]
        while len(symbols) > 1:
            r, k = min((self.rank.get(symbols[k] + symbols[k + 1], _NEVER), k) for k in range(len(symbols) - 1))
            if r == _NEVER:
                break
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
            steps.append((r, symbols[0], symbols[-1]))
        self._steps[i] = (first, last, steps, len(symbols) == 1)
        return self._steps[i]

    def stands(self, i: int) -> bool:
        """Whether BPE encodes the text of piece ``i`` as that one piece."""
        return self._grow(i)[3]

    def keeps_apart(self, a: int, b: int) -> bool:
        """Whether BPE encodes the texts of ``a`` and ``b``, joined, as these two pieces.

        Replays both builds in the order of the merges; the pair fails if at
        some moment the merge across the border comes first (ties: leftmost).
        """
        _, x, left, ok = self._grow(a)
        y, _, right, ok2 = self._grow(b)
        if not (ok and ok2):
            return False
        i = j = 0
        across = self.rank.get(x + y, _NEVER)
        while True:
            ra = left[i][0] if i < len(left) else _NEVER
            rb = right[j][0] if j < len(right) else _NEVER
            if ra <= rb and ra <= across:
                if ra == _NEVER:
                    return True
                x, i = left[i][2], i + 1
            elif across <= rb:
                return False
            else:
                y, j = right[j][1], j + 1
            across = self.rank.get(x + y, _NEVER)

    # -- encoding -----------------------------------------------------------
    def prefix_table(self, segment: str) -> list[tuple[int, int]]:
        """For each place the last token's (id, length) of the prefix that ends there."""
        pairs, steps = self._pairs, self._steps
        if len(pairs) > CACHED_PAIRS:
            pairs.clear()
        table: list = [None] * len(segment)
        for end, (piece, length) in self.automaton.iter(segment):
            if table[end] is not None:
                continue
            start = end - length
            if start < 0:
                fits = (steps.get(piece) or self._grow(piece))[3]
            else:
                before = table[start]
                if before is None:  # a character without a piece: nothing merges with it
                    fits = (steps.get(piece) or self._grow(piece))[3]
                else:
                    pair = before[0] << 24 | piece
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.keeps_apart(before[0], piece)
            if fits:
                table[end] = (piece, length)
        return table

    def encode_segment(self, segment: str) -> list[int]:
        table, ids, at = self.prefix_table(segment), [], len(segment)
        while at:
            if (last := table[at - 1]) is None:
                at -= 1
                ids += [self.id_of_byte[b] for b in reversed(segment[at].encode())]
            else:
                ids.append(last[0])
                at -= last[1]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        words, out = self._words, []
        for segment in self.segments.findall(MARK + text.replace(" ", MARK)):
            ids = words.get(segment)
            if ids is None:
                ids = self._older.get(segment) or array("i", self.encode_segment(segment)).tobytes()
                if len(segment) <= 64:
                    if len(words) >= CACHED_WORDS:  # words not met since go
                        self._older, self._words = words, (words := {})
                    words[segment] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype=np.int32)

    # -- decoding -----------------------------------------------------------
    def decode(self, ids) -> str:
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return ""
        if self._is_silent[ids].any():
            return self._decode_slowly(ids.tolist())
        data = b"".join(self._table[ids].tolist())
        if self.pieces[ids[0]].startswith(MARK):
            data = data[1:]  # the mark that encoding puts before every text
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._decode_slowly(ids.tolist())

    def _decode_slowly(self, ids: list[int]) -> str:
        """With control ids, which say nothing, and with byte ids that form no character:
        each byte left over gives U+FFFD."""
        out, run, begun = [], b"", False

        def flush():
            nonlocal run
            while run:
                size = next((n for n in (1, 2, 3, 4) if _is_text(run[:n])), 0)
                out.append(run[:size].decode() if size else "\ufffd")
                run = run[size or 1:]
        for i in ids:
            if i in self.byte_of:
                run += bytes([self.byte_of[i]])
                begun = True
                continue
            flush()
            if i in self.silent:
                continue
            text = self._bytes[i].decode()
            out.append(text[1:] if not begun and self.pieces[i].startswith(MARK) else text)
            begun = True
        flush()
        return "".join(out)


def _is_text(data: bytes) -> bool:
    try:
        return bool(data.decode())
    except UnicodeDecodeError:
        return False


_LOADED: dict[str, PieceBpe] = {}


def tokenizer(model_path: str) -> PieceBpe:
    """One tokenizer per Python worker and model."""
    if model_path not in _LOADED:
        _LOADED[model_path] = PieceBpe(model_path)
    return _LOADED[model_path]


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_column(text: Column | str, model_path: str | None = None) -> Column:
    """ids (array<int>) of a text column; the model is read by each worker from ``model_path``
    (default: the installed public model)."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = tokenizer(model_path or default_model())
        for texts in batches:
            yield texts.map(model.encode, na_action=None)
    return encode(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def decode_column(ids: Column | str, model_path: str | None = None) -> Column:
    """The text of an ids column."""
    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = tokenizer(model_path or default_model())
        for rows in batches:
            yield rows.map(model.decode)
    return decode(F.col(ids) if isinstance(ids, str) else ids)


def _code(model_path: str | None):
    """Arrow batches of (doc_id, text) to (doc_id, ids, decoded), a few texts at a time, so that
    a worker holds little beside its batch."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(model_path or default_model())
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            ends = np.searchsorted(sizes.cumsum(), np.arange(SLICE, sizes.sum() + SLICE, SLICE)) + 1
            start = 0
            for end in [*dict.fromkeys(np.minimum(ends, len(sizes)).tolist()), len(sizes)]:
                if end == start:
                    continue
                some = batch.slice(start, end - start)
                ids = [model.encode(t) for t in some.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                     pa.array([model.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])
                start = end
    return code


def encode_documents(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``docs`` (doc_id, text); rows are never merged."""
    rows = pick(docs, "doc_id", "text")
    out = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                        T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(_code(model_path), out)


def digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    rows = encode_documents(docs, model_path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_sentencepiece")
def op4_sentencepiece(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
