"""Filter audit, tokenizer alignment and exact top-k against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from runvault.llm import alignment, filter_audit, topk
from runvault.llm.registry import QUERIES
from tests.conftest import SF_ORACLE

DOCS = "doc_id long, text string, lang string, DOC_ID string, Text string"
LABELS = "doc_id long, quality int, toxic int, part string"


# -- filter audit -------------------------------------------------------------------
def words_of(text):
    return text.encode().split()


def plain_audit(docs, labels):
    """The contract, document by document and filter by filter."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    out = {}
    for part in {lang or "" for _, _, lang in docs}:
        rows = []
        for d, text, lang in docs:
            if (lang or "") == part:
                t, w = text or "", words_of(text or "")
                rows.append((d, {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                                 "D": any(c in "#$%&*|" for c in t),
                                 "E": d is not None and d > first[t]}))
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[1][f] for r in rows) - len(gone),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in rows),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def audited(spark, docs, labels):
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], DOCS)
    got = filter_audit.audit(filter_audit.failure_cells(d, spark.createDataFrame([(*r, "z") for r in labels], LABELS)))
    return {(r.part, r.filter_order, r.step): list(r[3:]) for r in got.collect()}


def test_audit_equals_plain_walk(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)] + ["é" * 3, "BIG", "a#b", "x y", "z\x1fz"]
    docs = []
    for i in range(160):
        n = rng.choice([0, 3, 150, 199, 200, 201, 400])
        some = rng.choice([vocabulary, vocabulary[:60], vocabulary[:500]])
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(rng.choice(some) for _ in range(n)), rng.choice(["en", "de", "", None])))
    docs += [(200 + i, docs[i % 7][1], docs[i % 3][2]) for i in range(120)]  # copies, across parts
    docs += [(5, docs[5][1], "en"), (5, docs[5][1], "fr"), (7, "other text", "en")]  # repeated ids
    docs += [(None, docs[5][1], "en"), (None, None, None), (None, "only here", "de"), (900, None, None), (901, "", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 280, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    assert audited(spark, [], []) == {}
    assert len(audited(spark, [(1, "a", None)], [])) == 600


def test_long_text_is_taken_in_slices(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(5000)).encode()
    whole = filter_audit.text_mask(text)
    monkeypatch.setattr(filter_audit, "SLICE", 100)
    assert b"".join(filter_audit._slices(text)) == text
    assert filter_audit.text_mask(text) == whole


@given(st.lists(st.integers(0, 50), min_size=32, max_size=32))
@settings(max_examples=30, deadline=None)
def test_gray_code_states_are_subset_sums(counts):
    cells = np.array(counts, dtype=np.int64)[:, None]
    states = filter_audit.survivor_states(cells)
    for s in range(32):
        assert states[s, 0] == sum(n for mask, n in enumerate(counts) if not mask & s)


# -- alignment ----------------------------------------------------------------------------
def plain_alignment(docs):
    """Whole texts through both libraries, every pair of overlapping tokens, counts by document."""
    model = alignment.tokenizers(*alignment.default_paths())
    out, holds = [], Counter()
    for doc_id, text in docs:
        a = model.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.b.encode(text or "")
        body = b" " + (text or "").encode()
        if not text or b"".join(model.a_bytes[i] for i in a) != body or b"".join(model.b_bytes[i] for i in b) != body:
            out.append((doc_id, 0, 0, 0, [], ""))
            continue
        spans = []
        for ids, size in ((a, model.a_bytes), (b, model.b_bytes)):
            at, s = 0, []
            for i in ids:
                s.append((at, at + len(size[i]), i))
                at += len(size[i])
            spans.append(s)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = []
        for lo, hi in zip([0, *common], common):
            groups.append("|".join(",".join(str(i) for s, e, i in side if lo < e <= hi) for side in spans))
        links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        holds.update(set(links))
        out.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = defaultdict(int)
    for (a, _), n in holds.items():
        highest[a] = max(highest[a], n)
    return sorted(((d, na, nb, g, len(ls), sum(holds[x] == highest[x[0]] for x in ls), sum(holds[x] for x in ls), h)
                   for d, na, nb, g, ls, h in out), key=repr)


def aligned(spark, docs, **options):
    frame = spark.createDataFrame([(*r, None, "x", "y") for r in docs], DOCS)
    rows = alignment.align(frame, **options)[0].select("doc_id", *alignment._COUNTS, "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


ODD_TEXTS = [
    "plain words here", "plain words here", None, "", " ", "  two  leading and trailing  ", "a\nb\n\nc \n d\t e", "x y   z",
    "mark ▁ inside", "<|endoftext|> <s> </s> <unk> <0x41>", "don't can't I'll 1234567 12 3.14", "日本語のテキスト と 漢字", "é naïve ﬁ 😀👩‍👩‍👧",
    "nul \x00 and \x1f sep \x85 end", "word " * 50, "\n", "a" * 300, "aaaa bbbb " * 3 + "\r\n tail ", "tab\tends\t"]


def test_alignment_of_odd_texts(spark):
    docs = list(enumerate(ODD_TEXTS)) + [(None, "null id"), (3, "plain words here"), (3, "plain words here")]
    assert aligned(spark, docs) == plain_alignment(docs)


def test_pieces_are_reduced_to_whole_documents(spark):
    rng = random.Random(5)
    words = "the quick brown fox über naïve 12345 don't x y (well) #tag\n\nnew a  b".split(" ")
    long = [" ".join(rng.choice(words) for _ in range(n)) for n in (300, 1200, 40)] + ["z" * 400, "long ▁ " * 80, "  " + "pad " * 100]
    docs = [(i, t) for i, t in enumerate(long)] + [(0, long[0]), (9, "short one")]
    assert aligned(spark, docs, piece_chars=60) == plain_alignment(docs)


def test_alignment_of_empty_table(spark):
    assert aligned(spark, []) == []


def test_blocks_and_cache_hold_the_whole_table(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(ODD_TEXTS[:6:5]) or "" for _ in range(rng.randrange(9))) + f" n{i}") for i in range(300)]
    monkeypatch.setattr(alignment, "BLOCK", 500)
    monkeypatch.setattr(alignment, "STEP", 200)
    assert aligned(spark, docs) == plain_alignment(docs)


def runs():
    ends = st.lists(st.integers(1, 40), min_size=1, max_size=25, unique=True).map(sorted)
    return st.tuples(ends, ends, st.lists(st.integers(0, 41), max_size=4))


@given(runs())
@settings(max_examples=200, deadline=None)
def test_fragments_are_a_monoid(case):
    a_end, b_end, borders = case
    total = max(a_end[-1], b_end[-1])
    a_end, b_end = sorted({*a_end, total}), sorted({*b_end, total})
    whole = alignment.Run([*range(len(a_end))], a_end, [*range(100, 100 + len(b_end))], b_end)
    edges = [0, *sorted(borders), total]
    parts = []
    for lo, hi in zip(edges, edges[1:]):
        ia = [i for i, e in enumerate(a_end) if lo < e <= hi]
        ib = [i for i, e in enumerate(b_end) if lo < e <= hi]
        parts.append(alignment.fragment(alignment.Run(ia, [a_end[i] for i in ia], [100 + i for i in ib], [b_end[i] for i in ib])))
    left = parts[0]
    for p in parts[1:]:
        left = left + p
    right = parts[-1]
    for p in reversed(parts[:-1]):
        right = p + right
    assert left == right == alignment.fragment(whole)


def test_alignment_query_equals_plain_libraries(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_alignment(docs)


# -- exact top-k ----------------------------------------------------------------------------
def plain_topk(rows, k=5):
    out = []
    usable = [(i, v, [int(np.floor(256 * float(x))) for x in e]) for i, (v, e) in enumerate(rows)
              if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    for i, v, q in usable:
        if v is not None and v % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), w is None, w or 0) for j, w, c in usable if i != j and len(c) == len(q))
            out += [(v, r, None if none else w, -s) for r, (s, none, w) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, Vec_ID int, label string")
    return sorted((tuple(r) for r in topk.top_k(frame, **options).collect()), key=repr)


def as_floats(rows):
    return [(v, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for v, e in rows]


def test_topk_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SLICE", 32)
    monkeypatch.setattr(topk, "TURN", 4)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=20).tolist()) for i in range(180)]
    rows += [(1000 + i, rows[i][1]) for i in range(90)]  # copies: ties
    rows += [(50, rows[50][1]), (100, [0.0] * 20), (150, [0.0] * 20), (None, rows[0][1]), (None, rows[0][1])]
    rows += [(200, None), (250, [1.0, None]), (300, [float("nan")] * 20), (350, [float("inf")] + [0.0] * 19)]
    rows += [(400, [0.5, -0.25, 0.125]), (401, [1.0, 1.0, 1.0]), (450, []), (500, [3.0])]
    rows = as_floats(rows)
    assert searched(spark, rows) == plain_topk(rows)


def test_topk_of_equal_vectors_and_empty_table(spark):
    rows = as_floats([(i, [0.25, -0.5, 0.75]) for i in range(120)])
    assert searched(spark, rows) == plain_topk(rows)
    assert searched(spark, []) == []
    assert searched(spark, rows[:1]) == []


def test_topk_refuses_scores_beyond_a_long(spark):
    with pytest.raises(Exception, match="could leave a long"):
        searched(spark, [(0, [3e30, 1.0]), (1, [1.0, 1.0])])


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    base = np.repeat(rng.normal(size=(40, 8)), 8, axis=1)  # slow signals, where segment means tell much
    rows = np.floor(256 * (base[rng.integers(0, 40, 4000)] + 0.05 * rng.normal(size=(4000, 64)))).astype(np.int64)
    exact = rows[:50] @ rows.T
    for segments in topk.LEVELS:
        bound = topk.segment_features(rows[:50], segments) @ topk.segment_features(rows, segments).T
        assert (bound >= exact - 1e-3).all()
    numbers = np.arange(len(rows))
    q, r, score, left = topk.best_in_slice(rows[:50], numbers[:50], rows, numbers, 5)
    for i in range(50):
        scores = np.delete(exact[i], i)
        assert sorted(score[q == i])[::-1][:5] == sorted(scores)[::-1][:5]
    assert left[0] >= left[1] >= left[2] and left[2] < 0.2 * 50 * len(rows)


def test_topk_query_has_five_ranks(spark):
    rows = QUERIES["op13_exact_topk"](spark, SF_ORACLE).collect()
    assert Counter(Counter(r.query_id for r in rows).values()) == {5: 10}
