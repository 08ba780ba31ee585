"""Ordered diffs and as-of producer edges against plain versions."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st

from runvault.operators import ledger as lg
from runvault.operators import ordered_diff as od
from runvault.operators import ranges
from pyspark.sql import functions as F

IDS = st.lists(st.integers(0, 6), max_size=25)


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def valid(a, b, kept):
    assert all(a[i] == b[j] for i, j in kept)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(kept, kept[1:]))


@given(IDS, IDS)
@settings(max_examples=300, deadline=None)
def test_shortest_script_is_shortest(a, b):
    kept = od.shortest_script(a, b)
    valid(a, b, kept)
    assert len(kept) == longest_common(a, b)
    edits = len(a) + len(b) - 2 * len(kept)
    assert od.shortest_script(a, b, edits) == kept
    assert edits == 0 or od.shortest_script(a, b, edits - 1) is None


@given(IDS, IDS)
@settings(max_examples=300, deadline=None)
def test_kept_positions_are_a_script(a, b):
    for kept in (od.kept_positions(a, b), od.by_occurrence(a, b)):
        valid(a, b, kept)
        assert bool(kept) == bool(set(a) & set(b))


@given(st.lists(st.integers(0, 30), max_size=30))
@settings(max_examples=200, deadline=None)
def test_rising_chain_is_longest(values):
    chain = od.rising_chain(list(enumerate(values)))
    best = [0] * len(values)
    for i, x in enumerate(values):
        best[i] = 1 + max((best[j] for j in range(i) if values[j] < x), default=0)
    assert len(chain) == max(best, default=0)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(chain, chain[1:]))


TEXTS = "pair long, side string, text string"


def scripts(spark, rows, **options):
    got = {}
    for r in od.ordered_line_diff(spark.createDataFrame(rows, TEXTS), **options).collect():
        got.setdefault(r.pair, []).append((r.op, r.old_pos, r.new_pos, r.line))
    return got


def test_scripts_replay_to_the_current_text(spark, monkeypatch):
    rng = random.Random(7)
    rows, texts = [], {}
    for pair in range(60):
        old = [rng.choice(["a", "b", "c", "", "same", f"u{rng.randrange(40)}"]) for _ in range(rng.randrange(60))]
        new = [x for x in old if rng.random() < 0.8]
        for _ in range(rng.randrange(12)):
            new.insert(rng.randrange(len(new) + 1), rng.choice(["a", "", f"n{rng.randrange(9)}"]))
        if pair % 9 == 0:
            rng.shuffle(new)
        texts[pair] = "\n".join(old), "\n".join(new)
        rows += [(pair, "target", texts[pair][0]), (pair, "curr", texts[pair][1])]
    for pair, ops in scripts(spark, rows).items():
        old = [x[3] for x in sorted((x for x in ops if x[0] != "add"), key=lambda x: x[1])]
        new = [x[3] for x in sorted((x for x in ops if x[0] != "remove"), key=lambda x: x[2])]
        assert ("\n".join(old), "\n".join(new)) == texts[pair]
        kept = sorted(x[1:3] for x in ops if x[0] == "keep")
        assert all(p[1] < q[1] for p, q in zip(kept, kept[1:]))
        if pair % 9:  # few changes: near the longest common sequence
            assert len(kept) >= 0.9 * longest_common(*(t.split("\n") for t in texts[pair]))
    back = {r.pair: r for r in od.replay(od.ordered_line_diff(spark.createDataFrame(rows, TEXTS))).collect()}
    assert {p: (r.target_text, r.curr_text, r.in_order) for p, r in back.items()} == {p: (*t, True) for p, t in texts.items()}


def test_scripts_of_odd_pairs(spark):
    rows = [(1, "curr", "a\nb"), (2, "target", "x"), (3, "curr", None), (3, "target", None), (4, "curr", ""),
            (4, "target", ""), (5, "curr", None), (5, "target", "a"), (None, "curr", "n"), (None, "target", "n")]
    assert {p: sorted(ops, key=repr) for p, ops in scripts(spark, rows).items()} == {
        1: [("add", None, 0, "a"), ("add", None, 1, "b")], 2: [("remove", 0, None, "x")], 4: [("keep", 0, 0, "")],
        5: [("remove", 0, None, "a")], None: [("keep", 0, 0, "n")]}
    assert scripts(spark, []) == {}
    assert scripts(spark, rows[:1], drop_last=True) == {1: [("add", None, 0, "a")]}


def test_one_huge_pair_is_searched_gap_by_gap(spark):
    n = 30_000
    old = [f"line {i}" if i % 10 else "" for i in range(n)]
    new = [f"{x} changed" if i % 1000 == 7 else x for i, x in enumerate(old) if i % 500 != 3]
    rows = [(1, "target", "\n".join(old)), (1, "curr", "\n".join(new))]
    counts = dict(od.ordered_line_diff(spark.createDataFrame(rows, TEXTS)).groupBy("op").count().collect())
    assert counts == {"keep": n - 60 - 30, "remove": 90, "add": 30}


def test_gaps_beyond_the_edit_limit_stay_valid():
    a, b = [i % 2 for i in range(3000)], [(i // 3) % 2 for i in range(3500)]
    assert od.shortest_script(a, b) is None
    valid(a, b, od.kept_positions(a, b))


def test_cell_scripts(spark):
    rows = [(1, "curr", 0, "code", "a"), (1, "curr", 4, "code", "new"), (1, "curr", 5, "markdown", None), (1, "curr", 9, "code", "last"),
            (1, "target", 0, "code", "a"), (1, "target", 1, "markdown", None), (1, "target", 2, "code", "old last")]
    c = spark.createDataFrame(rows, "pair long, side string, pos int, cell_type string, source string")
    got = sorted((tuple(r)[1:] for r in od.ordered_cell_diff(c).collect()), key=lambda r: r[2])
    assert got == [("keep", 0, 0, "code", "a"), ("add", None, 1, "code", "new"), ("keep", 1, 2, "markdown", None)]


# ------------------------------------------------------------------ producers, range parts

RUNS = "run_id string, start_time timestamp, inputs map<string,string>, outputs map<string,string>"
T0 = datetime(2024, 1, 1)


def test_producer_is_the_last_writer_before_the_run(spark):
    rows = [("run-1", T0, {"i": "/u"}, {"o": "/u"}), ("run-9", T0 + timedelta(days=9), {}, {"o": "/u"}),
            ("run-5", T0 + timedelta(days=5), {"i": "/u", "j": None, "k": "/none"}, None)]
    got = {(e.consumer_run, e.input_name): e.producer_run for e in lg.dependencies(spark.createDataFrame(rows, RUNS)).collect()}
    assert got == {("run-1", "i"): None, ("run-5", "i"): "run-1", ("run-5", "j"): None, ("run-5", "k"): None}


def test_producers_equal_a_plain_search(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        url = lambda: rng.choice(["/hot", "/hot", f"/u{rng.randrange(12)}"])
        rows.append((f"run-{rng.randrange(10**6):07}", T0 + timedelta(hours=rng.randrange(200)),
                     {f"i{k}": url() for k in range(rng.randrange(3))}, {f"o{k}": url() for k in range(rng.randrange(3))}))
    rows += [(rows[0][0], T0 + timedelta(hours=500), {"again": "/hot"}, {"late": "/hot"})]  # a second record of a run
    begun = {}
    for r, t, _, _ in rows:
        begun[r] = min(t, begun.get(r, t))
    writes = [((begun[r], r), n, u) for r, _, _, outs in rows for n, u in outs.items()]
    want = set()
    for r, _, ins, _ in rows:
        for n, u in ins.items():
            before = [(at, name) for at, name, w in writes if w == u and at < (begun[r], r)]
            want.add((r, n, u, *((max(before)[0][1], max(before)[1]) if before else (None, None))))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keeps many parts: urls cross their borders
    try:
        got = {tuple(e) for e in lg.dependencies(spark.createDataFrame(rows, RUNS)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == want


def test_prefix_sums_run_over_all_parts(spark):
    df = spark.range(2000).withColumn("size", F.pmod(F.col("id") * 7919, F.lit(13)))
    rows = ranges.prefix_sum(df, [F.col("id")], F.col("size"), "start").orderBy("id").collect()
    total = 0
    for r in rows:
        assert r.start == total
        total += r.size
    assert len(rows) == 2000


@pytest.mark.parametrize("keys", [100, 0])
def test_only_urls_that_are_read_and_written_are_ordered(spark, monkeypatch, keys):
    placed, real = [], lg.range_parts
    monkeypatch.setattr(lg, "range_parts", lambda df, order: placed.append(df.count()) or real(df, order))
    monkeypatch.setattr(lg, "BROADCAST_KEYS", keys)
    runs = [("w", "2024-01-05", {}, {"main": "/w", "part": "/never-read"}),
            ("w", "2024-01-02", {}, {"again": "/w"}),  # the run began here
            ("r", "2024-01-03", {"a": "/w", "b": "/never-written", "n": None}, {"own": "/r"}),
            (None, "2024-01-04", {"a": "/w", "b": "/never-written", "n": None}, {"own": "/w"}),
            ("early", None, {"a": "/w"}, {})]
    df = spark.createDataFrame(runs, "run_id string, start_time string, inputs map<string,string>, outputs map<string,string>")
    got = sorted((tuple(e) for e in lg.dependencies(df).collect()), key=str)
    assert got == sorted([("r", "a", "/w", "w", "main"), ("r", "b", "/never-written", None, None), ("r", "n", None, None, None),
                          (None, "n", None, None, None), ("early", "a", "/w", None, None)], key=str)
    assert placed == [4 if keys else 7]  # /w: read twice, written twice
