"""Codec, SimHash, chunk fingerprints, sharding, LM scores and WARC against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from runvault.llm import cdc, ce_diff, sentencepiece_bpe as sp, sharding, simhash, warc
from runvault.session import scratch_dir
from tests.conftest import SF_SMALL

ODD = [(1, "alpha beta gamma delta epsilon"), (2, None), (3, ""), (4, "one"), (4, "one"), (None, "x y z w v"),
       (5, "Ünïcode 的 text\n\nwith  spaces "), (6, "long word " * 3000), (7, "a" * 20000)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "T", "s", 9) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, shard string, ids int")


def empty(df):
    return df.filter("1 = 0")


# -- SentencePiece --------------------------------------------------------------
def test_codec_equals_library():
    import sentencepiece
    model, own = sentencepiece.SentencePieceProcessor(model_file=sp.default_model()), sp.PieceBpe(sp.default_model())
    rnd = random.Random(3)
    letters = "aabeethinors  ▁\n\tÀéß😀的0123.,-='\x00AB"
    for _ in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        assert own.encode(text).tolist() == model.encode(text)
        assert own.decode(own.encode(text)) == model.decode(model.encode(text))
    for _ in range(4000):
        text = "".join(own.pieces[rnd.randrange(259, 32000)] for _ in range(rnd.randint(0, 8)))
        assert own.encode(text).tolist() == model.encode(text)
        ids = [rnd.randrange(0, 32000 if rnd.random() < 0.5 else 259) for _ in range(rnd.randint(0, 8))]
        assert own.decode(ids) == model.decode(ids)


def test_prefix_table_is_unique():
    """At every place exactly one piece passes the pair test."""
    own = sp.PieceBpe(sp.default_model())
    for word in ("▁thereandation", "▁internationalisation", "▁aaaaaaaa", "▁▁▁▁▁▁x"):
        table = own.prefix_table(word)
        for end in range(len(word)):
            fits = [p for e, (p, n) in own.automaton.iter(word) if e == end
                    and (own.stands(p) if e - n < 0 else own.keeps_apart(table[e - n][0], p))]
            assert fits == [table[end][0]]


def test_codec_rows(spark, odd):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    got = sp.encode_documents(odd).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter(
        (i, tuple(model.encode(t or "")), model.decode(model.encode(t or ""))) for i, t in ODD)
    assert sp.digests(empty(odd)).collect() == []


# -- SimHash --------------------------------------------------------------------
def plain_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash_of_texts():
    for _, t in ODD:
        assert simhash.simhash(t) == plain_simhash(t)


def test_masks_cover_every_pair():
    masks = simhash.covering_masks(list(range(64)), 4)
    assert len(masks) == 31
    rnd = random.Random(1)
    for _ in range(3000):
        bits = rnd.sample(range(64), rnd.randint(1, 4))
        diff = sum(1 << b for b in bits)
        assert any(m & diff == 0 for m in masks)


@pytest.mark.parametrize("bucket", [512, 20])
def test_covering_links_connect_like_all_pairs(spark, bucket):
    """A dense cloud of near fingerprints, also with buckets so small that they are refined."""
    rnd = random.Random(5)
    fps = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))))
    fps |= {rnd.getrandbits(64) for _ in range(60)} | {0, 1, 2**63}
    signed = {f: simhash._signed(f) for f in fps}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = simhash.covering_links(df, 4, bucket)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    want = plain_components(fps, 4)
    classes = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    assert classes({s: got.get(s, s) for s in signed.values()}) == classes({signed[f]: signed[want[f]] for f in fps})


def test_refined_masks_keep_more_bits_and_cover():
    """Every refinement keeps more bits than its mask, and no near pair is missed, down to radius bits left."""
    rnd = random.Random(2)
    masks = simhash.covering_masks(list(range(64)), 4)
    for _ in range(5):
        finer = simhash._refined(masks, 4)
        for m, xs in finer.items():
            rest = [p for p in range(64) if not m >> p & 1]
            assert all(x & m == m and x != m for x in xs)
            for _ in range(20):
                diff = sum(1 << p for p in rnd.sample(rest, 4))
                assert any(x & diff == 0 for x in xs)
        masks = sorted({x for xs in finer.values() for x in xs if x.bit_count() < 60})
        masks = rnd.sample(masks, min(len(masks), 300))


@pytest.mark.parametrize("bucket", [64, 3])
def test_large_buckets_in_few_free_bits_end(spark, bucket):
    """Fingerprints that all agree on the 49 kept bits of a second-level mask, and one group far from them."""
    rnd = random.Random(6)
    first = simhash.covering_masks(list(range(64)), 4)[0]
    mask = next(m for m in simhash._refined([first], 4)[first] if m.bit_count() == 49)
    free, centre = [p for p in range(64) if not mask >> p & 1], rnd.getrandbits(64) & mask
    spread = lambda base, bits, k: {base ^ sum(1 << p for p in bits if rnd.random() < 0.5) for _ in range(k)}
    fps = spread(centre, free, 2500 if bucket > 3 else 60) | spread(centre ^ mask, free[:4], 60) | {centre ^ mask ^ 0x1F << 59}
    df = spark.createDataFrame([(simhash._signed(f),) for f in sorted(fps)], "fp long")
    assert all(m not in xs for m, xs in simhash._refined([mask], 4).items())  # else it would not end
    got = {r.node: r.root for r in simhash.components(simhash.covering_links(df, 4, bucket)).collect()}
    want = plain_components(fps, 4)
    classes = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    assert classes({simhash._signed(f): got.get(simhash._signed(f), simhash._signed(f)) for f in fps}) == classes(
        {simhash._signed(f): simhash._signed(want[f]) for f in fps})


def test_near_duplicates_rows(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ODD)
    assert {r.fp & (2**64 - 1) for r in got if r.doc_id in (2, 3)} == {0}
    assert {r.component_id for r in got if r.doc_id in (2, 3)} == {2}
    kept = simhash.one_of_each(odd).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == [1, 2, 4, 5, 6, 7] and len(kept) == 7
    assert simhash.near_duplicates(empty(odd)).collect() == []


def test_one_of_each_names_rows_by_what_they_hold(spark):
    """The choice does not hang on how the rows are spread; rows equal in doc_id and text leave one."""
    rows = [(i, f"text number {i // 3} of the same few words {i // 3}", i) for i in range(60)]
    rows += [(None, "no id here at all", 1), (None, "no id here at all", 2), (7, rows[7][1], 7), (0, rows[0][1], 99)]
    df = spark.createDataFrame(rows, "doc_id long, text string, DOC_ID long")
    spread = [sorted(str(r[0]) for r in simhash.one_of_each(df.repartition(n)).collect()) for n in (1, 5)]
    ids = simhash.near_duplicates(df).select("component_id").distinct().collect()
    assert spread[0] == spread[1] == sorted(str(r[0]) for r in ids)


def test_query_equals_all_pairs(spark):
    rows = simhash.op10_simhash(spark, SF_SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    fps = {i: plain_simhash(t) for i, t in docs.items()}
    roots = plain_components(set(fps.values()), 4)
    first = {}
    for i, f in fps.items():
        first[roots[f]] = min(i, first.get(roots[f], i))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{f:016x}", first[roots[f]]) for i, f in fps.items()}


# -- chunk fingerprints -----------------------------------------------------------
def test_chunks_join_and_resist_shifts():
    rnd = random.Random(2)
    text = " ".join("".join(rnd.choice("abcdeéü的") for _ in range(6)) for _ in range(4000))
    data = text.encode()
    ends = cdc.chunk_ends(data)
    pieces = [data[a:b].decode() for a, b in zip([0, *ends], ends)]
    assert "".join(pieces) == text and max(map(len, pieces)) <= cdc.MAX
    a, b = set(cdc.fingerprint(text).tolist()), set(cdc.fingerprint("xyz" + text).tolist())
    assert len(a & b) > 0.98 * len(a)


def test_gear_hash_is_the_rolled_sum():
    data = np.frombuffer(bytes(range(100)), dtype=np.uint8)
    h, want = cdc.gear_hashes(data), 0
    for i, x in enumerate(data):
        want = (want << 1) + int(cdc.GEAR[x]) & 0xFFFFFFFF
        assert int(h[i]) == want


@pytest.mark.parametrize("source", ["odd", "small"])
def test_edited_copies(spark, odd, source):
    docs = odd if source == "odd" else spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    tie = {r.text: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    want = Counter()
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        want[i, text, text[:len(text) - third] + following[:third], tuple(cdc.fingerprint(following).tolist())] += 1
    assert Counter((r.doc_id, r.text, r.edited, tuple(r.next_fp)) for r in cdc.edited_copies(docs).collect()) == want
    assert cdc.edited_copies(empty(docs)).collect() == []


def test_containment(spark):
    df = spark.createDataFrame([([2 << 16 | 10, 3 << 16 | 30], [3 << 16 | 30]), ([], []), ([], [5]), ([7], [])],
                               "a array<long>, b array<long>")
    assert [r[0] for r in df.select(cdc.containment(F.col("a"), F.col("b"))).collect()] == [0.75, 1.0, 0.0, 0.0]


# -- sharding -------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 3, 100, 1025])
def test_permutation(n):
    places = sharding.permute(np.arange(n), n, 9)
    assert sorted(places.tolist()) == list(range(n))
    assert sharding.permute(places, n, 9, back=True).tolist() == list(range(n))
    assert sharding.row_at(*sharding.place_of(n - 1, n, 7, 9), n, 7, 9) == n - 1


def test_shards(spark, odd):
    rows = sharding.shard_rows(odd, 4).collect()
    assert sorted(r.row for r in rows) == list(range(len(ODD)))
    per = Counter(r.shard for r in rows)
    assert max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(per[s]))
    assert all((r.shard, r.slot) == sharding.place_of(r.row, len(ODD), 4, 0) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ODD)
    assert sharding.shard_rows(empty(odd), 4).collect() == []


# -- LM scores ------------------------------------------------------------------
def test_losses_are_distributions():
    text = b"the cat sat on the mat " * 20
    grams, counts = np.unique(ce_diff.Tokens([text]).grams, return_counts=True)
    for thinned in (1.0, 0.3):
        table = ce_diff.Losses(grams.astype(np.int64), counts.astype(np.int64), thinned).table.reshape(-1, 256)
        assert np.allclose((2.0 ** -table[[0, 2570, (ord("t") << 8) | ord("h")]]).sum(axis=1), 1, atol=1e-4)


def words_of(text):
    """A word with the white space after it; the end of a text counts as a line feed."""
    return re.findall(rb"[^\t-\r ]*[\t-\r ]", text.encode() + b"\n") if text else []


def test_tokens():
    texts = [b"the cat  the", b"", b"\nthe cat", "Ünï 的".encode()]
    tokens = ce_diff.Tokens(texts)
    expected = [(d, w) for d, t in enumerate(texts) for w in words_of(t.decode())]
    assert list(tokens.doc) == [d for d, _ in expected]
    keys = dict(zip([w for _, w in expected], tokens.key))
    assert len(set(keys.values())) == len(keys) and [keys[w] for _, w in expected] == list(tokens.key)
    assert list(tokens.sums(np.ones(len(tokens.grams), dtype=np.int64))) == [len(w) for _, w in expected]


def plain_scores(docs, ids):
    """The same models from whole lists of words, one document after the other."""
    texts = [(i, t or "") for i, t in docs]
    counted = [(i in ids, words_of(t), b"\n\n" + t.encode() + b"\n") for i, t in texts]
    words, pairs, grams = (Counter(), Counter()), (Counter(), Counter()), (Counter(), Counter())
    for hit, found, raw in counted:
        for which in (0, 1) if hit else (1,):
            words[which].update(found)
            pairs[which].update(zip(found, found[1:]))
            if found:
                grams[which].update(raw[k:k + 3] for k in range(len(raw) - 2))
    share = sum(words[0].values()) / max(sum(words[1].values()), 1)
    gram_share = sum(grams[0].values()) / max(sum(grams[1].values()), 1)
    kinds = len(words[0]), sum(1 - (1 - share) ** c for c in words[1].values())
    total = sum(words[0].values()), share * sum(words[1].values())
    index = [np.array([int.from_bytes(g, "big") for g in sorted(grams[w])]) for w in (0, 1)]
    tables = [ce_diff.Losses(index[w], np.array([grams[w][g] for g in sorted(grams[w])]), s).table
              for w, s in ((0, 1.0), (1, gram_share))]
    out = []
    for (i, _), (hit, found, raw) in zip(texts, counted):
        loss, at, own, own_pairs = [0.0, 0.0], 0, Counter(found), Counter(zip(found, found[1:]))
        for k_word, word in enumerate(found):
            for w in (0, 1):
                spelled = sum(float(tables[w][int.from_bytes(raw[k:k + 3], "big")]) for k in range(at, at + len(word)))
                c = words[0][word] - own[word] * hit if w == 0 else share * (words[1][word] - own[word])
                n = total[w] - (len(found) * hit if w == 0 else share * len(found)) + kinds[w]
                bits = -np.log2((c + kinds[w] * 2.0 ** -spelled) / n) if c else spelled + np.log2(n / kinds[w])
                if k_word:
                    last = found[k_word - 1]
                    times = 1 if w == 0 else share
                    out_of = hit if w == 0 else 1
                    c2 = times * (pairs[w][last, word] - out_of * own_pairs[last, word])
                    c1 = times * (words[w][last] - out_of * own[last])
                    bits = (-np.log2((c2 + ce_diff.PRIOR * 2.0 ** -bits) / (c1 + ce_diff.PRIOR)) if c2
                            else bits + np.log2((c1 + ce_diff.PRIOR) / ce_diff.PRIOR))
                loss[w] += bits
            at += len(word)
        out.append((str(i), len(found), *[round(x / len(found), 4) if found else None for x in loss]))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 25, 200])
def test_scores_equal_plain_counts(spark, odd, monkeypatch, block):
    monkeypatch.setattr(ce_diff, "BLOCK", block)
    for ids in ({1}, {4, 6}, {1, 3, 5, 99}):
        rows = ce_diff.cross_entropy_difference(odd, spark.createDataFrame([(i,) for i in ids], "doc_id int")).collect()
        got = [(str(r.doc_id), r.n_tokens, *[None if x is None else round(x, 4) for x in (r.target_loss, r.background_loss)])
               for r in rows]
        for a, b in zip(sorted(got, key=str), plain_scores(ODD, ids), strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=2e-3)


def test_counted_words_grow_with_the_corpus(spark):
    def kinds(share):
        docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(f"doc_id % 4 < {share}")
        ids = docs.filter("doc_id % 8 = 0").select("doc_id")
        sums = ce_diff.train(*ce_diff.blocks(docs, ids))[1]
        return np.array([sums.filter(f"kind = {k}").groupBy().sum("n").first()[0] for k in (ce_diff.WORD, ce_diff.PAIR)])
    assert (kinds(4) > 1.5 * kinds(1)).all()


def test_packed_numbers():
    for values in ([], [0, 0], [1], [255, 256, 0], [2 ** 63, 5, 2 ** 40]):
        x = np.array(values, dtype=np.uint64)
        assert ce_diff.unpack(ce_diff.pack(x), len(x)).tolist() == values


def test_scores_tell_held_out_quality(spark):
    """Trained on the labels of even doc_ids, the score separates those of odd ones."""
    sf = SF_SMALL.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = ce_diff.cross_entropy_difference(docs, labels.filter("quality = 1 and doc_id % 2 = 0").select("doc_id"))
    held = got.join(labels.filter("doc_id % 2 = 1"), "doc_id").select("score", "quality").collect()
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    auc = np.mean([[(g < b) + (g == b) / 2 for b in bad] for g in good])
    assert auc > 0.9


def test_scores_of_odd_rows(spark, odd):
    ids = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    rows = ce_diff.cross_entropy_difference(odd, ids).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((i, len(words_of(t))) for i, t in ODD)
    assert all(r.score is None for r in rows if r.n_tokens == 0) and all(r.score is not None for r in rows if r.n_tokens)
    assert ce_diff.cross_entropy_difference(empty(odd), ids).collect() == []
    assert {r.score for r in ce_diff.cross_entropy_difference(odd, empty(ids)).collect()} == {None, 0.0}


# -- WARC -----------------------------------------------------------------------
def test_url_key():
    assert warc.url_key("https://a.Example.com/x?q=1#f") == "com,example,a)/x?q=1#f"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    pages = [(1, "http://a.com/1", "same"), (2, "http://a.com/2", "same"), (2, "http://a.com/2", "same"), (None, "http://b.org", "same"),
             (4, None, None), (5, "", ""), (6, "http://c.net/\r\n\r\nx", "über\r\n\r\n的" * 9000), (7, "http://c.net", "7")]
    pages += [(i, f"http://h{i % 3}.d.com/{i}", f"page {i}") for i in range(10, 60)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, offset string")
    folder = scratch_dir(spark, "warc-test")
    rows = warc.archive_and_read(spark, df, folder).collect()
    assert len(rows) == len(pages)
    got = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    for want, n in (((1, "response", None, 4), 1), ((2, "revisit", 1, 4), 2), ((None, "revisit", 1, 4), 1), ((4, "response", None, 0), 1),
                    ((5, "revisit", 4, 0), 1), ((7, "response", None, 1), 1)):
        assert got[want] == n
    payloads = {r.page_id: bytes(r.payload).decode() for r in rows if r.record_type == "response"}
    assert all(payloads[i] == (h or "") for i, _, h in pages if i in payloads)
    many = warc.with_roles(spark.createDataFrame([(1, "u", "p", "x")] * 9 + [(1, "v", "p", "x")], df.schema)).collect()
    assert sorted((r.revisit, r.refers_to, r.size) for r in many) == [(False, 1, 1)] + [(True, 1, 1)] * 9
    small = warc.archive_and_read(spark, df, scratch_dir(spark, "warc-test"), least=5).collect()
    assert [r for r in small if r.record_type == "revisit"] == []
    assert warc.archive_and_read(spark, empty(df), scratch_dir(spark, "warc-test")).collect() == []


def test_captures_of_a_url_across_blocks_and_files(spark, monkeypatch):
    from runvault.session import scratch_dir
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(i, f"http://h{i % 7}.org/p") for i in range(40)] + [(100 + i, "http://hot.org/") for i in range(60)]
    rows += [(300, None), (301, None)]
    captures = [(warc.url_key(u), p, n, "f", n, 1) for n, (p, u) in enumerate(rows)]
    folder, merge = scratch_dir(spark, "warc-test"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # so that there are several index files
    try:
        files = warc.build_index(spark.createDataFrame(captures, warc.CAPTURE).repartition(8), folder)
    finally:
        spark.conf.set(merge, "true")
    assert len(files) > 1
    wanted = ["http://HOT.org/", "http://h3.org/p", "http://h3.org/p", "http://no.org/", "http://zz.org/", None, ""]
    df = spark.createDataFrame([(1, u) for u in wanted], "URL long, url string")
    got = sorted((r.url or "", r.page_id) for r in warc.look_up_urls(df, folder, files).collect())
    hits = [(u or "", p) for u in wanted for p, v in rows if warc.url_key(u) == warc.url_key(v)]
    assert got == sorted(hits) and len(hits) == 60 + 2 * 6 + 2 * 2


def test_warc_query_sql_on_equal_payloads(spark, tmp_path):
    import duckdb
    rows = [(5, "u", "same"), (2, "v", "same"), (9, None, "same"), (1, "w", "other"), (3, "x", None), (4, "y", ""), (7, "z", "é" * 5000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = sorted(con.execute(warc.OP8_SQL).fetchall())
    assert sorted(map(tuple, warc.op8_warc(spark, str(tmp_path)).collect())) == want
    assert {r[0]: r[4] for r in want} == {5: 2, 2: None, 9: 2, 1: None, 3: None, 4: 3, 7: None}
