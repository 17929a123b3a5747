"""Operators 11 to 13 against brute force, with ties, nulls, repeats, hot groups, clashing columns and empty tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lociflow.llm import interval_join, prefix_trie, topk

SAID = "conv_id long, turn long, role string, text string, depth int, part int, keys string, family string"


def brute_trie(rows):
    """Nodes by explicit prefixes of rebuilt conversations."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append(((turn is not None, turn or 0), key, role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def total(p):
        leaves, saved = 0, (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for q in children.get(p, []):
            a, b = total(q)
            leaves, saved = leaves + a, saved + b
        return leaves or 1, saved

    out = []
    for p, cs in members.items():
        ends = sorted(c for c in cs if len(built[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children.get(p, [])), *total(p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def conversations(seed, n, hot):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(400), n):
        if rng.random() < hot:  # the same conversation again and again
            turns = [("user", "hello"), ("assistant", "good day"), ("user", "bye")]
        else:
            turns = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "é😀", "", None, "hello"])) for _ in range(rng.randrange(1, 9))]
        out += [(c, rng.choice([k, k, k, None]) if hot < 0.2 else k, r, t) for k, (r, t) in enumerate(turns)]
    out += out[:5]  # repeated turns
    return out + [(None, 1, "user", "no conversation"), (1000, 1, "user", "x" * 200_000)]


@pytest.mark.parametrize(("seed", "n", "hot", "parts"), [(1, 150, 0.0, "1"), (2, 200, 0.1, "7"), (3, 300, 0.7, "13"), (4, 380, 0.4, "61")])
def test_trie_is_that_of_all_prefixes(spark, seed, n, hot, parts):
    rows = conversations(seed, n, hot)
    df = spark.createDataFrame([(*r, 9, 9, "k", "f") for r in rows], SAID).repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # stacks cross real boundaries
    try:
        nodes = prefix_trie.conversation_trie(df)
        got = sorted((tuple(r) for r in prefix_trie.trie_digest(nodes).collect()), key=lambda r: (r[1], r[0]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_trie(rows)
    said = {(r.depth, r.conv_id): (r.last_role, r.last_text) for r in prefix_trie.with_last_turn(nodes, df).collect()}
    assert len(said) == len(got) and said[0, got[0][0]] == (None, None) and all(v[0] is not None for k, v in said.items() if k[0])


def test_trie_of_turnless_and_missing_heads(spark):
    # 7 has h = 4: with no conversation 0 and three turns of its own nothing is left of it
    short = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 >= 2][0]
    rows = [(short, 1, "user", "only turn")]
    got = prefix_trie.trie_digest(prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert [tuple(r) for r in got] == brute_trie(rows) and got[0].n_convs == 1 and got[0].n_leaves == 1
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SAID)).count() == 0


def brute_join(versions, asks):
    out = []
    for key, t in asks:
        able = [v for v in versions if None not in (key, t, v[0], v[1], v[2], v[3], v[4]) and v[0] == key and v[1] <= t and v[2] <= t < v[3]]
        best = max(able, key=lambda v: (v[1], v[2], v[4], v[5] is not None, v[5] or ""), default=None)
        out.append((key, t, *((best[1], best[2], best[4], best[5]) if best else ())))
    return out


@pytest.mark.parametrize(("pieces", "spread"), [(None, 3_000), (7, 3_000), (7, 10**9)])
def test_interval_join_enumerates_all(spark, monkeypatch, pieces, spread):
    if pieces:
        monkeypatch.setattr(interval_join, "PIECE_VERSIONS", pieces)
        monkeypatch.setattr(interval_join, "PIECE_ASKS", 5)
        monkeypatch.setattr(interval_join, "STEP", 16)
    rng = random.Random(spread + (pieces or 0))
    versions = []
    for k in range(600):
        event = rng.randrange(-spread, spread)
        length = rng.choice([0, 1, 5, 300, 5_000, spread])
        versions.append((rng.choice(["hot", "hot", "b", "c", None]), event, event + rng.randrange(-50, 200), event + length, rng.choice([k, k, 7, None]), rng.choice([None, "x", "y"])))
    versions += versions[:30] + [("b", None, 1, 5, 3, "x"), ("b", 1, None, 5, 3, "x"), ("b", 1, 1, None, 3, "x")]
    asks = [(rng.choice(["hot", "hot", "b", "c", "never", None]), rng.choice([rng.randrange(-spread, spread), None])) for _ in range(300)]
    asks += [(v[0], v[1]) for v in versions[:50]] + [(v[0], v[3]) for v in versions[:50]] + asks[:10]
    v = spark.createDataFrame([(*x, "n", 1) for x in versions], "key string, event long, arrival long, expiry long, rank long, lang string, cell string, level int")
    a = spark.createDataFrame([(*x, "n") for x in asks], "key string, t long, cell string")
    got = {tuple(r)[:2]: tuple(r)[2:] for r in interval_join.point_in_time(v, a, ["lang"]).collect()}
    want = {(x[0], x[1]): x[2:] for x in brute_join(versions, asks) if len(x) > 2}
    assert got == want and len(want) > 50


def test_tree_stabs_like_a_scan():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 256, 1000):
        start = rng.integers(0, 50, n)
        end = start + rng.integers(1, 40, n)
        times = rng.integers(-5, 100, 40)
        ask, found = interval_join.IntervalTree(start, end).stabbed(times)
        want = [(a, i) for a in range(40) for i in range(n) if start[i] <= times[a] < end[i]]
        assert sorted(zip(ask.tolist(), found.tolist(), strict=True)) == want and np.all(np.diff(ask) >= 0)


def test_feature_query_edge_cases(spark):
    docs = spark.createDataFrame([(k, f"t{k}", "en" if k % 2 else None, "hot" if k % 3 else None, k) for k in range(3000)] + [(None, "x", "en", "hot", 1), (5, "again", "de", "hot", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, 1, 0, "z") for k in range(0, 3000, 2)] + [(4, 1, 0, "z"), (None, 1, 1, "z"), (9_999, 0, 0, "z")], "doc_id long, quality int, toxic int, version_id string")
    got = sorted((tuple(r) for r in interval_join.feature_digest(docs, labels).collect()), key=str)
    number = lambda i, k: int(hashlib.sha256(str(i).encode()).hexdigest()[8 * k : 8 * k + 8], 16)
    source, versions = {}, []
    for r in docs.collect():
        if r.doc_id is not None:
            source[r.doc_id] = min(filter(None, (source.get(r.doc_id), r.source)), default=None)
            event = number(r.doc_id, 0) % 50_000
            versions.append((r.source, event, event - 60 + number(r.doc_id, 1) % 600, event + number(r.doc_id, 2) % 900, r.doc_id, (r.n_chars, r.lang)))
    want = []
    for r in labels.collect():
        t = None if r.doc_id is None else number(r.doc_id, 3) % 50_000
        key = source.get(r.doc_id)
        able = [v for v in versions if key is not None and v[0] == key and v[1] <= t and v[2] <= t < v[3]]
        best = max(able, key=lambda v: (v[1], v[2], v[4], v[5][0], v[5][1] or ""), default=None)
        age = t - best[1] if best else None
        fresh = best is not None and age <= 120
        want.append((r.doc_id, t, best and best[4], age, "none" if best is None else "fresh" if fresh else "stale", best[5][0] if fresh else None, best[5][1] if fresh else None))
    assert got == sorted(want, key=str) and {w[4] for w in want} == {"none", "stale", "fresh"}
    assert interval_join.feature_digest(docs.where("false"), labels).where("status = 'none'").count() == labels.count()
    assert interval_join.feature_digest(docs, labels.where("false")).count() == 0


def brute_top(rows, k, every):
    usable = [(i, [int(np.floor(float(x) * 1024)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q and len(w) == len(v))
        out += [(q, rank + 1, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard_rows", "block_queries", "kind"), [(10_000, 1000, "random"), (40, 3, "random"), (60, 4, "copies"), (60, 50, "clusters")])
def test_top_k_is_that_of_all_products(spark, monkeypatch, shard_rows, block_queries, kind):
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(400, 6))
    if kind == "copies":
        vectors[:200] = vectors[0]
        vectors[200:300] = np.round(vectors[200:300])
    if kind == "clusters":
        vectors += rng.normal(size=(5, 6))[rng.integers(0, 5, 400)] * 10
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [rows[20], rows[20], rows[0], (40, [1.0] * 6), (None, [1.0] * 6), (401, None), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (405, [1.0, 2.0]), (410, [3.0, 2.0]), (420, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, shard string, score int")
    vectors = df.select("vec_id", "shard", topk.quantized(df["embedding"]).alias("vector"))
    got = sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 10 = 0"), 5, shard_rows, block_queries).collect())
    assert got == brute_top(rows, 5, 10)


def test_top_k_with_huge_components_and_few_rows(spark):
    rows = [(0, [3e15, 1.0]), (1, [3e15, -2.0]), (2, [-3e15, 5.0]), (3, [1e300, 0.0]), (100, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clipped = [(i, [max(-(2**63), min(2**63 - 1, int(np.floor(x * 1024)))) / 1024 for x in v]) for i, v in rows if i != 3]
    got = sorted(tuple(r) for r in topk.embedding_top_k(df.where("vec_id <> 3")).collect())
    assert got == brute_top(clipped, 10, 100)
    assert topk.embedding_top_k(df).where("vec_id = 3").count() == 2  # saturates, but takes part
    assert topk.embedding_top_k(df.where("false")).count() == 0 and topk.embedding_top_k(df.where("vec_id = 0")).count() == 0


def test_best_first_leaves_nodes_out():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8)) * 4000
    vectors = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) * 100)
    tree = topk.KDTree(np.arange(4000), vectors, 64)
    leaves = sum(not below for _, _, below in tree.parts)
    read = []
    for q in vectors[:50]:
        bound = tree.bounds(q[None, :])[0]
        for node, (lo, hi, _) in enumerate(tree.parts):
            assert (tree.vectors[lo:hi] @ q).max() <= bound[node]
        found, n = topk.best_first(tree, q, bound.tolist(), -1, np.ones(4000, int), 10, None)
        read.append(n)
        scores = tree.vectors @ q
        assert [s for s, _ in found] == sorted(scores.astype(int).tolist(), reverse=True)[:10]
        again, fewer = topk.best_first(tree, q, bound.tolist(), -1, np.ones(4000, int), 10, found[-1])
        assert fewer <= n and again == [x for x in found if x > found[-1]]
    assert np.mean(read) < leaves / 4
