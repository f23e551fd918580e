"""Top-k search and SimHash against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash, topk


def brute_top_k(rows, k=20):
    usable = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in usable:
        if q % 20 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q))[:k]
            out |= {(q, n + 1, i, min(max(-s, 1 - 2**63), 2**63 - 1)) for n, (s, i) in enumerate(scored)}  # ends of the range of a long
    return out


def test_top_k(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(8)]) for i in range(400)]
    rows += [(400 + i, rows[40][1]) for i in range(60)]  # one very common vector
    rows += [(500, None), (501, [0.1, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [0.1] * 8), (504, [0.5, -0.5]), (505, []), (520, [3e38] * 8)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, components string").repartition(5)
    wanted = brute_top_k(rows)
    for block, shelf in ((32, 600), (1024, topk.SHELF_VALUES)):
        assert {tuple(x) for x in topk.search(df, block=block, shelf_values=shelf).collect()} == wanted


def test_top_k_of_large_components_and_repeated_ids(spark):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) * 10.0 ** r.choice([0, 0, 0, 3, 8, 9, 12, 17, 30]) for _ in range(r.choice([3, 3, 3, 0, 1, 7]))]) for i in range(150)]
    rows += [(100, [1e300] * 3), (7, [-1e307, 1e307, 0.5]), (7, [-1e307, 1e307, 0.5]), (9, [1.7e308]), (200, [2.0**35 / 64]), (201, [2.0**35 / 64]), (202, [2e10, 0.0]), (203, [1.0, 1.0])]
    rows += [(40, rows[40][1])] * 3 + [(300, [0.25] * 3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    # of rows that share an id the least vector is the query, all are candidates
    ints = [(i, [int(np.floor(64 * x)) if abs(64 * x) < 2**53 else int(64 * x) for x in v]) for i, v in rows if all(np.isfinite(64.0 * x) for x in v)]
    queries = {q: min(v for i, v in ints if i == q) for q, _ in ints if q % 20 == 0}
    wanted = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q)[:20]
        wanted += [(q, n + 1, i, min(max(-s, -(2**63) + 1), 2**63 - 1)) for n, (s, i) in enumerate(scored)]
    for block, shelf in ((16, 64), (1024, topk.SHELF_VALUES)):
        assert sorted(tuple(x) for x in topk.search(df, block=block, shelf_values=shelf).collect()) == sorted(wanted)


def test_products_are_exact_at_every_size():
    r = random.Random(7)
    for top in (2**10, 2**25, 2**29, 2**35, 2**61):
        a, b = ([[r.randint(-top, top) for _ in range(5)] for _ in range(6)] for _ in range(2))
        got = topk.exact_products(np.array(a), np.array(b))
        assert got.tolist() == [[sum(x * y for x, y in zip(v, w)) for w in b] for v in a]
    assert int(topk.exact_products(np.array([[2**35]]), np.array([[2**35]]))[0, 0]) == 2**70
    assert topk.clipped(np.array([[2**70, -(2**70), 5]], object)).tolist() == [[2**63 - 1, 1 - 2**63, 5]]
    assert topk.wide_key(-(2**80)) < topk.wide_key(-5) < topk.wide_key(2**63) < topk.wide_key(2**90)


def test_pruning_leaves_blocks_out(spark):
    # tight groups far from each other: all but a few blocks fall below the k-th score
    r = random.Random(1)
    rows = [(i, [(5.0 if d == i % 16 else 0.0) + r.random() / 10 for d in range(16)]) for i in range(640)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for shelf in (256, 1024, topk.SHELF_VALUES):
        assert {tuple(x) for x in topk.search(df, block=16, shelf_values=shelf).collect()} == brute_top_k(rows)
    # visits of one group: the k-th score rises on the way
    ints = np.array([[int(np.floor(64 * x)) for x in v] for _, v in sorted(rows, key=lambda x: x[0] % 16)])
    ids = np.array(sorted(range(640), key=lambda i: i % 16))
    blocks = [(ids[s : s + 16], ints[s : s + 16]) for s in range(0, 640, 16)]
    best = topk.Best(np.full(32, np.iinfo(np.int64).min), np.full(32, np.iinfo(np.int64).max), 20)
    scored = topk.visit(ints[::20], ids[::20], blocks, np.stack([m.max(axis=0) for _, m in blocks]), np.stack([m.min(axis=0) for _, m in blocks]), best)
    assert scored < 32 * 40 / 4


def test_top_k_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(x) for x in topk.search(df).collect()] == [(0, 1, 3, 64 * 128)]
    assert topk.search(df.limit(0)).count() == 0


def brute_fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))) if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    parent = {k: k for k in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def test_fingerprints(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in simhash.fingerprints(docs).collect():
        assert r["fingerprint"] % (1 << 64) == brute_fingerprint(texts[r["doc_id"]])


def test_near_duplicates(spark, docs, no_docs):
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [r.choices(words, k=80) for _ in range(15)]
    texts = {i: " ".join(b) for i, b in enumerate(base)}
    for i in range(15, 120):
        b = list(r.choice(base))
        for _ in range(r.randint(0, 2)):
            b[r.randrange(80)] = r.choice(words)
        texts[i] = " ".join(b)
    texts |= {200: "", 201: None, 202: "  "}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, vertex int")
    wanted = brute_components({i: brute_fingerprint(t) for i, t in texts.items()})
    got = simhash.near_duplicates(df).collect()
    assert {x["doc_id"]: x["component_id"] for x in got} == wanted and len(got) == len(texts)
    kept = {x["doc_id"] for x in simhash.first_of_each(df).collect()}
    assert kept == set(wanted.values())
    assert simhash.near_duplicates(docs).count() == docs.count()
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.first_of_each(no_docs).columns[0] == "doc_id"
    again = simhash.first_of_each(docs)
    assert set(again.columns) == set(docs.columns)


def test_large_nodes_are_split_without_loss(spark):
    r = random.Random(8)
    values = {r.getrandbits(64) for _ in range(40)}
    for b in list(values):
        for _ in range(30):
            v = b
            for _ in range(r.randint(0, 4)):
                v ^= 1 << r.randrange(64)
            values.add(v)
    values |= {r.getrandbits(18) for _ in range(300)}  # a crowd under one upper node
    values = sorted(values)
    wanted = brute_components(dict(enumerate(values)))
    df = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)], "vertex long, code long")
    for limit, n in ((20_000, len(values)), (60, len(values)), (20_000, 100_000_000), (20_000, 1)):
        found = {x["vertex"]: x["component"] for x in simhash.components(simhash.near_links(df, n, 3, limit)).collect()}
        assert {i: found.get(i, i) for i in range(len(values))} == wanted


def test_long_chains_become_one_component(spark):
    df = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    out = simhash.components(df).collect()
    assert len(out) == 299 and {x["component"] for x in out} == {0}


def test_linked_pairs_equal_brute_force():
    r = np.random.default_rng(2)
    codes, group = [], []
    for g, n in enumerate([1, 2, 3, 7, 8, 9, 64, 65, 1, 500]):
        some = np.unique(np.concatenate([r.integers(0, 1 << 12, n), r.integers(0, 1 << 62, n)]).astype(np.uint64))
        codes.append(r.permutation(some))
        group.append(np.full(len(some), (g * 7) % 5))
    codes, group = np.concatenate(codes), np.concatenate(group)
    run = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
    got = sorted(tuple(sorted(p)) for i, j in simhash.linked_pairs(group, codes, 3) for p in zip(i.tolist(), j.tolist()))
    wanted = [(i, j) for j in range(len(codes)) for i in range(j) if run[i] == run[j] and int(codes[i] ^ codes[j]).bit_count() <= 3]
    assert got == sorted(wanted)


def test_whole_groups_are_pruned():
    # 200 crowds of 20 codes each, far from each other
    r = np.random.default_rng(5)
    centres = r.integers(0, 1 << 63, 200).astype(np.uint64)
    codes = np.unique(np.concatenate([centres ^ (np.uint64(1) << np.uint64(b)) for b in r.integers(0, 64, 20)]))
    visited = []
    pairs = sum(len(i) for i, _ in simhash.linked_pairs(np.zeros(len(codes), np.int64), codes, 3, visited))
    all_pairs = len(codes) * (len(codes) - 1) // 2
    assert pairs > 0 and sum(visited) < all_pairs / 4


def test_hot_fingerprints_and_rows_without_an_id(spark):
    same = "one text that very many rows share, word for word"
    rows = [(i, same) for i in range(3, 300)] + [(None, same), (None, "only rows without an id have this text"), (None, "only rows without an id have this text"), (1, "alone"), (1, "alone"), (2, "another one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = simhash.near_duplicates(df).collect()
    of = {}
    for x in out:
        of.setdefault(x["fingerprint"], []).append((x["doc_id"], x["component_id"]))
    shared = of[f"{brute_fingerprint(same):016x}"]
    assert len(out) == len(rows) and len(shared) == 298 and {c for _, c in shared} == {3}
    assert of[f"{brute_fingerprint(rows[-4][1]):016x}"] == [(None, None)] * 2
    assert of[f"{brute_fingerprint('alone'):016x}"] == [(1, 1)] * 2


def test_linked_pairs_leave_out_what_is_linked():
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 1 << 9, 400, np.uint64))
    group, known = np.zeros(len(codes), np.int64), (codes >> np.uint64(7)).astype(np.int64)
    pairs = [{tuple(sorted(p)) for i, j in simhash.linked_pairs(group, codes, 3, known=k) for p in zip(i.tolist(), j.tolist())} for k in (None, known)]
    assert pairs[1] == {(i, j) for i, j in pairs[0] if known[i] != known[j]} != pairs[0]
