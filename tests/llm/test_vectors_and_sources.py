"""Vector codes, near-duplicate vectors and the divergence of sources against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import cap_filters, divergence, vector_codes

EXTRA = "code int, error string, label_error int, components string, key int, filters string, n_links string, item int, rank string, value int"
NONE = (None,) * len(EXTRA.split(","))


# -- vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6):
    usable = [(i, label, [int(np.floor(4096 * float(np.float32(x)))) if abs(x) < 2**40 else 4096 * int(np.float32(x)) for x in v]) for i, label, v in rows if v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    width = -(-max((len(v) for *_, v in usable), default=0) // parts)
    usable = [(i, label, v + [0] * (parts * width - len(v))) for i, label, v in usable]
    firsts = {}
    for i, _, v in usable:
        if i is not None:
            firsts[i] = min(firsts.get(i, v), v)
    start = [firsts[i] for i in sorted(firsts)[:entries]]
    cut = lambda v: [v[j * width : (j + 1) * width] for j in range(parts)]
    books = [[cut(v)[j] for v in start] for j in range(parts)]

    def nearest(q, book):
        return min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for j in range(parts):
            own = [[] for _ in books[j]]
            for *_, v in usable:
                own[nearest(cut(v)[j], books[j])[1]].append(cut(v)[j])
            books[j] = [[sum(x) // len(o) for x in zip(*o)] if o else e for o, e in zip(own, books[j])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, label, [nearest(q, b) for q, b in zip(cut(v), books)]) for i, label, v in usable]
    top = 2**63 - 1
    of = lambda near: min(sum(d for d, _ in near), top)
    by_label = Counter()
    for _, label, near in found:
        by_label[label] += of(near)
    return Counter((i, "".join(f"{k:02x}" for _, k in near), of(near), min(by_label[label], top), digest) for i, label, near in found)


def vector_rows(r, n, width=16, scale=0.3):
    return [(i, r.choice([None, 0, 1, 1, 1]), [r.gauss(0, scale) for _ in range(width)]) for i in range(n)]


def test_codes(spark):
    r = random.Random(11)
    rows = vector_rows(r, 300)
    rows += [(1000 + i, 2, rows[7][2]) for i in range(150)]  # one very common vector
    rows += [(600, 1, None), (601, 1, [0.1, None] + [0.0] * 14), (602, 1, [float("nan")] * 16), (603, 1, [float("inf")] * 16), (None, 1, [0.1] * 16), (604, 1, [0.5, -0.5]), (605, 1, []), rows[3], (3, 0, [-9.0] * 16)]
    df = spark.createDataFrame([(*x, *NONE) for x in rows], "vec_id long, label int, embedding array<float>, " + EXTRA).repartition(5)
    assert Counter(map(tuple, vector_codes.compress(df).collect())) == brute_codes(rows)


@pytest.mark.parametrize("rows", [[], [(5, 1, [0.5, 1.0])], [(5, 1, None)], [(i, 0, []) for i in range(3)], [(i, 0, [float(i % 2)] * 9) for i in range(40)]])
def test_codes_of_few_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert Counter(map(tuple, vector_codes.compress(df).collect())) == brute_codes(rows)


def test_codes_of_large_components(spark):
    r = random.Random(12)
    rows = [(i, 0, [r.gauss(0, 1) * 10.0 ** r.choice([0, 3, 9, 18, 30]) for _ in range(8)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    assert Counter(map(tuple, vector_codes.compress(df).collect())) == brute_codes(rows)


def test_cells_bound_and_filter():
    rng = np.random.default_rng(3)
    entries, parts = rng.integers(-900, 900, (16, 8)), rng.integers(-1000, 1000, (500, 8))
    cells = vector_codes.CellFile(entries)
    exact = ((parts[:, None] - entries) ** 2).sum(axis=2)
    lower, upper = cells.bounds(parts)
    assert (lower <= exact).all() and (exact <= upper).all()
    compared = []
    nearest, distance = cells.nearest(parts, compared)
    assert (nearest == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert sum(compared) < exact.size / 2
    wide = vector_codes.CellFile(entries.astype(object) * 10**30).nearest(parts.astype(object) * 10**30)
    assert (wide[0] == nearest).all() and (wide[1] == distance.astype(object) * 10**60).all()


# -- near-duplicate vectors


def brute_links(rows, threshold=0.93):
    """Counts of (vec_id, n_links, component_id, kept)."""
    width = max((len(v) for *_, v in rows if v), default=1)

    def unit(label, v):
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v + [0] * (width - len(v)), float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(label, v) for _, label, v in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][1] == rows[b][1] and units[a] @ units[b] >= threshold - 1e-12:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    names = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            names[find(k)] = min(names.get(find(k), i), i)
    return Counter((i, links[k], names.get(find(k)), i is not None and names.get(find(k)) == i) for k, (i, *_) in enumerate(rows))


def near_rows(r, n, width=16):
    rows = []
    for i in range(n):
        base = [r.gauss(0, 1) for _ in range(width)]
        rows.append((r.randrange(10**6), r.choice([None, 0, 1, 1]), base))
        for _ in range(r.choice([0, 0, 1, 3])):
            rows.append((r.randrange(10**6), rows[-1][1], [x + r.gauss(0, 1) * r.choice([0.01, 0.2, 0.3]) for x in base]))
    return rows


def linked(spark, rows, kind="float"):
    df = spark.createDataFrame([(*x, *NONE) for x in rows], f"vec_id long, label int, embedding array<{kind}>, " + EXTRA).repartition(5)
    return Counter(map(tuple, cap_filters.near_duplicates(df).collect()))


def test_near_vectors(spark):
    r = random.Random(13)
    rows = [(i, label, [float(np.float32(x)) for x in v]) for i, label, v in near_rows(r, 150)]
    rows += [(2 * 10**6 + i, 1, rows[5][2]) for i in range(80)]  # one very common vector
    core = [r.gauss(0, 1) for _ in range(16)]
    rows += [(3 * 10**6 + i, 0, [float(np.float32(x + r.gauss(0, 0.05))) for x in core]) for i in range(120)]  # a dense group of different vectors
    rows += [(1, 1, None), (2, 1, [0.0] * 16), (3, 1, [0.1, None]), (4, 1, [float("nan")] * 16), (5, 1, [float("inf")]), (6, 1, []), (7, None, rows[0][2]), (None, 1, rows[5][2]), (None, 0, [9.0, -9.0] * 8), (8, 1, [1.0, 0.5]), (9, 1, [2.0, 1.0, 0.0, 0.0]), rows[0]]
    assert linked(spark, rows) == brute_links(rows)


@pytest.mark.parametrize("cell, small", [(8, 48), (8, 2), (2048, 4)])
def test_near_vectors_in_cells(spark, monkeypatch, cell, small):
    """Hot filters split over cells give the same links."""
    monkeypatch.setattr(cap_filters, "CELL", cell)
    monkeypatch.setattr(cap_filters, "SMALL", small)
    r = random.Random(14)
    core = [r.gauss(0, 1) for _ in range(12)]
    rows = [(i, 0, [x + r.gauss(0, r.choice([0.05, 0.2])) for x in core]) for i in range(90)] + [(i + 200, 0, [r.gauss(0, 1) for _ in range(12)]) for i in range(30)]
    assert linked(spark, rows, "double") == brute_links(rows)


def test_near_vectors_of_any_size(spark):
    rows = [(1, 0, [1e300, 1e299]), (2, 0, [1e-300, 1.2e-301]), (3, 0, [-1e300, 0.0]), (4, 0, [5e-324]), (5, 0, [1.0]), (6, 0, [0.93, float(np.sqrt(1 - 0.93**2))]), (7, 1, [2.0])]
    assert linked(spark, rows, "double") == brute_links(rows)
    assert linked(spark, [], "double") == Counter()


def test_recall_at_the_threshold():
    """Of pairs at a cosine of exactly 0.93, other than those that set the margin, few are missed; of nearer ones none."""
    for dims, directions in ((64, 1 << 12), (64, 1 << 18), (24, 1 << 14)):
        code = cap_filters.make_code(dims, directions)
        rng = np.random.default_rng(99)
        assert cap_filters._meet(code, *cap_filters._pairs_at(0.93, dims, 4000, rng), code.margin) >= 3990
        assert cap_filters._meet(code, *cap_filters._pairs_at(0.96, dims, 4000, rng), code.margin) == 4000


# -- divergence of sources


def brute_audit(rows, min_docs=3, top=200):
    docs = [((text or ""), lang or "", source or "") for text, lang, source in rows]
    out = []
    for lang in {x for _, x, _ in docs}:
        own = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)), s) for t, x, s in docs if x == lang]
        holders = Counter(w for words, _ in own for w in set(words))
        kept = sorted(w for w in holders if holders[w] >= min_docs)
        counts = {s: Counter() for _, s in own}
        for words, s in own:
            counts[s].update(w for w in words if holders[w] >= min_docs)
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        p = {s: share(c) for s, c in counts.items()}
        q = share(sum(counts.values(), Counter()))
        far = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = [(-sum(far(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in counts if o != s]
            terms = [(-far(p[s][w], q[w]), w.encode(), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", w, -v, k + 1) for k, (v, _, w) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame([(*x, *NONE) for x in rows], "text string, lang string, source string, " + EXTRA).repartition(4)
    return sorted(map(tuple, divergence.audit(df, **options).collect()))


def source_rows(r, n):
    words = [f"{a}{b}" for a in ("ab", "Zé", "日", "Ünï", "x") for b in ("one", "TWO", "ß", "th-ree", "f4ur")]
    return [(" ".join(r.choice(words[: r.choice([5, 25])]) for _ in range(r.choice([0, 3, 40]))), r.choice(["en", "en", "de", None]), r.choice(["s1", "s2", "s3", "S1", None])) for _ in range(n)]


def test_divergence(spark):
    r = random.Random(15)
    rows = source_rows(r, 120) + [(None, "en", "empty"), ("", "xx", "alone"), ("the the the", "yy", "a"), ("other", "yy", "b"), (None, None, None)]
    rows += [(" ".join(["aBc dEf"] * 20000), "en", "s1")] * 3
    assert audited(spark, rows) == brute_audit(rows)
    assert audited(spark, rows, top_terms=2) == brute_audit(rows, top=2)
    assert audited(spark, []) == []


def test_divergence_in_squares_and_small_tables(spark, monkeypatch):
    """Squares of pairs, tables and held sums of any size give the same rows."""
    r = random.Random(16)
    rows = [(t, x, f"s{r.randrange(9)}") for t, x, _ in source_rows(r, 150)]
    wanted = brute_audit(rows)
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "VALUES", 40)
    monkeypatch.setattr(divergence, "SUMS", 30)
    monkeypatch.setattr(divergence, "TABLE_ENTRIES", 20)
    assert audited(spark, rows) == wanted


def test_shares_of_large_counts(spark):
    sizes = np.array([9 * 10**17 - 1, 5, 3])
    counts = np.array([8 * 10**17, 2, 0])
    assert divergence.shares(counts, sizes).tolist() == [1 + 10**9 * (int(c) + 1) // int(s) for c, s in zip(counts, sizes)]
    found = spark.createDataFrame(list(zip(counts.tolist(), sizes.tolist())), "c long, s long").select(divergence.share(F.col("c"), F.col("s")))
    assert [x[0] for x in found.collect()] == divergence.shares(counts, sizes).tolist()
