"""The pipeline's near-duplicate stage against brute force."""

import random
import time

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import near_copies


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    for i in texts:
        for j in texts:
            a, b = sets[i], sets[j]
            if j < i and 5 * len(a & b) >= 4 * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


def test_the_stage_drops_what_is_similar_by_five_words(spark, sf):
    r = random.Random(5)
    words = [f"w{i}" for i in range(900)]
    base = [r.choices(words, k=120) for _ in range(12)]
    texts = {i: " ".join(b) for i, b in enumerate(base)}
    for i in range(12, 150):  # similarities on both sides of 0.8
        b = list(r.choice(base))
        for _ in range(r.randint(1, 5)):
            b[r.randrange(120)] = r.choice(words)
        texts[i] = " ".join(b)
    texts |= {200: "", 201: None, 202: "one two", 203: "ONE  two", 204: "one two three"}
    wanted = set(brute_components(texts).values())
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_copies(spark, df.repartition(3), sf)
    assert out.columns == df.columns
    assert sorted(x["doc_id"] for x in out.collect()) == sorted(wanted)


def test_less_similar_candidates_are_not_linked():
    text = [f"w{i}" for i in range(44)]
    # 40 shingles; the last k words changed leave 40 - k of them
    for k, near in ((4, True), (5, False)):
        pair = [near_copies.shingle_set(" ".join(text)), near_copies.shingle_set(" ".join(text[:-k] + ["x"] * k))]
        assert (near_copies.similar_roots(pair).tolist() == [0, 0]) == near


def test_repeated_rows_and_rows_without_an_id(spark, docs, no_docs):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (5, long), (None, long), (7, long + " end"), (5, "another text of the same id here"), (None, "alone without an id at all"), (None, "alone without an id at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(map(str, (tuple(x) for x in near_copies.first_of_similar(df).collect())))
    assert out == sorted(map(str, [(5, long), (5, "another text of the same id here"), (None, "alone without an id at all")]))
    assert near_copies.first_of_similar(docs).columns == docs.columns and near_copies.first_of_similar(no_docs).count() == 0


def test_large_groups_of_several_clusters():
    """Half-and-half groups, whose sets all meet in one band, cost no square of their size."""
    rng = np.random.default_rng(3)
    bases = [rng.integers(0, 1 << 62, 60, np.uint64) for _ in range(3)]
    sets, wanted = [], []
    for i in range(9000):
        b = i % 3 if i > 2 else i
        own = np.concatenate([bases[b], rng.integers(0, 1 << 62, 3, np.uint64), bases[0][:1]])
        sets.append(np.unique(own))
        wanted.append(b)
    began = time.perf_counter()
    assert near_copies.similar_roots(sets).tolist() == wanted
    assert time.perf_counter() - began < 60


@pytest.mark.parametrize("n, sizes", [(300, (200, 22)), (30_000, (200, 22)), (30_000, (5, 1)), (3_000_000, (45, 5))])
def test_tables_find_pairs_at_the_threshold(n, sizes):
    """SimHash windows of texts at a similarity of 0.8 (or the nearest above) meet in a node within the radius."""
    tables = near_copies.Tables(n)
    rng = np.random.default_rng(7)
    size, apart = sizes  # sets of ``size``: as many shingles of each, ``apart`` of them not of the other (in small ones, one more)
    for _ in range(150):
        shared = rng.integers(0, 1 << 63, size - apart, np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, k, np.uint64)])) for k in ((apart, 0) if size == 5 else (apart // 2, apart - apart // 2)))
        assert len(np.intersect1d(a, b)) * 5 >= 4 * len(np.union1d(a, b))
        one, other = ({t: int(codes[0]) for t, _, codes in tables.windows([tables.fingerprint(x)])} for x in (a, b))
        assert any((x ^ y) >> (64 - tables.width) == 0 and (x ^ y).bit_count() <= tables.radius for x, y in ((one[t], other[t]) for t in one.keys() & other.keys()))


def test_candidates_come_from_the_fingerprints_index(spark):
    words = [f"w{i}" for i in range(60)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-2])), (3, " ".join(reversed(words)))], "doc_id long, text string")
    tables = near_copies.Tables(3)
    prints = near_copies._prints(near_copies._with_vertex(df), 5, tables)
    vertex = {bytes(r["vertex"]): r["id"] for r in prints.collect()}
    own = {r["doc_id"]: vertex[bytes(r["vertex"])] for r in df.select("doc_id", near_copies.text_digest("text").alias("vertex")).collect()}
    assert [tuple(r["members"]) for r in near_copies._groups(prints, tables).collect()] == [tuple(sorted((own[1], own[2])))]


def test_a_text_moves_as_often_in_tables_of_any_size():
    for n in (8_000, 200_000, 2_000_000, 16_000_000):
        tables = near_copies.Tables(n)
        assert tables.most <= 24 and tables.few <= 33


def test_texts_that_share_nothing_are_no_candidates(spark):
    """Their fingerprints agree here and there in the nodes of a table for many texts."""
    r = random.Random(8)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(30)) for _ in range(3000)]
    near = texts[0].rsplit(" ", 1)[0]
    df = spark.createDataFrame(list(enumerate([*texts, near])), "doc_id long, text string").repartition(2)
    tables = near_copies.Tables(11_000_000)
    groups = near_copies._groups(near_copies._prints(near_copies._with_vertex(df), 5, tables), tables).collect()
    assert [len(g["members"]) for g in groups] == [2]


def test_each_candidate_moves_once_and_large_groups_by_node(spark):
    r = random.Random(9)
    texts, start = [], [f"w{i}" for i in range(100)]
    for _ in range(8):  # chains: each is similar to the one before
        words = [f"{r.random()}{w}" for w in start]
        for k in range(8):
            words[11 * k : 11 * k + 3] = ["x", str(r.random()), "y"]
            texts.append(" ".join(words))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:5])], "doc_id long, text string").repartition(3)
    of = {bytes(x["vertex"]): x["doc_id"] for x in df.select("doc_id", near_copies.text_digest("text").alias("vertex")).collect()}
    groups = spark.createDataFrame([([1, 2, 3],), ([2, 4],), ([7, 8],)], "members array<long>")
    whole, crowded = near_copies._members(groups, 4)
    assert sorted(map(tuple, whole.collect())) == [(7, 7), (7, 8)]
    by_group = {}
    for x in crowded.collect():
        by_group.setdefault(x["group"], []).append(x["id"])
    assert sorted(map(sorted, by_group.values())) == [[1, 2, 3], [2, 4]]
    whole, crowded = near_copies._members(groups, 5)
    assert crowded is None and sorted(map(tuple, whole.collect())) == [(1, 1), (1, 2), (1, 3), (1, 4), (7, 7), (7, 8)]
    wanted = brute_components(dict(enumerate(texts)))
    for large in (3, 1000):
        found = {}
        for x in near_copies.similar_texts(df, large=large).collect():
            found.setdefault(bytes(x["component"]), {bytes(x["component"])}).add(bytes(x["vertex"]))
        got = sorted(sorted({of[v] % len(texts) for v in g}) for g in found.values())
        assert got == sorted(g for g in (sorted(i for i in wanted if wanted[i] == c) for c in set(wanted.values())) if len(g) > 1)
