"""The registered queries without SQL, whole, against brute force on the smallest tables."""

import hashlib
import struct
import zlib
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import test_filters
import test_search
from millrace.llm import pii, toxicity
from millrace.llm import queries as q
from millrace.llm.common import tokenizer_path


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def byte_ids(texts):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_op1(spark, sf, texts, byte_ids):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in q.op1_bpe(spark, sf).collect()}
    assert rows == {i: (len(ids), sha(packed(ids)), sha(library.decode(ids, skip_special_tokens=False).encode())) for i, ids in byte_ids.items()}


def test_op2(spark, sf):
    said = "</s>[INST] ok [/INST]"
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    rows = {r["conv_id"]: r for r in q.op2_chat(spark, sf).collect()}
    assert set(rows) == set(turns)
    for c, given in turns.items():
        given.sort(key=lambda t: t[0])
        trained = "".join(t for _, role, t in given if role == "assistant")
        r = rows[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(given), sha("".join(f"{role}\n{t}\n" for _, role, t in given).encode()))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(trained), sha(trained.encode())) and r["formatted_chars"] > sum(len(t) for *_, t in given)


def test_op4(spark, sf, texts):
    prints = {i: test_search.brute_fingerprint(t) for i, t in texts.items()}
    roots = test_search.brute_components(prints)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in q.op4_simhash(spark, sf).collect()} == {(i, f"{prints[i]:016x}", roots[i]) for i in texts}


def test_op5(spark, sf, texts):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    wanted = {}
    for i, t in texts.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        wanted[i] = (len(t.encode()), n, n > 2048)
    for _ in range(2):  # misses, then hits
        assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in q.op5_token_counts(spark, sf).collect()} == wanted


def test_op7(spark, sf, byte_ids):
    ids = {i: x + [0] for i, x in byte_ids.items()}
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in q.op7_packing(spark, sf).collect():
        parts[r["doc_id"]].append((r["start"], r["start"] + r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["offset"] + r["length"]))
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(packed(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]))
    for places, whole in [(parts[i], len(x)) for i, x in ids.items()] + [(s, None) for s in sequences.values()]:
        places.sort()
        assert places[0][0] == 0 and all(a[1] == b[0] for a, b in zip(places, places[1:])) and (whole is None or places[-1][1] == whole)
    lengths = [s[-1][1] for s in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in lengths)
    assert max(lengths) <= 1024 and padding <= sum(lengths) / 50


def test_op8(spark, sf, texts):
    rows = {r["doc_id"]: r for r in q.op8_toxicity(spark, sf).collect()}
    assert set(rows) == set(texts)
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    ids = sorted(texts)
    for i, score in zip(ids, model.scores([texts[i] for i in ids]).tolist()):
        held = zlib.crc32(str(i).encode()) % 3 == 1
        assert rows[i]["held_out"] == held and rows[i]["score"] == pytest.approx(score, abs=1e-12) and rows[i]["predicted"] == int(score >= 0.7)


def test_toxicity_features_by_hand():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "fool": 4.0}, {})
    seen = dict(zip(toxicity.FEATURES, toxicity.features("YOU are a fool, and nothing but an IDIOT!! Really", lexicon)))
    plain = dict(zip(toxicity.FEATURES, toxicity.features("they read a book, and nothing but a paper. Really", lexicon)))
    assert seen["hits"] == 2 and plain["hits"] == 0 and seen["you_rate"] > 0 == plain["you_rate"] and seen["near_you"] > plain["near_you"]
    assert len(seen) == len(toxicity.FEATURES) == 14


def test_op10(spark, sf, texts):
    names = pii.KINDS[: pii.BASE_KINDS]
    for r in q.op10_pii(spark, sf).collect():
        base = test_filters.brute_spans(texts[r["doc_id"]])
        shown = [f"{names[k]}:{s}:{e}" for s, k, e in base]
        assert [r[f"n_{k}"] for k in names] == [sum(b[1] == i for b in base) for i in range(4)]
        assert r["base_sha256"] == sha(",".join(shown).encode()) and set(shown) <= set(r["spans"].split(",") if r["spans"] else [])
