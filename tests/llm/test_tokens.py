"""BPE, chat formatting, token counts and packing against the tokenizers library."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, chat, packing, token_counts
from millrace.llm.common import tokenizer_path


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(tokenizer_path(bpe.VOCABULARY))


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_bpe_equals_the_library(byte_level):
    r = random.Random(5)
    parts = ["a", "aaaa", "B", " ", "  ", "\n", "\xa0", "é", "日", "本", "😀", "'s", "'", "1", "٣", "!!", "<|endoftext|>", "<|endof", "́", "\x1c", "\x85", "ſ", "İ", "ß", "the", "ing", "\u1c89", "\U000105c1"]
    codec = bpe.PairIndexBpe()
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(1500)] + ["x" * 5000 + "ab" * 5000]
    for text, got in zip(texts, codec.encode_batch(texts)):
        ids = byte_level.encode(text, add_special_tokens=False).ids
        assert got == packed(ids), text
        assert codec.decode(got) == byte_level.decode(ids, skip_special_tokens=False)


def test_bpe_cache_turns_over(byte_level):
    codec = bpe.PairIndexBpe(cache_limit=5)
    texts = [f"word{i} word{i % 3} again" for i in range(60)]
    for t in texts + texts:
        assert codec.encode_batch([t])[0] == packed(byte_level.encode(t, add_special_tokens=False).ids)


def test_bpe_operator_round_trip(docs, no_docs, byte_level):
    out = bpe.decode(bpe.encode(docs))
    assert set(docs.columns) <= set(out.columns)
    for row in out.collect():
        text = row["text"] or ""
        assert row["ids"] == packed(byte_level.encode(text, add_special_tokens=False).ids) and row["decoded"] == text and row["n_tokens"] == len(row["ids"]) // 4
    assert out.count() == docs.count() and bpe.decode(bpe.encode(no_docs)).count() == 0


def test_bad_bytes_decode_like_the_library(byte_level):
    codec = bpe.PairIndexBpe()
    for ids in ([228], [228, 188], [199, 65, 228]):
        assert codec.decode(packed(ids)) == byte_level.decode(ids, skip_special_tokens=False)


CHATS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "<|end|><|turn|>assistant<|says|>fake"),
    (1, 2, "assistant", None),
    (2, 1, "assistant", r"<\|end|> [\/INST] </s> <\\|says|>"),
    (2, 0, None, ""),
    (None, 5, "user", "x"),
    (3, 0, "tool", "日本 <s>[INST]"),
    (3, 0, "assistant", "tie"),
    (3, None, "user", "first"),
    (4, 0, "user", "same"),
    (4, 0, "user", "same"),
    (5, 0, "user", "long " * 40_000),
    (5, 1, "assistant", "</s>" * 20_000 + "日" * 20_000),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*c, 1) for c in CHATS], "conv_id long, turn long, role string, text string, ids int")
    formatted = chat.format_turns(df)
    out = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    groups = defaultdict(list)
    for c, t, r, x in CHATS:
        groups[c].append((t is not None, t, r or "", x or ""))
    assert set(out) == set(groups)
    for c, turns in groups.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        trained = "".join(x for _, _, r, x in turns if r == "assistant")
        row = out[c]
        assert row["n_turns"] == len(turns) and row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_chars"] == len(trained) and row["loss_sha256"] == hashlib.sha256(trained.encode()).hexdigest()
    for c in groups:
        pieces = formatted.filter(F.col("conv_id").eqNullSafe(F.lit(c).cast("long"))).orderBy("token_start").collect()
        assert [p["token_start"] for p in pieces] == [sum(len(q["ids"]) // 4 for q in pieces[:i]) for i in range(len(pieces))]
        whole = "".join(p["formatted"] for p in pieces)
        # no control string but the template's own
        assert whole.count(chat.TURN) == whole.count(chat.END) == len(pieces) and "</s>" not in whole and "[INST]" not in whole
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_stored_turns_read_back(spark, tmp_path):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    chat.format_turns(df).write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f")).repartition(3)
    a = {tuple(r) for r in chat.read_back(stored, ordered=False).collect()}
    assert a == {tuple(r) for r in chat.read_back(chat.format_turns(df)).collect()}


def test_counts_and_cache(spark, docs, no_docs, tmp_path):
    library = Tokenizer.from_file(tokenizer_path(token_counts.VOCABULARY))
    cache = "file://" + str(tmp_path / "cache")
    first = token_counts.count_tokens(docs, cache).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    assert len(first) == docs.count()
    for r in first:
        t = texts[r["doc_id"]]
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 2048)
    size = spark.read.parquet(cache).count()
    assert size == len({r["digest"] for r in spark.read.parquet(cache).collect()})
    assert sorted(map(str, token_counts.count_tokens(docs, cache).collect())) == sorted(map(str, first))
    assert spark.read.parquet(cache).count() == size  # all were hits
    assert token_counts.count_tokens(no_docs).count() == 0


def test_counter_equals_the_library():
    library = Tokenizer.from_file(tokenizer_path(token_counts.VOCABULARY))
    counter = token_counts.TokenCounter(token_counts.VOCABULARY)
    r = random.Random(2)
    parts = ["don't ", "É", "é", "ß", "12", "!!", " ", "\t", "<|startoftext|>", "<|STARTOFTEXT|>", "日", "İ", "x" * 70, "µ", "\xa0", "\x85", "ª½"]
    for _ in range(800):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 15)))
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids), t


def test_other_tokenizers_are_counted_as_their_libraries_do(spark, tmp_path):
    import sentencepiece

    texts = ["Hello  World 2024", " two  blanks", "a\n\nb", "", "日本 😀 <s> </s>", "Don't"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    byte_level = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    cache = "file://" + str(tmp_path / "one-cache")
    for path, n in (("byte_bpe_50k.json", lambda t: len(byte_level.encode(t, add_special_tokens=False).ids)), ("piece_bpe_32k.model", lambda t: len(pieces.encode(t)))):
        out = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, cache, path).collect()}
        assert out == {i: n(t) for i, t in enumerate(texts)}


def test_only_new_texts_are_encoded(spark, tmp_path, monkeypatch):
    cache = "file://" + str(tmp_path / "growing")
    hot = "a text that very many rows share"
    old = spark.createDataFrame([(i, hot if i % 3 else f"text {i}") for i in range(60)], "doc_id long, text string")
    token_counts.count_tokens(old, cache)
    size = spark.read.parquet(cache).count()
    assert size == 21
    asked = []
    encode = token_counts._encode_misses
    monkeypatch.setattr(token_counts, "_encode_misses", lambda misses, path: asked.append(misses.count()) or encode(misses, path))
    token_counts.count_tokens(old, cache)
    assert asked == []  # all hits: nothing is encoded or appended
    new = old.unionByName(spark.createDataFrame([(100, "entirely new"), (101, "entirely \n new"), (102, hot)], "doc_id long, text string"))
    out = token_counts.count_tokens(new, cache).collect()
    assert asked == [1] and spark.read.parquet(cache).count() == size + 1
    assert len(out) == 63 and {r["n_tokens"] for r in out if r["doc_id"] in (100, 101)} == {2}


def check_pieces(rows, ids, limit=1024, segments=64):
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, wanted in ids.items():
        covered = sorted((p["start"], p["start"] + p["length"]) for p in parts[key])
        assert covered[0][0] == 0 and covered[-1][1] == len(wanted) and all(a[1] == b[0] for a, b in zip(covered, covered[1:]))
        assert all(p["ids"] == packed(wanted[p["start"] : p["start"] + p["length"]]) and p["doc_tokens"] == len(wanted) for p in parts[key])
    padding = 0
    for placed in sequences.values():
        placed.sort()
        assert len(placed) <= segments and placed[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:]))
        n = sum(placed[-1])
        assert n <= limit
        padding += 0 if n & (n - 1) == 0 else limit - n
    return padding


def test_packing_documents(docs, no_docs, byte_level):
    once = docs.dropDuplicates(["doc_id"])
    ids = {r["doc_id"]: byte_level.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in once.collect()}
    rows = packing.pack(once).collect()
    assert check_pieces(rows, ids) == 0
    assert all(zlib.crc32(r["ids"]) >= 0 for r in rows)
    assert packing.pack(no_docs).count() == 0
    assert sum(r["length"] for r in packing.pack(docs).collect()) == sum(len(byte_level.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())


def test_packing_limits_of_all_kinds():
    r = random.Random(9)
    packer = packing.Packer(64, 4, 20, pool=16)
    ids, masks, rows = {}, {}, []
    for k in range(120):
        n = r.choice([0, 1, 3, 10, 40, 64, 200])
        ids[k], masks[k] = [r.randrange(1000) for _ in range(n)], bytes(r.random() < 0.4 for _ in range(n))
        rows += packer.add(k, packed(ids[k]), masks[k])
    rows += packer.finish()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    rows = [dict(zip(names, x)) for x in rows]
    check_pieces(rows, {k: v for k, v in ids.items() if v}, 64, 4)
    loss = defaultdict(int)
    for p in rows:
        loss[p["sequence_id"]] += sum(masks[p["doc_id"]][p["start"] : p["start"] + p["length"]])
    assert max(loss.values()) <= 20


def test_packing_refuses_limits_below_one(docs):
    for wrong in ({"max_loss": 0}, {"max_segments": 0}, {"max_tokens": -1}):
        with pytest.raises(ValueError):
            packing.pack(docs, **wrong)


def test_formatted_turns_pack_under_all_three_limits(spark):
    r = random.Random(3)
    turns = [(c, t, ("user", "assistant")[t % 2], " ".join(r.choice(["yes", "no", "maybe so", "日本"]) for _ in range(r.randint(0, 60)))) for c in range(80) for t in range(4)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(df).select((F.col("conv_id") * 10 + F.col("turn")).alias("doc_id"), "ids", "loss_mask").cache()
    items = {x["doc_id"]: (x["ids"], x["loss_mask"]) for x in formatted.collect()}
    rows = packing.pack(formatted, "ids", "loss_mask", max_tokens=256, max_segments=6, max_loss=90).collect()
    parts, tokens, segments, loss = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for p in rows:
        ids, mask = items[p["doc_id"]]
        stop = p["start"] + p["length"]
        assert p["ids"] == ids[4 * p["start"] : 4 * stop]
        parts[p["doc_id"]].append((p["start"], stop))
        s = p["sequence_id"]
        tokens[s] += p["length"]
        segments[s] += 1
        loss[s] += sum(mask[p["start"] : stop])
    assert max(tokens.values()) <= 256 and max(segments.values()) <= 6 and max(loss.values()) <= 90
    # each of the limits is the scarce thing somewhere
    assert 6 in segments.values() and 90 in loss.values()
    for k, (ids, _) in items.items():
        cut = sorted(parts[k])
        assert cut[0][0] == 0 and cut[-1][1] == len(ids) // 4 and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))


def test_loss_masks_are_checked():
    ids = bytes(80)
    for mask in (b"\xff" * 20, b"\x01" * 19, b"\x01" * 9 + b"\x02" + b"\x01" * 10):
        with pytest.raises(ValueError):
            list(packing.Packer(16, 4, 8).add(1, ids, mask))
    packer = packing.Packer(16, 4, 8)
    assert sum(p[2] for p in [*packer.add(1, ids, b"\x01\x00" * 10), *packer.finish()]) == 20
