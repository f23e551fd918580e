"""Token counts through a digest cache.

A text's key is the SHA-256 of its normalised content together with the tokenizer's
version, which is the digest of its file and the name of the normal form. Keys are
joined to the counts that a Parquet cache in the shared folder holds from earlier calls;
of the keys that it lacks, each is encoded once, however many rows have it, and the
counts are appended to the cache. All counts are then read from the cache.

Only the texts of misses move, each distinct one about once: copies of a hot text meet
in their own tasks first. The final join sends the counts of hot keys to the rows.

The normal form depends on the tokenizer. For one that lower-cases and drops white space
it joins runs of ASCII blanks into one space; anything further could make or break a
special string. For all others it is the text itself.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; texts of any
length are counted whole; equal texts share one cache row and each keep their own
result row; an empty table gives an empty table. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import is_latin1, slices, splitter
from .common import BLANK, HOT_KEYS, checkpointed, exists, joined_by_key, shared_dir, text_or_empty, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
CACHE_LIMIT = 400_000
CACHE_SCHEMA = "digest string, n_tokens long"

# How a tokenizer file says that it lower-cases, drops white space and cuts as the word pattern does.
_WORD_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


@lru_cache(maxsize=4)
def drops_blanks(path: str = VOCABULARY) -> bool:
    """Whether the tokenizer drops white space and counts word by word."""
    if path.endswith(".model"):
        return False
    with open(tokenizer_path(path), encoding="utf-8") as f:
        spec = json.load(f)
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return spec["normalizer"] == _WORD_NORMALIZER and cuts[0].get("pattern") == {"Regex": _WORD_SPLIT} and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]


@lru_cache(maxsize=4)
def tokenizer_version(path: str = VOCABULARY) -> str:
    with open(tokenizer_path(path), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest() + (" blanks joined" if drops_blanks(path) else " as is")


def normalised(text: Column, path: str = VOCABULARY) -> Column:
    return F.trim(F.regexp_replace(text, BLANK, " ")) if drops_blanks(path) else text


def content_digest(content: Column, path: str = VOCABULARY) -> Column:
    return F.sha2(F.concat(F.lit(tokenizer_version(path)), F.lit("\n"), content), 256)


class _WordCounts(dict):
    """Tokens of a lower-case word, asked from the tokenizer when first met."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> int:
        n = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= 64:
            if len(self) >= CACHE_LIMIT:
                self.clear()
            self[word] = n
        return n


class TokenCounter:
    """Counts as the tokenizer does; where words don't depend on each other, through a cache of words.

    In Latin-1 each character is its own NFC form and lower-cases alone, and a word's
    tokens don't depend on its neighbours, so the sum over words is the whole count.
    Other texts, those with a special string, and all texts of other tokenizers go to
    the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(path))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = drops_blanks(path)
        self.counts = _WordCounts(self.tokenizer)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def count(self, text: str) -> int:
        if not self.by_word or not is_latin1(text) or (self.special is not None and self.special.search(text)):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.counts.__getitem__, splitter("word", False).findall(text.lower())))


class PieceCounter:
    """Counts of a sentencepiece model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=tokenizer_path(path))

    def count(self, text: str) -> int:
        return len(self.model.encode(text))


@lru_cache(maxsize=2)
def counter(path: str = VOCABULARY) -> TokenCounter | PieceCounter:
    return PieceCounter(path) if path.endswith(".model") else TokenCounter(path)


def _encode_misses(misses: DataFrame, path: str) -> DataFrame:
    def run(batches):
        tokens = counter(path)
        for whole in batches:
            for batch in slices(whole):
                counts = [tokens.count(t) for t in batch.column("content").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return misses.mapInArrow(run, CACHE_SCHEMA)


def _contents(docs: DataFrame, missed: DataFrame, rows: int, path: str) -> DataFrame:
    """The content of each missed digest, once."""
    content = normalised(text_or_empty("text"), path)
    texts = docs.select(content_digest(content, path).alias("digest"), content.alias("content"))
    hot = missed.filter(F.col("rows") > rows // HOT_KEYS).select("digest")
    others = missed.filter(F.col("rows") <= rows // HOT_KEYS).select("digest")
    first = F.first("content").alias("content")
    if hot.isEmpty():
        return texts.join(others, "digest", "left_semi").groupBy("digest").agg(first)
    # fewer than HOT_KEYS of them: they are found where they lie, and copies meet before the shuffle
    crowded = texts.join(F.broadcast(hot), "digest", "left_semi").groupBy("digest").agg(first)
    some = texts.join(F.broadcast(hot), "digest", "left_anti").join(others, "digest", "left_semi")
    return crowded.unionByName(some.groupBy("digest").agg(first))


def count_tokens(docs: DataFrame, cache_path: str | None = None, path: str = VOCABULARY, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether n_tokens is over ``limit``.

    ``cache_path`` is a Parquet folder that the driver and all executors see; by default
    one in the shared folder, which later calls find again. ``path`` is a tokenizers file
    (.json) or a sentencepiece model. The misses are encoded and appended when this is
    called; a call that was cut short leaves whole appends only, so the next goes on.
    """
    spark = docs.sparkSession
    cache_path = cache_path or f"{shared_dir(spark)}/token-counts"
    text = text_or_empty("text")
    keyed = checkpointed(docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), content_digest(normalised(text, path), path).alias("digest")))
    digests = checkpointed(keyed.groupBy("digest").agg(F.count("*").alias("rows")))

    def cached() -> DataFrame:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)

    if not exists(spark, cache_path):
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    missed = checkpointed(digests.join(cached().select("digest"), "digest", "left_anti"))
    if not missed.isEmpty():
        # few and not too small files, however many tasks encode
        _encode_misses(_contents(docs, missed, keyed.count(), path), path).hint("rebalance").write.mode("append").parquet(cache_path)
    # two calls may have appended the same digest
    counts = cached().join(digests, "digest").groupBy("digest", "rows").agg(F.max("n_tokens").alias("n_tokens")).withColumnRenamed("digest", "known")
    found = joined_by_key(keyed, "digest", checkpointed(counts), "known", "rows", keyed.count())
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
