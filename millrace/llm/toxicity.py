"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: how dense and how strong its words of a lexicon are, plain and
after undoing obfuscation, how near they stand to a second-person word, and its rates
of capitals, punctuation and obfuscated words. The lexicon, of words and of word
beginnings, is learned from the labelled sample: entries that occur in toxic texts far
more often than in others. Trees are fitted on one half of the sample and calibrated
on the other; the lexicon knows the first half alone, so the calibration is honest.

The sample is the at most ``SAMPLE_ROWS`` labelled documents of lowest hash whose
crc32 of the doc_id is not 1 modulo 3. Only label and text of these are used; lang,
source and doc_id never enter a score.

Defined results: a null or empty text is scored like any other, from features that are
all zero; a document with several labels counts as toxic if one says so, null labels
are left out; without any usable label all scores are 0; an empty table gives an empty
table; texts of any length are read whole. Other columns are carried along by
``keep_clean``, and by ``score`` but for those with the names of its outputs.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import BoostedTrees, Isotonic, fit_isotonic, fit_trees
from .bpe import _with, slices
from .common import free_name

#: Labelled rows used for fitting, and lexicon entries kept, at most.
SAMPLE_ROWS = 12_000
LEXICON_SIZE = 400
#: Beginnings of words that can be lexicon entries.
STEM_LENGTHS = (4, 5)
THRESHOLD = 0.7

# Second-person words of English, German, French and Spanish, and the
# letters that digits and signs stand for in obfuscated words.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch euer ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split())
DISGUISES = str.maketrans("013457@$!€", "oieastasie")

_WORD = re.compile(r"[^\W\d_]+")
_INNER = re.compile(r"(?<=[^\W\d_])[0-9@$!€*]+(?=[^\W\d_])")
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]+")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")

FEATURES = ["hits", "density", "stem_hits", "stem_density", "distinct", "strongest", "hidden_hits", "near_you", "you_rate", "capitals", "capital_words", "punctuation", "exclaims", "obfuscated"]


@dataclass
class Lexicon:
    """Entries with their log-odds."""

    words: dict[str, float]
    stems: dict[str, float]

    def __post_init__(self):
        self.stems_of = [(n, found) for n in STEM_LENGTHS if (found := frozenset(s for s in self.stems if len(s) == n))]

    def strength(self, word: str) -> float:
        s = self.words.get(word, 0.0)
        for n in STEM_LENGTHS:
            if len(word) > n:
                s = max(s, self.stems.get(word[:n], 0.0))
        return s


def entries(text: str) -> set[str]:
    """What of a text could be lexicon entries: its words, and beginnings as ``stem*``."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for n in STEM_LENGTHS:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


def features(text: str, lexicon: Lexicon) -> list[float]:
    lower = text.lower()
    words = _WORD.findall(lower)
    n = max(len(words), 1)
    known = lexicon.words
    hits = [i for i, w in enumerate(words) if w in known] if known else []
    stem_hits = []
    for k, stems in lexicon.stems_of:
        stem_hits += [i for i, w in enumerate(words) if w[:k] in stems and len(w) > k]
    at = sorted({*hits, *stem_hits})
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0.0
    if at and you:
        places = np.array(you)
        spot = np.searchsorted(places, at)
        gaps = [min(abs(int(places[min(s, len(places) - 1)]) - a), abs(int(places[max(s - 1, 0)]) - a)) for s, a in zip(spot, at)]
        near = 1.0 / (1 + min(gaps))
    masked = [w for w in lower.split() if _INNER.search(w)] if _INNER.search(lower) else []
    revealed = ["".join(_WORD.findall(w.translate(DISGUISES))) for w in masked]
    revealed += [re.sub(r"[\W_]", "", m) for m in _SPACED.findall(lower)]
    hidden = sum(1 for w in revealed if lexicon.strength(w) > 0)
    letters = sum(map(len, words)) or 1
    strengths = [lexicon.strength(words[i]) for i in at]
    capitals = _CAPITALS.findall(text)
    signs = text.count("!") + text.count("?")
    return [
        float(len(hits)),
        len(hits) / n,
        float(len(stem_hits)),
        len(stem_hits) / n,
        float(len({words[i] for i in at})),
        max(strengths, default=0.0),
        float(hidden),
        near,
        len(you) / n,
        sum(map(len, capitals)) / letters,
        sum(1 for run in capitals if len(run) > 1) / n,
        sum(map(text.count, ".,;:!?")) / n,
        signs / n,
        len(masked) / n,
    ]


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: BoostedTrees
    calibration: Isotonic

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.array([features(t, self.lexicon) for t in texts])
        return np.clip(self.calibration(self.trees.margin(x)), 0.0, 1.0)


def held_out(doc_id) -> F.Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic and half (0 or 1) of at most ``rows`` labelled documents.

    The ids are chosen by a hash before any text is read; as there are at most
    ``rows`` of them, they are broadcast. Repeated documents count once.
    """
    chosen = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .filter(~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # one copy of a repeated id, still at most as many rows as ids
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half"))


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> Lexicon:
    """Entries of the sample's first half by their log-odds between toxic and other texts."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts.update((e, toxic > 0) for e in entries(text))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([counts[k] if k[1] else 0 for k in keys], pa.int64()), pa.array([0 if k[1] else counts[k] for k in keys], pa.int64())],
            names=["entry", "toxic", "clean"],
        )

    halves = sample.filter("half = 0")
    totals = halves.agg(F.coalesce(F.sum(F.when(F.col("toxic") > 0, 1)), F.lit(0)).alias("toxic"), F.count("*").alias("all")).first()
    n_toxic, n_clean = totals["toxic"], totals["all"] - totals["toxic"]
    if not n_toxic or not n_clean:
        return Lexicon({}, {})
    least = max(3, n_toxic // 500)
    counted = halves.select("text", "toxic").mapInArrow(run, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    best = counted.filter(F.col("toxic") >= least).withColumn("odds", odds).filter("odds > 3").orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "entry").limit(size)
    found = {r["entry"]: float(r["odds"]) for r in best.collect()}
    stems = {e[:-1]: v for e, v in found.items() if e.endswith("*")}
    return Lexicon({e: v for e, v in found.items() if not e.endswith("*")}, stems)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """The model; the driver gets at most ``rows`` feature rows and the lexicon.

    The half that the trees don't see calibrates them; where that half lacks toxic or
    other rows, as among very few labels, all rows do.
    """
    sample = labelled_sample(docs, labels, rows).cache()
    try:
        lexicon = learn_lexicon(sample)

        def run(batches):
            for whole in batches:
                for batch in slices(whole):
                    x = [features(t, lexicon) for t in batch.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("toxic"), batch.column("half")], names=["x", "toxic", "half"])

        got = sample.mapInArrow(run, "x array<double>, toxic double, half long").toArrow()
    finally:
        sample.unpersist()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    y = (got.column("toxic").to_numpy() > 0).astype(np.float64)
    half = got.column("half").to_numpy()
    order = np.lexsort((*x.T, y, half))  # the same model whatever order the rows come in
    x, y, half = x[order], y[order], half[order]
    trees = fit_trees(x[half == 0], y[half == 0])
    if not trees.trees:
        return ToxicityModel(lexicon, trees, Isotonic([0.0], [float(y.mean()) if len(y) else 0.0]))
    unseen = half == 1
    if len(np.unique(y[unseen])) < 2:
        unseen = np.ones(len(y), bool)
    return ToxicityModel(lexicon, trees, fit_isotonic(trees.margin(x[unseen]), y[unseen]))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, score_name: str = "score", predicted_name: str = "predicted") -> DataFrame:
    """All columns with the score and whether it reaches the threshold."""
    schema = _with(docs.schema, T.StructField(score_name, T.DoubleType(), False), T.StructField(predicted_name, T.IntegerType(), False))
    kept = schema.names[:-2]

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                s = model.scores([t or "" for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return docs.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    names = free_name(docs, "_score"), free_name(docs, "_toxic")
    return score(docs, fit(docs, labels), threshold, *names).filter(F.col(names[1]) == 0).select(*docs.columns)
