"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a predicate that rejects a text. On a bounded random sample of whole texts
the share that each rule rejects is counted in one pass, and its cost is timed: the very
expression that will run goes over the sample, repeated so often that one job reads
CHARS characters, and from its time that of a predicate is taken which reads the same
columns and does nothing. Rules that this does not tell from nothing go over ten times as much.
Costs are powers of two of a second per row, and those below what can be measured are equal, so that
two estimates of one table agree. The cascade is one CASE that asks the rules in
descending order of rejection per cost and stops at the first that rejects. The order
decides only how much work is done, never which documents stay. Where the features of all texts are wanted
anyway (``judge``), the rules read them as columns and what they save is the rules that
look at the text; ``keep_good`` computes what each rule needs only when its turn comes.

Features need no shuffle: words, their five-word windows and repeated windows are
array functions within a row. Windows are compared by 64-bit hashes of their words; in
a text of 20,000 windows two different ones collide with a chance of 1 in 10^11.

Defined results: a null text has no words and is rejected as too short, like an empty
one; texts of any length are judged whole; equal rows get equal verdicts; an empty
table gives an empty table. Other columns are carried along, except those with the
names of the outputs.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, checkpointed, free_name, let, quoted, text_or_empty

WINDOW = 5
MIN_WORDS = 10
#: Documents that costs and selectivities are estimated on, about, and the longest of them; longer texts are timed as their beginning.
SAMPLE, SAMPLE_CHARS = 400, 1 << 20
#: Characters that one timed job reads, how much more it reads for cheap rules, and how often it runs: the fastest counts.
CHARS, MORE, RUNS = 4_000_000, 10, 3
#: Seconds per row that are told from nothing; all cheaper rules cost this.
LEAST_SECONDS = 2.0**-20

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK, -1), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` words that occur twice or more."""

    def positions(hashes: Column) -> Column:
        """Ascending starts of the windows whose hash occurs elsewhere as well."""
        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(s: Column, a: Column, b: Column) -> Column:
            return F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))

        return let(by_hash, lambda s: F.sort_array(F.array_compact(F.transform(s, lambda x, k: F.when(same(s, k, k - 1) | same(s, k, k + 1), x["i"])))))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def count(hashes: Column) -> Column:
        # most texts repeat nothing, and a set shows that without sorting
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(positions(hashes), covered))

    def window_hashes(word_hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(word_hashes) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(word_hashes, i + k) for k in range(window)]))

    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(window_hashes(hashes), count))
    )


def duplicate_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")


def with_features(docs: DataFrame, words: str | None = None) -> DataFrame:
    """All columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    ``words`` names a further column for the array of words.
    """
    text = text_or_empty("text")
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in FEATURES]
    column = words or free_name(docs, "_words")
    with_words = docs.select(*kept, words_of(text).alias(column))
    return with_words.select(
        *kept,
        *([column] if words else []),
        F.size(column).cast("long").alias("n_words"),
        F.aggregate(column, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        symbols(text).alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        repeated_words(F.col(column)).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass
class Rule:
    """A named predicate that rejects a text, and the columns that it reads."""

    name: str
    rejects: Column
    reads: Sequence[str] = field(default=("text",))


def full_lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def _of_lines(text: Column, pattern: str, share: int) -> Column:
    """Of three lines or more, over ``share`` tenths match."""
    return let(full_lines(text), lambda x: (F.size(x) >= 3) & (10 * F.size(F.filter(x, lambda line: line.rlike(pattern))) > share * F.size(x)))


def rules(words: str | None = None) -> list[Rule]:
    """The rules, in no particular order; with ``words`` on ready features and that column of words."""
    text = text_or_empty("text")
    ready = tuple(FEATURES) if words else ()
    if words:
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = map(F.col, FEATURES)
        short = n_words < MIN_WORDS
        repetition = 100 * n_repeat_words > 20 * n_words
        lettered = F.size(F.filter(words, lambda w: w.rlike("\\p{L}")))
    else:
        n_words = F.size(F.split(F.trim(F.regexp_replace(text, BLANK, " ")), " "))
        word_chars, n_symbols, n_dup_lines = F.length(F.regexp_replace(text, BLANK, "")), symbols(text), duplicate_lines(text)
        short = F.when(F.length(F.trim(text)) == 0, True).otherwise(n_words < MIN_WORDS)
        repetition = let(words_of(text), lambda w: 100 * repeated_words(w) > 20 * F.size(w))
        lettered = F.size(F.filter(F.split(text, BLANK, -1), lambda w: w.rlike("\\p{L}")))
    # upper-case letters outweigh the lower-case ones
    shouting = F.length(F.regexp_replace(text, "[^A-ZÀ-ÖØ-Þ]", "")) > F.length(F.regexp_replace(text, "[^a-zß-öø-ÿ]", ""))
    return [
        Rule("short", short, ready or ("text",)),
        Rule("symbols", 10 * n_symbols > word_chars, ready or ("text",)),
        Rule("shouting", shouting),
        Rule("long_words", word_chars > 25 * n_words, ready or ("text",)),
        Rule("few_letters", 10 * lettered < 6 * n_words, (words, *ready) if words else ("text",)),
        Rule("repeated_lines", let(F.size(F.split(text, "\n", -1)), lambda n: 2 * n_dup_lines > n), ("text", *ready)),
        Rule("bullets", _of_lines(text, "^[ \\t]*[-*•]", 9)),
        Rule("ellipses", _of_lines(text, "(?:\\.\\.\\.|…)[ \\t]*$", 3)),
        Rule("repetition", repetition, ready or ("text",)),
    ]


@dataclass
class Estimate:
    name: str
    rejects: float
    seconds: float


def _sampled(docs: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` texts drawn from all rows, in one partition and without lineage."""
    n = docs.count()
    text = F.substring(text_or_empty("text"), 1, SAMPLE_CHARS)
    drawn = docs.select(text.alias("text")).sample(min(sample / max(n, 1), 1.0), seed=42).limit(2 * sample)
    return checkpointed(drawn.coalesce(1))


def _does_nothing(some: DataFrame, reads: Sequence[str]) -> Column:
    """A predicate that is never true but has to look at the columns."""
    size = {"string": lambda c: F.octet_length(c), "array<string>": lambda c: F.size(c)}
    kinds = dict(some.dtypes)
    return reduce(lambda a, b: a | b, [size.get(kinds[c], F.col)(c) < -1 for c in reads])


def seconds_of(some: DataFrame, chosen: Sequence[Rule], chars: int = CHARS, runs: int = RUNS) -> dict[str, float]:
    """Seconds per row of each rule alone, beyond those of reading its columns."""
    rows, held = some.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    if not rows:
        return {r.name: LEAST_SECONDS for r in chosen}

    def timed(predicate: Column, times: int) -> float:
        again = some.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias(free_name(some, "_again")))
        job = again.agg(F.count(F.when(predicate, 1)))
        best = math.inf
        for _ in range(runs):
            began = time.perf_counter()
            job.first()
            best = min(best, time.perf_counter() - began)
        return best

    out = {}
    left = list(chosen)
    for times in (max(chars // max(held, 1), 1), MORE * max(chars // max(held, 1), 1)):
        nothing: dict[tuple, float] = {}
        for r in list(left):
            reads = tuple(r.reads)
            if reads not in nothing:
                nothing[reads] = timed(_does_nothing(some, reads), times)
            spent = timed(r.rejects, times) - nothing[reads]
            out[r.name] = max(spent / (times * rows), 0.0)
            if spent > nothing[reads]:  # reading the columns is small beside it
                left.remove(r)
    return {name: max(2.0 ** round(math.log2(max(s, LEAST_SECONDS))), LEAST_SECONDS) for name, s in out.items()}


def estimates(docs: DataFrame, sample: int = SAMPLE, ready: bool = False, chosen: Sequence[Rule] | None = None) -> list[Estimate]:
    """Share rejected and seconds per row, for each rule alone on a random sample.

    ``ready`` estimates the rules on features that are computed already; ``chosen`` are
    other rules than those of this module.
    """
    drawn = _sampled(docs, sample)
    some = (with_features(drawn, "_words") if ready else drawn).cache()
    try:
        rules_ = list(chosen) if chosen is not None else rules("_words" if ready else None)
        found = some.agg(F.count("*").alias("n"), *[F.sum(F.when(r.rejects, 1).otherwise(0)).alias(r.name) for r in rules_]).first()
        seconds = seconds_of(some, rules_)
        return [Estimate(r.name, (found[r.name] or 0) / max(found["n"], 1), seconds[r.name]) for r in rules_]
    finally:
        some.unpersist()


def ordered(estimated: list[Estimate]) -> list[str]:
    """Rules by descending rejection per cost; ties by cost, then name."""
    return [e.name for e in sorted(estimated, key=lambda e: (-e.rejects / e.seconds, e.seconds, e.name))]


def cascade(order: list[str], words: str | None = None) -> Column:
    """The name of the first rule in ``order`` that rejects, or null; ``words`` as in ``rules``."""
    by_name = {r.name: r.rejects for r in rules(words)}
    first, *others = order
    return reduce(lambda case, name: case.when(by_name[name], F.lit(name)), others, F.when(by_name[first], F.lit(first)))


def judge(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All columns with the features, base_failed, kept and rejected_by."""
    order = ordered(estimates(docs, sample, ready=True))
    words = free_name(docs, "_words")
    out = with_features(docs.drop("base_failed", "kept", "rejected_by"), words).withColumn("base_failed", base_failed())
    return out.withColumn("rejected_by", cascade(order, words)).withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop(words)


def keep_good(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that no rule rejects, with their columns; later rules run on survivors only."""
    return docs.filter(cascade(ordered(estimates(docs, sample))).isNull())
