"""How the sources of a language differ in their terms, by deduplicated count columns.

A term is a run of ASCII letters and non-ASCII characters, of which only A-Z is
lower-cased. A language keeps the terms that at least MIN_DOCS of its documents hold.
Each kept term has a sparse vector of its counts by source. Most terms are rare and
share theirs with many others, so terms are grouped by identical vectors: each pair of
sources is evaluated once per distinct vector and multiplied by the number of terms that
have it. The ranks of single terms are those of the original terms.

With N occurrences of kept terms in a group and V kept terms, a term's smoothed share is
p = 1 + floor(SHARE * (count + 1) / (N + V)); a share p differs from a share q by
floor((p - q)^2 / q). All arithmetic is in integers. The shares of sources are compared
with one another over all kept terms (part ``pair``), and with those of the whole
language for each of their terms (part ``term``).

Tasks count whole texts into bounded tables, which one shuffle by term adds up and turns
into vectors; no group of rows meets in one task but the counts of one term, at most one
for each source and table. Pairs are summed in the tasks, in squares of at most BLOCK by
BLOCK sources, and their sums are added up.

Defined results: null text, lang and source count as ''. Every (lang, source) that
occurs takes part, also without terms; where a language keeps no term all its pairs have
the value 0; a language of one source has no pairs. Repeated rows count each for itself;
ties of a rank go to the smaller item in UTF-8; an empty table gives an empty table;
columns other than text, lang and source are not read. A language may have up to 9 *
10^17 occurrences of kept terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, joined_by_key, text_or_empty

MIN_DOCS = 3
SHARE_DIGITS = 9
TOP_TERMS = 200
#: Entries of a task's tables of counts before they are sent on.
TABLE_ENTRIES = 400_000
#: Sources of one side of a square of pairs, values that are computed at once, and sums that a task holds.
BLOCK, VALUES, SUMS = 512, 1 << 21, 1 << 22

_LETTERS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in their order."""
    return text.translate(_LETTERS).split()


def counted(docs: DataFrame, entries: int = TABLE_ENTRIES) -> DataFrame:
    """lang, source, term, n and docs: parts of the counts, to be added up."""

    def run(batches):
        counts, holders, held = defaultdict(Counter), defaultdict(Counter), 0

        def table():
            columns: list[list] = [[], [], [], [], []]
            for (lang, source), found in counts.items():
                by_docs = holders[lang, source]
                columns[0] += [lang] * len(found)
                columns[1] += [source] * len(found)
                columns[2] += found.keys()
                columns[3] += found.values()
                columns[4] += map(by_docs.__getitem__, found)
            kinds = [pa.binary()] * 3 + [pa.int64()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for i in range(batch.num_rows):
                lang, source, text = (batch.column(c)[i].as_py() for c in range(3))
                words = terms_of(text)
                found = counts[lang, source]
                held -= len(found)
                found.update(words)
                holders[lang, source].update(set(words))
                held += len(found)
                if held >= entries:
                    yield table()
                    counts, holders, held = defaultdict(Counter), defaultdict(Counter), 0
        if held:
            yield table()

    # as bytes, so that also ill-formed text passes as it is
    raw = docs.select(*[text_or_empty(c).cast("binary").alias(c) for c in ("lang", "source", "text")])
    found = raw.mapInArrow(run, "lang binary, source binary, term binary, n long, docs long")
    return found.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")], "n", "docs")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term and its vector: (source, n) of the sources that have it, by source."""
    by_term = counted(docs).repartition("lang", "term")  # tasks have combined; both groupings keep this partitioning
    by_source = by_term.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    vectors = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("vector"))
    return vectors.filter(F.col("docs") >= min_docs).select("lang", "term", "vector")


def languages(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per lang: its sources in order, N + V of each (``sizes``) and of the whole (``size``), and V as ``terms``."""
    groups = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    n = terms.select("lang", F.explode("vector").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("n"))
    v = terms.groupBy("lang").agg(F.count("*").alias("v"))
    each = groups.join(n, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    whole = each.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("s"), F.sum("n").alias("n"))
    v0 = F.coalesce("v", F.lit(0).cast("long"))
    return whole.join(v, "lang", "left").select(
        "lang", F.col("s.source").alias("sources"), F.transform("s.n", lambda n: n + v0).alias("sizes"), (F.col("n") + v0).alias("size"), v0.alias("terms")
    )


def share(count: Column, size: Column) -> Column:
    """1 + floor(10^SHARE_DIGITS * (count + 1) / size)."""
    scaled = (count + 1).cast("decimal(19,0)") * F.lit(10**SHARE_DIGITS).cast("decimal(10,0)")
    return 1 + F.call_function("div", scaled, size.cast("decimal(19,0)"))


def shares(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """As ``share``: the digits of the quotient one after another, so that nothing exceeds 64 bits."""
    rest = counts + 1
    out = np.zeros(np.broadcast_shapes(rest.shape, sizes.shape), np.int64)
    for _ in range(SHARE_DIGITS):
        digit, rest = np.divmod(rest * 10, sizes)
        out = out * 10 + digit
    return out + 1


def pair_sums(vectors: DataFrame) -> DataFrame:
    """lang, i, j and value: parts of the sums over all terms, for pairs of sources by their places.

    ``vectors`` has lang, places, counts, n (terms that have the vector), sizes (of all sources), row and column (where the square begins).
    """

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}

        def table():
            for (lang, row, column), found in sums.items():
                i, j = np.indices(found.shape)
                columns = [pa.array([lang] * found.size, pa.string()), pa.array(i.ravel() + row), pa.array(j.ravel() + column), pa.array(found.ravel())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "i", "j", "value"])

        for batch in batches:
            squares = defaultdict(list)
            for at, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "row", "column")))):
                squares[key].append(at)
            n = batch.column("n").to_numpy()
            for key, rows in squares.items():
                sizes = np.array(batch.column("sizes")[rows[0]].as_py(), np.int64)
                step = max(VALUES // min(len(sizes), BLOCK) ** 2, 1)
                for s in range(0, len(rows), step):
                    part = rows[s : s + step]
                    chosen = batch.take(pa.array(part))
                    at = np.repeat(np.arange(len(part)), chosen.column("places").value_lengths().to_numpy())
                    places, counts = (chosen.column(c).flatten().to_numpy() for c in ("places", "counts"))
                    sides = []
                    for low in key[1:]:
                        own = sizes[low : low + BLOCK]
                        dense = np.zeros((len(part), len(own)), np.int64)
                        inside = (places >= low) & (places < low + BLOCK)
                        dense[at[inside], places[inside] - low] = counts[inside]
                        sides.append(shares(dense, own))
                    p, q = sides[0][:, :, None], sides[1][:, None, :]
                    value = np.tensordot(n[part], (p - q) ** 2 // q, 1)
                    sums[key] = sums[key] + value if key in sums else value
            if sum(x.size for x in sums.values()) >= SUMS:
                yield from table()
                sums = {}
        yield from table()

    return vectors.mapInArrow(run, "lang string, i long, j long, value long")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank, as the module says.

    ``pair``: every other source of the lang, with the sum of the differences from its
    shares. ``term``: the terms of which the source has a larger share than its lang, up
    to rank ``top_terms``.
    """
    terms = checkpointed(kept_terms(docs, min_docs))
    langs = checkpointed(languages(docs, terms))
    total = langs.agg(F.coalesce(F.sum("terms"), F.lit(0))).first()[0]
    named = langs.withColumnRenamed("lang", "_lang")
    place = lambda x: F.array_position("sources", x["source"]) - 1

    distinct = joined_by_key(terms.groupBy("lang", "vector").agg(F.count("*").alias("n")), "lang", named, "_lang", "terms", total)
    side = F.ceil(F.size("sources") / F.lit(BLOCK))
    squares = distinct.select(
        "lang",
        F.transform("vector", place).alias("places"),
        F.col("vector.n").alias("counts"),
        "n",
        "sizes",
        side.alias("side"),
        F.explode(F.sequence(F.lit(0), (side * side - 1).cast("int"))).alias("square"),
    )
    at = lambda x: (x * BLOCK).cast("long")
    sums = pair_sums(squares.select("lang", "places", "counts", "n", "sizes", at(F.floor(F.col("square") / F.col("side"))).alias("row"), at(F.col("square") % F.col("side")).alias("column")))
    sums = sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    pairs = (
        langs.select("lang", "sources", F.posexplode("sources").alias("i", "source"))
        .select("lang", "i", "source", F.posexplode("sources").alias("j", "item"))
        .filter("i <> j")
        .join(sums, ["lang", "i", "j"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    )

    located = joined_by_key(terms, "lang", named, "_lang", "terms", total).select(
        "lang",
        F.col("term").alias("item"),
        share(F.aggregate("vector", F.lit(0).cast("long"), lambda n, x: n + x["n"]), F.col("size")).alias("q"),
        F.explode(F.transform("vector", lambda x: F.struct(x["source"], x["n"], F.get("sizes", place(x).cast("int")).alias("size")))).alias("x"),
    )
    shared = located.select("lang", F.col("x.source").alias("source"), "item", share(F.col("x.n"), F.col("x.size")).alias("p"), "q").filter("p > q")
    over = shared.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value"))

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)


def oracle() -> str:
    return r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT doc, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
gn AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
gp AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p FROM gn JOIN v USING (lang)),
ln AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM gn GROUP BY lang, term),
lp AS (SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v)::HUGEINT AS q FROM ln JOIN v USING (lang)),
pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
       FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
