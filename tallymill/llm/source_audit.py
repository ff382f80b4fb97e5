"""How the sources of each language differ in the words they use.

A table of 256 bytes lower-cases A-Z and blanks every other ASCII byte that is not a
letter; ``bytes.translate`` applies it in one pass, ``bytes.split`` cuts the words, and
a ``Counter`` per document gives their frequencies. Tasks add counters up per group
(language and source) before anything is shuffled.

A language keeps the terms that enough of its documents hold. A group's share of a
term is smoothed and scaled to whole numbers, so that all results are exact. Almost all
counts of a group are zero, and a count of zero has the same share for every term of
the group, its *base*. Distances between the shares of two groups g and h are therefore
added up from the counts that are not zero:

    sum |p_g - p_h| =   sum over terms of g of |p_g - base_h|
                      + sum over terms of h of |p_h - base_g|
                      + (terms - terms of g - terms of h) * |base_g - base_h|
                      + sum over common terms of what these parts get wrong there

The first two sums need only how often each share occurs in a group; they are read off
running totals. The last one is added up in the tasks, in a matrix per tile of sources,
so that no row per term and pair of sources is ever made.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymill.session import written

#: Documents of a language that must hold a term.
LEAST_DOCS = 30
#: Added to every count, and the whole that shares are parts of.
SMOOTHING = 5
WHOLE = 1_000_000_000
#: Terms reported for a group.
TOP_TERMS = 50

#: Sources of a tile of the pair matrix.
_TILE = 256
#: Distinct words that a task holds before it hands its counts on.
_HELD = 1 << 19
#: Bytes of a text that are split at once, about.
_PIECE = 1 << 20

#: Letters stay, A-Z become a-z, bytes of other characters stay, the rest become blanks.
_LETTERS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def word_counts(text: str) -> Counter[bytes]:
    """How often each word of a whole text occurs."""
    blanked = text.encode().translate(_LETTERS)
    counts: Counter[bytes] = Counter()
    at = 0
    while at < len(blanked):
        end = blanked.find(b" ", at + _PIECE)
        end = len(blanked) if end < 0 else end
        counts.update(blanked[at:end].split())
        at = end
    return counts


def _group_counts(docs: DataFrame) -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n``, ``docs``): counts per task; each group also has a row without a term."""

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
        sizes = [len(n) + 1 for n, _ in held.values()]
        groups = pa.array(np.repeat(np.arange(len(held)), sizes))
        langs, sources = zip(*held)
        terms, counts, docs = [], [], []
        for n, documents in held.values():
            terms += [None, *n]
            counts += [0, *n.values()]
            docs += [0, *(documents[term] for term in n)]
        columns = [
            pa.array(langs, pa.string()).take(groups), pa.array(sources, pa.string()).take(groups),
            pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(docs, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                counts = word_counts(text.as_py())
                n, documents = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(counts)
                documents.update(counts.keys())
                size += len(n)
                if size >= _HELD:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    return docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (n + SMOOTHING) / (total + SMOOTHING * terms)), exactly."""
    part = (n + SMOOTHING).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return F.call_function("div", part, (total + terms * SMOOTHING).cast("decimal(19,0)")) + 1


def _common_terms(terms: DataFrame) -> DataFrame:
    """(``lang``, ``g``, ``h``, ``value``): what two groups' own sums get wrong on the terms that both have."""
    entry = F.struct("no", "p", "base")
    tiles = terms.groupBy("lang", "term", F.expr(f"no div {_TILE}").alias("a")).agg(F.collect_list(entry).alias("left"))
    others = tiles.select("lang", "term", F.col("a").alias("b"), F.col("left").alias("right"))
    met = tiles.join(others, ["lang", "term"]).filter("a <= b").select("lang", "a", "b", "left", "right")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros((_TILE, _TILE), np.int64)

        def rows() -> pa.RecordBatch:
            g, h = np.nonzero(sums)
            lang, a, b = now
            columns = [pa.array([lang] * len(g), pa.string()), pa.array(a * _TILE + g), pa.array(b * _TILE + h), pa.array(sums[g, h])]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "g", "h", "value"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "a", "b"))))
            sides = []
            for name in ("left", "right"):
                column = batch.column(name)
                fields = column.flatten()
                ends = np.cumsum(column.value_lengths().to_numpy())
                sides.append((np.r_[0, ends], *(fields.field(f).to_numpy() for f in ("no", "p", "base"))))
            for row, key in enumerate(keys):
                if key != now:
                    if now is not None:
                        yield rows()
                    now, sums = key, np.zeros((_TILE, _TILE), np.int64)
                (i, p, x), (j, q, y) = (
                    (no[at[row] : at[row + 1]] % _TILE, p[at[row] : at[row + 1], None], base[at[row] : at[row + 1], None])
                    for at, no, p, base in sides
                )
                q, y = q.T, y.T
                sums[np.ix_(i, j)] += abs(p - q) - abs(p - y) - abs(x - q) + abs(x - y)
        if now is not None:
            yield rows()

    found = met.sortWithinPartitions("lang", "a", "b").mapInArrow(add_up, "lang string, g long, h long, value long")
    found = found.filter("g <> h")
    # A tile met with itself has both orders already.
    mirrored = found.filter(F.expr(f"g div {_TILE} <> h div {_TILE}")).select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value")
    return found.unionByName(mirrored)


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(``lang``, ``g``, ``h``, ``value``): the distance of every two groups of a language, in both orders."""
    other = groups.select("lang", F.col("no").alias("h"), F.col("base").alias("base_h"), F.col("held").alias("held_h"))
    both = groups.select("lang", F.col("no").alias("g"), "base", "held", "shares", "terms").join(other, "lang").filter("g <> h")
    apart = (F.col("terms") - F.col("held") - F.col("held_h")) * F.abs(F.col("base") - F.col("base_h"))
    # Where each other group's base lies among the shares of a group's own terms.
    points = both.select("lang", "g", F.col("base_h").alias("p"), F.lit(0).cast("long").alias("n"), "h", "held", "shares", apart.alias("apart"))
    shares = terms.groupBy("lang", F.col("no").alias("g"), "p").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("lang", "g").orderBy("p").rangeBetween(W.unboundedPreceding, 0)
    placed = points.unionByName(shares, allowMissingColumns=True).withColumns(
        {"less": F.sum("n").over(upto), "less_sum": F.sum(F.col("n") * F.col("p")).over(upto)}
    ).filter("h IS NOT NULL")
    x = F.col("p")
    own = x * F.col("less") - F.col("less_sum") + (F.col("shares") - F.col("less_sum")) - x * (F.col("held") - F.col("less"))
    one_way = placed.select("lang", "g", "h", (own + F.col("apart")).alias("value"), own.alias("back"))
    parts = one_way.select("lang", F.explode(F.array(
        F.struct("g", "h", "value"), F.struct(F.col("h").alias("g"), F.col("g").alias("h"), F.col("back").alias("value"))
    )).alias("x")).select("lang", "x.g", "x.h", "x.value")
    return parts.unionByName(_common_terms(terms)).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
) -> DataFrame:
    """(``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``) of every group.

    Part ``pair``: the group's distance from each other source of its language, all of
    them. Part ``term``: the terms that the group uses more than its language does, and
    by how much, the ``top`` first ones. Ranks go by value, the largest first, then by
    the item's bytes.

    Null texts, languages and sources count as empty strings, which are a language and
    a source like any other. Repeated rows are documents of their own. A group without
    words, or whose language keeps no term, has its pairs; an empty table gives nothing.
    Other columns are ignored whatever their names.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    chosen = docs.select(text(lang_column).alias("lang"), text(source_column).alias("source"), text(text_column).alias("text"))
    of_term = W.partitionBy("lang", "term")
    # Partitioned by term from the start: sums per group and sums per language need one shuffle.
    summed = (
        _group_counts(chosen).repartition("lang", "term").groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumns({
            "in_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term),
            "first": F.row_number().over(of_term.orderBy("source")) == 1,
        })
        .filter(F.col("term").isNull() | (F.col("in_docs") >= least_docs))
        .drop("docs", "in_docs")
    )
    counted = written(summed, "group-counts")
    kept = counted.filter(F.col("term").isNotNull())
    of_lang = kept.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    zero = F.lit(0).cast("long")
    groups = (
        counted.filter(F.col("term").isNull()).select("lang", "source")
        .join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
        .fillna(0, ["total", "held", "terms", "lang_total"])
        # One row per group: the window holds the sources of a language, not their terms.
        .withColumn("no", (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).cast("long"))
        .withColumn("base", F.when(F.col("terms") > 0, _share(zero, F.col("total"), F.col("terms"))).otherwise(zero))
    )
    groups = written(groups, "groups")
    terms = written(
        kept.join(groups, ["lang", "source"]).select(
            "lang", "source", "no", "term", "base", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        ),
        "shares",
    )
    shares = terms.groupBy("lang", "no").agg(F.sum("p").alias("shares"))
    groups = groups.join(shares, ["lang", "no"], "left").fillna(0, ["shares"])

    names = groups.select("lang", "no", "source")
    pairs = (
        _pairs(terms, groups)
        .join(names.withColumnsRenamed({"no": "g"}), ["lang", "g"])
        .join(names.withColumnsRenamed({"no": "h", "source": "item"}), ["lang", "h"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    most = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = terms.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ranked = pairs.withColumn("rank", F.row_number().over(most)).unionByName(
        over.withColumn("rank", F.row_number().over(most)).filter(F.col("rank") <= top)
    )
    return ranked
