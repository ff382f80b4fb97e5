"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits of a fingerprint are dealt into a few parts, correlated bits
together. If two fingerprints differ in at most ``distance`` bits and each part i
has a threshold t(i) >= -1 with sum(t) = distance - parts + 1, then in some part
they differ in at most t(i) bits. Every fingerprint picks its own thresholds: a
dynamic program takes those with the fewest expected candidates, so that a part
in which the fingerprint's value is common gets -1 and is not looked at. All
fingerprints are indexed by the value of each part; each then probes the values
within its thresholds, and candidates are verified by their bit distance.

A value shared by very many fingerprints would make a quadratic number of
candidates. The fingerprints that probe or have such a value are instead linked
through the fingerprints one bit away from them: two of them are at most two bits
apart exactly if they share one. At most 65 fingerprints share such a key, each
is linked with the smallest of them, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallymill.llm.components import components
from tallymill.llm.rows import column, digest, packed, text_or_empty, unpacked
from tallymill.session import written

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEED = 42
PARTS = 3

#: Values of a part are counted in so many classes, whatever the size of the data.
HISTOGRAM_BITS = 16
#: A value with more fingerprints than this is linked without candidates.
DENSE = 64
#: The work of one more probe, in candidates.
PROBE_COST = 1.0

_BYTE_COUNTS_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of one text as an unsigned integer.

    A-Z are lower-cased and words are runs of anything but ASCII white space. The
    words of a text shorter than a shingle form one; a text without words gives 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _BYTE_COUNTS_AT_ONCE):
        part = hashes[start : start + _BYTE_COUNTS_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(id, ``digest``, ``bits``): of each row a digest of the text and its fingerprint as a signed 64-bit integer.

    Null texts count as empty.
    """
    text = text_or_empty(text_column)
    chosen = docs.select(column(id_column).alias("id"), digest(text).alias("digest"), text.alias("text"))
    id_type = chosen.schema["id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            columns = [batch.column("id"), batch.column("digest"), pa.array(bits.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "bits"])

    return chosen.mapInArrow(hashed, f"id {id_type}, digest binary, bits long")


def correlations(distinct: DataFrame) -> np.ndarray:
    """Absolute correlation of each pair of bits over all distinct fingerprints; 64 x 64 numbers reach the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            rows = batch.column("bits").to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
            for start in range(0, len(rows), _BYTE_COUNTS_AT_ONCE):
                ones = np.unpackbits(rows[start : start + _BYTE_COUNTS_AT_ONCE], axis=1, bitorder="little").astype(np.float32)
                both += (ones.T @ ones).astype(np.int64)
                n += len(ones)
        places = pa.array(np.arange(BITS * BITS + 1), pa.int64())
        yield pa.RecordBatch.from_arrays([places, pa.array(np.r_[both.ravel(), n])], names=["place", "n"])

    total = np.zeros(BITS * BITS + 1)
    rows = distinct.select("bits").mapInArrow(counted, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    for place, n in rows.collect():
        total[place] = n
    n = max(total[-1], 1)
    joint = total[:-1].reshape(BITS, BITS) / n
    mean = joint.diagonal()
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs((joint - np.outer(mean, mean)) / np.outer(spread, spread))


def grouped_bits(correlation: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Deal the bits into parts of nearly equal width, each bit to the part it correlates with most."""
    left, groups = list(range(BITS)), []
    for part in range(parts):
        width = BITS // parts + (part < BITS % parts)
        among = correlation[np.ix_(left, left)] - np.eye(len(left))
        group = [left[int(np.argmax(among.max(axis=1)))]]
        left.remove(group[0])
        while len(group) < width:
            nearest = left[int(np.argmax(correlation[np.ix_(left, group)].mean(axis=1)))]
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def part_value(bits: Column, group: Sequence[int]) -> Column:
    """The bits of a part, in order, as a number."""
    value = F.lit(0).cast("long")
    for place, bit in enumerate(group):
        value = value.bitwiseOR(F.shiftleft(F.shiftright(bits, bit).bitwiseAND(F.lit(1)), place))
    return value


def part_values(bits: np.ndarray, group: Sequence[int]) -> np.ndarray:
    value = np.zeros(len(bits), np.int64)
    for place, bit in enumerate(group):
        value |= ((bits >> bit) & 1) << place
    return value


def value_counts(distinct: DataFrame, groups: Sequence[Sequence[int]]) -> np.ndarray:
    """For each part, how many distinct fingerprints fall in each class of values; bounded by the classes."""
    classes = (1 << HISTOGRAM_BITS) - 1
    keys = F.array(
        *[(F.lit(i << HISTOGRAM_BITS) + part_value(F.col("bits"), g).bitwiseAND(F.lit(classes))) for i, g in enumerate(groups)]
    )
    rows = distinct.select(F.explode(keys).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    found = np.zeros((len(groups), classes + 1), np.int64)
    for batch in rows.toArrow().to_batches():
        found.ravel()[batch.column("k").to_numpy()] = batch.column("n").to_numpy()
    return found


def thresholds(bits: np.ndarray, groups: Sequence[Sequence[int]], counts: np.ndarray, distance: int) -> np.ndarray:
    """Per fingerprint and part the threshold, -1 for a part that it does not probe.

    A dynamic program over the parts deals out ``distance + 1`` units; u units in
    a part mean threshold u - 1. The expected candidates of a threshold are read
    from the counts of the values it would probe.
    """
    units = distance + 1
    classes = counts.shape[1] - 1
    best = np.full((units + 1, len(bits)), np.inf)
    best[0] = 0
    choice = []
    for part, group in enumerate(groups):
        value = part_values(bits, group)
        cost = np.zeros((units + 1, len(bits)))
        for u in range(1, units + 1):
            cost[u] = cost[u - 1]
            for flips in combinations(range(len(group)), u - 1):
                mask = sum(1 << f for f in flips)
                cost[u] += counts[part][(value ^ mask) & classes] + PROBE_COST
        after, picked = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for total in range(units + 1):
            for u in range(total + 1):
                candidate = best[total - u] + cost[u]
                better = candidate < after[total]
                after[total][better], picked[total][better] = candidate[better], u
        best = after
        choice.append(picked)
    result = np.empty((len(bits), len(groups)), np.int8)
    left = np.full(len(bits), units)
    for part in range(len(groups) - 1, -1, -1):
        used = choice[part][left, np.arange(len(bits))]
        result[:, part] = used - 1
        left = left - used
    return result


def links(distinct: DataFrame, distance: int = DISTANCE, parts: int = PARTS, dense: int = DENSE) -> DataFrame:
    """(``a``, ``b``): links between distinct fingerprints in column ``bits``.

    All are at most ``distance`` bits apart, and every pair so close is connected
    by them, directly or through others.
    """
    if distance != 2:
        raise ValueError("very common values are resolved for a distance of 2 bits only")
    groups = grouped_bits(correlations(distinct), parts)
    counts = value_counts(distinct, groups)
    widest = max(map(len, groups))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_bits = batch.column("bits").to_numpy()
            for start in range(0, len(all_bits), 4096):
                bits = all_bits[start : start + 4096]
                allowed = thresholds(bits, groups, counts, distance)
                keys, sources = [], []
                for part, group in enumerate(groups):
                    value = part_values(bits, group)
                    for t in range(distance + 1):
                        chosen = allowed[:, part] >= t
                        if chosen.any():
                            for flips in combinations(range(len(group)), t):
                                keys.append((part << widest) + (value[chosen] ^ sum(1 << f for f in flips)))
                                sources.append(bits[chosen])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(sources))], names=["k", "a"]
                )

    index_keys = F.array(*[F.lit(i << widest) + part_value(F.col("bits"), g) for i, g in enumerate(groups)])
    index = distinct.select(F.explode(index_keys).alias("k"), F.col("bits").alias("b"))
    probed = written(distinct.select("bits").mapInArrow(probes, "k long, a long"), "probes")
    common = written(index.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > dense).select("k"), "common")

    few = probed.join(common, "k", "left_anti").join(index, "k").filter(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    near = few.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowd = (
        probed.join(common, "k", "left_semi")
        .select("a")
        .unionByName(index.join(common, "k", "left_semi").select(F.col("b").alias("a")))
        .distinct()
    )
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(BITS)])
    balls = crowd.select("a", F.explode(flips).alias("flip")).select(F.col("a").bitwiseXOR(F.col("flip")).alias("k"), "a")
    centre = balls.groupBy("k").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return near.unionByName(balls.join(centre, "k").filter("a != b").select("a", "b"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    parts: int = PARTS,
    dense: int = DENSE,
) -> DataFrame:
    """(id, ``fingerprint``, ``component_id``, ``text_digest``, ``stays``) of every row.

    ``component_id`` is the smallest id among the rows whose fingerprints are
    linked, directly or through others, the row's own included. ``stays`` marks the
    row that stands for the component: that of the smallest id, null after all others,
    and of several such rows the one with the least digest of its text; rows that are
    equal in both are marked alike. Null and empty texts have fingerprint zero and are
    linked like any other. Rows with a null id are linked but never name a component;
    one that reaches no id has null. Repeated rows each give their row, an empty table
    gives none, and other columns are ignored whatever their names.
    """
    hashed = written(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "digest")).alias("first")
    distinct = written(hashed.groupBy("bits").agg(first), "distinct-fingerprints")
    linked = components(links(distinct, distance, parts, dense), "a", "b")
    member = distinct.join(linked, distinct["bits"] == linked["node"], "left").select(
        "bits", "first", F.coalesce("component", "bits").alias("component")
    )
    smallest = member.groupBy("component").agg(F.min("first").alias("least"))
    named = member.join(smallest, "component").select("bits", F.col("least.id").alias("component_id"), F.col("least.digest").alias("least"))
    return hashed.join(named, "bits").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("digest").alias("text_digest"),
        (F.col("id").eqNullSafe(F.col("component_id")) & (F.col("digest") == F.col("least"))).alias("stays"),
    )


def keep_one(docs: DataFrame, groups: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` less all but one row of each component of ``near_duplicates``, columns unchanged.

    Rows are told apart by id and text, so rows that share an id stay or go each on
    its own account. Of equal ones that would all stay, one does.
    """
    key = ["id", "digest"]
    rows = packed(docs, id=column(id_column), digest=digest(text_or_empty(text_column)))
    marked = groups.select(column(id_column).alias("_id"), F.col("text_digest").alias("_digest"), "stays")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    kept = rows.join(marked.filter(~F.col("stays")).distinct(), same, "left_anti")
    again = written(marked.filter("stays").groupBy("_id", "_digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated-rows")
    if not again.isEmpty():
        first = kept.join(again, same, "left_semi").dropDuplicates(key)
        kept = kept.join(again, same, "left_anti").unionByName(first)
    return unpacked(kept, docs.columns)
