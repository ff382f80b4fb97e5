"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for each position, the sum of its code points
times the powers of a base, modulo a prime. The hash of any span is a difference
of two entries; spans are compared by bringing both to the same power, and the
longest common extension of two positions is found by binary search over lengths.

The fingerprint of a text is the hash of the whole text, and a sketch of the
hashes of all its spans of a fixed length: the least hash of each of a number of
bins, cut to two bytes. The likeness of two fingerprints is the share of equal
bins, which estimates how many of their spans two texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tallymill.session import written

#: Two primes below 2^31 and the bases of the hashes modulo each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)

#: Code points of a span of the sketch, and bins of the sketch.
SPAN = 12
BINS = 64


@lru_cache(maxsize=4)
def _powers(which: int, log2_size: int) -> np.ndarray:
    """The first 2^log2_size powers of a base, each the product of two earlier ones."""
    prime, base = np.uint64(PRIMES[which]), BASES[which]
    powers = np.ones(1 << log2_size, np.uint64)
    for k in range(log2_size):
        step = np.uint64(pow(base, 1 << k, PRIMES[which]))
        powers[1 << k : 2 << k] = powers[: 1 << k] * step % prime
    return powers


class PrefixHash:
    """Prefix arrays of one text modulo both primes."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.size = len(points)
        log2_size = max(int(self.size).bit_length(), 10)
        self._powers = [_powers(i, log2_size) for i in range(2)]
        self._prefix = []
        for i, prime in enumerate(PRIMES):
            terms = points * self._powers[i][: self.size] % np.uint64(prime)
            # Terms are below 2^31, so that 2^33 of them can be added before the remainder.
            self._prefix.append(np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)]) % np.uint64(prime))

    def spans(self, which: int, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the spans of one length at the given starts, free of where they start."""
        prime = np.uint64(PRIMES[which])
        prefix, powers = self._prefix[which], self._powers[which]
        raw = (prefix[starts + length] + prime - prefix[starts]) % prime
        # The power of the start is taken up to that of the last possible start.
        return raw * powers[(len(powers) - 1) - starts] % prime

    def equal(self, i: int, other: PrefixHash, j: int, length: int) -> bool:
        """Whether the spans of a length at i here and at j in another text are equal."""
        if i + length > self.size or j + length > other.size:
            return False
        for which, prime in enumerate(PRIMES):
            own = (int(self._prefix[which][i + length]) - int(self._prefix[which][i])) % prime
            its = (int(other._prefix[which][j + length]) - int(other._prefix[which][j])) % prime
            if own * int(other._powers[which][j]) % prime != its * int(self._powers[which][i]) % prime:
                return False
        return True

    def common_extension(self, i: int, other: PrefixHash, j: int) -> int:
        """The length of the longest equal spans at i here and at j in another text."""
        low, high = 0, min(self.size - i, other.size - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def common_ending(self, other: PrefixHash) -> int:
        """The length of the longest equal spans at the ends of both texts."""
        low, high = 0, min(self.size, other.size)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(self.size - middle, other, other.size - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def whole(self) -> str:
        return "".join(f"{int(prefix[-1]):08x}" for prefix in self._prefix) + f"{self.size:08x}"


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of span hashes over 64 bits."""
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def fingerprint(text: str) -> str:
    """The fingerprint of a text, see ``fingerprint_of``."""
    return fingerprint_of(PrefixHash(text))


def fingerprint_of(hashes: PrefixHash) -> str:
    """The hash of the text (24 hexadecimal digits) and its sketch (4 for each bin).

    Texts shorter than a span are one span; the empty text has none, and all its
    bins are empty. An empty bin is ffff.
    """
    bins = np.full(BINS, 0xFFFF, np.uint64)
    if hashes.size:
        length = min(SPAN, hashes.size)
        starts = np.arange(hashes.size - length + 1)
        # The start's power is made the same for all texts: see spans().
        size = len(hashes._powers[0])
        shift = [pow(BASES[i], -(size - 1), PRIMES[i]) for i in range(2)]
        value = hashes.spans(0, starts, length) * np.uint64(shift[0]) % np.uint64(PRIMES[0])
        value = _mixed((value << np.uint64(32)) + np.uint64(length))
        least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
        place = (value & np.uint64(BINS - 1)).astype(np.intp)
        # Only small values can be the least of a bin; the rest is dropped first.
        cut = np.uint64(min(np.iinfo(np.uint64).max, (np.iinfo(np.uint64).max // max(len(value), 1)) * BINS * 12))
        small = value <= cut
        np.minimum.at(least, place[small], value[small])
        if (least == np.iinfo(np.uint64).max).any() and not small.all():
            np.minimum.at(least, place, value)
        full = least != np.iinfo(np.uint64).max
        bins[full] = np.minimum((least[full] >> np.uint64(8)) & np.uint64(0xFFFF), np.uint64(0xFFFE))
    return hashes.whole() + "".join(f"{int(b):04x}" for b in bins)


def likeness(one: str, other: str) -> float:
    """The share of equal bins among those not empty in both; 1.0 for equal fingerprints."""
    if one == other:
        return 1.0
    pairs = [(one[i : i + 4], other[i : i + 4]) for i in range(24, 24 + 4 * BINS, 4)]
    pairs = [p for p in pairs if p != ("ffff", "ffff")]
    return sum(a == b for a, b in pairs) / len(pairs) if pairs else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc_id, text: str, hashes: PrefixHash, mark: str, following: str, next_hashes: PrefixHash, next_mark: str) -> tuple:
    changed = edited(text, following)
    changed_hashes = PrefixHash(changed)
    changed_mark = fingerprint_of(changed_hashes)
    return (
        doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), mark, changed_mark,
        likeness(mark, changed_mark), likeness(mark, next_mark),
        hashes.common_extension(0, changed_hashes, 0), hashes.common_ending(changed_hashes),
        hashes.common_extension(0, next_hashes, 0), hashes.common_ending(next_hashes),
    )


_RESULT = [
    "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "start_edited", "end_edited",
    "start_next", "end_next",
]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), *[pa.int64()] * 4]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``fingerprint``) of every row. Null texts count as empty."""
    mark = F.pandas_udf(lambda texts: texts.map(fingerprint), "string")
    return docs.select(F.col(id_column), mark(F.coalesce(F.col(text_column), F.lit(""))).alias("fingerprint"))


def compared(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and its likeness to that and to the next row's.

    Beside them, how many code points the text has in common with either at the start
    (``start_edited``, ``start_next``) and at the end (``end_edited``, ``end_next``): its longest
    common extensions with them there, found by binary search over the prefix hashes.

    The next row is that with the next smaller id, and after the last comes the
    first; a single row is its own next. Rows with a null id come last, repeated
    ids by a hash of their texts. Null texts count as empty. An empty table gives none, and
    other columns are ignored whatever their names.

    The texts are shuffled once, into ranges of ids. A row is compared with the one
    behind it as its range is read; only the first and last row of a range wait for
    the neighbouring ranges, of which they are the ends.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # Texts are ordered by their hashes, as the bounds of the ranges go through the driver.
    order = [F.desc_nulls_last("id"), F.xxhash64("text")]
    ordered = chosen.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = arrow_id = None
        for batch in batches:
            arrow_id = batch.schema.field("id").type
            done, first = [], None
            part = batch.column("part")[0].as_py() if batch.num_rows else None
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                hashes = PrefixHash(text.as_py())
                here = (doc_id.as_py(), text.as_py(), hashes, fingerprint_of(hashes))
                if held is None:
                    first = here
                else:
                    done.append(_row(*held, *here[1:]))
                held = here
            if first is not None:
                yield ends([("first", part, first[0], first[1], first[3])], arrow_id)
            if done:
                yield results(done, arrow_id)
        if held is not None:
            yield ends([("last", part, held[0], held[1], held[3])], arrow_id)

    def results(rows: list[tuple], arrow_id: pa.DataType) -> pa.RecordBatch:
        ids, *columns = zip(*rows)
        empty = [pa.nulls(len(rows), t) for t in (pa.string(), pa.int32(), pa.string())]
        return pa.RecordBatch.from_arrays(
            [*empty, pa.array(ids, arrow_id), *[pa.array(c, t) for c, t in zip(columns, _TYPES)]],
            names=["kind", "part", "text", "id", *_RESULT],
        )

    def ends(rows: list[tuple], arrow_id: pa.DataType) -> pa.RecordBatch:
        kind, part, ids, text, mark = (list(c) for c in zip(*rows))
        columns = {"kind": pa.array(kind), "part": pa.array(part, pa.int32()), "text": pa.array(text), "id": pa.array(ids, arrow_id)}
        rest = [pa.array(mark) if n == "fingerprint" else pa.nulls(len(rows), t) for n, t in zip(_RESULT, _TYPES)]
        return pa.RecordBatch.from_arrays([*columns.values(), *rest], names=[*columns, *_RESULT])

    schema = (
        f"kind string, part int, text string, id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, start_edited long, end_edited long, start_next long, end_next long"
    )
    walked = written(ordered.mapInArrow(walk, schema), "fingerprints")
    done = walked.filter("kind IS NULL")
    # At most one first and one last row for each range, so a single task can order them.
    edges = walked.filter("kind IS NOT NULL")
    firsts = edges.filter("kind = 'first'").select(
        F.col("part").alias("first_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark")
    )
    by_part = W.partitionBy(F.lit(0)).orderBy("first_part")
    whole = W.partitionBy(F.lit(0)).orderBy("first_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ring = firsts.select("first_part").withColumn(
        "next_part", F.coalesce(F.lead("first_part").over(by_part), F.first("first_part").over(whole))
    )
    ring = ring.withColumnsRenamed({"first_part": "part"})
    lasts = edges.filter("kind = 'last'").select("part", "id", "text", "fingerprint").join(ring, "part")
    lasts = lasts.join(firsts, F.col("next_part") == F.col("first_part"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                doc_id, text, mark, after, next_mark = (
                    batch.column(c)[i].as_py() for c in ("id", "text", "fingerprint", "next_text", "next_mark")
                )
                rows.append(_row(doc_id, text, PrefixHash(text), mark, after, PrefixHash(after), next_mark))
            if rows:
                yield results(rows, batch.schema.field("id").type)

    closed = lasts.select("id", "text", "fingerprint", "next_text", "next_mark").mapInArrow(close, schema)
    columns = [F.col("id").alias(id_column), *_RESULT]
    return done.select(columns).unionByName(closed.select(columns))
