"""Removal of byte strings that occur more than once, by suffix arrays over candidate passages.

A string of ``length`` bytes is one window of a text. Every window has an anchor:
of the shorter grams inside it, the first with the least hash. Equal windows have
equal anchors at equal places, so repeats need to be looked for only among windows
whose anchors have the same hash. Neighbouring windows of one anchor make up a
passage, at most twice as long as a window.

1. Anchors are counted; those that occur once are dropped, and most text with them.
2. Of each different passage that shares its anchor one occurrence is cut from its
   text, and a second one, from elsewhere, if it occurs again. (Passages are told
   apart by 128 bits of hash: n of them meet by chance with odds of n^2 to 2^129.)
3. The passages of an anchor are brought together, joined into strings, and sorted
   into suffix arrays by grouping (``suffix_grouping``). Symbols are phrases of some words,
   ranked by their bytes, so that the order of phrases and of bytes agree; windows that
   start inside a phrase follow from the rank of the suffix behind it. Bytes decide which
   windows are equal.
4. An anchor with very many different passages is not brought together: its windows
   are counted one by one, by 128 bits of hash: within a batch where the passages are
   read, and over all batches by one row for each window and batch.
5. The repeated windows of each text are united and cut out.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymill.llm.key_filter import KeyFilter, key_filter
from tallymill.llm.rows import column, digest, packed, text_or_empty, unpacked
from tallymill.llm.suffix_grouping import suffix_array
from tallymill.session import written

LENGTH = 200
#: Bytes of the grams that serve as anchors.
GRAM = 32
#: Anchors with more different passages than this are counted window by window.
CROWD = 4096
#: Bytes of passages that go into one suffix array, about.
BATCH_BYTES = 1 << 20

#: Words of a phrase, about: a power of two.
_PHRASE = 4
_PIECE = 1 << 22
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """A number for each byte, drawn from a fixed hash."""
    return np.array([xxhash.xxh64_intdigest(bytes([b]), 7) | 1 for b in range(256)], np.uint64)


@lru_cache(maxsize=2)
def _powers(base: int) -> np.ndarray:
    powers = np.ones(_PIECE + 2 * LENGTH + 2, np.uint64)
    filled = 1
    while filled < len(powers):
        n = min(filled, len(powers) - filled)
        powers[filled : filled + n] = powers[:n] * np.uint64(pow(base, filled, 1 << 64))
        filled += n
    return powers


def _prefix(flat: np.ndarray) -> np.ndarray:
    terms = _table()[flat] * _powers(_BASE)[: len(flat)]
    return np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def passages(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors' hashes and the windows of each passage, as ranges of window starts.

    Very long texts are worked through in pieces that overlap by a window.
    """
    found = []
    piece = max(_PIECE, 2 * length)
    for at in range(0, max(len(data) - length + 1, 0), piece):
        found.append([at + np.int64(0), *_passages(data[at : at + piece + length - 1], length, gram)])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = np.concatenate([k for _, k, _, _ in found])
    starts = np.concatenate([s + at for at, _, s, _ in found])
    ends = np.concatenate([e + at for at, _, _, e in found])
    return keys, starts, ends


def _passages(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(data, np.uint8)
    prefix = _prefix(flat)
    grams = _mixed((prefix[gram:] - prefix[:-gram]) * _powers(_INVERSE)[: len(flat) - gram + 1])
    width = length - gram + 1
    least, covered = grams, 1
    while covered * 2 <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < width:
        least = np.minimum(least[: len(least) - (width - covered)], least[width - covered :])
    # A new anchor begins when the least hash changes, or when the old anchor has left the window.
    left = grams[: len(least) - 1] == least[:-1]
    change = np.flatnonzero((least[1:] != least[:-1]) | left) + 1
    starts = np.concatenate([[0], change])
    return least[starts], starts, np.concatenate([change, [len(least)]])


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def repeated_windows(texts: Sequence[bytes], length: int = LENGTH, copies: Sequence[int] | None = None) -> list[np.ndarray]:
    """For each text, whether the window at each start also occurs elsewhere in these texts.

    ``copies`` tells how many copies each text stands for: a window that occurs once in
    the suffix array counts as often as its text.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    data = b"".join(texts)
    flat = np.frombuffer(data, np.uint8)
    if not len(flat):
        return [np.zeros(0, bool) for _ in texts]
    text_of = np.repeat(np.arange(len(texts)), sizes)
    # A word ends with its first white space, so that no word is a prefix of another,
    # but for the last words of texts, which come first as the ends of texts do.
    is_start = np.empty(len(flat), bool)
    is_start[1:] = flat[:-1] <= 0x20
    begins = (ends - sizes)[sizes > 0]
    is_start[begins] = True
    words = np.flatnonzero(is_start)
    prefix, back = _prefix(flat), _powers(_INVERSE)
    # A symbol is a phrase: words up to one whose hash says so. Equal words end phrases
    # alike, so that no phrase is a prefix of another either, and there are fewer symbols.
    word_stops = np.append(words[1:], len(flat))
    last = _mixed((prefix[word_stops] - prefix[words]) * back[words]) & np.uint64(_PHRASE - 1) == 0
    opens = np.zeros(len(words), bool)
    opens[np.searchsorted(words, begins)] = True
    opens[1:] |= last[:-1]
    starts = words[opens]
    stops = np.append(starts[1:], len(flat))
    phrases = [data[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
    ranks = {phrase: rank for rank, phrase in enumerate(sorted(set(phrases)), start=1)}
    owner = text_of[starts]
    symbols = np.zeros(len(phrases) + len(texts), np.int64)
    place = np.arange(len(phrases)) + owner
    symbols[place] = [ranks[phrase] for phrase in phrases]
    order = suffix_array(symbols)
    order = order[symbols[order] > 0]
    phrase_at = np.full(len(symbols), -1, np.int64)
    phrase_at[place] = np.arange(len(phrases))
    order = phrase_at[order]
    rank = np.empty(len(phrases), np.int64)
    rank[order] = np.arange(len(phrases))

    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([flat, np.zeros(length, np.uint8)]), length)
    rest = ends[owner] - starts
    common = _common(windows, starts[order], rest[order], length)
    several = np.zeros(len(texts), bool) if copies is None else np.asarray(copies) > 1
    repeated = np.zeros(len(flat), bool)
    # Each window starts ``inside`` bytes before the end of a phrase: the rank of the
    # suffix behind that phrase, and the bytes before it, tell equal windows. The phrase is
    # the first one of which the last word starts behind the window's start: what comes
    # before a window, or the word in which it starts, plays no part, as a text may begin anywhere.
    stop_rank = np.append(rank[1:], -1)
    text_end = ends[owner]
    last_word = words[np.append(np.flatnonzero(opens)[1:], len(words)) - 1]
    # Windows of this phrase start from the last word of the phrase before it in the text.
    from_byte = np.where(np.append(False, owner[1:] == owner[:-1]), np.append(0, last_word[:-1]), starts)
    # The last phrase of a text ends with the text, where no window ends before it does.
    ended = np.append(owner[1:] == owner[:-1], False)[: len(owner)]
    least, most = stops - last_word + 1, stops - from_byte

    def mark(at: np.ndarray, upto: int, kind: np.ndarray | int) -> None:
        """Mark the windows whose first bytes and kinds are equal, and that are equal throughout."""
        key = _mixed((prefix[at + upto] - prefix[at]) * back[at]) + np.uint64(_BASE) * np.asarray(kind).astype(np.uint64)
        by_key = np.argsort(key, kind="stable")
        at, key = at[by_key], key[by_key]
        repeated[at] |= several[text_of[at]]
        pair = np.flatnonzero(key[1:] == key[:-1])
        for cut in range(0, len(pair), 8192):
            some = pair[cut : cut + 8192]
            equal = some[(windows[at[some]] == windows[at[some + 1]]).all(axis=1)]
            repeated[at[equal]] = True
            repeated[at[equal + 1]] = True

    for inside in range(2, min(int(most.max(initial=0)) + 1, length)):
        chosen = np.flatnonzero(ended & (least <= inside) & (inside <= most) & (stops - inside + length <= text_end))
        if len(chosen):
            same_as_last = np.cumsum(np.append(0, common < length - inside))
            mark(stops[chosen] - inside, inside, same_as_last[stop_rank[chosen]])
    # Windows that no phrase ends inside of.
    whole = np.zeros(len(flat) + 1, np.int64)
    upto = np.where(ended, np.minimum(last_word, stops - length + 1), stops - length + 1)
    wide = np.flatnonzero(upto > from_byte)
    np.add.at(whole, from_byte[wide], 1)
    np.add.at(whole, upto[wide], -1)
    at = np.flatnonzero(np.cumsum(whole)[:-1] > 0)
    at = at[at + length <= ends[text_of[at]]]
    if len(at):
        mark(at, length, 0)
    begins = ends - sizes
    return [repeated[b : max(b, e - length + 1)] for b, e in zip(begins.tolist(), ends.tolist())]


def _common(windows: np.ndarray, starts: np.ndarray, rest: np.ndarray, length: int) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it, at most ``length`` and to the ends of texts."""
    found = np.empty(max(len(starts) - 1, 0), np.int64)
    for cut in range(0, len(found), 8192):
        upto = min(cut + 8192, len(found))
        differ = windows[starts[cut:upto]] != windows[starts[cut + 1 : upto + 1]]
        found[cut:upto] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return np.minimum(found, np.minimum(rest[:-1], rest[1:])) if len(found) else found


def ranges(flags: np.ndarray) -> list[int]:
    """Starts and ends, in turn, of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.tolist()


# --- the steps in Spark ---------------------------------------------------------------------------


def _identified(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows by their id and a digest of the text, so that rows that share an id, or have none, stay apart."""
    text = text_or_empty(text_column)
    return docs.select(column(id_column).alias("id"), digest(text).alias("h"), text.alias("text"))


def _anchor_counts(rows: DataFrame, length: int) -> DataFrame:
    """(``key``): hashes of the anchors that occur more than once. Each batch is counted before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [passages(t.as_py().encode(), length)[0] for t in batch.column("text")]
            found, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.uint64), [])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    long_enough = rows.filter(F.octet_length("text") >= length).select("text")
    counted = long_enough.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return written(counted.filter("n > 1").select("key"), "anchors")


def _occurrences(rows: DataFrame, length: int, wanted: KeyFilter) -> DataFrame:
    """One row for each text and distinct passage whose anchor may be ``wanted``: anchor, hash, windows, and where it starts."""
    id_type = rows.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_of, columns = [], [[] for _ in range(4)]
            for row, text in enumerate(batch.column("text")):
                data = text.as_py().encode()
                keys, starts, ends = passages(data, length)
                known = wanted.may_hold(keys)
                keys, starts, ends = keys[known], starts[known], ends[known]
                here: dict[tuple[int, int], list[int]] = {}
                shape = {}
                for key, start, end in zip(_signed(keys), starts.tolist(), ends.tolist()):
                    passage = (key, xxhash.xxh3_64_intdigest(data[start : end + length - 1]))
                    here.setdefault(passage, []).append(start)
                    shape[passage] = end - start
                for (key, content), at in here.items():
                    for column, value in zip(columns, (key, content, shape[key, content], np.array(at, "<i4").tobytes())):
                        column.append(value)
                id_of += [row] * len(here)
            taken = pa.array(id_of, pa.int32())
            key, content, windows, starts = columns
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(taken), batch.column("h").take(taken), pa.array(key, pa.int64()),
                    pa.array(np.array(content, np.uint64).view(np.int64)), pa.array(windows, pa.int32()), pa.array(starts, pa.binary()),
                ],
                names=["id", "h", "key", "content", "windows", "starts"],
            )

    schema = f"id {id_type}, h binary, key long, content long, windows int, starts binary"
    return rows.filter(F.octet_length("text") >= length).mapInArrow(find, schema)


def _bodies(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(``key``, ``content``, ``kinds``, ``body``): the bytes of passages, cut from the texts that hold them."""
    lists = wanted.groupBy("id", "h").agg(F.collect_list(F.struct("key", "content", "start", "windows", "kinds")).alias("cuts"))
    lists = lists.withColumnsRenamed({"id": "_id", "h": "_h"})
    joined = rows.join(lists, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))).select("text", "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column("cuts")
            fields = cuts.flatten()
            sizes = cuts.value_lengths().to_pylist()
            texts = iter(batch.column("text"))
            bodies = []
            starts, windows = fields.field("start").to_pylist(), fields.field("windows").to_pylist()
            at = 0
            for size in sizes:
                data = next(texts).as_py().encode()
                for i in range(at, at + size):
                    bodies.append(data[starts[i] : starts[i] + windows[i] + length - 1])
                at += size
            columns = [fields.field("key"), fields.field("content"), fields.field("kinds"), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "content", "kinds", "body"])

    return joined.mapInArrow(cut, "key long, content long, kinds long, body binary")


def _sorted_out(bodies: DataFrame, length: int) -> DataFrame:
    """(``key``, ``content``, ``ranges``): repeated windows of passages that share an anchor, by suffix arrays."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, bytes]] = []
        held, last = 0, None
        for batch in batches:
            columns = (batch.column("key").to_pylist(), batch.column("content").to_pylist(), batch.column("body"))
            for key, content, body in zip(*columns):
                # All passages of an anchor go into one array; arrays are cut between anchors.
                if held >= BATCH_BYTES and key != last:
                    yield found(waiting)
                    waiting, held = [], 0
                waiting.append((key, content, body.as_py()))
                held, last = held + len(waiting[-1][2]), key
        if waiting:
            yield found(waiting)

    def found(waiting: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        # The two occurrences of a passage are one text of the array if their bytes are equal.
        copies = Counter(waiting)
        flags = repeated_windows([body for _, _, body in copies], length, list(copies.values()))
        united: dict[tuple[int, int], np.ndarray] = {}
        for (key, content, _), f in zip(copies, flags):
            other = united.get((key, content))
            united[key, content] = f if other is None or len(other) != len(f) else f | other
        rows = [(key, content, ranges(f)) for (key, content), f in united.items() if f.any()]
        columns = list(zip(*rows)) if rows else [(), (), ()]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "content", "ranges"])

    together = bodies.repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(search, "key long, content long, ranges array<int>")


def _counted_out(bodies: DataFrame, length: int) -> DataFrame:
    """As ``_sorted_out``, by counting every window on its own; no anchor's passages are brought together.

    Windows that repeat within about ``BATCH_BYTES`` of passages are decided there. One
    row stands for all of them in the count over the whole table, which asks about the
    others: a window has at most one row for each batch, however often it occurs.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, bytes]] = []
        held = 0
        for batch in batches:
            for passage in zip(batch.column("key").to_pylist(), batch.column("content").to_pylist(), batch.column("body")):
                waiting.append((*passage[:2], passage[2].as_py()))
                held += len(waiting[-1][2])
                if held >= BATCH_BYTES:
                    yield from counted(waiting)
                    waiting, held = [], 0
        if waiting:
            yield from counted(waiting)

    def counted(waiting: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        bodies = [body for _, _, body in waiting]
        sizes = np.array([len(body) - length + 1 for body in bodies], np.int64)
        ends = np.cumsum(sizes)
        marks = b"".join(xxhash.xxh3_128_digest(body[i : i + length]) for body in bodies for i in range(len(body) - length + 1))
        halves = np.frombuffer(marks, "<u8").reshape(-1, 2)
        order = np.lexsort((halves[:, 0], halves[:, 1]))
        same = (halves[order[1:]] == halves[order[:-1]]).all(axis=1)
        repeated = np.zeros(len(order), bool)
        repeated[order[1:][same]] = repeated[order[:-1][same]] = True
        # What is decided here: the passages' ranges, without a mark.
        rows = [
            (None, key, content, ranges(repeated[end - size : end]))
            for (key, content, _), size, end in zip(waiting, sizes.tolist(), ends.tolist())
            if repeated[end - size : end].any()
        ]
        if rows:
            yield as_batch(rows)
        # One row for each different window; the passage is asked for if it is the only one here.
        owner = np.repeat(np.arange(len(sizes)), sizes)
        first = np.sort(order[np.append(True, ~same)])
        for cut in range(0, len(first), 1 << 15):
            chosen = first[cut : cut + (1 << 15)]
            start = chosen - (ends - sizes)[owner[chosen]]
            rows = []
            for i, at, who, known in zip(chosen.tolist(), start.tolist(), owner[chosen].tolist(), repeated[chosen].tolist()):
                mark = marks[16 * i : 16 * i + 16]
                rows.append((mark, None, None, None) if known else (mark, *waiting[who][:2], [at, at + 1]))
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = {"mark": pa.binary(), "key": pa.int64(), "content": pa.int64(), "ranges": pa.list_(pa.int32())}
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))

    marked = written(bodies.mapInArrow(windows, "mark binary, key long, content long, ranges array<int>"), "windows")
    asked = marked.filter("mark IS NOT NULL").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("mark")))
    found = marked.filter("mark IS NULL").unionByName(asked.filter("n > 1 AND key IS NOT NULL").drop("n"))
    # Ranges are united when they are cut out.
    return found.groupBy("key", "content").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def _removals(rows: DataFrame, length: int, crowd: int) -> DataFrame:
    """(``id``, ``h``, ``marks``): where the repeated windows of each text are."""
    anchors = _anchor_counts(rows, length)
    # The filter drops most passages where they are read; the join behind it decides.
    occurrences = written(_occurrences(rows, length, key_filter(anchors)).join(anchors, "key"), "passages")
    places = F.octet_length("starts") / 4
    place = F.struct("id", "h", "starts")
    distinct = written(
        occurrences.groupBy("key", "content").agg(
            F.sum(places).cast("long").alias("n"), F.min("windows").alias("windows"), F.min(place).alias("at"), F.max(place).alias("to")
        ),
        "distinct-passages",
    )
    kinds = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    unclear = distinct.join(kinds, "key").filter("n > 1 OR kinds > 1")
    # The first occurrence, and the last one where there are several.
    cuts = F.array(
        F.struct("at.id", "at.h", _start(F.substring("at.starts", 1, 4)).alias("start")),
        F.when(F.col("n") > 1, F.struct("to.id", "to.h", _start(F.substring("to.starts", -4, 4)).alias("start"))),
    )
    wanted = unclear.select("key", "content", "windows", "kinds", F.explode(F.array_compact(cuts)).alias("cut"))
    wanted = wanted.select("key", "content", "windows", "kinds", "cut.id", "cut.h", "cut.start")
    bodies = written(_bodies(rows, wanted, length), "bodies")
    verdicts = _sorted_out(bodies.filter(F.col("kinds") <= crowd), length).unionByName(
        _counted_out(bodies.filter(F.col("kinds") > crowd), length)
    )
    verdicts = written(verdicts, "verdicts")
    marked = occurrences.join(verdicts, ["key", "content"]).select("id", "h", F.struct("starts", "ranges").alias("mark"))
    return marked.groupBy("id", "h").agg(F.collect_list("mark").alias("marks"))


def _start(four_bytes: Column) -> Column:
    """A 32-bit little-endian integer."""
    byte = lambda i: F.conv(F.hex(F.substring(four_bytes, i, 1)), 16, 10).cast("int")
    return byte(1) + byte(2) * 256 + byte(3) * 65536 + byte(4) * 16777216


def _spans(marks, length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes covered by repeated windows."""
    if not marks:
        return []
    pieces = []
    for mark in marks:
        starts = np.frombuffer(mark["starts"], "<i4").astype(np.int64)
        edges = np.array(mark["ranges"], np.int64).reshape(-1, 2)
        low = (starts[:, None] + edges[:, 0]).ravel()
        high = (starts[:, None] + edges[:, 1] + length - 1).ravel()
        pieces.append(np.stack([low, high], axis=1))
    covered = np.concatenate(pieces)
    covered = covered[np.argsort(covered[:, 0], kind="stable")]
    reach = np.maximum.accumulate(covered[:, 1])
    opens = np.flatnonzero(np.append(True, covered[1:, 0] > reach[:-1]))
    closes = np.append(opens[1:], len(covered)) - 1
    return list(zip(covered[opens, 0].tolist(), reach[closes].tolist()))


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for span in spans for edge in span), len(data)]
    return b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def _with_marks(rows: DataFrame, length: int, crowd: int) -> DataFrame:
    marks = _removals(rows, length, crowd).withColumnsRenamed({"id": "_id", "h": "_h"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    return rows.join(marks, same, "left").drop("_id", "_h")


def removed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, crowd: int = CROWD
) -> DataFrame:
    """(id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``) of every row.

    Each byte is removed that is covered by a string of ``length`` bytes that also
    starts elsewhere, in this or another row; overlapping strings count, and the
    input decides, not what is left. Null texts count as empty. Equal rows repeat
    each other like any other. An empty table gives none, and other columns are
    ignored whatever their names.
    """
    marked = _with_marks(_identified(docs, id_column, text_column), length, crowd).select("id", "text", "marks")
    id_type = marked.schema["id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, marks in zip(batch.column("text"), batch.column("marks")):
                data, spans = text.as_py().encode(), _spans(marks.as_py(), length)
                rows.append((len(data), sum(b - a for a, b in spans), len(spans), hashlib.sha256(_kept(data, spans)).hexdigest()))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    found = marked.mapInArrow(digest, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return found.withColumnRenamed("id", id_column)


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, crowd: int = CROWD
) -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts; rows and columns stay, whatever the columns' names.

    A character of which only some bytes are left is dropped. ``n_chars``, where
    there is such a column, is the new length. Null texts stay null.
    """
    marks = _removals(_identified(docs, id_column, text_column), length, crowd).withColumnsRenamed({"id": "_id", "h": "_h"})
    rows = packed(docs, id=column(id_column), h=digest(text_or_empty(text_column)), text=column(text_column))
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, marks in batches:
            yield pa.array(
                [
                    text.as_py() if not marked.is_valid or not text.is_valid
                    else _kept(text.as_py().encode(), _spans(marked.as_py(), length)).decode("utf-8", "ignore")
                    for text, marked in zip(texts, marks)
                ],
                pa.string(),
            )

    result = joined.select("row", cut(F.col("text"), F.col("marks")).alias("text"))
    changed = {text_column: F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return unpacked(result, docs.columns, **changed)
