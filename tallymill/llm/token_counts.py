"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into words by the tokenizer's pattern. The bytes of a word form a
linked list of symbols; its adjacent pairs wait in a heap ordered by merge rank.
The lowest pair is merged again and again, and the count is the number of
bytes less the number of merges. No token identifier is ever looked up.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tallymill.llm.vocabulary import default_path, load

#: How the byte-level tokenizer cuts text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words whose counts a process remembers; beyond it the memory starts anew.
REMEMBERED = 600_000


def merged(symbols: Sequence[str], ranks: Mapping[tuple[str, str], int]) -> int:
    """The number of merges that byte-pair encoding makes in one word."""
    n = len(symbols)
    here = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank_of = ranks.get
    # The rank of the pair that starts at each symbol, as it is now; no pair: None.
    pair = [rank_of(p) for p in zip(here, here[1:])]
    pair.append(None)
    # One number orders by rank and then by place.
    heap = [rank * n + i for i, rank in enumerate(pair) if rank is not None]
    heapify(heap)
    merges = 0
    while heap:
        rank, left = divmod(heappop(heap), n)
        if pair[left] != rank:  # one of its symbols has been merged meanwhile
            continue
        merges += 1
        right = after[left]
        here[left] += here[right]
        pair[right] = None
        following = after[left] = after[right]
        if following < n:
            before[following] = left
            pair[left] = rank = rank_of((here[left], here[following]))
            if rank is not None:
                heappush(heap, rank * n + left)
        else:
            pair[left] = None
        previous = before[left]
        if previous >= 0:
            pair[previous] = rank = rank_of((here[previous], here[left]))
            if rank is not None:
                heappush(heap, rank * n + previous)
    return merges


class WordCounts(dict):
    """Token counts of words, worked out when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        vocabulary = load(path)
        self._ranks, self._symbols = vocabulary.merges, vocabulary.byte_symbols

    def __missing__(self, word: str) -> int:
        symbols = [self._symbols[b] for b in word.encode()]
        count = len(symbols) - merged(symbols, self._ranks)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = count
        return count


@lru_cache(maxsize=2)
def _remembered(path: str) -> WordCounts:
    return WordCounts(path)


def count_tokens(text: str, path: str) -> int:
    """Tokens of one text. An added token's string inside the text is one token."""
    counts, words = _remembered(path), regex.compile(WORD_PATTERN)
    total = 0
    for place, part in enumerate(load(path).segments(text)):
        total += 1 if place % 2 else sum(map(counts.__getitem__, words.findall(part)))
    return total


def token_counts(
    docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text", limit: int = 1024
) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` of every row's whole text.

    Null texts count as empty: 0 bytes, 0 tokens. Rows with a null or repeated id
    each give their row, an empty table gives none, and other columns are ignored
    whatever their names. Nothing is shuffled.
    """
    path = path or default_path("byte_bpe_50k.json")
    chosen = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    id_type = chosen.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [count_tokens(text.as_py(), path) for text in batch.column("text")]
            sizes = [len(text.as_buffer()) if text.is_valid else 0 for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    counted = chosen.mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
