"""BPE encoding and decoding by batched numpy merge rounds.

The new words of a batch are laid into one flat array of symbols. In each round
the keys of all adjacent pairs are looked up by binary search in the sorted keys
of the merge table, every word takes its lowest rank, and all pairs of that rank
are merged, from left to right. Rounds end when no word has a pair left.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tallymill.llm.vocabulary import default_path, load

#: How this tokenizer cuts normalised text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words whose tokens a process remembers, and symbols merged in one flat array.
REMEMBERED = 300_000
FLAT_SYMBOLS = 1 << 20

_NO_RANK = np.iinfo(np.int64).max


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        self._vocabulary = v = load(path)
        self._words = regex.compile(WORD_PATTERN)
        self._size = max(v.ids.values()) + 1
        keys = np.array([v.ids[a] * self._size + v.ids[b] for a, b in v.merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order.astype(np.int64)
        self._merged = np.array([v.ids[a + b] for a, b in v.merges], np.int64)
        self._inner = np.array([v.ids[s] for s in v.byte_symbols], np.int64)
        self._last = np.array([v.ids[s + v.word_end] for s in v.byte_symbols], np.int64)
        self._strings = {i: s for s, i in v.ids.items()} | {i: s for s, i in v.added.items()}
        # Of each word: ids as little-endian 32-bit integers, and its decoded tokens.
        self._ids: dict[str, bytes] = {}
        self._tokens: dict[str, str] = {}

    def words(self, text: str) -> list[str]:
        """The words and added tokens of a text in order; added tokens are kept as they are."""
        found: list[str] = []
        for place, part in enumerate(self._vocabulary.segments(text)):
            if place % 2:
                found.append(part)
            elif part:
                found += self._words.findall(self._normal(part))
        return found

    def _normal(self, text: str) -> str:
        # The file also turns white space into single spaces, which no word can hold.
        text = unicodedata.normalize("NFC", text)
        # Lower case code point by code point: str.lower() has a rule of its own for a final sigma.
        return text.lower() if "Σ" not in text else "σ".join(part.lower() for part in text.split("Σ"))

    def learn(self, words: Sequence[str]) -> None:
        """Work out the tokens of words not yet known, in flat arrays of bounded size."""
        added = self._vocabulary.added
        part, size = [], 0
        for word in words:
            if word in added:
                self._ids[word], self._tokens[word] = np.array([added[word]], "<u4").tobytes(), word
                continue
            data = word.encode()
            if part and size + len(data) > FLAT_SYMBOLS:
                self._learn(part)
                part, size = [], 0
            part.append((word, data))
            size += len(data)
        if part:
            self._learn(part)

    def _learn(self, part: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(data) for _, data in part])
        flat = np.frombuffer(b"".join(data for _, data in part), np.uint8)
        symbols = self._inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self._last[flat[ends]]
        owner = np.repeat(np.arange(len(part)), lengths)
        symbols, owner = merge_rounds(symbols, owner, self._keys, self._ranks, self._merged, self._size)
        data = symbols.astype("<u4")
        bounds = np.searchsorted(owner, np.arange(len(part) + 1))
        listed = symbols.tolist()
        for (word, _), start, end in zip(part, bounds[:-1].tolist(), bounds[1:].tolist()):
            self._tokens[word] = self.join([self._strings[i] for i in listed[start:end]])
            self._ids[word] = data[start:end].tobytes()

    def encode_batch(self, texts: Sequence[str]) -> Iterator[tuple[bytes, str]]:
        """Per text: its ids as little-endian 32-bit integers and the decoded text."""
        if len(self._ids) > REMEMBERED:
            self._ids.clear()
            self._tokens.clear()
        cut = [self.words(text) for text in texts]
        self.learn([w for w in set().union(*cut) if w not in self._ids])
        for words in cut:
            yield b"".join(map(self._ids.__getitem__, words)), self.join(map(self._tokens.__getitem__, words))

    @staticmethod
    def join(strings: Iterable[str]) -> str:
        """The file names no decoder; tokens are then joined by single spaces."""
        return " ".join(strings)

    def decode(self, ids: Sequence[int]) -> str:
        return self.join([self._strings[i] for i in ids])


def merge_rounds(
    symbols: np.ndarray, owner: np.ndarray, keys: np.ndarray, ranks: np.ndarray, merged: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of many words until none has a mergeable pair; ``owner`` numbers their words."""
    done_symbols, done_owner = [], []
    while len(symbols):
        key = symbols[:-1] * size + symbols[1:]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        inside = (keys[at] == key) & (owner[:-1] == owner[1:])
        rank = np.full(len(symbols), _NO_RANK)
        rank[:-1][inside] = ranks[at[inside]]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        per_symbol = np.repeat(lowest, np.diff(np.r_[starts, len(symbols)]))
        open_ = per_symbol != _NO_RANK
        if not open_.all():
            done_symbols.append(symbols[~open_])
            done_owner.append(owner[~open_])
            symbols, owner, rank, per_symbol = symbols[open_], owner[open_], rank[open_], per_symbol[open_]
            if not len(symbols):
                break
        hit = rank == per_symbol
        # In a run of overlapping pairs (a a a) every second one is merged, from the left.
        place = np.flatnonzero(hit)
        fresh = np.r_[True, np.diff(place) > 1]
        run_start = place[np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))]
        place = place[(place - run_start) % 2 == 0]
        symbols = symbols.copy()
        symbols[place] = merged[rank[place]]
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    symbols, owner = np.concatenate([*done_symbols, symbols]), np.concatenate([*done_owner, owner])
    order = np.argsort(owner, kind="stable")
    return symbols[order], owner[order]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(
    docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row's token ids (``ids``, little-endian 32-bit integers) and ``decoded`` text.

    Null texts count as empty: no ids, an empty decoded text. Rows with a null or
    repeated id each give their row, an empty table gives none, and other columns
    are ignored whatever their names. Nothing is shuffled.
    """
    return _coded(docs, path, id_column, text_column, digests=False)


def digests(
    docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """As ``encoded``, with the number of tokens and digests in place of the data."""
    return _coded(docs, path, id_column, text_column, digests=True)


def _coded(docs: DataFrame, path: str | None, id_column: str, text_column: str, digests: bool) -> DataFrame:
    path = path or default_path("word_bpe_49k.json")
    chosen = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    id_type = chosen.schema["id"].dataType.simpleString()
    rows_at_once = 512

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(start, rows_at_once)
                coded = coder.encode_batch(part.column("text").to_pylist())
                if digests:
                    rows = [(len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in coded]
                    types = [pa.int64(), pa.string(), pa.string()]
                else:
                    rows, types = list(coded), [pa.binary(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=["id", *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    types = ["long", "string", "string"] if digests else ["binary", "string"]
    schema = f"id {id_type}, " + ", ".join(f"{n} {t}" for n, t in zip(names, types))
    return chosen.mapInArrow(code, schema).withColumnRenamed("id", id_column)
