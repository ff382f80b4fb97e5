"""Vocabulary files of byte-level BPE tokenizers, read once per Python process.

A file's path is a parameter everywhere and must exist on every machine, as it
does where the package that brings the files is installed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import lru_cache

import regex


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Vocabulary:
    """What the tokenizer file says that the operators need.

    ``merges`` maps a pair of symbols to its rank; ``byte_symbols`` has the
    symbol of each byte; ``special`` finds the added tokens inside a text.
    """

    ids: dict[str, int]
    merges: dict[tuple[str, str], int]
    byte_symbols: tuple[str, ...]
    added: dict[str, int]
    special: regex.Pattern | None
    word_end: str

    def segments(self, text: str):
        """Alternately ordinary text and an added token, starting with text."""
        return [text] if self.special is None else self.special.split(text)


def byte_symbols() -> tuple[str, ...]:
    """The printable symbol that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the others take the code
    points from 256 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return tuple(chr(b) if b in own else chr(next(free)) for b in range(256))


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    longest_first = sorted(added, key=len, reverse=True)
    return Vocabulary(
        ids=model["vocab"],
        merges={pair: rank for rank, pair in enumerate(pairs)},
        byte_symbols=byte_symbols(),
        added=added,
        special=regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None,
        word_end=model.get("end_of_word_suffix") or "",
    )
