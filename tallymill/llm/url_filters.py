"""Verdicts on URLs by pattern rules that are indexed by their rarest literal token.

A rule is a host and a path: it fits URLs of that host and its subdomains whose path
starts with the rule's. ``*`` in a path stands for any characters, ``|`` at its end for
the end of the URL's path. Every rule becomes a regular expression, and is filed under
one token (run of letters, digits and other characters that do not separate) that each
URL it fits must hold as a whole: the rarest such token, as counted in the URLs. The
tokens of a URL fetch the rules filed under them, and only those run their expressions.

Counting the tokens of the rules in the URLs is one aggregation with a row per token;
judging is one pass without a shuffle. The index is part of the task, so the number of
rules is bounded (``MOST_RULES``); more are refused.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rules of one index; a rule takes less than a kilobyte or so.
MOST_RULES = 200_000

#: Verdict on URLs that no rule fits: a filter names what it blocks.
UNLISTED = "allow"

_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Letters and digits of ASCII, and everything outside it, make up tokens.
_TOKEN = re.compile(r"[0-9A-Za-z\u0080-\U0010FFFF]+")


@dataclass(frozen=True)
class Rule:
    """What a rule says and where: ``Rule("block", "example.org", "/ads/")``."""

    verdict: str
    host: str
    path: str = ""

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    def __post_init__(self) -> None:
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks: {self.verdict!r}")
        if not self.host or any(c in self.host for c in "/?#*|"):
            raise ValueError(f"a rule needs a literal host: {self.host!r}")
        if self.path and not self.path.startswith("/"):
            raise ValueError(f"the path of a rule starts with a slash: {self.path!r}")
        object.__setattr__(self, "host", self.host.translate(_ASCII_LOWER))

    def __str__(self) -> str:
        return self.host + self.path

    def expression(self) -> str:
        """What host and path, joined, match from their start."""
        ends = self.path.endswith("|")
        pieces = self.path.removesuffix("|").split("*")
        # Without a path of its own the rule's host must end where the URL's does.
        path = ".*".join(map(re.escape, pieces)) or r"(?=/|\Z)"
        return rf"(?s:(?:[^/]*\.)?{re.escape(self.host)}{path}{r'\Z' if ends else ''})"

    def tokens(self) -> list[str]:
        """The tokens that every URL which the rule fits holds as a whole.

        Tokens of the host are whole: a dot or the start is before, a dot, a slash or the
        end behind. Those of the path are unless the rule leaves open what comes next to them.
        """
        closed = self.path.endswith("|")
        path = self.path.removesuffix("|")
        whole = [m.group() for m in _TOKEN.finditer(self.host)]
        for found in _TOKEN.finditer(path):
            before, behind = path[found.start() - 1], path[found.end() : found.end() + 1]
            if before != "*" and behind != "*" and (behind or closed):
                whole.append(found.group())
        return whole

    def order(self) -> tuple[int, int, bool, str]:
        """The longest rule wins; of equally long ones that with the longer host, then one that blocks."""
        return len(self.host) + len(self.path), len(self.host), self.verdict == "block", self.path


class Index:
    """Rules by their rarest token; expressions are compiled when first fetched."""

    def __init__(self, rules: Iterable[Rule], seen: Mapping[str, int] | None = None) -> None:
        best: dict[tuple[str, str], Rule] = {}
        for rule in rules:
            place = (rule.host, rule.path)
            if place not in best or rule.order() > best[place].order():
                best[place] = rule
        self.rules = sorted(best.values(), key=Rule.order, reverse=True)
        if len(self.rules) > MOST_RULES:
            raise ValueError(f"{len(self.rules)} rules; an index holds {MOST_RULES}")
        in_rules = Counter(token for rule in self.rules for token in set(rule.tokens()))
        seen = seen or {}
        self.under: dict[str, list[int]] = {}
        self.always: list[int] = []
        for place, rule in enumerate(self.rules):
            tokens = rule.tokens()
            if tokens:
                rarest = min(tokens, key=lambda t: (seen.get(t, 0), in_rules[t], -len(t), t))
                self.under.setdefault(rarest, []).append(place)
            else:
                self.always.append(place)
        self._compiled: dict[int, re.Pattern[str]] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_compiled": {}}

    def candidates(self, address: str) -> list[int]:
        """The places of the rules that the tokens of a host and path fetch, the strongest first."""
        fetched = set(self.always)
        for token in _TOKEN.findall(address):
            fetched.update(self.under.get(token, ()))
        return sorted(fetched)

    def fitting(self, host: str, path: str) -> Rule | None:
        """The strongest rule that fits."""
        address = host + path
        for place in self.candidates(address):
            expression = self._compiled.get(place)
            if expression is None:
                expression = self._compiled[place] = re.compile(self.rules[place].expression())
            if expression.match(address):
                return self.rules[place]
        return None


def addresses(pages: DataFrame, url_column: str = "url") -> DataFrame:
    """``pages`` with the columns ``host`` and ``path`` of each URL instead of any it had.

    The host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; the path from there to ``?``, ``#`` or the end. Both are empty where
    there is no URL or no ``://`` in it.
    """
    url = F.coalesce(F.col(url_column), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(_url, _at + 3)")).otherwise("")
    parts = pages.drop("host", "path", "_url", "_at").withColumns({"_url": url, "_at": at}).withColumn("_url", rest)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return parts.withColumns({
        "host": F.translate(F.regexp_extract("_url", r"^[^/?#]*", 0), upper, lower),
        "path": F.regexp_extract("_url", r"^[^/?#]*([^?#]*)", 1),
    }).drop("_url", "_at")


def token_counts(addressed: DataFrame, tokens: Iterable[str]) -> dict[str, int]:
    """In how many of the URLs each of the tokens occurs. There is one row per token at most."""
    wanted = frozenset(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                seen.update(wanted.intersection(_TOKEN.findall(host + path)))
        columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "n"])

    counted = addressed.select("host", "path").mapInArrow(count, "token string, n long")
    return {row["token"]: row["n"] for row in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def judged(
    pages: DataFrame, rules: Iterable[Rule], id_column: str = "page_id", url_column: str = "url", unlisted: str = UNLISTED
) -> DataFrame:
    """(id, ``host``, ``path``, ``rule``, ``verdict``) of every row.

    ``rule`` is the strongest rule that fits (see ``Rule.order``) and ``verdict`` what it
    says; where none fits, null and ``unlisted``. A rule given with both verdicts blocks.
    Null URLs and those without ``://`` have an empty host and path, which no rule fits.
    Null ids stay, repeated rows each give their row, an empty table gives none, and
    other columns are ignored whatever their names.
    """
    rules = list(rules)
    found = addresses(pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url")))
    index = Index(rules, token_counts(found, (token for rule in rules for token in rule.tokens())))
    id_type = found.schema["id"].dataType

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [index.fitting(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            rule = pa.array([None if r is None else str(r) for r in hits], pa.string())
            verdict = pa.array([unlisted if r is None else r.verdict for r in hits], pa.string())
            names = ["id", "host", "path", "rule", "verdict"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), rule, verdict], names=names)

    schema = f"id {id_type.simpleString()}, host string, path string, rule string, verdict string"
    return found.select("id", "host", "path").mapInArrow(judge, schema).withColumnRenamed("id", id_column)
