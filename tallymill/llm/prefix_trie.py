"""The trie of conversation prefixes: how often turns are repeated, and what sharing them saves.

A conversation becomes a *path*: 24 bytes per turn, the first half of the SHA-256 of its
role and text, and the bytes of its text. Paths are sorted by range over all tasks, so
conversations that begin alike lie side by side, and a very common conversation is
spread over as many tasks as its copies need.

Each task cuts its sorted paths into shards of bounded size. A shard's trie is written
down as balanced parentheses; ``findclose`` (a range min-max search over blocks of the
excess) delimits every subtree, the rank of leaf pairs counts its leaves, and sums over
preorder give members and bytes.

Nodes on the first and on the last path of a shard, its *spines*, may go on in the
shards beside it. All values of a node are sums over its shards, less what neighbours
count twice: two neighbouring shards share just the nodes of the longest common prefix
of the paths on both sides of their border, and what they add to the subtrees of that
chain follows from the prefix alone. So spines and these corrections are added up by
node, some rows per shard, and no other node is touched again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymill.llm.parentheses import Parentheses
from tallymill.session import written

#: Nodes of a shard, about.
SHARD_NODES = 1 << 18
#: Ids of the copies of one conversation that are held together.
_IDS = 1 << 13

#: Bytes of a turn in a path: digest and size.
_DIGEST, _TURN = 16, 24

#: Of no members at all.
_NO_IDS = hashlib.sha256(b"").hexdigest()

_VALUES = ("n_convs", "n_children", "n_leaves", "weighed", "distinct")
_FIELDS = {
    "kind": pa.string(), "conv_id": pa.int64(), "depth": pa.int64(), **{v: pa.int64() for v in _VALUES},
    "ends": pa.string(), "parent_conv_id": pa.int64(),
    # Where the node is: its shard, its number there and its parent's; spines also by their digests.
    "shard": pa.int64(), "piece": pa.int64(), "node": pa.int64(), "parent": pa.int64(),
    "key": pa.binary(), "parent_key": pa.binary(),
    # Of ``edge`` rows: a task's first and last path. Of ``ids`` rows: some members of ``key``.
    "first_path": pa.binary(), "last_path": pa.binary(), "ids": pa.string(),
}
_SCHEMA = pa.schema(list(_FIELDS.items()))
_DDL = ", ".join(f"{n} {({pa.string(): 'string', pa.int64(): 'long', pa.binary(): 'binary'})[t]}" for n, t in _FIELDS.items())


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f], t) if f in columns else pa.nulls(n, t) for f, t in _FIELDS.items()], schema=_SCHEMA
    )


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _chain(path: bytes) -> list[bytes]:
    """The digests of a path's prefixes, the empty one first."""
    running = hashlib.sha256()
    keys = [running.digest()]
    for at in range(0, len(path), _TURN):
        running.update(path[at : at + _TURN])
        keys.append(running.copy().digest())
    return keys


def _sizes(path: bytes) -> np.ndarray:
    """The bytes of the text of each turn of a path."""
    return np.frombuffer(path, np.dtype([("digest", f"V{_DIGEST}"), ("size", ">u8")]))["size"].astype(np.int64)


def _common(a: bytes, b: bytes) -> int:
    """How many turns two paths share from the start."""
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(differ.argmax()) if differ.any() else n) // _TURN


def _border(last: bytes, first: bytes) -> pa.RecordBatch:
    """What two neighbouring shards count twice, for each node that they share."""
    shared = _common(last, first)
    keys = _chain(first[: shared * _TURN])
    sizes = np.r_[0, _sizes(first[: shared * _TURN])]
    n = shared + 1
    below = np.arange(n) < shared
    # If the path before the border ends at the deepest shared node, that node is a leaf
    # there: either again behind the border, or it is none at all.
    leaf = int(len(last) == shared * _TURN)
    zero = np.zeros(n, np.int64)
    return _rows(
        n, kind=["spine"] * n, depth=np.arange(n), key=keys, n_convs=zero, weighed=zero, n_children=-below.astype(np.int64),
        n_leaves=np.full(n, -leaf), distinct=-np.cumsum(sizes[::-1])[::-1],
    )


@dataclass
class _Shard:
    """Sorted distinct paths, made into parentheses as they come."""

    name: tuple[int, int]
    bits: bytearray = field(default_factory=lambda: bytearray(b"\1"))
    depths: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1, np.int64)])
    sizes: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1, np.int64)])
    parents: list[int] = field(default_factory=lambda: [-1])
    stack: list[int] = field(default_factory=lambda: [0])
    ended: list[tuple[int, int, int, str | None, bytes]] = field(default_factory=list)
    first: bytes | None = None
    last: bytes = b""

    def add(self, path: bytes, members: int, least: int, ends: str | None) -> None:
        shared = _common(self.last, path) if self.first is not None else 0
        depth = len(path) // _TURN
        new = range(len(self.parents), len(self.parents) + depth - shared)
        self.bits += b"\0" * (len(self.stack) - 1 - shared) + b"\1" * len(new)
        del self.stack[shared + 1 :]
        if new:
            self.parents.append(self.stack[-1])
            self.parents += range(new.start, new.stop - 1)
            self.stack += new
            self.depths.append(np.arange(shared + 1, depth + 1))
            self.sizes.append(_sizes(path[shared * _TURN :]))
        self.ended.append((self.stack[-1], members, least, ends, path))
        self.first = path if self.first is None else self.first
        self.last = path

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row per node: ``spine`` if it may go on elsewhere or its members are not settled, else ``node``."""
        n = len(self.parents)
        right = list(self.stack)
        shape = Parentheses(np.frombuffer(bytes(self.bits) + b"\0" * len(self.stack), np.uint8))
        depth, size, parent = np.concatenate(self.depths), np.concatenate(self.sizes), np.array(self.parents, np.int64)
        opens = shape.opens()
        closes = shape.closes(opens)
        # Nodes are numbered in preorder, so that a subtree is a range of numbers.
        end = shape.opened[closes]
        node = np.arange(n)

        def within(values: np.ndarray) -> np.ndarray:
            upto = np.r_[0, np.cumsum(values)]
            return upto[end] - upto[node]

        own, ends, least = np.zeros(n, np.int64), np.full(n, None, object), [np.iinfo(np.int64).max] * n
        spine = np.zeros(n, bool)
        keys, parent_keys = np.full(n, None, object), np.full(n, None, object)

        def put(path: bytes, along: list[int]) -> None:
            chain = _chain(path)
            spine[along] = True
            for at, key in zip(along, chain):
                keys[at] = key
            for at, key in zip(along[1:], chain):
                parent_keys[at] = key

        put(self.first, list(range(len(self.first) // _TURN + 1)))
        put(self.last, right)
        for at, members, smallest, digest, path in self.ended:
            own[at], least[at], ends[at] = members, smallest, digest
            if digest is None and not spine[at]:
                spine[at] = True
                keys[at], parent_keys[at] = hashlib.sha256(path).digest(), hashlib.sha256(path[:-_TURN]).digest()
        parents = self.parents
        for at in range(n - 1, 0, -1):
            if least[at] < least[parents[at]]:
                least[parents[at]] = least[at]
        least = np.array(least, np.int64)
        n_convs = within(own)
        columns = {
            "conv_id": least, "depth": depth, "n_convs": n_convs, "n_children": np.bincount(parent[1:], minlength=n),
            "n_leaves": shape.leaves[closes] - shape.leaves[opens], "weighed": within(n_convs * size), "distinct": within(size),
            "shard": np.full(n, self.name[0]), "piece": np.full(n, self.name[1]), "node": node, "parent": parent,
        }
        settled = ~spine & ~spine[parent]
        for kind, chosen in (("node", np.flatnonzero(~spine)), ("spine", np.flatnonzero(spine))):
            if not len(chosen):
                continue
            # The parents of settled nodes are settled too; others are looked up when spines are.
            inner = pa.array(least[parent[chosen]], mask=~settled[chosen])
            yield _rows(
                len(chosen), kind=[kind] * len(chosen), ends=list(ends[chosen]), parent_conv_id=inner, key=list(keys[chosen]),
                parent_key=list(parent_keys[chosen]), **{c: v[chosen] for c, v in columns.items()},
            )


def _shards(batches: Iterator[pa.RecordBatch], most_nodes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task's shards. Rows come sorted by path and id."""
    shard: _Shard | None = None
    first: bytes | None = None
    path: bytes | None = None
    held: list[int] = []
    members, least, key, spilt = 0, 0, b"", False

    def ids() -> pa.RecordBatch:
        return _rows(1, kind=["ids"], key=[key], conv_id=[held[0]], ids=[_joined(held)])

    def finish(is_last: bool) -> Iterator[pa.RecordBatch]:
        """The path that has just been read to its end goes into the shard."""
        nonlocal shard
        # Its members are not all here if it is the task's first or last, and too many to hold if it was spilt.
        open_ended = is_last or spilt or path == first
        if open_ended and held:
            yield ids()
        digest = None if open_ended else hashlib.sha256(_joined(held).encode()).hexdigest()
        if shard.first is not None and len(shard.parents) >= most_nodes:
            yield from shard.rows()
            yield _border(shard.last, path)
            shard = _Shard((shard.name[0], shard.name[1] + 1))
        shard.add(path, members, least, digest)

    for batch in batches:
        for now, conv_id in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()):
            if now != path:
                if path is not None:
                    yield from finish(False)
                else:
                    shard, first = _Shard((conv_id, 0)), now
                path, key = now, hashlib.sha256(now).digest()
                held, members, least, spilt = [], 0, conv_id, False
            elif len(held) == _IDS:
                yield ids()
                held, spilt = [], True
            held.append(conv_id)
            members += 1
    if path is not None:
        yield from finish(True)
        yield from shard.rows()
        yield _rows(1, kind=["edge"], conv_id=[shard.name[0]], first_path=[first], last_path=[shard.last])


def paths(
    conversations: DataFrame, depth_of: Column, base_of: Column, most_shared: int, id_column: str, turn_column: str,
    role_column: str, text_column: str,
) -> DataFrame:
    """(``conv_id``, ``path``) of every conversation, rebuilt: the first turns of another one, then its own."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    role, said = text(role_column), text(text_column)
    # The length of the role keeps role and text apart.
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, said), 256)
    code = F.concat(F.substring(digest, 1, 2 * _DIGEST), F.lpad(F.hex(F.octet_length(said)), 2 * (_TURN - _DIGEST), "0"))
    turns = conversations.select(F.col(id_column).cast("long").alias("conv_id"), F.col(turn_column).alias("turn"), code.alias("code"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "code")))
    own = written(
        turns.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.unhex(F.array_join(ordered["code"], "")).alias("own")), "turns"
    )
    heads = own.select(F.col("conv_id").alias("base"), F.substring("own", 1, most_shared * _TURN).alias("head"))
    shared = own.withColumns({"base": base_of, "h": depth_of}).join(heads, "base", "left")
    head = F.expr(f"coalesce(substring(head, 1, h * {_TURN}), X'')")
    rest = F.expr(f"substring(own, h * {_TURN} + 1)")
    return shared.select("conv_id", F.concat(head, rest).alias("path"))


def trie(rows: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The nodes of the trie of the paths in (``conv_id``, ``path``); ids are unique and not null."""
    spread = rows.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    made = written(spread.mapInArrow(lambda batches: _shards(batches, shard_nodes), _DDL), "trie")

    edges = made.filter("kind = 'edge'").select("conv_id", "first_path", "last_path")
    # One row per task; tasks hold ranges, so the order of their first rows is that of all their rows.
    following = W.partitionBy(F.lit(0)).orderBy("first_path", "conv_id")
    borders = edges.select("last_path", F.lead("first_path").over(following).alias("next_path")).filter("next_path IS NOT NULL")

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for last, first in zip(batch.column("last_path").to_pylist(), batch.column("next_path").to_pylist()):
                yield _border(last, first)

    spines = made.filter("kind = 'spine'")
    summed = _summed(spines.unionByName(borders.mapInArrow(correct, _DDL)))
    summed = written(summed.join(_open_ends(made), "key", "left"), "spines")
    names = summed.select("key", F.col("conv_id").alias("parent_conv_id"))
    merged = summed.join(names.withColumnRenamed("key", "parent_key"), "parent_key", "left").withColumn(
        "ends", F.coalesce("open_ends", "ends")
    )
    nodes = made.filter("kind = 'node'")
    # Children of spines look their parent up by shard, where its children are few, not by the node, where they may be most rows.
    local = spines.select("shard", "piece", F.col("node").alias("parent"), "key").join(names, "key").drop("key")
    under_spines = nodes.filter("parent_conv_id IS NULL").drop("parent_conv_id").join(local, ["shard", "piece", "parent"])
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("weighed") - F.col("distinct")).alias("saved_tokens"), F.coalesce("ends", F.lit(_NO_IDS)).alias("ends_sha256"),
    ]
    parts = [nodes.filter("parent_conv_id IS NOT NULL"), under_spines, merged]
    return parts[0].select(columns).unionByName(parts[1].select(columns)).unionByName(parts[2].select(columns))


def _summed(rows: DataFrame) -> DataFrame:
    """One row per node of the spines."""
    return rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
        F.max("ends").alias("ends"), *[F.sum(v).alias(v) for v in _VALUES],
    )


def _open_ends(made: DataFrame) -> DataFrame:
    """(``key``, ``open_ends``): digests of the members of paths that several tasks hold, or that have very many.

    The ids of a path come in lists of thousands; one task hashes the lists of a path in order, as its digest asks for.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])], names=["key", "open_ends"])

        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if key != now:
                    if now is not None:
                        yield row()
                    now, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.as_py().encode())
        if now is not None:
            yield row()

    lists = made.filter("kind = 'ids'").select("key", "conv_id", "ids")
    return lists.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(digest, "key binary, open_ends string")


def rebuilt_trie(
    conversations: DataFrame, every: int = 5, shared_turns: int = 9, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text", shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """The prefix trie of conversations that share beginnings.

    Conversation c takes its first h turns from conversation c - c % ``every`` and goes
    on with its own turns after its first h, where h is the CRC-32 of its decimal id
    modulo ``shared_turns``. Returns one row per distinct prefix of d turns: ``conv_id``
    (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes of text of the subtree that all but one member
    of each node repeat) and ``ends_sha256`` (of the ids of its members of just d turns).

    Turns go by number, null first; equal numbers by the digest of role and text, so
    that equal rows are so many equal turns. Null roles and texts are empty. Rows
    without a conversation id belong to none and are left out. A conversation without
    turns is a member of the root. An empty table gives no rows, the root neither; other
    columns are ignored whatever their names. A conversation's path, 24 bytes a turn, is
    one value: millions of turns in one conversation are fine, billions are not.
    """
    conv_id = F.col("conv_id")
    rows = paths(
        conversations, F.crc32(conv_id.cast("string").cast("binary")) % shared_turns, conv_id - conv_id % every, shared_turns - 1,
        id_column, turn_column, role_column, text_column,
    )
    return trie(rows, shard_nodes)
