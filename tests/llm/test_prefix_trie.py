from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract
from tallymill.llm import prefix_trie
from tallymill.llm.parentheses import Parentheses
from tests.compare import differences, duck
from tests.conftest import SMALL

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Every prefix as a tuple of turns. Turn numbers do not repeat within a conversation."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return plain_nodes(rebuilt)


def plain_nodes(rebuilt):
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(ids) if len(rebuilt[c]) == len(node)).encode()).hexdigest(),
        )
        for node, ids in members.items()
    )


def found(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()))


def test_query_equals_sql(spark):
    got = contract.queries()["op12_prefix_trie"](spark, SMALL).toArrow()
    assert got.num_rows > 0
    assert differences(got, duck(SMALL).sql(contract.oracle_sql()["op12_prefix_trie"]).to_arrow_table()) == []


def made_up(draw):
    rows = []
    for c in range(-40, 300):
        for turn in range(draw.choice([0, 1, 2, 3, 9, 12])):
            rows.append((c, turn or draw.choice([0, None]), draw.choice(["user", "a", None, ""]), draw.choice(["x", "é", "", None, "yy"]), "x", c))
    # Many copies of one conversation, rows of none, one turn only, a very long conversation.
    rows += [(c, t, "user", "same", None, None) for c in range(1000, 1600) for t in range(5)]
    rows += [(None, 1, "a", "b", None, None), (None, None, None, None, None, None), (3001, 0, "a", "b" * 100_000, "x", 1)]
    return rows + [(3002, t, "user", "x" if t % 2 else "", "x", 1) for t in range(120)]


# Shards of a few nodes put nearly every node on a spine; lists of a few ids cross tasks.
@pytest.mark.parametrize("nodes, ids, parts", [(1 << 18, 1 << 13, 3), (40, 7, 8), (1, 2, 5)])
def test_made_up_rows(spark, monkeypatch, nodes, ids, parts):
    monkeypatch.setattr(prefix_trie, "_IDS", ids)
    rows = made_up(random.Random(3))
    names = "conv_id long, turn long, role string, text string, path string, key int"
    df = spark.createDataFrame(rows, names).repartition(parts)
    assert found(prefix_trie.rebuilt_trie(df, shard_nodes=nodes)) == plain(rows)
    assert found(prefix_trie.rebuilt_trie(df.limit(0))) == []
    assert found(prefix_trie.rebuilt_trie(df.filter("conv_id IS NULL"))) == []


def test_equal_turn_numbers_go_by_digest(spark):
    rows = [(10, 1, "user", t) for t in ("b", "a", "a", "c")] + [(10, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    digest = lambda t: hashlib.sha256(f"4:user{t}".encode()).hexdigest()
    path = tuple(("user", t) for t in ["z", *sorted("baac", key=digest)])
    for order in (df, df.orderBy("text"), df.orderBy(df.text.desc())):
        assert found(prefix_trie.rebuilt_trie(order)) == plain_nodes({10: path})


def test_parentheses_close_where_a_stack_says():
    draw = random.Random(3)
    for _ in range(300):
        bits, level = [], 0
        while not bits or level:
            up = level == 0 or (len(bits) < draw.choice([3, 80, 2000]) and draw.random() < 0.55)
            bits.append(int(up))
            level += 1 if up else -1
        stack, close = [], {}
        for i, bit in enumerate(bits):
            if bit:
                stack.append(i)
            else:
                close[stack.pop()] = i
        shape = Parentheses(np.array(bits))
        opens = shape.opens()
        closes = shape.closes(opens)
        assert closes.tolist() == [close[i] for i in opens.tolist()]
        leaves = [sum(bits[k] and not bits[k + 1] for k in range(i, j)) for i, j in zip(opens[:20], closes[:20])]
        assert (shape.leaves[closes] - shape.leaves[opens])[:20].tolist() == leaves
