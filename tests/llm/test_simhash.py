from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from tallymill.llm import simhash
from tallymill.llm.queries import QUERIES
from tests.conftest import SMALL


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, ids):
    """Smallest id reachable per row, by comparing all pairs of fingerprints."""
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bits = np.array(marks, np.uint64)
    for i in range(len(marks)):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= 2) + i + 1:
            root[find(j)] = find(i)
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [least.get(find(i)) for i in range(len(ids))]


def expected(rows):
    marks = [plain_fingerprint(text) for _, text in rows]
    found = plain_components(marks, [name for name, _ in rows])
    return sorted([(name, f"{m:016x}", c) for (name, _), m, c in zip(rows, marks, found)], key=repr)


def found(df):
    return sorted([tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()], key=repr)


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op3_simhash"](spark, SMALL)) == expected(docs)


def test_crowded_values_lose_no_link(spark):
    draw = random.Random(3)
    centre = draw.getrandbits(64)
    marks = {centre}
    while len(marks) < 300:
        base = draw.choice(sorted(marks))
        for bit in draw.sample(range(64), draw.choice([1, 2, 3])):
            base ^= 1 << bit
        marks.add(base)
    marks |= {draw.getrandbits(64) for _ in range(200)}
    signed = [int(np.array(m, np.uint64).view(np.int64)) for m in marks]
    distinct = spark.createDataFrame([(s,) for s in signed], "bits long").repartition(5)
    for dense, parts in ((1, 3), (64, 2), (64, 3), (10_000, 4)):
        pairs = simhash.links(distinct, parts=parts, dense=dense).collect()
        assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 for a, b in pairs)
        root = {s: s for s in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        whole = plain_components([s & (2**64 - 1) for s in signed], list(range(len(signed))))
        groups = {}
        for s, c in zip(signed, whole):
            groups.setdefault(find(s), set()).add(c)
        assert len(groups) == len(set(whole)) and all(len(g) == 1 for g in groups.values())


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "One two", "c"), (3, "ONE two", "c"), (None, "one  TWO", None), (4, "x " * 3000, ""), (None, "alone here now ok", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    assert found(simhash.near_duplicates(docs)) == expected([(a, b) for a, b, _ in rows])
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 3, 4, None]
    assert kept.columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_thresholds_keep_the_pigeonhole_sum():
    draw = np.random.default_rng(1)
    bits = draw.integers(-(2**63), 2**63 - 1, 500)
    for parts in (2, 3, 4):
        groups = simhash.grouped_bits(np.abs(draw.normal(size=(64, 64))), parts)
        assert sorted(sum(groups, [])) == list(range(64))
        counts = draw.integers(0, 50, (parts, 1 << simhash.HISTOGRAM_BITS))
        assert (simhash.thresholds(bits, groups, counts, 2).sum(axis=1) == 2 - parts + 1).all()


def test_one_row_of_each_component_stays(spark):
    a, b, c = "one two three four five six", "quite another text with other words", "and a third one of its own"
    rows = [
        (3, a, 0, 1), (5, a, 0, 2), (5, b, 0, 3), (9, c, 0, 4), (9, c, 0, 4), (9, c, 0, 5), (None, a, 0, 6), (None, "no id has this text", 0, 7),
        (None, "no id has this text", 0, 8), (11, None, 0, 9), (12, "", 0, 10),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int, stays int").repartition(4)
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(3, a), (5, b), (9, c), (None, "no id has this text"), (11, None)], key=repr
    )
    assert simhash.keep_one(docs.limit(0), simhash.near_duplicates(docs.limit(0))).collect() == []
