from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as contract
from tallymill.llm import key_filter, suffix_dedup
from tallymill.llm.queries import QUERIES
from tallymill.llm.suffix_grouping import suffix_array
from tests.compare import differences, duck
from tests.conftest import SMALL
from tests.test_plans import plan


def plain(rows, length=200):
    seen = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    result = []
    for name, t in rows:
        gone = bytearray(len(t) + 1)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        result.append((name, len(t), sum(gone[: len(t)]), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=repr)


def found(df):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted([tuple(r) for r in df.select(columns).collect()], key=repr)


def test_query_equals_counting_every_string(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op7_suffix_dedup"](spark, SMALL)) == plain([(d, t.encode()) for d, t in docs])


def test_query_equals_sql(spark):
    got = contract.queries()["op7_suffix_dedup"](spark, SMALL).toArrow()
    assert differences(got, duck(SMALL).sql(contract.oracle_sql()["op7_suffix_dedup"]).to_arrow_table()) == []


def made_up(draw):
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60) for _ in range(4)]
    rows = [(i, text(draw.randrange(0, 80)) + draw.choice([" ", "x", ""]) + draw.choice(shared)[draw.randrange(30) :] + text(20)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 3000), (103, "ab " * 900), (104, rows[0][1]), (None, rows[1][1]), (105, rows[2][1] * 3), (105, rows[2][1] * 3)]
    rows += [(200 + i, shared[0][i : i + 199]) for i in range(3)] + [(300 + i, shared[1][5:230] + text(8)) for i in range(40)]
    rows += [(400, "".join(draw.choice("xyzw") for _ in range(900))), (401, "".join(draw.choice("xyzw") for _ in range(300)))]
    rows += [(402, "q" + rows[-2][1][100:450] + "q"), (403, "\n\n \n" * 300)]
    return rows


@pytest.mark.parametrize("crowd", [4096, 2])
def test_made_up_rows(spark, crowd):
    rows = made_up(random.Random(4))
    docs = spark.createDataFrame([(a, b, None, 1) for a, b in rows], "doc_id long, text string, starts string, h int").repartition(4)
    assert found(suffix_dedup.removed(docs, crowd=crowd)) == plain([(a, (b or "").encode()) for a, b in rows])


def test_windows_of_a_crowd_meet_without_a_join(spark, monkeypatch):
    draw = random.Random(8)
    common = draw.randbytes(150)
    bodies = [common + draw.randbytes(60) for _ in range(30)] + [draw.randbytes(20) + common + b"x" * 49 + draw.randbytes(9) for _ in range(200)]
    # The last passages share a window with one another, some a longer run; one occurs twice, one alone.
    bodies += [bodies[0], bodies[40][:215], draw.randbytes(230), b"y" * 230]
    rows = [(1, i, body) for i, body in enumerate(bodies)] + [(1, len(bodies) - 4, bodies[0])]
    seen = Counter(body[i : i + 200] for _, _, body in rows for i in range(len(body) - 199))
    expected = {(k, c, i) for k, c, body in rows for i in range(len(body) - 199) if seen[body[i : i + 200]] > 1}
    tables, written = [], suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, label: tables.append(written(df, label)) or tables[-1])
    for size in (1, 5_000, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", size)
        verdicts = suffix_dedup._counted_out(spark.createDataFrame(rows, "key long, content long, body binary").repartition(3), 200)
        got = [tuple(r) for r in verdicts.collect()]
        assert len({r[:2] for r in got}) == len(got)
        assert {(k, c, i) for k, c, edges in got for a, b in zip(edges[::2], edges[1::2]) for i in range(a, b)} == expected
        assert "Join" not in plan(verdicts)
    # With all of a task's passages in one batch, a window has one row a task.
    assert tables[-1].filter("mark IS NOT NULL").groupBy("mark").count().selectExpr("max(count)").first()[0] <= 3


def test_cut_texts(spark):
    rows = made_up(random.Random(5))
    docs = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, n_chars long")
    kept = suffix_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    digests = {(r[0], r[4]) for r in plain([(a, (b or "").encode()) for a, b in rows])}
    for row in kept.filter("text IS NOT NULL").collect():
        assert row.n_chars == len(row.text)
        assert "�" not in row.text
    whole = {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect()}
    assert len(whole & digests) > 0.8 * len(digests)
    assert suffix_dedup.removed(docs.limit(0)).collect() == []


@pytest.mark.parametrize("ids", [(7, 7, 8), (None, None, None), (7, 7, 7)])
def test_rows_of_one_id_and_equal_short_hashes_stay_apart(spark, ids):
    from pyspark.sql import functions as F

    # Two texts of equal 32-bit hash, found among many that differ in one number.
    draw = random.Random(3)
    fill = "".join(draw.choice("abcdefgh ") for _ in range(240))
    many = spark.range(0, 400_000, 1, 8).select("id", F.hash(F.concat(F.lit(fill), F.col("id").cast("string"))).alias("h"))
    low, high = many.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").orderBy("a").select("a", "b").first()
    # What differs comes first, so that the texts share no window.
    a, b = (f"{n}" .zfill(8).translate(str.maketrans("0123456789", "ABCDEFGHIJ")) * 32 for n in (low, high))
    rows = [(ids[0], a), (ids[1], b), (ids[2], a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(suffix_dedup.removed(docs)) == plain([(i, t.encode()) for i, t in rows])
    collided = [(ids[0], fill + str(low)), (ids[1], "".join(reversed(fill)) + str(high)), (ids[2], fill + str(low))]
    docs = spark.createDataFrame(collided, "doc_id long, text string")
    assert found(suffix_dedup.removed(docs)) == plain([(i, t.encode()) for i, t in collided])


def test_clashing_columns_come_back_unchanged(spark):
    text = "some words that are said twice " * 9
    rows = [(1, text, 5, "a", [1], "x"), (2, text, 6, "b", None, None), (3, None, 7, "c", [2], "y"), (4, "short", 8, "d", [3], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, marks int, _h string, id array<int>, row string")
    kept = suffix_dedup.without_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted(r[:1] + r[2:] for r in map(tuple, kept.collect())) == [r[:1] + r[2:] for r in rows]
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "", 2: "", 3: None, 4: "short"}


def test_repeated_windows_equal_counting():
    draw = random.Random(5)
    for _ in range(2500):
        length, letters = draw.choice([3, 5, 8, 20]), draw.choice(["ab ", "abc  ", "a b\nc", "abcdefgh "])
        text = lambda n: "".join(draw.choice(letters) for _ in range(draw.randrange(n)))
        base = text(80) + "x"
        texts = []
        for _ in range(draw.randrange(1, 7)):
            start = draw.randrange(len(base))
            texts.append(draw.choice([text(6) + base[start : start + draw.randrange(60)] + text(6), text(50)]).encode())
        copies = [draw.choice([1, 1, 2]) for _ in texts]
        seen = Counter()
        for t, n in zip(texts, copies):
            for i in range(len(t) - length + 1):
                seen[t[i : i + length]] += n
        expected = [[seen[t[i : i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]
        assert [f.tolist() for f in suffix_dedup.repeated_windows(texts, length, copies)] == expected


def test_suffix_arrays():
    draw = random.Random(1)
    for _ in range(600):
        n, kinds = draw.randrange(0, 40), draw.choice([1, 2, 3, 5])
        s = [draw.randrange(kinds) for _ in range(n)]
        if draw.random() < 0.3:
            s = (s[: max(1, n // 4)] * 9)[:n]
        assert suffix_array(np.array(s, np.int64)).tolist() == sorted(range(n), key=lambda i: s[i:])


@pytest.mark.parametrize("most_blocks", [1024, 1])
def test_key_filters_hold_every_key_and_few_others(spark, monkeypatch, most_blocks):
    monkeypatch.setattr(key_filter, "MOST_BLOCKS", most_blocks)
    table = spark.range(0, 200_000, 1, 4).selectExpr("xxhash64(id) AS key")
    found = key_filter.key_filter(table)
    assert found.blocks == min(8, most_blocks)
    keys = np.array([r.key for r in table.collect()], np.int64).view(np.uint64)
    assert found.may_hold(keys).all()
    others = np.random.default_rng(1).integers(0, 2**63, 50_000, np.uint64)
    # A filter with room keeps out nearly all others; one without still loses none.
    assert found.may_hold(others).mean() < (0.02 if most_blocks > 1 else 0.9)
    assert not key_filter.key_filter(table.limit(0)).may_hold(others).any()
