from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallymill.llm import topk_search, warc
from tallymill.llm.components import components
from tallymill.session import new_path
from tests.compare import differences, duck
from tests.conftest import SMALL


@pytest.mark.parametrize("name", ["op6_topk_search", "op8_warc"])
def test_query_equals_sql(spark, name):
    found = contract.queries()[name](spark, SMALL).toArrow()
    assert found.num_rows > 0
    assert differences(found, duck(SMALL).sql(contract.oracle_sql()[name]).to_arrow_table()) == []


@pytest.mark.parametrize("limits", [{}, {"block_rows": 7, "query_rows": 3}, {"block_rows": 7, "query_rows": 1, "held_blocks": 2}])
def test_search_with_ties_and_odd_vectors(spark, limits):
    draw = random.Random(2)
    rows = [(i, [draw.choice([0.0, 0.5, -0.25, 0.1]) for _ in range(6)], "x") for i in range(0, 300, 3)]
    rows += [(1000, None, "x"), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (1100, [float("nan")] * 6, "x"), (1150, [float("inf")] + [0.0] * 5, "x")]
    rows += [(None, [0.5] * 6, "x"), (5000, [0.5] * 3, "x"), (5050, [0.1, 0.2, 0.3], "x"), (6000, [0.5] * 6, "x"), (6001, [0.5] * 6, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string").repartition(4)
    found = topk_search.top_k(df, F.col("vec_id") % 50 == 0, **limits).collect()
    from math import floor, isfinite

    usable = {i: [floor(256 * x) for x in v] for i, v, _ in rows if i is not None and v and all(x is not None and isfinite(x) for x in v)}
    expected = []
    for q in (i for i in usable if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_search_with_repeated_ids_and_large_numbers(spark):
    from math import floor

    draw = random.Random(8)
    rows = [(i, [float(draw.randrange(-3, 4)) for _ in range(4)]) for i in range(40)]
    # Two vectors of one query's id, one of them twice; one candidate's row twice; numbers beyond 32 bits.
    rows += [(50, [1.0, 0.0, 0.0, 0.0]), (50, [0.0, 0.0, -2.0, 1.0]), (50, [1.0, 0.0, 0.0, 0.0]), (7, [9.0, 9.0, -9.0, 9.0]), (7, [9.0, 9.0, -9.0, 9.0])]
    rows += [(100, [1e7, -1e7, 1e6, 0.5]), (101, [1e7, 6e6, -1e7, 2e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = [(i, [floor(256 * x) for x in v]) for i, v in rows]
    expected = []
    for q in (0, 50, 100):
        asking = {tuple(v) for i, v in whole if i == q}
        hits = sorted((-sum(a * b for a, b in zip(a_, v)), i) for a_ in asking for i, v in whole if i != q)
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(hits[:5], 1)]
    for limits in ({}, {"block_rows": 3, "query_rows": 1, "held_blocks": 1}):
        assert sorted(map(tuple, topk_search.top_k(df, F.col("vec_id") % 50 == 0, **limits).collect())) == sorted(expected)


def test_scores_are_exact_or_refused(spark):
    import numpy as np

    large = np.array([[2**40, -(2**40), 3]], np.int64)
    found = topk_search.accumulate(large, np.array([[2**40, 2**40, 5], [2**40, 0, 0]], np.int64))
    assert found.tolist() == [[15, 2**80]]
    with pytest.raises(Exception, match="does not fit"):
        df = spark.createDataFrame([(0, [1e16]), (1, [1e16])], "vec_id long, embedding array<double>")
        topk_search.top_k(df, F.col("vec_id") % 50 == 0).collect()
    df = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2\\^62"):
        topk_search.top_k(df, F.col("vec_id") % 50 == 0).collect()


def records(n):
    return [warc.page_record(i, f"http://x/{i}", (f"<p>page {i} " * (i + 3)).encode(), hashlib.sha256((f"<p>page {i} " * (i + 3)).encode()).hexdigest(), None) for i in range(n)]


def read(data):
    items = list(warc.SalvageReader(io.BytesIO(data), len(data)))
    place = 0
    for item in items:  # records and gaps cover the file without holes
        assert item.offset == place
        place += item.length
    assert place == len(data)
    ids = [i.headers["page-id"] for i in items if isinstance(i, warc.Record)]
    return ids, [(g.offset, g.length) for g in items if isinstance(g, warc.Gap)]


@pytest.mark.parametrize("packed", [True, False])
def test_damaged_archives(packed):
    parts = [warc.member(r) if packed else r for r in records(9)]
    names = [str(i) for i in range(9)]
    assert read(b"".join(parts)) == (names, [])
    start = sum(map(len, parts[:4]))
    # Noise in the payload of a record.
    broken = bytearray(b"".join(parts))
    for place in (30, 31):
        broken[start + len(parts[4]) - place] ^= 0x55
    assert read(bytes(broken)) == (names[:4] + names[5:], [(start, len(parts[4]))])
    # A record cut off, with others behind it.
    cut = b"".join(parts[:4]) + parts[4][: len(parts[4]) // 2] + b"".join(parts[5:])
    assert read(cut) == (names[:4] + names[5:], [(start, len(parts[4]) // 2)])
    # Bytes that belong to no record, before, between and behind.
    noise = b"WARC/1.0 no\x1f\x8b\x08 noise" * 3
    ids, gaps = read(noise + b"".join(parts[:4]) + noise + b"".join(parts[4:]) + noise)
    assert ids == names and sum(n for _, n in gaps) == 3 * len(noise)
    # The end is missing.
    assert read(b"".join(parts)[:-5])[0] == names[:-1]
    assert read(b"") == ([], [])
    assert read(b"nothing here")[1] == [(0, 12)]


def test_members_are_ordinary_gzip():
    parts = records(3)
    assert gzip.decompress(b"".join(map(warc.member, parts))) == b"".join(parts)


def test_revisits_and_odd_pages(spark):
    same, short = "<p>" + "same " * 50, "short"
    rows = [(5, "u", same, 1), (3, "u\r\nx y", same, 1), (9, None, same, 1), (9, None, same, 1), (None, "n", same, 1), (1, "u", short, 1), (2, "u", short, 1)]
    rows += [(10, "u", None, 1), (11, "u", "", 1), (None, "u", "é" * 70, 1), (None, "u", "é" * 70, 1), (12, "u", "x" * 99, 1), (13, "u", "x" * 99, 1), (14, "u", "y" * 300_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    found = warc.round_trip(pages)
    expected = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        again = html == same and i != 3
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert warc.round_trip(pages.limit(0)).collect() == []
    plain = new_path(spark, "plain-warc")
    archives = warc.write_archives(pages, plain, packed=False, file_bytes=1000)
    assert archives.count() > 3
    records = warc.read_archives(spark, archives, plain)
    assert records.filter("record_type IN ('response', 'revisit')").count() == len(rows)
    assert records.filter("record_type = 'warcinfo'").count() == archives.count()


def local(path):
    return path.removeprefix("file:").replace("//", "/")


@pytest.mark.parametrize("packed", [True, False])
def test_a_damaged_file_is_salvaged_in_spark(spark, packed):
    folder = new_path(spark, "damaged-warc")
    pages = spark.range(0, 40, 1, 3).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "repeat(concat('<p>page ', id), 60) AS html")
    archives = warc.write_archives(pages, folder, packed=packed)
    whole = warc.read_archives(spark, archives, folder)
    assert warc.missing(archives, whole) == (0, 0)
    victim = whole.filter("page_id = '7'").first()
    with open(local(victim.path), "r+b") as file:
        file.seek(victim.offset + victim.length - 40)
        file.write(b"\xff\x00\xff")
    again = warc.read_archives(spark, archives, folder)
    assert {r.page_id for r in again.filter("page_id IS NOT NULL").collect()} == {str(i) for i in range(40)} - {"7"}
    gap = again.filter("reason IS NOT NULL").collect()
    assert [(g.path, g.offset, g.length) for g in gap] == [(victim.path, victim.offset, victim.length)]
    assert warc.missing(archives, again) == (1, 1)


def test_missing_pages_are_told(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "u", "x" * 200), (2, "u", "y" * 200)], "page_id long, url string, html string")
    write = warc.write_archives

    def damaged(*args, **options):
        archives = write(*args, **options)
        path = local(archives.first().path)
        with open(path, "r+b") as file:
            file.seek(-30, 2)
            file.write(b"\0" * 10)
        return archives

    monkeypatch.setattr(warc, "write_archives", damaged)
    with pytest.raises(RuntimeError, match="1 records were not read back"):
        warc.round_trip(pages)


def test_records_have_ids_of_their_own():
    page = (5, "http://x/ y", b"payload", "0" * 64, 3, "http://z")
    one, other = (next(iter(warc.SalvageReader(io.BytesIO(r), len(r)))).headers for r in (warc.page_record(*page), warc.page_record(*page)))
    assert one["warc-record-id"] != other["warc-record-id"] and one["warc-record-id"].startswith("<urn:uuid:")
    assert (one["page-id"], one["refers-to-page-id"], one["warc-refers-to-target-uri"]) == ("5", "3", "http://z")
    assert one["warc-target-uri"] == "http://x/%20y"


def test_addresses_are_those_of_spark(spark, tmp_path):
    assert warc.shared_address(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert warc.shared_address(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    with pytest.raises(Exception):
        warc.shared_address(spark, "unknown://x/y")


def test_components(spark):
    draw = random.Random(6)
    pairs = [(draw.randrange(-200, 200), draw.randrange(-200, 200)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(90)]
    pairs += [(7, 7), (1, None), (None, None)] + pairs[:9]
    root = {x: x for p in pairs for x in p if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    found = components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    linked = {x for a, b in pairs if a is not None and b is not None and a != b for x in (a, b)}
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in linked)
