"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors are packed into blocks of bounded size. A block of candidates is an
inverted list: for each component, the rows in which it is not zero and their
values. Term by term, the entries of the sparse query rows scatter their weighted
postings into dense score arrays. Partition selection keeps each query's best rows
of the block, and the survivors of all blocks are merged.

Blocks meet in a grid. Queries are dealt to columns of the grid, as many blocks to
each as a task can hold, candidates to its rows. A task gets the queries of one column
and the candidates of one row, holds the former, and works through the latter block by
block. Every candidate is thus sent once per column and every query once per row,
instead of once per pair of blocks, and a task hands on k rows per query.

Queries times candidates is the work that is asked for; no other pairs are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymill.session import written

#: Rows of a block of candidates and of a block of queries.
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Blocks of queries that a task holds, about: at 64 components some 64 MB.
HELD_BLOCKS = 256
#: Query rows whose scores are added up together.
_ROWS_AT_ONCE = 8
#: Scaled components from here on are refused.
_LARGEST = 2**62


def _usable(vector: Column) -> Column:
    """Not null, and neither are its components, which are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """(``block``, ``n``, ``width``, ``ids``, ``data``): rows of equal width packed by partition, ``size`` at most."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(width: int) -> pa.RecordBatch:
            part = waiting.pop(width)
            ids = np.array([i for i, _ in part], "<i8")
            data = np.array([v for _, v in part], "<i8").reshape(len(part), width)
            values = [[len(part)], [width], [ids.tobytes()], [data.tobytes()]]
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=["n", "width", "ids", "data"])

        for batch in batches:
            for row_id, vector in zip(batch.column("id").to_pylist(), batch.column("v")):
                values = vector.values.to_numpy(zero_copy_only=False)
                kept = waiting.setdefault(len(values), [])
                kept.append((row_id, values))
                if len(kept) == size:
                    yield block(len(values))
        for width in list(waiting):
            yield block(width)

    packed = rows.mapInArrow(pack, "n int, width int, ids binary, data binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all query rows with all candidate rows, term at a time, exactly.

    The scores are kept in the narrowest integers that hold the largest sum possible.
    """
    most = _most(queries) * _most(candidates) * max(queries.shape[1], 1)
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    scores = np.zeros((len(queries), len(candidates)), kind)
    queries, terms = queries.astype(kind), np.ascontiguousarray(candidates.T.astype(kind))
    postings = [np.flatnonzero(values) for values in terms]
    part = np.empty((_ROWS_AT_ONCE, len(candidates)), kind)
    # A few rows at a time, so that their scores stay in the cache from term to term.
    for start in range(0, len(queries), _ROWS_AT_ONCE):
        few, here = queries[start : start + _ROWS_AT_ONCE], scores[start : start + _ROWS_AT_ONCE]
        for term, (values, posted) in enumerate(zip(terms, postings)):
            rows = np.flatnonzero(few[:, term])
            if 2 * len(posted) >= len(values):
                # Nearly all have the term; adding nothing to the others is cheaper than leaving them out.
                here += np.multiply(few[:, term, None], values, out=part[: len(few)])
            elif len(posted) and len(rows):
                here[np.ix_(rows, posted)] += few[rows, term, None] * values[posted]
    return scores if kind is object else scores.astype(np.int64)


def _most(values: np.ndarray) -> int:
    """The largest absolute value."""
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, ties to smaller ids, in no order."""
    if len(scores) <= k:
        return np.arange(len(scores))
    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
    above, equal = np.flatnonzero(scores > kth), np.flatnonzero(scores == kth)
    wanted = k - len(above)
    if len(equal) > wanted:
        equal = equal[np.argpartition(ids[equal], wanted - 1)[:wanted]]
    return np.concatenate([above, equal])


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id",
    vector_column: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, held_blocks: int = HELD_BLOCKS,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the k best other rows of each query.

    Components become floor(scale * x). Rows with a null id or vector, or with a
    null or non-finite component, take no part; scaled components of 2^62 or more, and
    scores that do not fit a long integer, raise. Vectors are compared with those of
    their own length only. Ties go to smaller ids. A query finds every row but those of
    its own id. Where ids repeat, each of the rows is a candidate, each different vector
    of a query's id asks, and what they find gives k rows in all. An empty table gives
    none; other columns are ignored whatever their names.
    """
    spark = vectors.sparkSession
    v = F.col(vector_column)
    small = lambda x: F.abs(x.cast("double") * scale) < float(_LARGEST)
    refused = F.raise_error(F.lit(f"a component times {scale} is 2^62 or more")).cast("long")
    whole = F.transform(v, lambda x: F.when(small(x), F.floor(x.cast("double") * scale)).otherwise(refused))
    usable = vectors.filter(F.col(id_column).isNotNull() & _usable(v))
    rows = usable.select(F.col(id_column).cast("long").alias("id"), whole.alias("v"))
    # Blocks are written: their numbers, and who is in them, must not change later.
    candidates = written(_packed(rows, block_rows), "candidates")
    asking = usable.filter(F.coalesce(is_query, F.lit(False))).select(F.col(id_column).cast("long").alias("id"), whole.alias("v"))
    asked = written(_packed(asking.distinct(), query_rows), "queries")

    cells = 3 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    across = max(-(-asked.count() // held_blocks), 1)
    down = max(min(-(-cells // across), candidates.count()), 1)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    # A query's copy in each row of the grid comes ahead of the candidates there.
    sent = asked.withColumns({"column": dealt(across), "row": every(down), "is_candidate": F.lit(False)}).unionByName(
        candidates.withColumns({"row": dealt(down), "column": every(across), "is_candidate": F.lit(True)})
    )
    cell = ["width", "column", "row"]
    met = sent.repartition(cells, *cell).sortWithinPartitions(*cell, "is_candidate", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, found = None, [], []
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in cell)))
            for row, place in enumerate(places):
                if place != now:
                    yield from _results(held, found)
                    now, held, found = place, [], []
                n, width = batch.column("n")[row].as_py(), place[0]
                # Copies: batches may be let go while their queries are held.
                ids = np.frombuffer(batch.column("ids")[row].as_buffer(), "<i8").copy()
                data = np.frombuffer(batch.column("data")[row].as_buffer(), "<i8").reshape(n, width).copy()
                if not batch.column("is_candidate")[row].as_py():
                    held.append((ids, data))
                    found.append([(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n)
                    continue
                for (q_ids, queries), so_far in zip(held, found):
                    scores = accumulate(queries, data)
                    for q, q_id in enumerate(q_ids):
                        so_far[q] = _merged(so_far[q], scores[q], ids, q_id, k)
        yield from _results(held, found)

    columns = [*cell, "n", "ids", "data", "is_candidate"]
    hits = met.select(*columns).mapInArrow(search, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec_id").alias(id_column), "score")
    )


def _merged(so_far: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, own: int, k: int):
    """A query's best rows, now that one more block of candidates is known."""
    old_ids, old_scores = so_far
    if scores.dtype == object:
        scores = np.where(ids == own, 0, scores)  # a row's product with itself is not asked for
        if any(abs(s) >= 2**63 for s in scores):
            raise OverflowError("a score does not fit a long integer")
        scores = scores.astype(np.int64)
    if len(old_ids) == k:
        # Only what reaches the worst of the best so far can take a place.
        near = np.flatnonzero((scores >= old_scores.min()) & (ids != own))
    else:
        near = np.flatnonzero(ids != own)
    if not len(near):
        return so_far
    all_ids, all_scores = np.r_[old_ids, ids[near]], np.r_[old_scores, scores[near]]
    kept = best(all_scores, all_ids, k)
    return all_ids[kept], all_scores[kept]


def _results(held: list, found: list) -> Iterator[pa.RecordBatch]:
    for (q_ids, _), rows in zip(held, found):
        sizes = [len(ids) for ids, _ in rows]
        columns = [np.repeat(q_ids, sizes), np.concatenate([ids for ids, _ in rows]), np.concatenate([scores for _, scores in rows])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])
