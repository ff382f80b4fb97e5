"""Tables written once so that joins and groupings on their key need no shuffle any more."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallymill.session import scratch_path

BUCKETS = 64


def bucketed(df: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` written as a table of ``columns``, bucketed and sorted by ``key``.

    Two such tables of equally many buckets are joined, and each is grouped, by the key
    without moving a row. Writing shuffles each table once; it pays off from the second
    use on. Rows go to their bucket before they are written, so that every bucket is one
    sorted file. The files are removed when the driver ends. A key that holds much of a
    table makes one large bucket: for those, ``layout`` and adaptive joins are better.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        df.select(*columns).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        .option("path", scratch_path(df.sparkSession, name)).saveAsTable(name)
    )
    return df.sparkSession.table(name)
