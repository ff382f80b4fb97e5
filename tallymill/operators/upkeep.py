"""An aggregate table kept up to date by batches of changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymill.session import written

CHANGE = "change"


class KeptTotals:
    """Sums per group in a table partitioned by ``part``, changed batch by batch.

    A batch holds rows to add (``change`` = 1) and rows to take back (-1). It is added up
    first; then the partitions that it touches, and no others, are read, changed and
    replaced, each whole. Every row records the last batch that changed its partition, so
    that a batch that is applied again, after a failure in between or by mistake, leaves
    alone the partitions that it has changed already: the table is the same as if each
    batch had been applied once. Batches are numbered from 1 and come in order.

    Groups of which all rows have been taken back stay as hidden rows of zeros. Sums must
    be exact for rows to be taken back: integers or decimals. A null partition raises.
    """

    def __init__(self, spark: SparkSession, path: str, part: str, keys: Sequence[str], totals: Mapping[str, Column]) -> None:
        self._spark, self.path, self._part, self._keys, self._totals = spark, path, part, list(keys), dict(totals)

    def apply(self, changes: DataFrame, batch: int) -> None:
        """Bring a batch into the table."""
        names = ["n_rows", *self._totals]
        sums = {"n_rows": F.lit(1).cast("long"), **self._totals}
        part = F.when(F.col(self._part).isNull(), F.raise_error(F.lit(f"{self._part} is null"))).otherwise(F.col(self._part))
        # A batch has at most a row per group, however many changes.
        added = [F.sum(value * F.col(CHANGE)).alias(name) for name, value in sums.items()]
        delta = written(changes.withColumn(self._part, part).groupBy(self._part, *self._keys).agg(*added), "delta")
        if self._exists():
            # One value per partition of the batch: with them the scan reads no other.
            touched = [row[0] for row in delta.select(self._part).distinct().collect()]
            kept = self.table(with_batch=True).filter(F.col(self._part).isin(touched))
            last = kept.groupBy(self._part).agg(F.max("_batch").alias("_last"))
            done = [row[0] for row in last.filter(F.col("_last") >= batch).collect()]
            both = kept.select(self._part, *self._keys, *names).unionByName(delta).filter(~F.col(self._part).isin(done))
            # Written first, as Spark does not replace what a plan still reads.
            delta = written(both.groupBy(self._part, *self._keys).agg(*[F.sum(n).alias(n) for n in names]), "changed")
        rows = delta.withColumn("_batch", F.lit(batch))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self._part).parquet(self.path)

    def table(self, with_batch: bool = False) -> DataFrame:
        """The groups that have rows, with their sums."""
        found = self._spark.read.parquet(self.path)
        return found if with_batch else found.filter("n_rows <> 0").drop("_batch")

    def _exists(self) -> bool:
        place = self._spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self._spark._jsc.hadoopConfiguration()).exists(place)
