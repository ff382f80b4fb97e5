"""Event-time jobs as streams.

Each run reads what has arrived, writes the finished windows to a file sink and
stops (``availableNow``). Offsets, state and output live in one folder that all
executors share, so a lost executor or a restarted query goes on from the last
committed batch, and windows are written exactly once.

Windows are emitted only once the watermark has passed their end; those still
open at the end of the input stay in the state for the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallymill.session import scratch_path, settings

Transform = Callable[[DataFrame], DataFrame]

# State on local disk with changes saved to the shared folder, so that its size is
# not limited by the heap; sessions are joined in each task before the shuffle.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def instant(time: str) -> Column:
    """A zone-less timestamp read as UTC, whatever the session zone; watermarks need it."""
    return F.expr(
        f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{time}`))"
    )


def zone_less(time: Column) -> Column:
    """The inverse of ``instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(time), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def arrivals(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A stream of parquet files with event time in ``at``. ``path`` may be a glob.

    All waiting files form one batch unless ``max_files`` limits it. With a limit
    files should arrive in time order, or their rows may count as late.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumn("at", instant("ts"))


def run_once(stream: DataFrame, folder: str) -> None:
    """Process what is there and stop. Calling it again continues in ``folder``."""
    with settings(stream.sparkSession, STREAM_SETTINGS):
        started = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .start()
        )
    started.awaitTermination()


def output(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/out")


def streamed(spark: SparkSession, path: str, schema: StructType, job: Transform, label: str) -> DataFrame:
    """Run ``job`` over the files at ``path`` and return what it wrote, which stays until the driver ends."""
    folder = scratch_path(spark, label)
    stream = job(arrivals(spark, path, schema))
    run_once(stream, folder)
    return output(spark, folder, stream.schema)


def tumbling(delay: str, width: str) -> Transform:
    def job(stream: DataFrame) -> DataFrame:
        return (
            stream.withWatermark("at", delay)
            .groupBy(F.window("at", width).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
            .select(
                zone_less(F.col("w.start")).alias("window_start"),
                zone_less(F.col("w.end")).alias("window_end"),
                "n_events",
                F.round("total", 2).alias("total_value"),
            )
        )

    return job


def sliding(delay: str, width: str, step: str) -> Transform:
    def job(stream: DataFrame) -> DataFrame:
        return (
            stream.withWatermark("at", delay)
            .groupBy(F.window("at", width, step).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(zone_less(F.col("w.start")).alias("window_start"), "n_events")
        )

    return job


def sessions(delay: str, gap: str) -> Transform:
    def job(stream: DataFrame) -> DataFrame:
        return (
            stream.withWatermark("at", delay)
            .groupBy("user_id", F.session_window("at", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(
                "user_id",
                zone_less(F.col("w.start")).alias("session_start"),
                zone_less(F.col("w.end")).alias("session_end"),
                "n_events",
            )
        )

    return job


def answers(delay: str, question: Column, answer: Column) -> Transform:
    """For each row that satisfies ``question``: the user's rows within the next hour that satisfy ``answer``.

    Returns the number of answers and the time of the first, for questions without any
    too, once the watermarks of both sides say that no more can come. Both sides wait in
    the state, an hour and the delay long.

    Users are cut into hours, so that the rows of a busy one lie in as many tasks as
    hours are open: a question waits in its own hour and in the next one, an answer
    belongs to one hour. What is found in the two hours is added up at the end, by
    ``event_id``, which should identify a question.
    """
    hour = F.expr("(unix_micros(at) - pmod(unix_micros(at), 3600000000)) div 3600000000")

    def job(stream: DataFrame) -> DataFrame:
        asked = (
            stream.filter(question)
            .select("event_id", "user_id", F.col("at").alias("asked_at"), F.explode(F.array(hour, hour + 1)).alias("hour"))
            .withWatermark("asked_at", delay)
        )
        answered = (
            stream.filter(answer)
            .select(F.col("user_id").alias("_user"), F.col("at").alias("answered_at"), hour.alias("_hour"))
            .withWatermark("answered_at", delay)
        )
        in_time = "answered_at > asked_at AND answered_at <= asked_at + INTERVAL 1 HOUR"
        met = asked.join(answered, F.expr(f"user_id = _user AND hour = _hour AND {in_time}"), "leftOuter")
        return (
            met.groupBy("event_id", "user_id", F.window("asked_at", "1 hour"))
            .agg(F.min("asked_at").alias("asked"), F.count("answered_at").alias("n_answers"), F.min("answered_at").alias("first"))
            .select(
                "event_id", "user_id", zone_less(F.col("asked")).alias("asked_at"), "n_answers",
                zone_less(F.col("first")).alias("answered_at"),
            )
        )

    return job


def first_seen(delay: str, keys: list[str]) -> Transform:
    """One row per key and stretch of ``delay``.

    Each Arrow batch is first cut, without state, to the earliest and the latest
    row of every key: the state then drops of the key what it would have dropped
    anyway, the watermark still sees the latest time, and a frequent key sends few
    rows to the task that holds its state.
    """

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            cut = rows.group_by(keys).aggregate([("at", "min"), ("at", "max")])
            first = cut.select([*keys, "at_min"]).rename_columns([*keys, "at"])
            last = cut.filter(pc.not_equal(cut["at_min"], cut["at_max"])).select([*keys, "at_max"]).rename_columns([*keys, "at"])
            yield from pa.concat_tables([first, last]).cast(batch.schema).to_batches()

    def job(stream: DataFrame) -> DataFrame:
        rows = stream.select(*keys, "at")
        return (
            rows.mapInArrow(ends, rows.schema)
            .withWatermark("at", delay)
            .dropDuplicatesWithinWatermark(keys)
            .select(*keys)
        )

    return job
