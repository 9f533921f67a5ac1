"""Incremental work on the append-only response log."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.session import folder_names, work_dir
from attestry.sources.readers import CORRUPT, LOG_LINES, split_responses

LOG_KEYS = ["queryType", "owner", "repo"]

#: State is kept on the executors' disks and saved as change logs, so that a batch costs what it changes.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, not on the heap."""
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stream_responses(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New log files as a stream of response records, broken lines left out."""
    lines = (
        spark.readStream.schema(LOG_LINES)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )
    return split_responses(lines)[0]


def with_event_time(log: DataFrame) -> DataFrame:
    """The record's keys and time as top-level columns."""
    return log.select(
        F.try_to_timestamp(F.col("metadata.timestamp")).alias("ts"),
        *[F.col(f"metadata.{k}").alias(k) for k in LOG_KEYS],
        "response",
    )


def drop_repeats(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once, the row that came first, however late a repeat or a new key arrives.

    The state holds one entry for each key ever seen and no row; nothing is dropped for its time, as a watermark would.
    Start the stream with `run_to_table`, which keeps that state on disk.
    """
    return stream.dropDuplicates(keys)


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str | None = None, partition_by: str | None = None
) -> None:
    """Write everything that has arrived to Parquet, then stop."""
    spark = stream.sparkSession
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or work_dir(spark, "stream"))
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with state_on_disk(spark):
        writer.start(path).awaitTermination()


class LatestSnapshot:
    """The newest row per key of a stream, kept as keyed state.

    A micro-batch aggregates its rows to the newest per key and merges those into the state of their keys, so its cost
    follows its own rows; neither earlier batches nor the snapshot are read. The state is the snapshot: ``read`` takes it
    from the checkpoint. ``order`` names columns, the newest row having the largest values (NULL is smallest); they
    should make it unique.
    """

    def __init__(self, checkpoint: str, keys: list[str], order: list[str]):
        self.checkpoint, self.keys, self.order = checkpoint.rstrip("/"), keys, order

    def newest(self, rows: DataFrame) -> DataFrame:
        """The newest row of each key as one struct."""
        rest = [F.col(f"`{c}`") for c in rows.columns if c not in self.keys]
        newest = F.max_by(F.struct(*rest), F.struct(*[F.col(f"`{c}`") for c in self.order]))
        return rows.groupBy(*[F.col(f"`{k}`") for k in self.keys]).agg(newest.alias("newest"))

    def run(self, stream: DataFrame, changed=None) -> DataFrame:
        """Process all that has arrived and return the snapshot.

        ``changed(rows, batch)`` gets the newest rows of the keys of each batch, if given.
        """
        spark = stream.sparkSession
        writer = self.newest(stream).writeStream.outputMode("update").trigger(availableNow=True)
        writer = writer.option("checkpointLocation", self.checkpoint)
        if changed is None:
            writer = writer.format("noop")
        else:
            flat = [*self.keys, "newest.*"]
            writer = writer.foreachBatch(lambda rows, batch: changed(rows.select(*flat), batch))
        with state_on_disk(spark):
            query = writer.start()
            query.awaitTermination()
        return self.read(spark, stream)

    def read(self, spark: SparkSession, like: DataFrame) -> DataFrame:
        """The snapshot after the last completed batch, with the columns of ``like``."""
        with state_on_disk(spark):
            if not any(name.isdigit() for name in folder_names(spark, f"{self.checkpoint}/commits")):
                return spark.createDataFrame([], like.schema)
            state = spark.read.format("statestore").load(self.checkpoint)
        # The aggregate's buffer: the row of the largest order, and that order.
        return state.select("key.*", "value.valueWithExtremumOrdering.*").select(
            *[F.col(f"`{c}`") for c in like.columns]
        )

