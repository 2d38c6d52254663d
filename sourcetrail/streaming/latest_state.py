"""Latest state per key over a stream.

Every key's newest row is kept as state of its own, without any time limit: an older event never wins, however
late it comes.  A batch gives only the rows that really changed, which become one run of the state's table; runs are
merged on the way, so storage follows the keys and not the number of batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sourcetrail.streaming.run_folders import RunFolders

PARTITIONS = "spark.sql.shuffle.partitions"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a commit then writes what the batch changed, not the files of the whole store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def changed_rows(events: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """Stream of rows that became the newest of their key.

    The state of a key is the maximum of its rows, ordered as ``cdc.latest_by`` orders them, with the time of the batch
    that brought it; of equal rows the earliest stays.  A key's maximum that bears this batch's time is new.  Tasks reduce
    their own events first, so a hot key crosses the network as one row per task."""
    rest = [n for n in events.columns if n not in keys and n != sequence_by]
    since = -F.unix_micros(F.current_timestamp())
    newest = F.max(F.struct(sequence_by, *rest, "__since")).alias("__newest")
    states = events.withColumn("__since", since).groupBy(*keys).agg(newest)
    changed = states.where(F.col("__newest.__since") == since)
    return changed.select(*keys, "__newest.*").select(*events.columns)


def start_latest_state(
    events: DataFrame,
    keys: list[str],
    sequence_by: str,
    folder: str,
    checkpoint: str,
    merge_after: int = 8,
    on_change: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Bring the table in ``folder`` up to date with all events that have arrived, then stop.

    ``on_change`` gets every batch's changed rows, read from where they were written, with the batch's number."""
    spark = events.sparkSession
    table = RunFolders(spark, folder, events.schema, keys, sequence_by)

    def keep(changed: DataFrame, batch: int) -> None:
        table.add(changed, batch)
        if on_change:
            on_change(spark.read.schema(events.schema).parquet(table.path((batch, batch))), batch)
        table.merge(merge_after)

    # state on disk, not in memory, and in one store per core: opening and committing a store costs the same in every batch,
    # however few keys it holds.  A query keeps what it was started with, its checkpoint the number of stores
    stores = min(int(spark.conf.get(PARTITIONS)), spark.sparkContext.defaultParallelism)
    wanted = {**SETTINGS, PARTITIONS: str(stores)}
    usual = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        return (
            changed_rows(events, keys, sequence_by)
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
    finally:
        for name, value in usual.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_latest_state(spark: SparkSession, folder: str, schema, keys: list[str], sequence_by: str) -> DataFrame:
    """Current rows: the newest of every key over the runs."""
    return RunFolders(spark, folder, schema, keys, sequence_by).read()
