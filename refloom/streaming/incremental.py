"""Incremental operators: resume, changed files, continuous arrival, work states, partition progress."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.operators.dedup import dedup_last
from refloom.operators.skew import join_keys, tie


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(file_key, last_modified, size) of files, without reading their content."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.col("path").alias("file_key"), F.col("modificationTime").alias("last_modified"), F.col("length").alias("size")
    )


def changed_files(files: DataFrame, manifest: DataFrame, key: str = "file_key", stamp: str = "last_modified") -> DataFrame:
    """Files that are new, whose stamp differs, or whose last load did not complete."""
    known = manifest.filter("status = 'completed'").select(key, F.col(stamp).alias("_known"))
    rows = files.join(known, key, "left")
    return rows.filter(F.col("_known").isNull() | (F.col("_known") != F.col(stamp))).drop("_known")


def replace_files(base: DataFrame, loaded: DataFrame, key: str = "file_key") -> DataFrame:
    """Rows of reloaded files replace all rows these files gave before; nothing is appended twice."""
    kept = join_keys(base, loaded.select(key).distinct(), [key], "left_anti")
    return kept.unionByName(loaded)


def update_manifest(manifest: DataFrame, loads: DataFrame, key: str = "file_key", order: Sequence[str] = ("last_modified",)) -> DataFrame:
    """Latest state per file."""
    rows = manifest.withColumn("_side", F.lit(0)).unionByName(loads.withColumn("_side", F.lit(1)))
    return dedup_last(rows, [key], ["_side", *order]).drop("_side")


def latest_state(log: DataFrame, key: str, status: str, order: Sequence[str], failed: str = "failed") -> DataFrame:
    """State of each work item out of an append-only status log, with the number of failed tries.

    Aggregates combine before the shuffle, so an item with very many entries is no hot spot.
    """
    at = F.struct(*order)
    return log.groupBy(key).agg(
        F.max_by(status, at).alias("state"),
        F.count(F.when(F.col(status) == failed, 1)).alias("retries"),
        F.count(F.lit(1)).alias("n_entries"),
    )


def retry_queue(states: DataFrame, most: int) -> DataFrame:
    """Work that is not complete and has tries left."""
    return states.filter((F.col("state") != "completed") & (F.col("retries") < most))


def partition_progress(wanted: DataFrame, done: DataFrame, key: str, part: Column, out: str = "partition") -> DataFrame:
    """Per partition: records wanted, records done, and whether it is complete."""
    flagged = wanted.join(done.select(key).distinct().withColumn("_done", F.lit(1)), key, "left")
    counts = flagged.groupBy(part.alias(out)).agg(F.count(F.lit(1)).alias("n_wanted"), F.count("_done").alias("n_done"))
    return counts.withColumn("complete", F.col("n_wanted") == F.col("n_done"))


def write_partitions(df: DataFrame, path: str, part: Column, out: str = "partition") -> None:
    """Write by a derived partition key so that later reads prune. Hot partitions get several files."""
    rows = df.withColumn(out, part)
    rows.hint("rebalance", out).write.partitionBy(out).parquet(path)


#: Where streams keep their state: on the executors' disks, with changes logged to the checkpoint, so that it may outgrow memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run_stream(updates: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str) -> list[dict]:
    """Run a stateful stream over all that has arrived since its last run; the progress of its batches."""
    spark = updates.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        writer = updates.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return [json.loads(p.json) for p in query.recentProgress]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _arriving(spark: SparkSession, source: str, schema, glob: str | None, fmt: str) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(source)


def stream_once(
    spark: SparkSession, source: str, schema, keys: Sequence[str], order: Sequence[str | Column], target: str,
    checkpoint: str, glob: str | None = None, fmt: str = "parquet",
) -> list[dict]:
    """Take in all files that arrived since the last run; each id is kept once, over all runs. Returns the progress of the batches.

    The first batch with an id gives its row, the first one in (ascending) ``order`` within that batch. State has a row per id, with no time limit, because an id may come
    again in any later file; rows are combined in each task before they meet it, so a hot id costs one row per task. A batch
    reads what arrived and touches the state of the ids it has, never the target. It overwrites its own folder, and its time is logged with
    it, so a batch that runs again gives the same rows.
    """
    rows = _arriving(spark, source, schema, glob, fmt)
    # The time of a batch is one value, logged before it runs: whatever arrived earlier stays first.
    timed = rows.withColumn("_at", F.current_timestamp())
    at = F.struct("_at", *order, tie(rows))
    rest = [c for c in rows.columns if c not in keys]
    first = timed.groupBy(*keys).agg(F.min_by(F.struct(F.lit(0).alias("_"), *rest), at).alias("_row"), F.min("_at").alias("_arrived"))
    fresh = first.filter(F.col("_arrived") == F.current_timestamp())
    fresh = fresh.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return run_stream(fresh, save, checkpoint)


def stream_states(
    spark: SparkSession, source: str, schema, key: str, status: str, order: Sequence[str], target: str, checkpoint: str,
    failed: str = "failed", claimed: str = "claimed", note: str | None = None, glob: str | None = None, fmt: str = "parquet",
) -> list[dict]:
    """Bring the states of work items up to date with the log rows that arrived since the last run.

    Per item: its latest status, failed tries, times claimed, entries, and (with ``note``) the note of its latest row. State has one row per item, and a batch
    writes the items it changed; ``read_states`` gives the latest row of each. A batch reads new log rows only.
    """
    log = _arriving(spark, source, schema, glob, fmt)
    at = F.struct(*order)
    counts = {"retries": F.col(status) == failed, "claims": F.col(status) == claimed}
    states = log.groupBy(key).agg(
        F.max_by(status, at).alias("state"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n_entries"),
        *[F.count(F.when(c, 1)).alias(n) for n, c in counts.items()], *([F.max_by(F.struct(note), at)[note].alias(note)] if note else []),
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return run_stream(states, save, checkpoint)


def read_states(spark: SparkSession, target: str, key: str) -> DataFrame:
    """States of all items: of each one, what the last batch that changed it wrote."""
    rows = spark.read.parquet(target)
    rest = [c for c in rows.columns if c not in (key, "batch")]
    latest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return latest.select(key, *[F.col("_row")[c].alias(c) for c in rest])


def compact_states(spark: SparkSession, target: str, key: str, out: str) -> None:
    """The same as a table of one batch, for a target that many batches have written to. It bears number -1, so later batches replace it."""
    read_states(spark, target, key).write.mode("overwrite").parquet(f"{out}/batch=-1")


def claim(states: DataFrame, n: int, key: str, by: Sequence[str], most: int, claimed: str = "claimed", pending: str = "pending") -> DataFrame:
    """Log rows that claim the next ``n`` items in order: pending ones, and failed ones with tries left."""
    free = (F.col("state") == pending) | ((F.col("state") == "failed") & (F.col("retries") < most))
    return states.filter(free).orderBy(*by, key).limit(n).select(key, F.lit(claimed).alias("status"))
