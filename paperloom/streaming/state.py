"""Functions that work on batch and streaming frames alike, and a resumable sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TERMINAL = ("done", "failed")


def first_terminal(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Streams: each data_id once, when it first is done or failed; state is dropped after ``late``."""
    return events.where(F.col("state").isin(*TERMINAL)).withWatermark("ts", late).dropDuplicatesWithinWatermark(["data_id"])


def first_terminal_batch(events: DataFrame) -> DataFrame:
    ends = events.where(F.col("state").isin(*TERMINAL))
    return ends.groupBy("data_id").agg(F.min_by(F.struct("state", "ts"), F.struct("ts", "event_id")).alias("e")).select("data_id", "e.state", "e.ts")


def heartbeat(events: DataFrame, length: str = "10 minutes", slide: str = "30 seconds", late: str | None = None) -> DataFrame:
    """Fresh outputs in a sliding window."""
    rows = events.withWatermark("ts", late) if late else events
    return rows.groupBy(F.window("ts", length, slide).alias("w")).agg(F.count("*").alias("fresh")).select(F.col("w.start").alias("window_start"), "fresh")


def sessions(events: DataFrame, gap: str = "15 minutes", late: str | None = None) -> DataFrame:
    """Runs of activity of a user without a pause of ``gap``: what lies between is a stall."""
    rows = events.withWatermark("ts", late) if late else events
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events")).select("user_id", F.col("w.start").alias("started"), "events")


#: Parts of the index of a sink's keys.
BUCKETS = 64


def known_keys(batch: DataFrame, number: int, path: str, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys that batches before ``number`` wrote, of the buckets that the keys of ``batch`` fall in: ``buckets`` numbers at most
    pass the driver."""
    touched = [r["_bucket"] for r in batch.select(_bucket(key, buckets)).distinct().collect()]
    schema = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in key)
    index = batch.sparkSession.read.schema(f"{schema}, _batch long, _bucket int").parquet(f"{path}/_index")
    return index.where((F.col("_batch") < number) & F.col("_bucket").isin(touched)).select(*key)


def append_once(batch: DataFrame, number: int, path: str, key: list[str], buckets: int = BUCKETS) -> None:
    """Write the rows of micro-batch ``number`` whose ``key`` no earlier batch wrote.

    Rows go to ``_batch=number``, keys to an index by batch and bucket with a Bloom filter in each file. Only the buckets that the
    batch's keys fall in are read, and never the rows. A batch that is played again, wherever it broke off, replaces its own part
    of both and overlooks that part of the index, so it writes the same.
    """
    once = batch.dropDuplicates(key)
    if number and _exists(batch.sparkSession, f"{path}/_index"):
        known = known_keys(batch, number, path, key, buckets).select(*[F.col(k).alias(f"__{k}") for k in key])
        once = once.join(known, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key], "left_anti")
    once.write.mode("overwrite").parquet(f"{path}/_batch={number}")
    writer = _written(batch, number, path).select(*key, _bucket(key, buckets)).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket")
    for k in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.parquet(f"{path}/_index/_batch={number}")


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("_bucket")


def _written(batch: DataFrame, number: int, path: str) -> DataFrame:
    return batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/_batch={number}")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def resumable_sink(results: DataFrame, path: str, checkpoint: str, key: list[str]):
    """Starts a query that appends rows whose ``key`` the sink does not have yet; restarts continue at the checkpoint."""
    once = lambda batch, number: append_once(batch, number, path, key)
    return results.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
