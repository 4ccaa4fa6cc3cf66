"""Structured streaming: hit tables arrive as files, and the coverage cap keeps up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.running import coverage_cap


def hit_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def capped(stream: DataFrame, state_path: str, out_path: str, checkpoint: str, least: int = 10, cap: int = 100, buckets: int = 256) -> StreamingQuery:
    """Append each micro-batch to the hit table, then recompute only the proteins it touched.

    The table is partitioned by a bucket of the protein, so a batch reads the buckets of its proteins
    only. A batch's rows carry its id, so a batch that is run again overwrites itself instead of adding twice.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("bucket", F.expr(f"pmod(xxhash64(protein), {buckets})").cast("int"))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{state_path}/batch={batch_id}")
        mine = spark.read.parquet(f"{state_path}/batch={batch_id}")
        touched = mine.select("protein").distinct()
        known = [r.bucket for r in mine.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
        hits = spark.read.parquet(state_path).filter(F.col("bucket").isin(known)).drop("batch", "bucket").join(touched, "protein", "left_semi")
        coverage_cap(hits, F.col("evalue"), least, cap).withColumn("version", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest result of each protein."""
    rows = spark.read.parquet(out_path)
    newest = rows.groupBy("protein").agg(F.max("version").alias("version"))
    return rows.join(newest, ["protein", "version"], "left_semi").drop("batch", "version")


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", key: str = "event_type") -> DataFrame:
    """Counts per tumbling window with a watermark; works on streams and tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", key: str = "user_id") -> DataFrame:
    """Events per session of a user."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), key, "n")


def run_now(query: Callable[[], StreamingQuery]) -> None:
    query().awaitTermination()
