"""Structured Streaming over raw window files: new files are picked up, deduplicated per file and written once."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jangbu.operators.normalize import normalized
from jangbu.sources.raw import split_meta

#: Window files a batch at most. A batch costs the same fixed time whether its files are few or many, and the driver holds their names.
BATCH_FILES = 16384
#: Window files are small: listed by few tasks instead of one each, and read many to a task.
SMALL_FILES = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "64", "spark.sql.files.openCostInBytes": str(256 << 10)}


def _for_small_files(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` but for those that concern small files; those of ``spark`` stay as they are."""
    own = spark.newSession()
    for key, value in (spark.conf.getAll | SMALL_FILES).items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def stream_windows(spark: SparkSession, folder: str, feed: str, out: str, checkpoint: str, batch_files: int = BATCH_FILES) -> StreamingQuery:
    """Normalises every window file that isn't processed yet, then stops. Which files are done is in the checkpoint, so a
    second run does only what is new, and a run that broke off starts again at the file it broke at. A file is always in
    one batch whole, which keeps deduplication within it, and a batch that is done again replaces what it wrote. A batch has
    at most ``batch_files`` files, is read once and lies on the executors' disks until it is written."""
    lines = _for_small_files(spark).readStream.format("text").option("maxFilesPerTrigger", batch_files).load(folder)
    tagged = lines.select(F.col("_metadata.file_name").alias("file"), "value").where(F.trim("value") != "")

    def batch(df: DataFrame, number: int) -> None:
        held: list[DataFrame] = []

        def hold(rows: DataFrame) -> DataFrame:
            held.append(rows.persist(StorageLevel.DISK_ONLY))
            return held[-1]

        try:
            metas, records = split_meta(df.withColumn("pos", F.monotonically_increasing_id()), hold)
            normalized(records, metas, feed, hold).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year", "month").parquet(f"{out}/batch={number}")
        finally:
            for rows in held:
                rows.unpersist()

    return tagged.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, ts: str, key: str, width: str = "7 days", late: str = "1 day") -> DataFrame:
    """Counts per key and tumbling window of event time; rows later than ``late`` behind the newest are dropped by the
    watermark, and repeats within it are counted once by ``event_id``."""
    unique = events.withWatermark(ts, late).dropDuplicatesWithinWatermark(["event_id"])
    return unique.groupBy(F.window(ts, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")

