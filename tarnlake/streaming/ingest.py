"""Documents that arrive as a stream: repeated texts dropped within a time, each batch joined to the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, text: str = "text", time: str = "added_date", late: str = "1 hour") -> DataFrame:
    """The stream without texts already seen within ``late``; state is bounded by the watermark."""
    return stream.withColumn("_h", F.sha2(text, 256)).withWatermark(time, late).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


def import_stream(stream: DataFrame, store: str, checkpoint: str, key: str = "line_id", text: str = "text"):
    """A query that appends to the Parquet table ``store`` the texts it doesn't hold yet.

    Within a batch the smallest key of a text stands for it; against the store only hashes are joined, and of those only
    the folders whose first hash digit the batch holds. Exactly once per batch: a batch that is run again replaces its own folders.
    """

    def run(batch: DataFrame, no: int) -> None:
        spark: SparkSession = batch.sparkSession
        hashed = batch.where(F.col(text).isNotNull()).withColumn("text_hash", F.sha2(text, 256))
        cols = [c for c in hashed.columns if c != "text_hash"]
        first = hashed.groupBy("text_hash").agg(F.min_by(F.struct(*cols), F.col(key)).alias("r")).select("text_hash", "r.*")
        first = first.withColumn("slot", F.concat(F.lit("h"), F.left("text_hash", F.lit(1))))
        if _holds_files(spark, store):
            slots = [r[0] for r in first.select("slot").distinct().collect()]  # sixteen at most
            seen = spark.read.parquet(store).where((F.col("batch") != no) & F.col("slot").isin(slots)).select("text_hash")
            first = first.join(seen, "text_hash", "left_anti")
        first.write.mode("overwrite").partitionBy("slot").parquet(f"{store}/batch={no}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def _holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a batch was written below ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/slot=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by key and time window, late ones up to the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
