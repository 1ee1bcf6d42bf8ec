"""Daily submission counts against a quota, counted as a stream.

Submissions arrive as files in any order.  Each micro-batch counts its own rows by
day and writes these partial counts to ``<out>/batch=<id>`` (a re-run batch
overwrites its own folder); a day's count is the sum of its partial counts.  The
stream holds no state and has no watermark, so no row is too late to be counted.
A row without a timestamp belongs to no day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_daily_quota(spark: SparkSession, source: str, out_path: str, checkpoint: str, schema: T.StructType,
                       ts: str = "timestamp", quota: int = 10, max_files_per_trigger: int | None = None,
                       fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a day is one of the session zone; naive (NTZ) input is read in it
    days = reader.load(source).select(F.date_format(F.col(ts).cast("timestamp"), "yyyy-MM-dd").alias("day")).where("day is not null")

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}")

    q = (days.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    parts = spark.read.schema("day string, n long").parquet(out_path)
    out = parts.groupBy("day").agg(F.sum("n").alias("submitted"))
    return (out.withColumn("remaining", F.greatest(F.lit(quota) - F.col("submitted"), F.lit(0)).cast("long"))
            .withColumn("quota_reached", F.col("submitted") >= quota))
