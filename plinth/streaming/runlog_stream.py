"""Run-log ingestion as a stream (A08 semantics).

New run records land as files in ``source``; each micro-batch keeps the runs
whose duplicate keys are not yet in the log (and the first of several new ones
with equal keys), then writes them to ``<log>/batch=<id>``.  A batch reads the
folders of earlier batches only, never its own, so running it again after a
failure writes the same rows to the same folder; the checkpoint records which
files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.operators.runlog import DEDUP_KEYS, fresh_runs


def append_batch(batch: DataFrame, batch_id: int, log_path: str, schema: T.StructType, keys=DEDUP_KEYS,
                 order: str = "run_id") -> None:
    """Append one micro-batch to the log; may run any number of times for a batch id."""
    path = log_path.rstrip("/")
    dated = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    log = batch.sparkSession.read.schema(dated).parquet(path).where(F.col("batch") < batch_id).drop("batch")
    fresh_runs(log, batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def stream_append_runs(spark: SparkSession, source: str, log_path: str, checkpoint: str, schema: T.StructType,
                       keys=DEDUP_KEYS, order: str = "run_id", max_files_per_trigger: int | None = None,
                       fmt: str = "parquet") -> DataFrame:
    """Process every file available in ``source`` (``availableNow`` trigger) and return the log."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    runs = reader.load(source)

    q = (runs.writeStream.foreachBatch(lambda batch, batch_id: append_batch(batch, batch_id, log_path, schema, keys, order)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(schema).parquet(log_path)
