"""Incremental validation of JSONL shards as they land (Structured Streaming).

The file source picks up new files; every micro-batch holds whole files, so the
per-file counts written for a batch are final for those files.  Results are
appended with ``foreachBatch`` to a parquet table keyed by (batch_id, file);
the streaming checkpoint makes reprocessing after a failure idempotent
(a re-run batch overwrites its own ``batch_id`` partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..operators import validate as V
from ..session import configure


def _summaries(batch: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    lines = batch.select(F.col("file"), F.lit(None).cast("bigint").alias("line_no"), F.col("value").alias("line"))
    return V.summary(V.validate_lines(lines, bounds))


def start_validation_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                            glob: str = "*.jsonl", bounds: dict[str, tuple[int, int]] = K.TRAINING_BOUNDS,
                            available_now: bool = False, max_files_per_trigger: int | None = None
                            ) -> StreamingQuery:
    """Start the stream; returns the running query."""
    configure(spark)
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(input_dir).select(F.col("_metadata.file_path").alias("file"), "value")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = _summaries(batch, bounds).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(output_dir))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
