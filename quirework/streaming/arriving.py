"""Volumes that arrive as files: each micro-batch is paired and checked as it comes.

Pairing needs a volume's detections together, so a volume must arrive within one batch: one
file, or the files of one trigger. No state is kept between batches.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quirework.operators import pairing


def detection_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of detections below ``path`` as a stream."""
    schema = "doc_id long, det_id long, page_index long, label_id long, confidence double, x1 double, y1 double, x2 double, y2 double, model string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def pair_arriving(detections: DataFrame, pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the opinions of every arriving volume to ``target``; a batch that is run again replaces its own folder, and only that of its own checkpoint."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def pair(batch: DataFrame, number: int) -> None:
        pairing.pair_opinions(batch, pages).write.mode("overwrite").parquet(f"{target}/run={run}/batch={number}")

    return detections.writeStream.foreachBatch(pair).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
