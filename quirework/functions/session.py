"""The folder that all executors share, and tables staged in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in a local session without it a temporary folder, on a cluster an error: executors would each write to a disk of their own."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="quirework-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def staged(df: DataFrame, label: str, sized: bool = True) -> DataFrame:
    """``df`` written to the shared folder and read back, for tables that several branches of a plan read.

    Such a table is computed once, survives lost executors and keeps the plans that use it short.
    The optimizer takes the bytes of its files for its size; with ``sized`` it is told better by ``rightly_sized``.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return rightly_sized(stored) if sized else stored


def rightly_sized(stored: DataFrame) -> DataFrame:
    """``stored``, never to be broadcast if its rows take more than the limit for that.

    Files of few distinct values are small: 400,000 pages of 13 columns take 2 MB, but over
    40 MB in a broadcast, which the driver builds. Rows are counted by the files' footers, and only
    where the files are so small that some of their columns might seem to fit.
    """
    limit = stored.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    told = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if told > 10 * limit or stored.count() * (8 + stored._jdf.schema().defaultSize()) <= limit:
        return stored
    return stored.hint("merge")
