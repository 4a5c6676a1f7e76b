"""How tables are read, and where intermediate ones live."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions.session import shared_dir, staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and executors may be lost."""
    return staged(df, label, sized=False)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` made and that nothing will read again."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Up to so many hashes of keys, or words of row numbers, are broadcast; with more, rows are shuffled.
FEW = 1 << 20


def told_apart(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``column`` stands in that of ``keys``, maybe with some others, and those whose does not.

    Only hashes of keys are broadcast, so rows stay where they are. With more than FEW keys all rows are among the first.
    """
    hashes = materialize(keys.select(F.xxhash64(column).alias("_hash")).distinct(), "key-hashes")
    if hashes.count() > FEW:
        return rows, rows.where(F.lit(False))
    same = F.xxhash64(rows[column]) == F.col("_hash")
    return tuple(rows.join(F.broadcast(hashes), same, how) for how in ("left_semi", "left_anti"))


def numbered(rows: DataFrame, wanted: DataFrame, number: str = "uid") -> DataFrame:
    """``rows`` whose ``number``, a long of their own, stands in ``wanted``.

    A word has the bits of 64 numbers in a row, so a list of most rows is short and is broadcast: rows stay where they are.
    With more than FEW words Spark chooses the join.
    """
    words = materialize(wanted.groupBy(F.shiftright(number, 6).alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST({number} & 63 AS INT))")).alias("_bits")), "row-numbers")
    listed = F.broadcast(words) if words.count() <= FEW else words
    found = rows.withColumn("_word", F.shiftright(number, 6)).join(listed, "_word")
    return found.where(f"shiftright(_bits, CAST({number} & 63 AS INT)) & 1 = 1").drop("_word", "_bits")


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], count: str = "n", how: str = "inner") -> DataFrame:
    """``rows`` with what ``facts`` (one row for each key, ``count`` of them in ``rows``) says of their key.

    Keys of more rows than a task's fair share are fewer than there are tasks, so their list is
    broadcast; their rows are dealt over all tasks, and their facts repeated for each. ``rows``
    must be a stored table, so that a task that runs again deals its rows alike.
    """
    parts = partitions(rows.sparkSession)
    total = facts.agg(F.sum(count)).first()[0] or 0
    heavy = facts.where(F.col(count) > total // parts).select(*keys, F.lit(True).alias("_heavy"))
    dealt = rows.join(F.broadcast(heavy), keys, "left").withColumn("_salt", F.when(F.col("_heavy"), F.pmod(F.monotonically_increasing_id(), F.lit(parts))).otherwise(F.lit(0).cast("long"))).drop("_heavy")
    last = F.when(F.col(count) > total // parts, F.lit(parts - 1)).otherwise(F.lit(0)).cast("long")
    spread = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop(count)
    return dealt.join(spread, [*keys, "_salt"], how).drop("_salt")
