"""Cutting lineage on shared storage, and broadcasting only what has been measured."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure a checkpoint folder is set; one named by the cluster is never replaced.

    A local session may do with a folder of this machine; on a cluster, where executors could not read it, a missing one is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cellscore-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder; later reads survive lost executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of narrow tables (terms, pairs of terms, labels) that are broadcast.
MOST_SMALL = 200_000


def small_enough(df: DataFrame, most_rows: int = MOST_SMALL) -> DataFrame:
    """df with a broadcast hint if it has at most most_rows rows, otherwise df unchanged.

    Counts at most most_rows + 1 rows, so a table that has outgrown the bound is
    not scanned whole; the join then runs as a shuffle join.
    """
    if df.limit(most_rows + 1).count() <= most_rows:
        return F.broadcast(df)
    return df


def numbered_within(df: DataFrame, key: str, order: str, number: str) -> DataFrame:
    """df with number: the place, from 0, of each row among those of its key, by order.

    Rows are range-partitioned by key and order and counted by partition, so a key that holds most rows is
    numbered by many tasks; only one count for each partition and key meets in a window.
    """
    ranged = cut_lineage(df.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part", key).agg(F.count("*").alias("_n"))
    before = counts.select("_part", key, (F.sum("_n").over(Window.partitionBy(key).orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part", key).orderBy(order)) - 1
    return ranged.withColumn("_inside", inside).join(before, ["_part", key]).withColumn(number, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")
