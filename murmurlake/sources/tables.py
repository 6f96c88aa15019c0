"""Readers of the stored tables, with the columns that several queries derive alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurlake.functions.time import usable_millis


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than the cluster has cores, dealt out anew; others as they are.

    For work that multiplies rows or is heavy a row. Large tables have more splits than
    cores, so they are never shuffled for this.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def account() -> Column:
    """The uid of a message: ``uid``, or ``sender.uid`` if that is null."""
    return F.coalesce(F.col("uid"), F.col("sender.uid"))


def message_time() -> Column:
    return usable_millis("timestamp_ms", "time_text")
