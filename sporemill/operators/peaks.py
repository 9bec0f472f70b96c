"""Peaks of length histograms, for splitting clusters of long reads by length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def peaks(histogram: DataFrame, height: int = 15, distance: int = 20, width: int = 1) -> DataFrame:
    """(cluster, center) from histogram(cluster, length, reads): lengths of at least ``height`` reads with no larger bin
    within ``distance``, of equal ones the shortest; and ``width`` bins or more in a row around it, within that distance,
    that have half its reads."""
    near = Window.partitionBy("cluster").orderBy("length").rangeBetween(-distance, distance)
    best = F.max(F.struct("reads", (-F.col("length")).alias("l"))).over(near)
    top = histogram.withColumn("_b", best).where((F.col("reads") >= height) & (F.col("_b.l") == -F.col("length"))).select("cluster", F.col("length").alias("center"), F.col("reads").alias("_top"))
    if width <= 1:
        return top.drop("_top")
    bins = top.join(histogram, "cluster").where((F.abs(F.col("length") - F.col("center")) <= distance) & (F.col("reads") * 2 >= F.col("_top")))
    # lengths in a row keep their distance to their number
    run = F.col("length") - F.row_number().over(Window.partitionBy("cluster", "center").orderBy("length"))
    runs = bins.withColumn("_run", run).groupBy("cluster", "center", "_run").agg(F.count("*").alias("_w"), F.max((F.col("length") == F.col("center")).cast("int")).alias("_in"))
    return runs.where((F.col("_in") == 1) & (F.col("_w") >= width)).select("cluster", "center")


def nearest(reads: DataFrame, centers: DataFrame) -> DataFrame:
    """reads(read_id, cluster, length) with the nearest center of their cluster, ties to the lower; null without centers.

    A cluster has few centers, so lengths, and not reads, are compared with them.
    """
    lengths = reads.select("cluster", "length").distinct().join(centers, "cluster")
    best = lengths.groupBy("cluster", "length").agg(F.min(F.struct(F.abs(F.col("length") - F.col("center")).alias("d"), "center")).alias("b"))
    return reads.join(best.select("cluster", "length", "b.center"), ["cluster", "length"], "left")


def split_by_length(reads: DataFrame, height: int = 15, distance: int = 20, width: int = 1) -> DataFrame:
    """Adds center and subcluster (cluster_center) to reads(read_id, cluster, length)."""
    histogram = reads.groupBy("cluster", "length").agg(F.count("*").alias("reads"))
    return nearest(reads, peaks(histogram, height, distance, width)).withColumn("subcluster", F.concat_ws("_", "cluster", "center"))
