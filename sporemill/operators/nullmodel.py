"""Raup-Crick distances by simulation, in blocks: null communities are rows of bits, and pairs are counted by matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise

#: Samples of a block.
PLACES = 256

#: A table of distances has the square of as many samples.
MOST_SAMPLES = 1_000_000


def drawn(rich: np.ndarray, weights: np.ndarray, seed: int, simulation: int, block: int) -> np.ndarray:
    """A row of presences for each richness: so many OTUs without replacement, by weight (least exponential times)."""
    rng = np.random.default_rng([seed, simulation, block])
    out = np.zeros((len(rich), len(weights)), bool)
    for row, r in zip(out, rich):
        times = rng.exponential(size=len(weights)) / weights
        row[np.argpartition(times, r - 1)[:r]] = True
    return out


def raup_crick(counts: DataFrame, simulations: int = 999, seed: int = 1) -> DataFrame:
    """(s1, s2, d): the share of null communities in which a pair of samples shares at least as many OTUs as it does, the real
    one counted; 1 for pairs that share none.

    A null community has the sample's richness; OTUs are drawn by how many samples have them. Of the OTUs, tasks know only
    how many have each weight. Cells without a sample, an OTU or a count above zero count for nothing.
    """
    spark = counts.sparkSession
    cells = counts.where("n > 0 and sample is not null and otu is not null").select("otu", "sample").distinct()
    cells = materialise(cells, "cells")
    rows = cells.groupBy("sample").agg(F.count("*").alias("k")).limit(MOST_SAMPLES + 1).collect()
    if len(rows) > MOST_SAMPLES:
        raise ValueError(f"null communities are drawn for at most {MOST_SAMPLES} samples")
    rows.sort(key=lambda r: r["sample"])
    rich = np.array([r["k"] for r in rows], np.int64)
    often = cells.groupBy("otu").agg(F.count("*").alias("w")).groupBy("w").agg(F.count("*").alias("m")).orderBy("w").collect()  # weights are at most samples
    histogram = spark.sparkContext.broadcast((np.array([r["w"] for r in often], float), np.array([r["m"] for r in often], np.int64)))
    richness, blocks = spark.sparkContext.broadcast(rich), -(-len(rich) // PLACES)
    places = PLACES  # goes with the tasks' code

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = np.repeat(*histogram.value)
        for batch in batches:
            for i in batch["id"]:
                sim, block = divmod(int(i), blocks)
                found = drawn(richness.value[block * places : (block + 1) * places], weights, seed, sim, block)
                yield pd.DataFrame({"sim": [sim], "block": [block], "bits": [np.packbits(found, axis=1).tobytes()]})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    draws = materialise(spark.range(0, simulations * blocks, 1, parts).mapInPandas(draw, "sim long, block long, bits binary"), "draws")
    a, b = draws.select("sim", F.col("block").alias("b1"), F.col("bits").alias("x")), draws.select("sim", F.col("block").alias("b2"), F.col("bits").alias("y"))
    at = spark.createDataFrame(pd.DataFrame([(r["sample"], i) for i, r in enumerate(rows)], columns=["sample", "at"]), "sample string, at long")
    one, two = cells.withColumnRenamed("sample", "s1"), cells.withColumnRenamed("sample", "s2")
    shared = one.join(two, "otu").where("s1 < s2").groupBy("s1", "s2").agg(F.count("*").alias("obs"))
    every = at.select(F.col("sample").alias("s1"), F.col("at").alias("a1")).join(at.select(F.col("sample").alias("s2"), F.col("at").alias("a2")), F.col("s1") < F.col("s2"))
    real = materialise(every.join(shared, ["s1", "s2"], "left").withColumn("obs", F.coalesce("obs", F.lit(0))), "observed")
    block = lambda c: F.floor(F.col(c) / places)
    cell = ((F.col("a1") % places) * places + F.col("a2") % places).cast("int")

    def matrix(own: pd.DataFrame) -> pd.DataFrame:
        m = np.zeros(places * places, np.int64)
        m[own["cell"].to_numpy()] = own["obs"].to_numpy()
        return pd.DataFrame({"b1": own["b1"].iloc[:1], "b2": own["b2"].iloc[:1], "obs": [m.tobytes()]})

    observed = real.select(block("a1").alias("b1"), block("a2").alias("b2"), cell.alias("cell"), "obs").groupBy("b1", "b2").applyInPandas(matrix, "b1 long, b2 long, obs binary")
    pairs = a.join(b, "sim").where("b1 <= b2").join(observed, ["b1", "b2"])
    pairs = pairs.repartition(parts, "b1", "b2", F.col("sim") % 64).sortWithinPartitions("b1", "b2")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = -(-int(histogram.value[1].sum()) // 8)
        key, total = None, None
        for batch in batches:
            for b1, b2, x, y, obs in zip(batch["b1"], batch["b2"], batch["x"], batch["y"], batch["obs"]):
                if key != (b1, b2):
                    if key:
                        yield pd.DataFrame({"b1": key[0], "b2": key[1], "ge": [total.ravel()]})
                    key, total = (b1, b2), np.zeros((places, places), np.int64)
                p, q = (np.unpackbits(np.frombuffer(v, np.uint8).reshape(-1, width), axis=1).astype(np.float32) for v in (x, y))
                want = np.frombuffer(obs, np.int64).reshape(places, places)[: len(p), : len(q)]
                total[: len(p), : len(q)] += p @ q.T >= want
        if key:
            yield pd.DataFrame({"b1": key[0], "b2": key[1], "ge": [total.ravel()]})

    ge = pairs.select("b1", "b2", "x", "y", "obs").mapInPandas(count, "b1 long, b2 long, ge array<long>").select("b1", "b2", F.posexplode("ge").alias("cell", "ge"))
    ge = ge.groupBy("b1", "b2", "cell").agg(F.sum("ge").alias("ge"))
    ge = ge.select((F.col("b1") * places + F.floor(F.col("cell") / places)).alias("a1"), (F.col("b2") * places + F.col("cell") % places).alias("a2"), "ge")
    d = F.when(F.col("obs") == 0, 1.0).otherwise((F.coalesce("ge", F.lit(0)) + 1) / (F.lit(simulations) + 1))
    return real.join(ge, ["a1", "a2"], "left").select("s1", "s2", d.alias("d"))
