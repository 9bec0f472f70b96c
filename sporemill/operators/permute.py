"""Permutation tests in blocks: the labels of many permutations are matrices, a block of samples each, that meet the data once.

Samples are few beside their distances, whose number is their square; so the list of samples is known to every task, and
its size is checked. Permutation 0 is the labels as they are. In permutation p the samples are ordered by the md5 of
"p:sample" and ``seed``, and take the labels in the order of (label, sample).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Samples of a block, and permutations of a chunk.
PLACES, CHUNK = 256, 128

#: Rows of members that may be known to every task: a million samples have 5e11 distances.
MOST_MEMBERS = 1_000_000


class Families:
    """The samples of one or more tests, by the test's name ``fam``: members(fam, sample, grp), groups that are null left out."""

    def __init__(self, members: DataFrame, permutations: int, seed: str = "perm"):
        self.spark: SparkSession = members.sparkSession
        rows = members.where("grp is not null and sample is not null").select("fam", "sample", "grp").distinct().limit(MOST_MEMBERS + 1).collect()
        if len(rows) > MOST_MEMBERS:
            raise ValueError(f"permutation tests hold at most {MOST_MEMBERS} members")
        self.permutations, self.seed = permutations, seed
        self.of: dict[str, tuple[list, np.ndarray, np.ndarray]] = {}
        self.groups: dict[str, list] = {}
        listed: dict[str, list] = {}
        for r in rows:
            listed.setdefault(r["fam"], []).append((r["grp"], r["sample"]))
        for fam, some in listed.items():
            some.sort()
            names, codes, size = np.unique(np.array([g for g, _ in some], object), return_inverse=True, return_counts=True)
            self.groups[fam] = names.tolist()
            self.of[fam] = ([s for _, s in some], codes.astype(np.int32), size)
        self.shared = self.spark.sparkContext.broadcast(self.of)

    def places(self) -> DataFrame:
        """(fam, sample, at): each sample's number in its family."""
        frame = pd.DataFrame([(fam, s, i) for fam, (names, _, _) in self.of.items() for i, s in enumerate(names)], columns=["fam", "sample", "at"])
        return self.spark.createDataFrame(frame, "fam string, sample string, at long")

    def sizes(self) -> DataFrame:
        """(fam, n, k): samples and groups."""
        return self.spark.createDataFrame([(fam, len(names), len(size)) for fam, (names, _, size) in self.of.items()], "fam string, n long, k long")

    def labels(self) -> DataFrame:
        """(fam, block, chunk, codes): the groups' numbers of a block's samples (rows) in a chunk's permutations, as int32."""
        names, chunks = sorted(self.of), -(-(self.permutations + 1) // CHUNK)
        shared, permutations, seed = self.shared, self.permutations, self.seed

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for i in batch["id"]:
                    fam, chunk = names[i // chunks], int(i % chunks)
                    samples, codes, _ = shared.value[fam]
                    first, last = chunk * CHUNK, min((chunk + 1) * CHUNK, permutations + 1)
                    dealt = np.empty((len(samples), last - first), np.int32)
                    for p in range(first, last):
                        keys = [hashlib.md5(f"{p}:{s}{seed}".encode()).digest() for s in samples]
                        order = sorted(range(len(samples)), key=lambda j: (keys[j], samples[j])) if p else range(len(samples))
                        dealt[np.fromiter(order, np.int64, len(samples)), p - first] = codes
                    blocks = range(0, len(samples), PLACES)
                    yield pd.DataFrame({"fam": fam, "block": [b // PLACES for b in blocks], "chunk": chunk, "codes": [dealt[b : b + PLACES].tobytes() for b in blocks]})

        ids = self.spark.range(len(names) * chunks)
        return ids.mapInPandas(run, "fam string, block long, chunk long, codes binary")

    def within(self, dist: DataFrame) -> DataFrame:
        """(fam, perm, within, total): squared distances within groups, over the groups' sizes, and all squared distances.

        Distances (s1, s2, d) are gathered by pairs of blocks, PLACES x PLACES at most, and multiplied with the indicator
        matrices of both blocks' labels. Shuffled are the distances once, and two matrices a chunk and pair of blocks.
        """
        at = self.places()
        d = dist.select("s1", "s2", (F.col("d") * F.col("d")).alias("d2"))
        d = d.join(at.select("fam", F.col("sample").alias("s1"), F.col("at").alias("a1")), "s1").join(at.select("fam", F.col("sample").alias("s2"), F.col("at").alias("a2")), ["fam", "s2"])
        d = d.select("fam", F.least("a1", "a2").alias("x"), F.greatest("a1", "a2").alias("y"), "d2")
        block = lambda c: F.floor(F.col(c) / PLACES)
        d = d.select("fam", block("x").alias("b1"), block("y").alias("b2"), (F.col("x") % PLACES).cast("int").alias("i"), (F.col("y") % PLACES).cast("int").alias("j"), "d2")
        blocks = at.select("fam", block("at").alias("b1")).distinct()
        pairs = blocks.join(blocks.withColumnRenamed("b1", "b2"), "fam").where("b1 <= b2")
        labels = self.labels()
        sides = [pairs.join(labels.withColumnRenamed("block", b), ["fam", b]).select("fam", "b1", "b2", "chunk", F.lit(b).alias("side"), "codes") for b in ("b1", "b2")]
        shared, permutations = self.shared, self.permutations

        def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            m = np.zeros((PLACES, PLACES))
            np.add.at(m, (left["i"].to_numpy(), left["j"].to_numpy()), left["d2"].to_numpy())
            size, out = shared.value[key[0]][2], []
            sums = {}
            for chunk, side, codes in zip(right["chunk"], right["side"], right["codes"]):
                sums.setdefault(chunk, {})[side] = codes
            for chunk, both in sums.items():
                width = min(CHUNK, permutations + 1 - chunk * CHUNK)
                one, two = (np.frombuffer(both[b], np.int32).reshape(-1, width) for b in ("b1", "b2"))
                own = m[: len(one), : len(two)]
                total = np.zeros(width)
                for g, n in enumerate(size):
                    total += ((own @ (two == g)) * (one == g)).sum(0) / n
                out.append((key[0], chunk, total, float(m.sum())))
            return pd.DataFrame(out, columns=["fam", "chunk", "within", "total"])

        keys = ["fam", "b1", "b2"]
        matrices = sides[0].unionByName(sides[1]).select(*[F.col(c).alias(c) for c in (*keys, "chunk", "side", "codes")])  # columns of its own
        both = d.groupBy(*keys).cogroup(matrices.groupBy(*keys)).applyInPandas(run, "fam string, chunk long, within array<double>, total double")
        each = both.select("fam", "chunk", "total", F.posexplode("within").alias("_i", "w"))
        return each.groupBy("fam", (F.col("chunk") * CHUNK + F.col("_i")).alias("perm")).agg(F.sum("w").alias("within"), F.sum("total").alias("total"))

    def sums(self, values: DataFrame) -> DataFrame:
        """(fam, perm, code, s): the sum of values(fam, sample, v) over each group."""
        at = values.join(self.places(), ["fam", "sample"]).select("fam", F.floor(F.col("at") / PLACES).alias("block"), F.struct((F.col("at") % PLACES).cast("int").alias("i"), F.col("v").cast("double").alias("v")).alias("p"))
        blocks = at.groupBy("fam", "block").agg(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["v"]).alias("v"))  # PLACES at most
        shared, permutations = self.shared, self.permutations

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for fam, chunk, v, codes in zip(b["fam"], b["chunk"], b["v"], b["codes"]):
                    dealt = np.frombuffer(codes, np.int32).reshape(len(v), min(CHUNK, permutations + 1 - chunk * CHUNK))
                    groups = range(len(shared.value[fam][2]))
                    yield pd.DataFrame({"fam": fam, "chunk": chunk, "code": list(groups), "s": [v @ (dealt == g) for g in groups]})

        each = self.labels().join(blocks, ["fam", "block"]).select("fam", "chunk", "v", "codes").mapInPandas(run, "fam string, chunk long, code int, s array<double>")
        return each.select("fam", "chunk", "code", F.posexplode("s").alias("_i", "s")).groupBy("fam", (F.col("chunk") * CHUNK + F.col("_i")).alias("perm"), "code").agg(F.sum("s").alias("s"))

    def table_sums(self, counts: DataFrame, bucket: int = 256) -> DataFrame:
        """(bucket, block, chunk, otus, sums) of one family's counts(otu, sample, n): for the OTUs of a bucket, sums of n, of n * n
        and of cells over each group in each of a chunk's permutations, in the samples of a block; float64, in this order of axes:
        kind, otu, group, permutation. About ``bucket`` OTUs, and PLACES samples, are multiplied with labels at once."""
        at = counts.join(self.places().drop("fam"), "sample")
        buckets = F.lit(max(1, -(-counts.select("otu").distinct().count() // bucket)))
        cell = F.struct("otu", (F.col("at") % PLACES).cast("int").alias("i"), F.col("n").cast("double").alias("n"))
        cells = at.groupBy(F.pmod(F.xxhash64("otu"), buckets).alias("bucket"), F.floor(F.col("at") / PLACES).alias("block")).agg(F.array_sort(F.collect_list(cell)).alias("c"))
        cells = cells.select("bucket", "block", F.col("c.otu").alias("otu"), F.col("c.i").alias("i"), F.col("c.n").alias("n"))
        shared, permutations = self.shared, self.permutations

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for r in b.itertuples():
                    ((_, _, size),) = shared.value.values()
                    dealt = np.frombuffer(r.codes, np.int32).reshape(-1, min(CHUNK, permutations + 1 - r.chunk * CHUNK))
                    otus, row = np.unique(np.array(r.otu, object), return_inverse=True)
                    m = np.zeros((3, len(otus), len(dealt)))
                    n = np.asarray(r.n, float)
                    for kind, v in enumerate((n, n * n, np.ones(len(n)))):
                        np.add.at(m[kind], (row, np.asarray(r.i)), v)
                    sums = np.stack([m @ (dealt == g) for g in range(len(size))], 2)
                    yield pd.DataFrame({"bucket": [r.bucket], "block": [r.block], "chunk": [r.chunk], "otus": [otus.tolist()], "sums": [sums.tobytes()]})

        joined = cells.join(self.labels().drop("fam"), "block")
        return joined.mapInPandas(run, "bucket long, block long, chunk long, otus array<string>, sums binary")

    def group_sizes(self) -> DataFrame:
        """(fam, code, m)."""
        return self.spark.createDataFrame([(fam, i, int(m)) for fam, (_, _, size) in self.of.items() for i, m in enumerate(size)], "fam string, code int, m long")
