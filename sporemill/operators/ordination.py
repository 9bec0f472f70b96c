"""Principal coordinates of a long distance table: Gower's centring and block Lanczos steps, the table multiplied as it is.

With B = -1/2 J D2 J (D2 the squared distances, J the centring), a step multiplies a few columns by B: a join with the distances
and a grouped sum. The columns so far are kept a row a sample; only their products with one another, some ten thousand
numbers, reach the driver, where the small eigenvalue problem is solved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise


def stacked(batch: pd.DataFrame) -> np.ndarray:
    """The columns k, w and one of ones, a row a sample."""
    parts = [np.array(batch[c].tolist(), float).reshape(len(batch), -1) for c in ("k", "w")]
    return np.hstack([*parts, np.ones((len(batch), 1))])


def products(table: DataFrame, width: int) -> np.ndarray:
    """All products of the columns of (sample, k, w) and ones, summed over the samples."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for b in batches:
            z = stacked(b)
            total += z.T @ z
        yield pd.DataFrame({"p": [total.ravel()]})

    parts = table.select("k", "w").mapInPandas(run, "p array<double>").select(F.posexplode("p").alias("i", "x"))
    rows = parts.groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(width * width)
    for r in rows:
        out[r["i"]] = r["x"]
    return out.reshape(width, width)


def extended(table: DataFrame, by: np.ndarray, keep: bool) -> DataFrame:
    """(sample, k): the columns k (if ``keep``) and (k, w, 1) times ``by``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            new = stacked(b) @ by
            if keep:
                new = np.hstack([np.array(b["k"].tolist(), float).reshape(len(b), -1), new])
            yield pd.DataFrame({"sample": b["sample"], "k": list(new)})

    return table.select("sample", "k", "w").mapInPandas(run, "sample string, k array<double>")


def multiplied(ways: DataFrame, columns: DataFrame, first: int, width: int) -> DataFrame:
    """(sample, k, w): -1/2 D2 times the columns of k from ``first`` on."""
    v = columns.select(F.col("sample").alias("s2"), *[F.get("k", F.lit(first + i)).alias(f"v{i}") for i in range(width)])
    sums = ways.join(v, "s2").groupBy("s1").agg(F.array(*[F.sum(F.col("d2") * F.col(f"v{i}")) * -0.5 for i in range(width)]).alias("w"))
    return columns.join(sums.withColumnRenamed("s1", "sample"), "sample")


def principal_coordinates(dist: DataFrame, axes: int = 2, tolerance: float = 1e-8, extra: int = 4, most: int = 120) -> DataFrame:
    """(sample, axis1, .., share1, ..) of dist(s1, s2, d), s1 < s2, all pairs: coordinates on the axes with the largest positive
    eigenvalues, and each axis's share of the trace. The largest coordinate of an axis is positive; an axis with no positive
    eigenvalue is zero. Pairs whose distance is null count as equal. ``most`` columns are kept before the best of them
    begin anew; twenty such rounds without an error below ``tolerance`` of the largest eigenvalue are an error."""
    d2 = dist.select(F.col("s1").cast("string"), F.col("s2").cast("string"), F.coalesce(F.col("d") * F.col("d"), F.lit(0.0)).alias("d2"))
    ways = materialise(d2.unionByName(d2.select(F.col("s2").alias("s1"), F.col("s1").alias("s2"), "d2")), "ways")
    trace, m = ways.agg(F.sum("d2")).first()[0], axes + extra
    noise = F.array(*[F.pmod(F.xxhash64("sample", F.lit(i)), F.lit(1 << 20)) / float(1 << 20) for i in range(m)])
    table = materialise(ways.select(F.col("s1").alias("sample")).distinct().select("sample", F.array().cast("array<double>").alias("k"), noise.alias("w")), "columns")
    empty = ", ".join(["sample string", *[f"axis{i + 1} double" for i in range(axes)], *[f"share{i + 1} double" for i in range(axes)]])
    if trace is None:
        return dist.sparkSession.createDataFrame([], empty)
    h, c, width, rounds = np.zeros((0, 0)), 0, m, 0
    while True:
        z = products(table, c + width + 1)
        gram, cross, own, s, n = z[:c, :c], z[:c, c:-1], z[c:-1, c:-1], z[c:-1, -1], z[-1, -1]
        solved = np.linalg.solve(gram, cross) if c else np.zeros((0, width))
        rest = own - np.outer(s, s) / n - cross.T @ solved  # of what the columns do not say yet
        values, vectors = np.linalg.eigh((rest + rest.T) / 2)
        good = values > 1e-11 * max(np.trace(own), 1e-300)
        if c:
            h = np.block([[h, cross[: len(h)]], [cross[: len(h)].T, (cross[len(h) :] + cross[len(h) :].T) / 2]])
            low = np.linalg.cholesky(gram)
            inner = np.linalg.solve(low, np.linalg.solve(low, h).T)
            theta, y = np.linalg.eigh((inner + inner.T) / 2)
            theta, y = theta[::-1], np.linalg.solve(low.T, y[:, ::-1])
            last = y[-width:, :axes]
            error = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", last, rest, last), 0)).max(initial=0.0)
            done = error <= tolerance * np.abs(theta).max() or not good.any()
            if done or c + int(good.sum()) > most:
                best = y[:, : (axes if done else m)]
                if done:
                    break
                rounds += 1
                if rounds == 20:
                    raise RuntimeError(f"principal coordinates did not settle: error {error}")
                by = np.vstack([best, np.zeros((width + 1, best.shape[1]))])
                table = materialise(extended(table, by, False).select("sample", F.array().cast("array<double>").alias("k"), F.col("k").alias("w")), "columns")
                h, c, width = np.zeros((0, 0)), 0, best.shape[1]
                continue
        elif not good.any():  # all samples are the same
            best, theta = np.zeros((0, 0)), np.zeros(0)
            break
        turn = vectors[:, good] / np.sqrt(values[good])
        by = np.vstack([-solved, np.eye(width), -s[None] / n]) @ turn
        columns = materialise(extended(table, by, True), "columns")
        old, c, width = c, c + by.shape[1], by.shape[1]
        table = materialise(multiplied(ways, columns, old, width), "columns")
    theta = np.maximum(np.r_[theta[: best.shape[1]], np.zeros(axes)][:axes], 0)
    by = np.zeros((c + width + 1, axes))
    by[: best.shape[0], : best.shape[1]] = best * np.sqrt(theta[: best.shape[1]])
    scores = materialise(extended(table, by, False), "coordinates")
    at = [F.get("k", F.lit(i)) for i in range(axes)]
    signs = scores.agg(*[F.max_by(F.signum(a), F.struct(F.round(F.abs(a), 9), "sample")).alias(f"s{i}") for i, a in enumerate(at)]).first()
    shares = theta / (trace / 2 / n) if trace else theta
    return scores.select("sample", *[(at[i] * F.lit(signs[i] or 1.0)).alias(f"axis{i + 1}") for i in range(axes)], *[F.lit(float(shares[i])).alias(f"share{i + 1}") for i in range(axes)])
