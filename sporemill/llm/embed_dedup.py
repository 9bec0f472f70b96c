"""Near-duplicate vectors by randomly rotated binary codes.

Each distinct vector is normalised and rotated by random orthogonal matrices; the signs are its binary codes. From the
first rotation the vector keeps the code x (signs over sqrt(D)), the correction factor f = <x, Po>, and its rotated form
in steps of one byte a component. For another vector q, <x, Pq> / f estimates <o, q> without bias, with a standard error
of sqrt(1 - <o,q>^2) * sqrt(1/f^2 - 1) / sqrt(D - 1), to which the steps add a known bound.

1. Bands of code bits bring vectors together. Only codes, factors and bytes travel to a bucket; estimates and their
   confidence bounds, from both sides of a pair, decide which pairs cannot reach the threshold.
2. Vectors with a pair left undecided meet again in their bucket, with their full doubles, and are computed exactly.

Buckets of more than ``BLOCK`` vectors are cut into hashed blocks whose pairs are units of work. A pair counts in the
first band that it shares, so it counts once. Only link counts and spanning links leave a unit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, local_roots, materialise, mix64, runs, type_of

BLOCK = 1024
#: Standard errors below the threshold at which an estimate rules a pair out.
SIGMAS = 4.5
RECALL = 0.999


def plan(n: int, dim: int, threshold: float) -> tuple[int, int, int]:
    """(bits a band, bands, rotations): bits so that chance meetings stay rare among n vectors, bands for RECALL."""
    bits = min(60, max(10, math.ceil(math.log2(max(n, 2))) + 2))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    bands = math.ceil(math.log(1 - RECALL) / math.log1p(-same))
    return bits, bands, math.ceil(bands * bits / dim)


def rotations(dim: int, count: int) -> np.ndarray:
    rng = np.random.default_rng(977)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(count)])


def matrix(column: pa.Array) -> np.ndarray:
    """Arrays of doubles of one length, without nulls, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def stack(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, v) of usable vectors to (vec_id, dim, print1, print2, raw): the exact values and two hashes of them."""
    for batch in batches:
        v = batch["v"]
        dims = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
        h, raw = np.zeros((2, batch.num_rows), np.uint64), [b""] * batch.num_rows
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = matrix(v.take(pa.array(at))) + 0.0
            u = np.ascontiguousarray(x).view(np.uint64)
            a, b = np.full(len(at), dim, np.uint64), np.full(len(at), dim + 1, np.uint64)
            for j in range(u.shape[1]):
                a, b = mix64(a ^ u[:, j]), mix64(b + u[:, j] * np.uint64(0x9E3779B97F4A7C15))
            h[0, at], h[1, at] = a, b
            for i, r in zip(at.tolist(), x):
                raw[i] = r.tobytes()
        columns = [batch["vec_id"], pa.array(dims.astype(np.int64)), pa.array(h[0].view(np.int64)), pa.array(h[1].view(np.int64)), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "dim", "print1", "print2", "raw"])


CODED = "cid long, size long, dim long, unit binary, code binary, factor double, step double, steps binary, bands array<long>"


def encoder(plans: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                bits, bands, rot = plans[int(dim)]
                x = stack(rows["raw"], np.float64)
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                turned = np.einsum("rij,nj->nri", rot, x).reshape(len(x), -1)
                sign = turned > 0
                hashes = np.empty((len(x), bands), np.uint64)
                weight = np.uint64(1) << np.arange(bits, dtype=np.uint64)
                for b in range(bands):
                    hashes[:, b] = mix64(mix64(sign[:, b * bits : (b + 1) * bits] @ weight) + np.uint64(b) + np.uint64(int(dim) << 20))
                turned = turned[:, :dim]
                step = np.abs(turned).max(1) / 127
                steps = np.rint(turned / step[:, None]).astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["cid"],
                        rows["size"],
                        rows["dim"],
                        pa.array([r.tobytes() for r in x], pa.binary()),
                        pa.array([np.packbits(r).tobytes() for r in sign[:, :dim]], pa.binary()),
                        pa.array(np.abs(turned).sum(1) / math.sqrt(dim)),
                        pa.array(step),
                        pa.array([r.tobytes() for r in steps], pa.binary()),
                        pa.FixedSizeListArray.from_arrays(pa.array(hashes.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64())),
                    ],
                    names=["cid", "size", "dim", "unit", "code", "factor", "step", "steps", "bands"],
                )

    return run


UNIT = ("h", "dim", "band", "b1", "b2")


def undecided(unit: pa.Table, threshold: float) -> np.ndarray:
    """Which members of a unit are in a pair whose estimates do not rule it out."""
    dim, crossing = unit["dim"][0].as_py(), unit["b1"][0] != unit["b2"][0]
    block, factor, step = (unit[c].to_numpy() for c in ("block", "factor", "step"))
    code = np.unpackbits(stack(unit["code"], np.uint8), axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = stack(unit["steps"], np.int8).astype(np.float32)
    error = SIGMAS * math.sqrt(max(0.0, 1 - threshold**2)) * np.sqrt(np.maximum(1 / factor**2 - 1, 0)) / math.sqrt(max(dim - 1, 1))
    some = np.zeros(len(block), bool)
    for s in range(0, len(block), 256):
        e = slice(s, s + 256)
        # rows estimate by their own code, and then by the others'
        by_own = code[e] @ turned.T * step[None] / (math.sqrt(dim) * factor[e, None])
        by_other = turned[e] @ code.T * step[e, None] / (math.sqrt(dim) * factor[None])
        rounding = math.sqrt(dim) / 2
        maybe = by_own >= threshold - error[e, None] - rounding * step[None] / factor[e, None] - 1e-6
        maybe &= by_other >= threshold - error[None] - rounding * step[e, None] / factor[None] - 1e-6
        maybe[np.arange(maybe.shape[0]), np.arange(s, s + maybe.shape[0])] = False
        if crossing:
            maybe &= block[e, None] != block[None]
        some[e] |= maybe.any(1)
    return some


def sieve(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in runs(batches, *UNIT):
            if unit.num_rows > 1:
                kept = unit.select([*UNIT, "block", "cid"]).filter(pa.array(undecided(unit, threshold)))
                yield from kept.to_batches()

    return run


def unit_links(unit: pa.Table, threshold: float) -> tuple:
    """(ids, rows linked to each, spanning links as pairs of ids) among the vectors of a unit, exactly."""
    band, crossing = unit["band"][0].as_py(), unit["b1"][0] != unit["b2"][0]
    ids, sizes, block = (unit[c].to_numpy() for c in ("cid", "size", "block"))
    hashes, x = matrix_of_longs(unit["bands"]), stack(unit["unit"], np.float64)
    linked, a_all, b_all = np.zeros(len(ids), np.int64), [], []
    for s in range(0, len(ids), 128):
        a, b = np.nonzero(x[s : s + 128] @ x.T >= threshold - 1e-9)
        a += s
        ok = b > a
        if crossing:
            ok &= block[a] != block[b]
        a, b = a[ok], b[ok]
        ok = np.einsum("ij,ij->i", x[a], x[b]) >= threshold  # the same sum whatever the block
        a, b = a[ok], b[ok]
        for k in range(band):
            ok = hashes[a, k] != hashes[b, k]
            a, b = a[ok], b[ok]
        np.add.at(linked, a, sizes[b])
        np.add.at(linked, b, sizes[a])
        a_all.append(a)
        b_all.append(b)
    root = local_roots(len(ids), np.concatenate(a_all), np.concatenate(b_all))
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids, linked, np.stack([ids[moved], ids[root[moved]]], 1)


def matrix_of_longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def link_rows(ids: np.ndarray, linked: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
    """Rows (cid, links, to): links found, and a spanning link or null."""
    some = np.flatnonzero(linked)
    to = np.concatenate([np.zeros(len(some), np.int64), pairs[:, 1]])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([ids[some], pairs[:, 0]])),
            pa.array(np.concatenate([linked[some], np.zeros(len(pairs), np.int64)])),
            pa.array(to, pa.int64(), mask=np.arange(len(to)) < len(some)),
        ],
        names=["cid", "links", "to"],
    )


def verifier(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in runs(batches, *UNIT):
            if unit.num_rows > 1:
                yield link_rows(*unit_links(unit, threshold))

    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    n_links: other rows with cosine >= ``threshold``, found with probability RECALL at the threshold and more above it;
    component_id: smallest vec_id reachable by links; kept: vec_id = component_id. Vectors that are null, empty, zero,
    or hold null or non-finite components link with nothing, as do rows with a null id. Vectors of different dimensions
    never link. Identical vectors, repeated rows among them, link with one another; an id that stands for several vectors
    is several vectors. Ids may be of any type that has an order. An empty table gives no rows; other columns are ignored.
    """
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0), F.lit(False))
    same = ["print1", "print2", "dim"]
    signed = source.where(usable).mapInArrow(prints, f"vec_id {type_of(source, 'vec_id')}, dim long, print1 long, print2 long, raw binary")
    signed = materialise(signed, "vectors")
    # one row a distinct vector, with a number of its own; the numbers are fixed by the written table
    classes = signed.groupBy(*same).agg(F.min("vec_id").alias("low"), F.count("*").alias("size"), F.first("raw").alias("raw"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    plans = {}
    for r in classes.groupBy("dim").count().collect():  # a row for each dimension that occurs
        bits, bands, turns = plan(r["count"], r["dim"], threshold)
        plans[r["dim"]] = (bits, bands, rotations(r["dim"], turns))
    coded = materialise(classes.select("cid", "size", "dim", "raw").mapInArrow(encoder(plans), CODED), "codes")

    keyed = coded.select("cid", "dim", F.posexplode("bands").alias("band", "h"))
    crowd = keyed.groupBy("h", "dim", "band").agg(F.count("*").alias("m")).where("m > 1").select("h", "dim", "band", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    light = keyed.join(crowd, ["h", "dim", "band"]).join(coded.select("cid", "code", "factor", "step", "steps"), "cid")
    light = light.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    light = light.withColumns({"b1": F.least("block", "other"), "b2": F.greatest("block", "other")}).drop("other", "blocks")
    light = light.repartition(*UNIT).sortWithinPartitions(*UNIT)
    left = light.mapInArrow(sieve(threshold), "h long, dim long, band int, b1 int, b2 int, block int, cid long")
    full = materialise(left, "undecided").join(coded.select("cid", "size", "unit", "bands"), "cid").repartition(*UNIT).sortWithinPartitions(*UNIT)
    found = materialise(full.mapInArrow(verifier(threshold), "cid long, links long, to long"), "links")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found.where("to is not null").select(F.col("cid").alias("a"), F.col("to").alias("b")))
    comp = comp.select(F.col("id").alias("cid"), "component").join(classes.select("cid", "low"), "cid")
    first = comp.groupBy("component").agg(F.min("low").alias("first"))
    comp = comp.join(first, "component").select("cid", "first")
    about = classes.drop("raw").join(links, "cid", "left").join(comp, "cid", "left")
    about = about.select(*same, (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("first", "low").alias("component_id"))
    out = signed.drop("raw").join(about, same).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    alone = source.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)
