"""What several corpus operators share: shared scratch tables, Arrow tokenising, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import discard, materialise, scratch_path, scratch_scope, write_table

__all__ = ["ascii_lower", "components", "discard", "fresh", "hash_strings", "local_roots", "materialise", "mix64", "runs", "scratch_path", "scratch_scope", "tokens", "type_of", "write_table"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c):
    """Lower-case A-Z and nothing else."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, UPPER, LOWER)).otherwise(F.lower(c))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of each run of equal keys (numbers without nulls), across batches."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if (key := tuple(c[a] for c in columns)) != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def tokens(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list]:
    """Whitespace tokens (``[^\\x20\\x09-\\x0D]+``) of a string array.

    Returns (codes, lengths, vocabulary): the codes of all tokens in order, the number of tokens of each row
    (0 for null), and the distinct tokens as an Arrow array that the codes index.
    """
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    # Arrow's string functions misread arrays whose data starts within a larger buffer, as slices do: copy first
    text = pc.fill_null(text.cast(pa.large_string()).take(pa.array(np.arange(len(text)))), "")
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    flat = lists.flatten()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        row = np.repeat(np.arange(len(lengths)), lengths)[full]
        lengths = np.bincount(row, minlength=len(lengths)).astype(np.int64)
        flat = flat.filter(pa.array(full))
    enc = flat.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), lengths, enc.dictionary


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same on every machine."""
    if len(values) == 0:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.asarray(values.to_numpy(zero_copy_only=False), dtype=object), categorize=False)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index in each index's component, for n nodes and links a-b; all vectorised."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, root):
            break
        root = new
    return root


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of links (a, b), both long: rows (id, component), component the smallest id.

    Alternates large-star and small-star steps; each round is written to the shared folder, so nothing is
    collected and lost executors cost one round at most. Nodes without links do not occur in the result.
    An empty table gives an empty result. Hubs are spread by Spark's skew join, and minima are taken before
    the shuffle. Raises if it has not settled after ``rounds`` rounds.
    """
    e = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    spark, path = edges.sparkSession, scratch_path(edges.sparkSession, "edges")
    write_table(e, path)
    e = spark.read.schema("u long, v long").parquet(path)

    def seal(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = seal(e)
    for _ in range(rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.col("k")).alias("m"))
        # large star: every larger neighbour of u points to the smallest of u and its neighbours
        large = (
            e.select(F.col("v").alias("k"), F.col("u").alias("x"))
            .join(low, "k")
            .select(F.col("x").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        # small star: every smaller neighbour of u, and u itself, points to the smallest of them
        low = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = (
            large.select(F.col("u").alias("k"), F.col("v").alias("x"))
            .join(low, "k")
            .select(F.col("x").alias("u"), F.col("m").alias("v"))
            .union(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        before_path, path = path, scratch_path(spark, "edges")
        write_table(small, path)
        e = spark.read.schema("u long, v long").parquet(path)
        now = seal(e)
        discard(spark, before_path)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    pairs = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    return pairs.union(pairs.select(F.col("component").alias("id"), "component").distinct())
