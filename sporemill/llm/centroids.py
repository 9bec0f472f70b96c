"""Centroid clustering of integer vectors by scalar lookup tables.

Components become integers once, and are stored in blocks of at most ``BLOCK`` vectors: for each dimension the integers that
occur in the block, and each vector's places among them. A round tabulates, for each dimension, occurring integer and
centroid, the squared difference; distances are gathers from these tables and sums. A task adds up the vectors of each
centroid over its blocks, so at most ``k`` rows leave it; k x dimensions sums go to the driver. All numbers are integers, so
results do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, type_of
from .embed_dedup import matrix

#: Vectors of a block: their places fit into 16 bits.
BLOCK = 8192
#: Greatest size of an integer component, so that squared distances of 64 dimensions fit into 63 bits.
MOST = 1 << 27


def usable(v: str, dim: int | None = None):
    """Whether an array has no null and no non-finite component, and ``dim`` components."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) == dim if dim is not None else F.lit(True)) & ~bad, F.lit(False))


def floored(v: str, scale: float):
    return F.transform(v, lambda x: F.floor(x * F.lit(float(scale))))


BLOCKS = "ids binary, n int, values binary, sizes binary, places binary"


def blocks_of(dim: int):
    """Rows (row, q array<long>) to blocks."""

    def block(rows: np.ndarray, q: np.ndarray) -> tuple:
        if q.size and max(int(q.max()), -int(q.min())) > MOST:
            raise ValueError(f"a component is beyond {MOST} in size; its squared distances have no place in a long")
        values, places = [], np.empty(q.shape, np.uint16)
        for d in range(dim):
            found, places[:, d] = np.unique(q[:, d], return_inverse=True)
            values.append(found)
        sizes = np.array([len(x) for x in values], np.int64)
        return rows.tobytes(), len(rows), np.concatenate(values).tobytes(), sizes.tobytes(), places.T.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate([b["row"].to_numpy() for b in held])
            q = np.concatenate([b["q"].flatten().to_numpy() for b in held]).reshape(len(rows), dim)
            made = [block(rows[a : a + BLOCK], q[a : a + BLOCK]) for a in range(0, len(rows), BLOCK)]
            kinds = [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["ids", "n", "values", "sizes", "places"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    return run


def opened(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    """(row numbers, occurring integers by dimension, places by dimension) of each block."""
    for batch in batches:
        for b in batch.to_pylist():
            values = np.split(np.frombuffer(b["values"], np.int64), np.cumsum(np.frombuffer(b["sizes"], np.int64))[:-1])
            yield np.frombuffer(b["ids"], np.int64), values, np.frombuffer(b["places"], np.uint16).reshape(dim, b["n"])


def nearest(values: list[np.ndarray], places: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector of a block; ties: the smaller number."""
    total = np.zeros((places.shape[1], len(centroids)), np.int64)
    for d, found in enumerate(values):
        squares = (found[:, None] - centroids[None, :, d]) ** 2  # occurring integer x centroid
        total += squares[places[d]]
    best = total.argmin(1)  # the first of the smallest
    return best, total[np.arange(len(best)), best]


def summer(centroids: np.ndarray):
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, values, places in opened(batches, dim):
            best, _ = nearest(values, places, centroids)
            counts += np.bincount(best, minlength=k)
            order = np.argsort(best, kind="stable")
            some, first = np.unique(best[order], return_index=True)
            for d in range(dim):
                sums[some, d] += np.add.reduceat(values[d][places[d][order]], first)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def assigner(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, places in opened(batches, centroids.shape[1]):
            best, distance = nearest(values, places, centroids)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(best.astype(np.int32)), pa.array(distance)], names=["row", "cluster", "distance"])

    return run


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, seed: str = "2:", vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per vector of exactly ``dim`` components, none null or non-finite: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid (array<long>), centroid_sha256.

    A component x counts as floor(scale * x). The first centroids are the ``k`` vectors with the smallest lowercase-hex
    sha256 of ``seed`` and the id, in that order (of rows repeated under an id, those with the smaller components first; null
    ids last); where there are fewer vectors, there are fewer centroids. Each round assigns every vector to the nearest centroid (squared
    Euclidean distance; ties: the smaller number) and moves each centroid that has vectors to the floor of their mean; then
    vectors are assigned once more. Rows may repeat, and ids may be null or of any type; other vectors, null ones among
    them, give no rows, and an empty table none. Components beyond 2^27 / scale are an error: their squared distances do not fit a long.
    """
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    kept = source.where(usable("v", dim)).select("vec_id", floored("v", scale).alias("q"))
    kept = materialise(kept.withColumn("row", F.monotonically_increasing_id()), "integers")
    spark = kept.sparkSession
    hashed = kept.withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256))
    first = hashed.orderBy(F.asc_nulls_last("h"), "q").limit(k).select("q").collect()
    centroids = [list(r.q) for r in first]  # k x dim integers, here and after each round
    blocks = materialise(kept.select("row", "q").mapInArrow(blocks_of(dim), BLOCKS), "blocks")
    for _ in range(rounds if centroids else 0):
        found = blocks.mapInArrow(summer(np.array(centroids, np.int64)), "cluster long, n long, sums array<long>")
        cells = found.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        for r in cells.collect():
            centroids[r.cluster][r.d] = r.s // r.n
    last = np.array(centroids, np.int64).reshape(-1, dim)
    assigned = materialise(blocks.mapInArrow(assigner(last), "row long, cluster int, distance long"), "assigned")
    inertia = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row a cluster
    about = [(c, d, sum(inertia.values()), centroids[c], hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, d in inertia.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    return kept.select("row", "vec_id").join(assigned, "row").join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")


def oracle_sql(k: int = 40, rounds: int = 5) -> str:
    """The query in SQL: rounds written out."""
    steps = [
        """kept as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        cells as (select vec_id, d, q[d] as x from kept, range(1, 65) t(d)),
        c0 as (select n - 1 as c, d, q[d] as x from (select q, row_number() over (order by sha256('2:' || vec_id::varchar)) as n from kept), range(1, 65) t(d) where n <= %d)"""
        % k
    ]
    for i in range(rounds + 1):
        steps.append(f"""s{i} as (select vec_id, c, sum((cells.x - c{i}.x) * (cells.x - c{i}.x))::bigint as distance from cells join c{i} using (d) group by all),
        a{i} as (select vec_id, arg_min(c, (distance, c)) as c, min(distance) as distance from s{i} group by vec_id)""")
        if i < rounds:
            steps.append(f"""m{i} as (select c, d, sum(x)::bigint as s, count(*) as n from a{i} join cells using (vec_id) group by c, d),
        c{i + 1} as (select o.c, o.d, case when m.n is null then o.x else ((m.s - ((m.s %% m.n) + m.n) %% m.n) // m.n)::bigint end as x from c{i} o left join m{i} m on m.c = o.c and m.d = o.d)""".replace("%%", "%"))
    last = f"a{rounds}"
    return f"""with {", ".join(steps)},
        names as (select c, sha256(string_agg(x::varchar, ',' order by d)) as centroid_sha256 from c{rounds} group by c)
    select vec_id, c::int as cluster, distance, (sum(distance) over (partition by c))::bigint as cluster_inertia, (sum(distance) over ())::bigint as inertia, centroid_sha256
    from {last} join names using (c)"""
