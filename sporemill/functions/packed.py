"""Joins of long texts by id that shuffle them compressed: many records of one part are one binary value."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of records that a task gathers before it packs them, and bytes that a part should have.
GATHERED, PART = 32 << 20, 64 << 20


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack(blobs: pa.ChunkedArray) -> pa.Table | None:
    tables = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in blobs]
    return pa.concat_tables(tables) if tables else None


def packs(parts: int):
    """Batches with a column id to rows (part, blob); records without an id go."""

    def some(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        table = table.filter(table["id"].is_valid())
        part = np.array([zlib.crc32(x.encode()) % parts for x in table["id"].to_pylist()], np.int64)
        order = np.argsort(part, kind="stable")
        table, part = table.take(order), part[order]
        which, begins = np.unique(part, return_index=True)
        blobs = [pack(table.slice(a, b - a)) for a, b in zip(begins, [*begins[1:], len(part)])]
        return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for b in batches:
            held.append(b)
            if sum(x.nbytes for x in held) >= GATHERED:
                yield some(held)
                held = []
        if held:
            yield some(held)

    return run


def joined(left: DataFrame, right: DataFrame, size: int) -> DataFrame:
    """left(id, ...) and right(id, ...), string ids, joined by id; ``size``: bytes of both, by which parts are made that a task
    holds unpacked."""
    spark = left.sparkSession
    few = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    parts = max(few, -(-size // PART))
    # columns of their own names on both sides
    a, b = (df.mapInArrow(packs(parts), "part int, blob binary").selectExpr(f"part AS part{n}", f"blob AS blob{n}").repartition(parts, f"part{n}") for n, df in enumerate((left, right)))
    fields = [*left.schema.fields, *[f for f in right.schema.fields if f.name != "id"]]
    names = [f.name for f in fields]

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return none
        met = unpack(x["blob0"]).join(unpack(y["blob1"]), "id", join_type="inner")
        return met.select(names).cast(none.schema)

    none = pa.table({name: pa.array([], pa.string()) for name in names})
    return a.groupBy("part0").cogroup(b.groupBy("part1")).applyInArrow(run, ", ".join(f"`{n}` string" for n in names))
