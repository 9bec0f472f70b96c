"""N-gram Jaccard join by MinHash banding.

1. Every text becomes the set of its hashed five-word shingles; rows with equal sets form one class.
2. Each class has ``bands`` hashes of ``rows`` minima each; numbers chosen for a target recall at the threshold.
3. Classes meet in the buckets of their band hashes, by set sizes and band hashes only. A pair belongs to the first band
   that it shares, so it is looked at once; a class stays in a bucket if it has a pair there whose sizes allow the
   threshold.
4. Those that stay meet in the bucket again with their full shingle sets, and their pairs are verified exactly.

A large bucket is cut into hashed blocks, and each pair of blocks is a unit of work of its own, so no bucket has to fit
one task. Units count links (Jaccard >= threshold on the full sets) and report a few links that
span their components; pairs are not emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, hash_strings, local_roots, materialise, mix64, runs, tokens, type_of

#: Members of a block; a unit of work holds two blocks at most. Full sets are much larger than sizes and band hashes, so
#: their blocks are smaller.
BLOCK, LIGHT_BLOCK = 256, 2048
PERMUTATIONS = 96
MERSENNE_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float = 0.9999, permutations: int = PERMUTATIONS) -> tuple[int, int]:
    """(bands, rows): the most rows a band, and with them the fewest bands, that reach ``recall`` at ``threshold``."""
    for rows in range(permutations, 0, -1):
        bands = permutations // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return next(b for b in range(1, bands + 1) if 1 - (1 - threshold**rows) ** b >= recall), rows
    raise ValueError("no banding reaches this recall; allow more permutations")


def shingle_sets(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(all distinct shingle hashes, row after row and ascending within a row; how many each row has).

    A text of fewer words than ``width`` has all its words as one shingle; one without words has none.
    """
    codes, lengths, vocabulary = tokens(text)
    word = mix64(hash_strings(vocabulary))[codes] if len(codes) else np.zeros(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    n = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    row = np.repeat(np.arange(len(lengths)), n)
    first = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    size = np.minimum(lengths, width)[row]
    h = np.zeros(len(row), np.uint64)
    for i in range(width):
        inside = i < size
        if inside.all():
            h = (h * MERSENNE_MIX) ^ word[first + i]
        else:
            h[inside] = (h[inside] * MERSENNE_MIX) ^ word[first[inside] + i]
        h = mix64(h)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return h[keep], np.bincount(row[keep], minlength=len(lengths)).astype(np.int64)


def signer(width: int, bands: int, rows: int):
    rng = np.random.default_rng(20240229)
    mult = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sets, n = shingle_sets(batch["text"], width)
                full = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                band = np.zeros((len(n), bands), np.uint64)
                prints = np.zeros((2, len(n)), np.uint64)
                if len(full):
                    for b in range(bands):
                        acc = np.full(len(full), b, np.uint64)
                        for r in range(rows):
                            low = np.minimum.reduceat(sets * mult[b * rows + r], starts)
                            acc = mix64(acc * MERSENNE_MIX + low)
                        band[full, b] = acc
                    prints[0, full] = np.add.reduceat(mix64(sets), starts)
                    prints[1, full] = np.add.reduceat(mix64(sets ^ MERSENNE_MIX), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"],
                        batch["text_hash"],
                        pa.array(n),
                        pa.array(prints[0].view(np.int64)),
                        pa.array(prints[1].view(np.int64)),
                        pa.FixedSizeListArray.from_arrays(pa.array(band.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "print1", "print2", "bands"],
                )

    return run


def set_maker(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sets, n = shingle_sets(batch["text"], width)
                raw = [sets[e - k : e].astype("<u8").tobytes() for e, k in zip(np.cumsum(n), n)]
                yield pa.RecordBatch.from_arrays([batch["cid"], pa.array(raw, pa.binary())], names=["cid", "shingles"])

    return run


UNIT = ("h", "band", "b1", "b2")


def matrix_of(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def candidates(unit: pa.Table, threshold: float) -> np.ndarray:
    """Which members of a unit have a pair that belongs to its band and whose sizes allow the threshold."""
    band, crossing = unit["band"][0].as_py(), unit["b1"][0] != unit["b2"][0]
    n, block, hashes = unit["n"].to_numpy(), unit["block"].to_numpy(), matrix_of(unit["bands"])
    some = np.zeros(len(n), bool)
    for s in range(0, len(n), 256):
        e = slice(s, s + 256)
        pair = (n[None] >= threshold * n[e, None]) & (n[None] * threshold <= n[e, None])
        pair[np.arange(len(pair)), np.arange(s, s + len(pair))] = False
        if crossing:
            pair &= block[e, None] != block[None]
        for k in range(band):
            pair &= hashes[e, k, None] != hashes[None, :, k]
        some[e] = pair.any(1)
    return some


def sieve(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in runs(batches, *UNIT):
            if unit.num_rows > 1:
                yield from unit.select(["h", "band", "cid"]).filter(pa.array(candidates(unit, threshold))).to_batches()

    return run


def unit_links(unit: pa.Table, threshold: float) -> tuple:
    """(ids, documents linked to each, spanning links as pairs of ids) among the classes of a unit."""
    band, crossing = unit["band"][0].as_py(), unit["b1"][0] != unit["b2"][0]
    ids, sizes, block, hashes = unit["cid"].to_numpy(), unit["size"].to_numpy(), unit["block"].to_numpy(), matrix_of(unit["bands"])[:, :band]
    sets = [np.frombuffer(x, "<u8") for x in unit["shingles"].to_pylist()]
    n = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(n) - n
    linked = np.zeros(len(ids), np.int64)
    a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    mark = np.zeros(column.max() + 1, np.int64)
    later = np.arange(len(ids))
    for i in range(len(ids)):
        # only members whose sizes allow the threshold, and that no earlier band has brought here
        near = np.flatnonzero((n >= threshold * n[i]) & (n * threshold <= n[i]) & ((block != block[i]) if crossing else True) & (later > i))
        if band and len(near):
            near = near[(hashes[near] != hashes[i]).all(1)]
        if len(near):
            mine = column[starts[i] : starts[i] + n[i]]
            mark[mine] = 1
            span = n[near]
            at = np.repeat(starts[near] - (np.cumsum(span) - span), span) + np.arange(span.sum())
            common = np.add.reduceat(mark[column[at]], np.cumsum(span) - span)
            hit = near[common >= threshold * (n[i] + span - common) - 1e-9]
            linked[i] += sizes[hit].sum()
            linked[hit] += sizes[i]
            a_all.append(np.full(len(hit), i))
            b_all.append(hit)
            mark[mine] = 0
    root = local_roots(len(ids), np.concatenate(a_all), np.concatenate(b_all))
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids, linked, np.stack([ids[moved], ids[root[moved]]], 1)


def verifier(threshold: float):
    """Rows sorted by unit to rows (cid, links, to): links found, and a spanning link or null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in runs(batches, *UNIT):
            if unit.num_rows > 1:
                ids, linked, pairs = unit_links(unit, threshold)
                some = np.flatnonzero(linked)
                to = np.concatenate([np.zeros(len(some), np.int64), pairs[:, 1]])
                columns = [
                    pa.array(np.concatenate([ids[some], pairs[:, 0]])),
                    pa.array(np.concatenate([linked[some], np.zeros(len(pairs), np.int64)])),
                    pa.array(to, pa.int64(), mask=np.arange(len(to)) < len(some)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["cid", "links", "to"])

    return run


def in_units(members: DataFrame, about: DataFrame, block: int) -> DataFrame:
    """Members of buckets (h, band, cid) dealt to units, with what is known about each cid: a row for every pair of blocks
    that a member's block is in. Members that are alone in their bucket go."""
    crowd = members.groupBy("h", "band").agg(F.count("*").alias("m")).where("m > 1").select("h", "band", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    placed = members.join(crowd, ["h", "band"]).join(about, "cid").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.withColumns({"b1": F.least("block", "other"), "b2": F.greatest("block", "other")}).drop("other", "blocks")
    return dealt.repartition(*UNIT).sortWithinPartitions(*UNIT)


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class_id, class_size, n_links, group_id, kept.

    class_id is the smallest doc_id with the same shingle set, n_links the number of other rows whose sets have Jaccard
    similarity >= ``threshold`` (its own class included), group_id the smallest doc_id reachable by links, kept marks
    one row of each group (the class's first by id; of rows repeated under that id all are kept). Words are whitespace
    words with A-Z lower-cased. Texts of fewer than ``width`` words have one shingle; null and wordless texts have none,
    link with nothing, and stand alone (class_size 1, kept). Rows with a null id take no part: they have null class_id
    and group_id, no links, and are kept. Ids may be of any type that has an order. An empty table gives no rows; other
    columns are ignored.
    """
    bands, rows = choose_bands(threshold, recall)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    signed = source.mapInArrow(signer(width, bands, rows), f"doc_id {type_of(source, 'doc_id')}, text_hash long, n_shingles long, print1 long, print2 long, bands array<long>")
    signed = materialise(signed, "minhash")
    usable = signed.where("doc_id is not null and n_shingles > 0")
    same = ["print1", "print2", "n_shingles"]
    # one row a distinct set, with a number of its own; the numbers are fixed by the written table
    classes = usable.groupBy(*same).agg(F.min(F.struct("doc_id", "text_hash")).alias("one"), F.count("*").alias("size"), F.first("bands").alias("bands"))
    classes = classes.select(*same, "size", "bands", F.col("one.doc_id").alias("class_id"), F.col("one.text_hash").alias("text_hash"), F.monotonically_increasing_id().alias("cid"))
    classes = materialise(classes, "classes")

    keyed = classes.select("cid", F.posexplode("bands").alias("band", "h"))
    light = in_units(keyed, classes.select("cid", F.col("n_shingles").alias("n"), "bands"), LIGHT_BLOCK)
    left = light.mapInArrow(sieve(threshold), "h long, band int, cid long")
    left = materialise(left.distinct(), "candidates")

    wanted = classes.join(left.select("cid").distinct(), "cid", "left_semi").select("cid", F.col("class_id").alias("doc_id"), "text_hash")
    sets = source.join(wanted, ["doc_id", "text_hash"]).select("cid", "text").mapInArrow(set_maker(width), "cid long, shingles binary").dropDuplicates(["cid"])
    full = in_units(left, sets.join(classes.select("cid", "size", "bands"), "cid"), BLOCK)
    found = materialise(full.mapInArrow(verifier(threshold), "cid long, links long, to long"), "links")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found.where("to is not null").select(F.col("cid").alias("a"), F.col("to").alias("b")))
    comp = comp.select(F.col("id").alias("cid"), "component").join(classes.select("cid", "class_id"), "cid")
    first = comp.groupBy("component").agg(F.min("class_id").alias("group_id"))
    comp = comp.join(first, "component").select("cid", "group_id")
    about = classes.drop("bands", "text_hash").join(links, "cid", "left").join(comp, "cid", "left")
    about = about.select(*same, "class_id", "size", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group_id", "class_id").alias("group_id"))
    known = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    # copies of one class may be many rows; the other side has one row a class
    out = usable.drop("bands").join(about, same).select(
        "doc_id", "n_shingles", "class_id", F.col("size").alias("class_size"), (F.col("links") + F.col("size") - 1).alias("n_links"), "group_id", (F.col("doc_id") == F.col("group_id")).alias("kept")
    )
    alone = signed.where(~known).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("group_id"), F.lit(True).alias("kept")
    )
    return out.unionByName(alone)
