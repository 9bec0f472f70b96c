"""Hard-negative mining by slot-decomposed selection.

Each anchor's positives set windows of scores. The windows' upper limits, in descending order, split the scores into disjoint
slots: slot j holds the scores at or below limit j and above limit j + 1. A candidate falls into one slot, whatever number of
windows overlap there, and a combiner keeps the best few of each slot: the best few of a window are among those of the slots from
its own on. Merging slots in descending order, each window reads the suffix that starts at its slot.

Anchors are stated queries against all rows, in blocks: a unit of work is a block of anchors and a block of rows. A unit holds its anchors, reads its rows
in Arrow batches, and lets go of a few rows for each anchor and slot. Positives come from the same pass with one slot, among
rows of the anchor's label. Scores are integers, so results do not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .centroids import floored, usable
from .common import materialise

#: Anchors and rows of a unit; rows of it multiplied at a time.
ANCHORS = 2048
ROWS = 4096
TILE = 512
#: Scores below this are exact in 64-bit floats; beyond LIMIT, 95 times a score has no place in a long.
EXACT, LIMIT = 1 << 53, 1 << 56
UNIT = ["dim", "part", "ab", "rb"]
#: Ways that the rows of one label are dealt when they learn how many blocks it has.
SALTS = 64
NONE, ALL = -(1 << 63), (1 << 63) - 1


class Slots:
    """The best ``k`` candidates so far of each cell, that is each slot of each anchor."""

    def __init__(self, cells: int, k: int):
        self.k = k
        self.cell, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.worst = np.full(cells, NONE)  # the k-th score of a cell, once it has k

    def add(self, cell: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        """Candidates; equal scores go by the smaller id."""
        maybe = score >= self.worst[cell]
        if not maybe.any():
            return
        cell, score, id = (np.concatenate([a, b[maybe]]) for a, b in ((self.cell, cell), (self.score, score), (self.id, id)))
        order = np.lexsort((id, -score, cell))
        sorted_cell = cell[order]
        first = np.flatnonzero(np.r_[True, sorted_cell[1:] != sorted_cell[:-1]])
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        few, last = order[rank < self.k], order[rank == self.k - 1]
        self.cell, self.score, self.id = cell[few], score[few], id[few]
        self.worst[cell[last]] = score[last]


def stacked(column: pa.Array, exact: bool) -> np.ndarray:
    """Lists of one length as rows, in floats where these multiply exactly."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return rows.astype(np.float64) if exact else rows


class Anchors:
    """A unit's anchors, to which its rows are held."""

    def __init__(self, batches: list[pa.RecordBatch], k: int, slots: int, same_label: bool, exact: bool):
        own = pa.Table.from_batches(batches)
        self.row, self.id, self.label, self.least = (own[c].to_numpy() for c in ("row", "id", "label", "least"))
        self.v = stacked(own["q"], exact).T
        self.upper = stacked(own["upper"], False)
        self.slots, self.same_label, self.exact = slots, same_label, exact
        self.best = Slots(len(self.row) * slots, k)

    def meet(self, rows: pa.RecordBatch) -> None:
        for s in range(0, rows.num_rows, TILE):
            tile = rows.slice(s, TILE)
            id, label = (tile[c].to_numpy() for c in ("id", "label"))
            score = (stacked(tile["q"], self.exact) @ self.v).astype(np.int64)
            ok = (label[:, None] == self.label[None]) == self.same_label
            ok &= (score <= self.upper[None, :, 0]) & (score >= self.least[None])
            if self.same_label:
                ok &= id[:, None] != self.id[None]
            r, a = np.nonzero(ok)
            got = score[r, a]
            slot = np.zeros(len(r), np.int64)
            for j in range(1, self.slots):
                slot += got <= self.upper[a, j]  # limits descend: the last that is not below the score
            self.best.add(a * self.slots + slot, got, id[r])

    def found(self) -> pa.RecordBatch:
        anchor, slot = np.divmod(self.best.cell, self.slots)
        columns = [pa.array(self.row[anchor]), pa.array(slot.astype(np.int32)), pa.array(self.best.id), pa.array(self.best.score)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "id", "score"])


def selector(k: int, slots: int, same_label: bool, exact: bool):
    """Units, each with its anchors before its rows, to rows (anchor, slot, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, anchors = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in [*UNIT, "kind"]], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                key, kind = tuple(keys[a, :-1]), keys[a, -1]
                if key != unit:
                    if anchors:
                        yield anchors.found()
                    unit, held, anchors = key, [], None
                if kind == 0:
                    held.append(batch.slice(a, b - a))
                elif held:
                    anchors = anchors or Anchors(held, k, slots, same_label, exact)
                    anchors.meet(batch.slice(a, b - a))
        if anchors:
            yield anchors.found()

    return run


def best(rows: DataFrame, anchors: DataFrame, k: int, slots: int, same_label: bool, exact: bool) -> DataFrame:
    """(anchor, slot, id, score): of each anchor's slots the best ``k`` rows whose label is the anchor's, or is another.

    rows: row (unique), id, dim, label, q; anchors: the same, upper (``slots`` limits, descending) and least (a limit below all).
    """
    part = F.col("label") if same_label else F.lit(0).cast("long")
    rows, anchors = rows.withColumn("part", part), anchors.withColumn("part", part)

    def counted(df: DataFrame, most: int, name: str) -> DataFrame:
        return df.groupBy("dim", "part").agg(F.ceil(F.count("*") / most).cast("long").alias(name))

    blocks = materialise(counted(anchors, ANCHORS, "abs").join(counted(rows, ROWS, "rbs"), ["dim", "part"]), "blocks")
    blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    common, own = ["row", "id", "label", "q", *UNIT], F.xxhash64("row")
    where = lambda df: df.withColumn("salt", F.pmod(own, F.lit(SALTS)).cast("int")).join(blocks, ["dim", "part", "salt"])
    block = lambda c: F.pmod(F.xxhash64(own), c)
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), c - 1))
    right = where(rows).withColumn("ab", every(F.col("abs"))).withColumn("rb", block(F.col("rbs")))
    left = where(anchors).withColumn("ab", block(F.col("abs"))).withColumn("rb", every(F.col("rbs")))
    units = left.select(*common, "upper", "least", F.lit(0).alias("kind")).unionByName(
        right.select(*common, F.lit(None).cast("array<long>").alias("upper"), F.lit(None).cast("long").alias("least"), F.lit(1).alias("kind"))
    )
    units = units.repartition(*UNIT).sortWithinPartitions(*UNIT, "kind")
    found = units.mapInArrow(selector(k, slots, same_label, exact), "anchor long, slot int, id long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """For anchors and their positives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``: a condition on the columns of ``vectors``. A component x counts as floor(scale * x); a score is the inner
    product with the anchor; higher scores come first, ties by smaller id. An anchor's positives are the first ``positives``
    rows of its label and other ids; a positive's negatives are the first ``negatives`` rows of other labels whose score is
    from ``low`` to ``high`` per cent of the positive's, limits included; a negative score has none.

    Ids and labels are whole numbers. Rows with a null id or label, a null vector, or a null or non-finite component take no
    part; vectors of different dimensions do not meet. Rows repeated under an id are several rows, and each is an anchor of
    its own. Anchors without positives, and positives without negatives, give no rows; an empty table gives none. Other
    columns are ignored. Scores that could reach 2^56 are an error.
    """
    source = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    kept = source.where(usable("v") & F.col("id").isNotNull() & F.col("label").isNotNull()).select("id", "label", F.size("v").alias("dim"), floored("v", scale).alias("q"), "is_anchor")
    rows = materialise(kept.withColumn("row", F.monotonically_increasing_id()), "integers")
    size = F.coalesce(F.array_max(F.transform("q", lambda x: F.abs(x.cast("double")))), F.lit(0.0))
    bound = rows.agg(F.max(F.col("dim") * size * size)).first()[0] or 0
    if bound >= LIMIT:
        raise ValueError(f"scores may reach {bound:.3g}; they must stay below {LIMIT}")
    exact = bound < EXACT
    anchors = rows.where("is_anchor")
    wide = anchors.withColumns({"upper": F.array(F.lit(ALL)), "least": F.lit(NONE)})
    near = best(rows, wide, positives, 1, True, exact).where("score >= 0").withColumns({"limit": F.expr(f"(score * {high}L) div 100"), "floor": F.expr(f"(score * {low}L + 99) div 100")})
    windows = near.groupBy("anchor").agg(
        F.collect_list(F.struct("id", "score", "limit", "floor")).alias("windows"),
        F.sort_array(F.collect_set("limit"), asc=False).alias("limits"),
        F.min("floor").alias("least"),
    )
    windows = materialise(windows.withColumn("upper", F.slice(F.concat("limits", F.array_repeat(F.lit(NONE), positives)), 1, positives)), "windows")
    bounded = anchors.join(windows.select(F.col("anchor").alias("row"), "upper", "least"), "row")
    slotted = best(rows, bounded, negatives, positives, False, exact)
    # slots in descending order, one after another; a window reads on from its own slot
    merged = slotted.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("merged"))
    pairs = windows.join(merged, "anchor").select("anchor", "merged", "limits", F.explode("windows").alias("w"))
    suffix = F.filter("merged", lambda x: (x.slot >= F.array_position("limits", F.col("w.limit")) - 1) & (-x.down >= F.col("w.floor")))
    ranked = pairs.select("anchor", "w", F.posexplode(F.slice(suffix, 1, negatives)).alias("at", "x"))
    return ranked.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", F.col("w.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"), F.col("w.score").alias("positive_score"), (-F.col("x.down")).alias("negative_score")
    )


SQL = """with kept as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
        from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    cells as (select vec_id, label, d, q[d] as x from kept, range(1, 65) t(d) where d <= len(q)),
    scores as (select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label, sum(a.x * b.x)::bigint as score
        from cells a join cells b using (d) where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id group by all),
    positives as (select anchor_id, vec_id as positive_id, score as positive_score from scores where label = own
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
        vec_id as negative_id, positive_score, score as negative_score
    from positives join scores using (anchor_id)
    where label <> own and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    qualify rank <= 3"""
