"""Katz back-off language model: fitted and evaluated over a corpus in blocks.

Documents become *chunks*: coded token sequences of a bounded number of tokens. A chunk reduces its n-grams to distinct
ones before anything is shuffled, so a frequent word or pair costs one row a chunk. The n-grams of all chunks meet in
hash buckets, where their counts over the training documents are summed and written as a table partitioned by order.
The counts return to the chunks, which evaluate the model recursively per token:

    P(w|h) = d(c(hw)) * c(hw) / (c(h) + G)   if c(hw) > 0
           = a(h) * P(w|h')                  if c(h) > 0, h' being h without its first word
           = P(w|h')                         otherwise

d is the Good-Turing discount of counts up to ``GT_MAX`` (1 above; where the counts of counts do not allow it, for
example in tiny corpora, absolute discounting by a half), c(h) the count of h as a history. a(h) normalises exactly:
the mass left by the seen words of h over the lower-order mass of the words not seen. G is a small constant that keeps
some mass for unseen words after histories whose counts are all large. At order 1 the mass left by discounting goes to
the unknown word, one type.

The model is a folder of tables: ``counts`` and ``backoff`` (the log of a(h) for every history), both partitioned by level,
and ``about``. ``score`` evaluates new texts with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import discard, hash_strings, mix64, scratch_path, tokens, write_table

GT_MAX = 5
ZSTD = "zstd"
G = 0.5
#: Tokens of a chunk, about; a single longer text is a chunk of its own.
CHUNK_TOKENS = 2_000_000
END, BOS = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0xB05B05B05B05B051)
CHUNK = "chunk long, doc_ids binary, train binary, lengths binary, vocabulary binary, codes binary, code_bytes long"
BLOCK = "chunk long, bucket int, level int, n_train long, grams binary, counts binary"
MODEL = "kind string, level int, bucket int, chunk long, grams binary, counts binary, owned binary, n_types long, n_tokens long, n1 long, n2 long, n3 long, n4 long, n5 long, n6 long"
PART = "kind string, row long, doc_id {}, held_out boolean, level int, history long, n long, n_known long, base double, score double, seen double, lower double"


def planes(x: np.ndarray) -> bytes:
    """Ascending 64-bit integers as the byte planes of their differences, which compress."""
    d = np.diff(x, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(b: bytes) -> np.ndarray:
    d = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(d, dtype=np.uint64)


def small_ints(x: np.ndarray) -> bytes:
    """Counts in the narrowest width that holds them, after a byte that names it."""
    width = next(w for w in (1, 2, 4, 8) if not len(x) or x.max() < 1 << (8 * w - 1))
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unsmall(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<i{b[0]}", offset=1).astype(np.int64)


def packed(rows: pa.RecordBatch) -> bytes:
    """Rows of any type as bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def chunk_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, train, text) to coded chunks."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 20
    made = 0
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch["text"]), 0), dtype=np.int64)
        part = (np.cumsum(sizes) // (CHUNK_TOKENS * 6)).astype(np.int64)
        bounds = np.flatnonzero(np.diff(part, prepend=-1)).tolist() + [len(part)]
        for a, b in zip(bounds, bounds[1:]):
            rows = batch.slice(a, b - a)
            codes, lengths, vocabulary = tokens(rows["text"])
            width = np.uint32 if len(vocabulary) >= 65536 else np.uint16
            ids = rows.select(["doc_id"])
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "chunk": first + made,
                        "doc_ids": packed(ids),
                        "train": rows["train"].to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                        "lengths": lengths.astype("<i8").tobytes(),
                        "vocabulary": hash_strings(vocabulary).astype("<u8").tobytes(),
                        "codes": pa.compress(bytes([np.dtype(width).itemsize]) + codes.astype(width).tobytes(), ZSTD, asbytes=True),
                        "code_bytes": 1 + len(codes) * np.dtype(width).itemsize,
                    }
                ],
                schema=CHUNK_ARROW,
            )
            made += 1


CHUNK_ARROW = pa.schema([("chunk", pa.int64())] + [(c, pa.binary()) for c in ("doc_ids", "train", "lengths", "vocabulary", "codes")] + [("code_bytes", pa.int64())])


class Grams:
    """The distinct n-grams of a chunk, order by order.

    Position i of the sequence holds a word, an end or a begin mark. ``at[k][i]`` is the number of the (k+1)-gram that
    ends there among ``keys[k]``, or -1 where there is none: none crosses a text's begin mark, and none longer than the
    mark alone ends on it. ``history[k]`` and ``suffix[k]`` are the numbers one order lower of a gram without its last
    and without its first token.
    """

    def __init__(self, row: dict, order: int):
        lengths = np.frombuffer(row["lengths"], "<i8")
        vocabulary = np.frombuffer(row["vocabulary"], "<u8")
        raw = pa.decompress(row["codes"], row["code_bytes"], ZSTD, asbytes=True)
        codes = np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)
        n_docs, v = len(lengths), len(vocabulary)
        ends = np.cumsum(lengths + 2)
        starts = ends - lengths - 2
        seq = np.full(int(ends[-1]) if n_docs else 0, -1, np.int64)
        self.bos, self.end = v, v + 1
        seq[starts], seq[ends - 1] = self.bos, self.end
        seq[seq < 0] = codes
        self.doc = np.repeat(np.arange(n_docs), lengths + 2)
        self.train = np.frombuffer(row["train"], np.uint8).astype(bool)[self.doc]
        self.real = seq != self.bos
        self.doc_ids = pa.ipc.open_stream(row["doc_ids"]).read_all()["doc_id"].combine_chunks()
        self.rows = (row["chunk"] << 20) + np.arange(n_docs)
        self.held = ~np.frombuffer(row["train"], np.uint8).astype(bool)
        self.lengths = lengths + 1
        self.at, self.keys = [seq], [np.concatenate([vocabulary, [BOS, END]]).astype(np.uint64)]
        self.history, self.suffix = [None], [None]
        for _ in range(1, order):
            low, size = self.at[-1], len(self.keys[-1])
            ok = np.zeros(len(seq), bool)
            ok[1:] = (low[:-1] >= 0) & (seq[1:] != self.bos) & (low[1:] >= 0 if len(self.at) == 1 else True)
            where = np.flatnonzero(ok)
            pair = low[where - 1] * np.int64(v + 2) + seq[where]
            distinct, inverse = np.unique(pair, return_inverse=True)
            at = np.full(len(seq), -1, np.int64)
            at[where] = inverse
            first = np.zeros(len(distinct), np.int64)
            first[inverse] = low[where]
            history, last = distinct // (v + 2), distinct % (v + 2)
            keys = mix64(self.keys[-1][history] * np.uint64(0x9E3779B97F4A7C15) + self.keys[0][last])
            self.at.append(at)
            self.keys.append(keys)
            self.history.append(history)
            self.suffix.append(first)

    def counts(self, level: int) -> np.ndarray:
        at = self.at[level]
        return np.bincount(at[(at >= 0) & self.train], minlength=len(self.keys[level]))


def blocks(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = Grams(row, order)
                for level in range(order):
                    keys, counts = grams.keys[level], grams.counts(level)
                    by_key = np.argsort(keys)
                    keys, counts = keys[by_key], counts[by_key]
                    cut = np.searchsorted(keys, bucket_bounds(buckets))
                    out = [
                        {"chunk": row["chunk"], "bucket": b, "level": level, "n_train": int(counts[s:e].sum()), "grams": planes(keys[s:e]), "counts": small_ints(counts[s:e])}
                        for b, (s, e) in enumerate(zip(cut, cut[1:]))
                        if e > s
                    ]
                    yield pa.RecordBatch.from_pylist(out, schema=BLOCK_ARROW)

    return run


BLOCK_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("level", pa.int32()), ("n_train", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])


def bucket_bounds(buckets: int) -> list:
    """Buckets are equal ranges of the hash, so a sorted chunk is cut and not scattered."""
    return [np.uint64(((1 << 64) * b) // buckets) for b in range(buckets)] + [np.uint64((1 << 64) - 1)]


MODEL_ARROW = pa.schema(
    [("kind", pa.string()), ("level", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary()), ("owned", pa.binary())]
    + [(c, pa.int64()) for c in ("n_types", "n_tokens", "n1", "n2", "n3", "n4", "n5", "n6")]
)


def sum_bucket(table: pa.Table) -> pa.Table:
    """All blocks of a (level, bucket): the summed counts as a piece of the model, and as replies to the chunks.

    A gram is owned by the first chunk that has it; owners report on it, so that all is reported once.
    """
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    level, bucket = rows[0]["level"], rows[0]["bucket"]
    keys = [unplanes(r["grams"]) for r in rows]
    joined, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate([unsmall(r["counts"]) for r in rows]), minlength=len(joined)).astype(np.int64)
    owner = np.full(len(joined), len(inverse))
    np.minimum.at(owner, inverse, np.arange(len(inverse)))
    out, at = [], 0
    for r, k in zip(rows, keys):
        mine = inverse[at : at + len(k)]
        owned = owner[mine] == np.arange(at, at + len(k))
        out.append({"kind": "reply", "level": level, "bucket": bucket, "chunk": r["chunk"], "counts": small_ints(total[mine]), "owned": np.packbits(owned).tobytes()})
        at += len(k)
    seen = total > 0
    counted = total[seen & (joined != BOS)] if level == 0 else total[seen]
    r = np.bincount(np.minimum(counted, 7), minlength=8)
    out.append(
        {"kind": "counts", "level": level, "bucket": bucket, "grams": planes(joined[seen]), "counts": small_ints(total[seen]), "n_types": len(counted), "n_tokens": int(counted.sum())}
        | {f"n{i}": int(r[i]) for i in range(1, 7)}
    )
    return pa.Table.from_pylist(out, schema=MODEL_ARROW)


def discounts(n: list[int]) -> np.ndarray:
    """d(r) for r = 0..GT_MAX+1 from the counts of counts n[1..GT_MAX+1]; d(0) is unused, the last stands for all above."""
    d = np.ones(GT_MAX + 2)
    a = (GT_MAX + 1) * n[GT_MAX + 1] / n[1] if n[1] else 1.0
    for r in range(1, GT_MAX + 1):
        x = ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) if n[r] and a < 1 else -1.0
        if not 0 < x < 1:
            return np.array([1.0] + [(i - 0.5) / i for i in range(1, GT_MAX + 1)] + [1.0])
        d[r] = x
    return d


def unigram_scale(stats: dict, d: np.ndarray) -> tuple[float, float]:
    """(what a discounted count is multiplied with, the unknown word's probability)."""
    n = max(stats["n_tokens"], 1)
    left = sum(r * stats[f"n{r}"] * (1 - d[r]) for r in range(1, GT_MAX + 1))
    unknown = left / n if left > 0 else 1 / (n + 1)
    unknown = 1.0 if not stats["n_tokens"] else min(unknown, 0.5)
    return (1 - unknown) / max(stats["n_tokens"] - left, 1e-300), unknown


def evaluate(order: int, buckets: int, stats: list[dict], id_type: pa.DataType):
    d = [discounts([0] + [s[f"n{i}"] for i in range(1, 7)]) for s in stats]
    schema = pa.schema([pa.field(f.name, id_type) if f.name == "doc_id" else f for f in PART_ARROW])
    scale, unknown = unigram_scale(stats[0], d[0])
    total, types = stats[0]["n_tokens"], stats[0]["n_types"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        g = Grams(left.to_pylist()[0], order)
        count = [np.zeros(len(k), np.int64) for k in g.keys]
        owned = [np.zeros(len(k), bool) for k in g.keys]
        by_key = [np.argsort(k) for k in g.keys]
        cuts = [np.searchsorted(k[o], bucket_bounds(buckets)) for k, o in zip(g.keys, by_key)]
        for r in right.to_pylist():
            level = r["level"]
            here = by_key[level][cuts[level][r["bucket"]] : cuts[level][r["bucket"] + 1]]
            count[level][here] = unsmall(r["counts"])
            owned[level][here] = np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=len(here)).astype(bool)
        p = []
        for level in range(order):
            c = count[level]
            kept = d[level][np.minimum(c, GT_MAX + 1)] * c
            if level == 0:
                p.append(np.where(c > 0, kept * scale, unknown))
            else:
                p.append(np.where(c > 0, kept / (count[level - 1][g.history[level]] + G), 0.0))
        parts = []
        for level in range(1, order):
            mine = np.flatnonzero(owned[level] & (count[level] > 0))
            h = g.history[level][mine]
            size = len(g.keys[level - 1])
            seen, lower = np.bincount(h, p[level][mine], size), np.bincount(h, p[level - 1][g.suffix[level][mine]], size)
            some = np.unique(h)
            parts.append(part(schema, "mass", len(some), level=level, history=g.keys[level - 1][some].view(np.int64), seen=seen[some], lower=lower[some]))

        n_docs = len(g.doc_ids)
        where = np.flatnonzero(g.real)
        doc = g.doc[where]
        score = np.zeros(len(where))
        open_ = np.ones(len(where), bool)
        for level in range(order - 1, -1, -1):
            at = g.at[level][where]
            has = open_ & (at >= 0)
            hit = has.copy()
            hit[has] = (count[level][at[has]] > 0) | (level == 0)
            score[hit] = np.log10(p[level][at[hit]])
            open_ &= ~hit
            if level:
                back = np.flatnonzero(has & ~hit)
                h = g.history[level][at[back]]
                known = count[level - 1][h] > 0
                back, h = back[known], h[known]
                size = len(g.keys[level - 1])
                pair, n = np.unique(doc[back] * np.int64(size) + h, return_counts=True)
                own = pair // size
                parts.append(part(schema, "need", len(pair), row=g.rows[own], level=level, history=g.keys[level - 1][pair % size].view(np.int64), n=n))
        at = g.at[0][where]
        c = count[0][at]
        base = np.log10((c + 0.1) / (total + 0.1 * (types + 1)))
        parts.append(
            part(schema, "doc", n_docs, row=g.rows, doc_id=g.doc_ids, held_out=g.held, n=g.lengths, n_known=np.bincount(doc, c > 0, n_docs).astype(np.int64), base=np.bincount(doc, base, n_docs), score=np.bincount(doc, score, n_docs))
        )
        return pa.concat_tables(parts)

    return run


PART_ARROW = pa.schema(
    [("kind", pa.string()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("level", pa.int32()), ("history", pa.int64()), ("n", pa.int64()), ("n_known", pa.int64())]
    + [(c, pa.float64()) for c in ("base", "score", "seen", "lower")]
)


def part(schema: pa.Schema, kind: str, rows: int, **given) -> pa.Table:
    def column(f: pa.Field) -> pa.Array:
        if f.name == "kind":
            return pa.array([kind] * rows, f.type)
        x = given.get(f.name)
        if x is None:
            return pa.nulls(rows, f.type)
        if isinstance(x, pa.Array):
            return x.cast(f.type)
        return pa.array(np.full(rows, x) if np.ndim(x) == 0 else x, f.type)

    return pa.table([column(f) for f in schema], schema=schema)


SUMS = [f"n{i}" for i in range(1, 7)] + ["n_types", "n_tokens"]
COUNTS = ["level", "bucket", "grams", "counts", *SUMS]
COUNTS_SCHEMA = "level int, bucket int, grams binary, counts binary, " + ", ".join(f"{c} long" for c in SUMS)


def look_up(model: pa.Table, blocks_: pa.Table) -> pa.Table:
    """Replies to the blocks of a (level, bucket) from its part of a model; nothing is owned, as nothing is learnt."""
    known, total = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for r in model.to_pylist():  # one row, or none
        known, total = unplanes(r["grams"]), unsmall(r["counts"])
    out = []
    for r in blocks_.to_pylist():
        keys = unplanes(r["grams"])
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        n = np.where(known[at] == keys, total[at], 0) if len(known) else np.zeros(len(keys), np.int64)
        out.append({"chunk": r["chunk"], "level": r["level"], "bucket": r["bucket"], "counts": small_ints(n), "owned": np.packbits(np.zeros(len(n), bool)).tobytes()})
    return pa.Table.from_pylist(out, schema=REPLY_ARROW)


REPLY_ARROW = pa.schema([(f.name, f.type) for f in MODEL_ARROW if f.name in ("level", "bucket", "chunk", "counts", "owned")])
REPLY = "level int, bucket int, chunk long, counts binary, owned binary"


def chunked(docs: DataFrame, train, doc_id: str, text: str, path: str) -> DataFrame:
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    write_table(source.mapInArrow(chunk_docs, CHUNK), path)
    return docs.sparkSession.read.schema(CHUNK).parquet(path)


def statistics(counts: DataFrame, order: int) -> list[dict]:
    """The sums of each level: a row a level comes to the driver."""
    got = {r["level"]: r.asDict() for r in counts.groupBy("level").agg(*[F.sum(c).alias(c) for c in SUMS]).collect()}
    return [got.get(level, dict.fromkeys(SUMS, 0)) for level in range(order)]


def evaluated(chunks: DataFrame, replies: DataFrame, order: int, buckets: int, stats: list[dict], id_type, path: str) -> DataFrame:
    spark, schema = chunks.sparkSession, PART.format(id_type.simpleString())
    parts = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(evaluate(order, buckets, stats, to_arrow_type(id_type)), schema)
    write_table(parts, path, "kind")
    return spark.read.schema(schema).parquet(path)


def summed(parts: DataFrame, backoff: DataFrame, stats: list[dict]) -> DataFrame:
    """Adds the back-off weights that each document needs to what its chunk could tell."""
    back = parts.where("kind = 'need'").select("row", "level", "history", "n").join(backoff, ["level", "history"])
    back = back.groupBy("row").agg(F.sum(F.col("n") * F.col("alpha")).alias("back"))
    return parts.where("kind = 'doc'").join(back, "row", "left").select(
        "doc_id",
        "held_out",
        F.col("n").alias("n_tokens"),
        "n_known",
        F.lit(int(stats[0]["n_tokens"])).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("score") + F.coalesce("back", F.lit(0.0))).alias("score"),
    )


def katz_scores(
    docs: DataFrame, train, order: int = 2, doc_id: str = "doc_id", text: str = "text", model_path: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Fit on the rows where ``train`` (a boolean Column) holds and score every row.

    Returns per row: doc_id, held_out (not train), n_tokens, n_known, train_tokens, base_score, score. Tokens are
    whitespace words with A-Z lower-cased, then one end. Null text counts as empty: its one token is the end. A null
    ``train`` counts as false. Rows are numbered, so repeated rows and repeated or null ids, which may be of any type, are
    each scored by themselves. An empty table gives no rows; without training rows every token is unknown. Other columns
    are ignored. The model is written below ``model_path`` (the shared scratch folder by default) for ``score``.
    """
    spark = docs.sparkSession
    model_path = model_path or scratch_path(spark, "katz-model")
    chunk_path, bucket_path, part_path = (scratch_path(spark, f"katz-{x}") for x in ("chunks", "buckets", "parts"))
    chunks = chunked(docs, train, doc_id, text, chunk_path)
    # a bucket holds as many n-grams as a chunk or so
    buckets = buckets or max(64, chunks.count())
    write_table(chunks.mapInArrow(blocks(order, buckets), BLOCK).groupBy("level", "bucket").applyInArrow(sum_bucket, MODEL), bucket_path, "kind", "level")
    summed_up = spark.read.schema(MODEL).parquet(bucket_path)
    counts = summed_up.where("kind = 'counts'").select(*COUNTS)
    stats = statistics(counts, order)
    replies = summed_up.where("kind = 'reply'").select("chunk", "level", "bucket", "counts", "owned")
    parts = evaluated(chunks, replies, order, buckets, stats, docs.schema[doc_id].dataType, part_path)
    discard(spark, chunk_path)
    backoff = (
        parts.where("kind = 'mass'").groupBy("level", "history").agg(F.sum("seen").alias("seen"), F.sum("lower").alias("lower"))
        .select("level", "history", F.log10((1 - F.col("seen")) / (1 - F.col("lower"))).alias("alpha"))
    )
    write_table(backoff, f"{model_path}/backoff", "level")
    write_table(counts, f"{model_path}/counts", "level")
    write_table(spark.createDataFrame([(order, buckets)], "order int, buckets int"), f"{model_path}/about")
    discard(spark, bucket_path)
    return summed(parts, spark.read.schema(BACKOFF).parquet(f"{model_path}/backoff"), stats)


BACKOFF = "level int, history long, alpha double"


def score(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``katz_scores`` returns for rows that the model of ``model_path`` has not learnt from; all are held out."""
    spark = docs.sparkSession
    order, buckets = spark.read.parquet(f"{model_path}/about").first()
    counts = spark.read.schema(COUNTS_SCHEMA).parquet(f"{model_path}/counts")
    stats = statistics(counts, order)
    chunks = chunked(docs, F.lit(False), doc_id, text, scratch_path(spark, "katz-chunks"))
    asked = chunks.mapInArrow(blocks(order, buckets), BLOCK)
    replies = counts.groupBy("level", "bucket").cogroup(asked.groupBy("level", "bucket")).applyInArrow(look_up, REPLY)
    parts = evaluated(chunks, replies, order, buckets, stats, docs.schema[doc_id].dataType, scratch_path(spark, "katz-parts"))
    return summed(parts, spark.read.schema(BACKOFF).parquet(f"{model_path}/backoff"), stats)
