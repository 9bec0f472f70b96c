"""Document quality: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

Every word and every word shape ("Aa.", "a&&&") has a sparse random index vector, drawn from its hash. Over all documents
each of them adds up the index vectors of what stands within ``WINDOW`` tokens of it; these sums, scaled, are its vector.
The sums are kept in a table of ``WORD_ROWS`` and ``SHAPE_ROWS`` rows that words and shapes share by hash: no word is left
out whatever the vocabulary, the table's size is known, and where words share a row the frequent one shapes it. A document
is the mean vector of its words, the mean vector of its shapes, and a few ratios (repeated, distinct and rare tokens).
The network learns from a bounded sample of labelled documents; a temperature, fitted on a part of the sample that the
weights have not seen, calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_strings, mix64, tokens
from .labelled import SAMPLE, labelled_sample

DIM = 32
NONZERO = 4
WINDOW = 2
#: Rows of the context table; words first, then shapes.
WORD_ROWS, SHAPE_ROWS = 1 << 15, 1 << 11
HIDDEN = 24
#: Tokens handled at once.
SLICE = 400_000
#: A token is rare if fewer than one in so many tokens share its row.
RARE = 20_000
FEATURES = 2 * DIM + 6


def shapes(words: pa.Array) -> pa.Array:
    """Runs of capitals as A, of other letters as a, of digits as 0; what else there is stays."""
    for pattern, by in ((r"\p{Lu}+", "\x01"), (r"\p{L}+", "a"), ("\x01", "A"), (r"\p{Nd}+", "0")):
        words = pc.replace_substring_regex(words, pattern, by)
    return words


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """NONZERO signs at places that the hash draws; where two meet they add up."""
    out = np.zeros((len(hashes), DIM), np.int8)
    rows = np.arange(len(hashes))
    for j in range(NONZERO):
        place = (hashes >> np.uint64(8 * j)) % np.uint64(DIM)
        sign = (hashes >> np.uint64(8 * j + 7)) & np.uint64(1)
        out[rows, place.astype(np.int64)] += np.where(sign > 0, 1, -1).astype(np.int8)
    return out


class Known(NamedTuple):
    """What each distinct token of a piece has: its rows in the table, and its index vector (word and shape together)."""

    word: np.ndarray
    shape: np.ndarray
    index: np.ndarray


def know(distinct: pa.Array, index: bool = True) -> Known:
    form = shapes(distinct).dictionary_encode()
    of = form.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    word, shape = mix64(hash_strings(distinct)), mix64(hash_strings(form.dictionary) + np.uint64(1))
    vectors = index_vectors(word) + index_vectors(shape)[of] if index else np.zeros((0, DIM), np.int8)
    rows = lambda h, n: (h >> np.uint64(40)).astype(np.int64) % n
    return Known(rows(word, WORD_ROWS), rows(shape, SHAPE_ROWS)[of] + WORD_ROWS, vectors)


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Pieces of batches with about ``size`` tokens; a single longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        chars = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(chars) // (size * 6)
        bounds = np.flatnonzero(np.diff(part, prepend=-1)).tolist() + [len(part)]
        for a, b in zip(bounds, bounds[1:]):
            yield batch.slice(a, b - a)


CONTEXT = ["n"] + [f"c{j}" for j in range(DIM)]


def context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens and sums of the index vectors near them, one row a row of the table and task: (id, n, c0, c1, ...)."""
    total = np.zeros((WORD_ROWS + SHAPE_ROWS, 1 + DIM), np.int64)
    for rows in slices(batches):
        codes, lengths, distinct = tokens(rows["text"], lower=False)
        if not len(codes):
            continue
        known = know(distinct)
        own = known.index[codes]
        doc = np.repeat(np.arange(len(lengths)), lengths)
        near = np.zeros_like(own)
        for k in range(1, WINDOW + 1):
            same = (doc[k:] == doc[:-k])[:, None]
            near[k:] += own[:-k] * same
            near[:-k] += own[k:] * same
        small = codes.astype(np.uint16) if len(distinct) < 1 << 16 else codes  # sorted by radix
        order = np.argsort(small, kind="stable")
        first = np.flatnonzero(np.diff(codes[order], prepend=-1))
        each = np.add.reduceat(near[order], first, axis=0, dtype=np.int32)
        n = np.diff(first, append=len(codes))
        which = codes[order[first]]
        for at in (known.word[which], known.shape[which]):
            np.add.at(total, at, np.hstack([n[:, None], each]))
    some = np.flatnonzero(total[:, 0])
    yield pa.RecordBatch.from_arrays([pa.array(some)] + [pa.array(total[some, j]) for j in range(1 + DIM)], names=["id", *CONTEXT])


def learn_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(a vector of length 1 for each row of the table, how rare its tokens are as -log10 of their share), from all
    documents. WORD_ROWS + SHAPE_ROWS rows come to the driver at most."""
    rows = docs.select("text").mapInArrow(context_sums, ", ".join(f"{c} long" for c in ("id", *CONTEXT)))
    got = rows.groupBy("id").agg(*[F.sum(c).alias(c) for c in CONTEXT]).toPandas()
    size = WORD_ROWS + SHAPE_ROWS
    out, n = np.zeros((size, DIM)), np.zeros(size)
    out[got["id"]], n[got["id"]] = got[CONTEXT[1:]], got["n"]
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    out = unit(out)
    seen = n > 0
    if seen.any():
        out[seen] -= out[seen].mean(0)
    share = np.maximum(n, 0.5) / max(n[:WORD_ROWS].sum(), 1)
    return unit(out).astype(np.float32), np.minimum(-np.log10(share), 9).astype(np.float32)


def features(text: pa.Array, vectors: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    codes, lengths, distinct = tokens(text, lower=False)
    out = np.zeros((len(lengths), FEATURES), np.float32)
    full = np.flatnonzero(lengths)
    if len(full):
        known = know(distinct, index=False)
        both = np.hstack([vectors[known.word], vectors[known.shape]])
        starts = (np.cumsum(lengths) - lengths)[full]
        n = lengths[full][:, None]
        out[full, : 2 * DIM] = np.add.reduceat(both[codes], starts, axis=0) / n
        doc = np.repeat(np.arange(len(lengths)), lengths)
        again = np.zeros(len(codes))
        again[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
        distinct_in = np.bincount(np.unique(doc * np.int64(len(distinct)) + codes) // len(distinct), minlength=len(lengths))
        rare = rarity[known.word][codes]
        mean = lambda x: np.add.reduceat(x, starts)[:, None] / n
        out[full, 2 * DIM :] = np.hstack([mean(again), distinct_in[full][:, None] / n, mean(rare), mean((rare > np.log10(RARE)).astype(np.float32)), np.log1p(n), np.ones_like(n)])
    return out


class Network(NamedTuple):
    """Standardised inputs, one tanh layer, one logit over a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, epochs: int = 60) -> Network:
    """Adam on the log loss; a fifth of the rows is kept for the temperature. Without both labels: a constant."""
    x = x.astype(np.float64)
    if len(y) < 10 or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        zero = np.zeros((x.shape[1], 1))
        return Network(np.zeros(x.shape[1]), np.ones(x.shape[1]), zero, np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))), 1.0)
    rng = np.random.default_rng(99)
    order = rng.permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-3
    z = (x - mean) / scale
    theta = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta], 0
    size = 128
    for _ in range(max(epochs, int(np.ceil(600 * size / len(fit))))):
        shuffled = rng.permutation(fit)
        for s in range(0, len(shuffled), size):
            i = shuffled[s : s + size]
            h = np.tanh(z[i] @ theta[0] + theta[1])
            e = (1 / (1 + np.exp(-np.clip(h @ theta[2] + theta[3], -50, 50))) - y[i]) / len(i)
            d = np.outer(e, theta[2]) * (1 - h * h)
            grads = [z[i].T @ d + 1e-4 * theta[0], d.sum(0), h.T @ e + 1e-4 * theta[2], e.sum(keepdims=True)]
            t += 1
            for p, g, a, b in zip(theta, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.003 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    net = Network(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]), 1.0)
    logit = net.logit(x[held])

    def loss(temperature: float) -> float:
        return np.mean(np.logaddexp(0, logit / temperature) - y[held] * logit / temperature)

    return net._replace(temperature=float(min(np.geomspace(0.25, 16, 61), key=loss)))


def featurise(vectors: np.ndarray, rarity: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            x = features(rows["text"], vectors, rarity)
            yield pa.RecordBatch.from_arrays([rows["label"], pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "x"])

    return run


def scorer(vectors: np.ndarray, rarity: np.ndarray, net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            p = net.probability(features(rows["text"], vectors, rarity).astype(np.float64))
            passed = [c for c in rows.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in passed), pa.array(p)], names=[*passed, "score"])

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.5,
    sample: int = SAMPLE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, the columns ``carry``, score (0 to 1, higher: label 1 likelier), predicted.

    ``learn`` is a Column over doc_id: labels are learnt from rows where it holds, from ``sample`` of them at most;
    held_out is its opposite (null counts as held out). Null and empty texts are scored as texts without words.
    Without labels of both kinds the score is the smoothed share of label 1. Repeated rows each get the same score, which
    depends on the text alone; ids may be of any type and null. An empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *carry)
    vectors, rarity = learn_vectors(source)
    some = labelled_sample(docs, labels, label, learn, doc_id, text, sample)
    got = some.mapInArrow(featurise(vectors, rarity), "label int, x binary").toPandas().sort_values(["x", "label"])
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), FEATURES)
    net = train(x, got["label"].to_numpy(np.float64))
    rows = source.withColumn("held_out", ~F.coalesce(learn, F.lit(False))).select("doc_id", "held_out", *carry, "text")
    returned = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    scored = rows.mapInArrow(scorer(vectors, rarity, net), f"{returned}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
