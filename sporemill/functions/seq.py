"""Nucleotide and quality strings as Column expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements (W, S, N, X are their own).
IUPAC = "ACGTURYKMBDHV"
COMPLEMENT = "TGCAAYRMKVHDB"


def sample_of(title: Column) -> Column:
    """The sample id in a read's title: after label= or sample=, else after the first =, up to the next ;"""
    got = [F.nullif(F.regexp_extract(title, p, 1), F.lit("")) for p in ("label=([^;]*)", "sample=([^;]*)", "=([^;]*)")]
    return F.coalesce(*got)


def title_values(title: Column) -> Column:
    """key=value pairs of a title, ;-separated, as a map; the first of repeated keys counts."""
    parts = F.filter(F.split(title, ";"), lambda x: x.contains("="))
    pairs = F.transform(parts, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.regexp_extract(x, "=(.*)$", 1).alias("v")))
    first = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(first)


def index_of(title: Column) -> Column:
    """The index sequence after a title's last colon; null where that is a number or missing."""
    x = F.regexp_extract(title, r":([^:]+)$", 1)
    return F.when((x != "") & ~x.rlike("^[0-9]+$"), x)


def cut(text: Column, start: Column | int, end: Column | int) -> Column:
    """text[start:end], positions from 0."""
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def trim_or_pad(seq: Column, qual: Column, length: int, pad: bool = False) -> tuple[Column, Column]:
    """Cut to ``length``; with ``pad`` shorter reads get N and quality I up to it."""
    if pad:
        return F.rpad(seq, length, "N"), F.rpad(qual, length, "I")
    return F.left(seq, F.lit(length)), F.left(qual, F.lit(length))


def strip_padding(seq: Column, qual: Column | None = None) -> tuple[Column, Column | None]:
    """Without trailing N, and the quality cut to match."""
    bare = F.rtrim(seq, F.lit("N"))
    return bare, None if qual is None else F.left(qual, F.length(bare))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), IUPAC, COMPLEMENT))


def phred(qual: Column) -> Column:
    """Phred+33 text to array<int>."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def score_text(qual: Column) -> Column:
    """Phred+33 text to its scores, separated by spaces."""
    return F.arrow_udf(scores_of, "string")(qual)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, where each text ends, from 0 on) of a batch; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def texts_of(raw: np.ndarray, ends: np.ndarray, like: pa.Array) -> pa.Array:
    """The inverse of ``bytes_of`` for ASCII, null where ``like`` is."""
    out = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
    return pc.if_else(pc.is_valid(like), out, None).cast(pa.string())


def scores_of(quals: pa.Array) -> pa.Array:
    raw, ends = bytes_of(quals)
    if raw.size and (raw.min() < 43 or raw.max() > 126):  # a score of one digit, or what is no Phred+33
        return pa.array([None if q is None else " ".join([str(ord(c) - 33) for c in q]) for q in quals.to_pylist()], pa.string())
    score = raw - 33
    out = np.empty((len(raw), 3), np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = score // 10 + 48, score % 10 + 48, 32
    full = np.diff(ends) > 0
    keep = np.ones(out.shape, bool)
    keep[ends[1:][full] - 1, 2] = False  # no blank behind the last
    return texts_of(out[keep], 3 * ends - np.r_[0, np.cumsum(full)], quals)


def letters_of(scores: pa.Array) -> pa.Array:
    raw, ends = bytes_of(scores)
    digit, blank = (raw >= 48) & (raw <= 57), (raw == 32) | (raw == 10) | (raw == 13) | (raw == 9)
    second = digit & np.r_[False, digit][: len(raw)]
    second[ends[:-1][ends[:-1] < len(raw)]] = False  # the digit before is of another text
    if not (digit | blank).all() or (second & np.r_[False, second][: len(raw)]).any():  # signs, or three digits
        return pa.array([None if s is None else "".join([chr(int(x) + 33) for x in s.split()]) for s in scores.to_pylist()], pa.string())
    last = digit & ~np.r_[second[1:], False][: len(raw)]
    at = np.flatnonzero(last)
    value = raw[at].astype(np.int64) - 48 + np.where(second[at], 10 * (raw[at - 1].astype(np.int64) - 48), 0)
    if (value > 93).any():
        return pa.array([None if s is None else "".join([chr(int(x) + 33) for x in s.split()]) for s in scores.to_pylist()], pa.string())
    return texts_of((value + 33).astype(np.uint8), np.r_[0, np.cumsum(last)][ends], scores)


def phred_text(scores: Column) -> Column:
    """Scores separated by blanks or line ends to Phred+33 text; what is no number is an error."""
    return F.arrow_udf(letters_of, "string")(scores)


#: Error probability of each byte of Phred+33 text.
ERROR = np.power(10.0, -(np.arange(256) - 33) / 10.0)


def sum_errors(quals: pa.Array) -> pa.Array:
    """Expected errors of a batch: one table lookup over all its bytes, as Arrow holds them, and a sum per read."""
    texts = pc.fill_null(quals, "").cast(pa.large_string())
    if pc.sum(pc.binary_length(texts)).as_py() != pc.sum(pc.utf8_length(texts)).as_py():  # a character is a byte
        texts = pa.array([x.encode("latin-1", "replace") for x in texts.to_pylist()], pa.large_binary())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    out, full = np.zeros(len(texts)), np.diff(ends) > 0
    if full.any():
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
        out[full] = np.add.reduceat(ERROR[raw], (ends[:-1] - ends[0])[full])
    return pa.array(out, mask=pc.is_null(quals).to_numpy(zero_copy_only=False))


def expected_errors(qual: Column) -> Column:
    """Sum of 10^(-Q/10), in Arrow batches: per base, a lambda expression costs a hundred times as much."""
    return F.arrow_udf(sum_errors, "double")(qual)


def average_quality(qual: Column) -> Column:
    """-10 log10 of the mean error probability; null for an empty text."""
    return F.when(F.length(qual) > 0, -10 * F.log10(expected_errors(qual) / F.length(qual)))


def wrap(seq: Column, width: int = 80) -> Column:
    return F.regexp_replace(seq, "(.{%d})(?=.)" % width, "$1\n")


def human_size(n: Column) -> Column:
    """Bytes with one decimal and a unit."""
    unit, out = 1024.0, None
    for i, name in enumerate(("B", "KB", "MB", "GB", "TB")):
        text = F.concat(F.format_string("%.1f", n.cast("double") / unit**i), F.lit(f" {name}"))
        small = n < unit ** (i + 1)
        out = F.when(small, text) if out is None else out.when(small, text) if i < 4 else out.otherwise(text)
    return out


#: Latin-1 characters that become one ASCII character, and those that become several.
LATIN_FROM = "¡¢£¤¥¦§¨©ª¬\u00ad®¯°²³´µ¶·¸¹º¿ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåçèéêëìíîïðñòóôõö÷øùúûüýþÿ’×"
LATIN_TO = "!cLoY|S`ca--R-o23'uP.,1o?AAAAAACEEEEIIeIDNOOOOOOUUUUYpbaaaaaaceeeeiiiidnooooo/ouuuuypy'x"
LATIN_MANY = {"«": "<<", "±": "+-", "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4", "Æ": "Ae", "æ": "ae"}


def to_ascii(text: Column) -> Column:
    """Repairs Latin-1 headers; what has no counterpart is dropped."""
    text = F.translate(text, LATIN_FROM, LATIN_TO)
    for a, b in LATIN_MANY.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")
