"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent character n-grams (n = 1 to 3, letters only, words padded with a blank), most
frequent first. A language's profile comes from all its training documents. A text goes to the language whose profile
has the least out-of-place distance: over the text's own profile, how far each n-gram's rank is from its rank in the
language, and the full length of the profile for n-grams that the language's lacks.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, type_of
from .quality import slices

#: N-grams of a profile.
TOP = 300
#: Languages whose profiles may be held in memory at once (about 5 kB each).
MOST_LANGUAGES = 20_000
CHARS = 21  # bits of a code point


@functools.cache
def letter_table() -> np.ndarray:
    """All code points: the letter itself, or 0 for what is not a letter."""
    return np.array([i if chr(i).isalpha() else 0 for i in range(sys.maxunicode + 1)], np.int64)


def grams(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-grams as integers, their counts) of a text."""
    s = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    s = np.concatenate([[0], letters[s], [0]])
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)  # one blank between words
    s = s[keep]
    if len(s) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # small numbers for the letters of this text, so that n-grams sort as 32-bit integers where they can
    seen, code = np.unique(s, return_inverse=True)
    m = len(seen) + 1
    code = code + 1
    two = code[:-1] * m + code[1:]
    three = two[:-1] * m + code[2:]
    parts = [code[s != 0], two, three[s[1:-1] != 0]]
    all_ = np.concatenate(parts)
    if m**3 < 1 << 31:
        all_ = all_.astype(np.int32)
    distinct, n = np.unique(all_, return_counts=True)
    # back to code points: a digit in base m is a letter's number, 0 where the n-gram is shorter
    d, out, shift = distinct.astype(np.int64), np.zeros(len(distinct), np.int64), 0
    lookup = np.concatenate([[0], np.where(seen == 0, 32, seen)])
    while d.any():
        out += lookup[d % m] << shift
        d //= m
        shift += CHARS
    return out, n


def ranked(g: np.ndarray, n: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams, ties by the smaller code."""
    if len(g) > top:
        least = np.partition(n, len(n) - top)[len(n) - top]
        g, n = g[n >= least], n[n >= least]
    return g[np.lexsort((g, -n))][:top]


def language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letter_table()
    for rows in slices(batches):
        by: dict[str, list] = {}
        for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist()):
            if text:
                by.setdefault(lang, []).append(grams(text, letters))
        for lang, found in by.items():
            g, inverse = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([x for _, x in found]).astype(float), len(g)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])


def learn_profiles(docs: DataFrame, top: int = TOP) -> dict[str, list[int]]:
    """{language: its n-grams, most frequent first} from rows (lang, text); at most ``top`` rows a language come back."""
    n = docs.where("lang is not null and text is not null").select("lang", "text")
    n = n.mapInArrow(language_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = materialise(n.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "profiles")
    languages = best.select("lang").distinct().count()
    if languages > MOST_LANGUAGES:  # before any profile comes to the driver
        raise ValueError(f"{languages} languages are too many to hold at once")
    out: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Profiles:
    """All profiles as one sorted table of n-grams, each with its languages and the ranks that it has there."""

    def __init__(self, profiles: dict[str, list[int]], top: int):
        self.names, self.top = sorted(profiles), top
        lengths = [len(profiles[x]) for x in self.names]
        grams = np.array([g for x in self.names for g in profiles[x]], np.int64)
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(grams))
        self.language = np.repeat(np.arange(len(self.names), dtype=np.int32), lengths)[order]
        self.rank = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths] + [np.zeros(0, np.int32)])[order]

    def distances(self, profile: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language, as a share of the most that is possible."""
        at = np.searchsorted(self.grams, profile)
        at[at == len(self.grams)] = 0
        place = np.flatnonzero(self.grams[at] == profile)
        first, n = self.first[at[place]], self.first[at[place] + 1] - self.first[at[place]]
        posting = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        nearer = self.top - np.abs(self.rank[posting] - np.repeat(place, n))
        most = self.top * len(profile)
        return (most - np.bincount(self.language[posting], nearer, len(self.names))) / most

    def predict(self, profile: np.ndarray) -> tuple[str, float]:
        """(language, score): ties go to the first name; the score is the nearness of the best among all nearnesses, sharpened."""
        d = self.distances(profile)
        best = int(d.argmin())
        near = np.exp(-20 * (d - d[best]))
        return self.names[best], float(near[best] / near.sum())


def predictor(profiles: dict[str, list[int]], top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known = letter_table(), Profiles(profiles, top)
        for rows in slices(batches):
            out = []
            for text in rows["text"].to_pylist():
                g, n = grams(text, letters) if text else (np.zeros(0, np.int64), None)
                out.append(known.predict(ranked(g, n, top)) if len(g) and known.names else ("und", 0.0))
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], rows["held_out"], pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"]
            )

    return run


def identify_languages(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    Profiles come from text and non-null lang of the rows where ``learn``, a Column over doc_id, holds; held_out is its
    opposite (null counts as held out). Only the text decides a prediction. Null texts and texts without a letter are
    ``und`` with score 0, as is everything when nothing could be learnt. Equal distances go to the alphabetically first
    language. Repeated rows get equal results; ids may be of any type
    and null. An empty table gives no rows; other columns are
    ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    learned = F.coalesce(learn, F.lit(False))
    profiles = learn_profiles(source.where(learned), top)
    rows = source.select("doc_id", (~learned).alias("held_out"), "text")
    return rows.mapInArrow(predictor(profiles, top), f"doc_id {type_of(source, 'doc_id')}, held_out boolean, lang_pred string, score double")
