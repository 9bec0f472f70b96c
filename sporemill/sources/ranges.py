"""Byte ranges of four-line FASTQ files, plain, gzip or block gzip: one row a record, no shuffle of records.

A range owns the text from its sync point to that of the next range. The sync point of a place is the first line behind
a line end that begins with @ and is followed, two lines on, by one that begins with +; in a well-formed file only a
title does so, since no sequence begins with +. Every byte thus belongs to one range, also where records are malformed.
"""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a range, and of text held at once.
RANGE, PIECE = 64 << 20, 1 << 20
#: Other codecs by the end of a name; such a file is one piece, as gzip without blocks is.
CODECS = {".bz2": "bz2", ".zst": "zstd", ".lz4": "lz4"}
#: How a block of block gzip begins; its length less one follows.
BLOCK = bytes.fromhex("1f8b0804")
SCHEMA = "source string, start long, i long, h string, seq string, plus string, qual string"


def opened(path: str):
    if path.startswith("file:") or path.startswith("/"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    fs, inner = pa.fs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def block_size(head: bytes) -> int | None:
    """Bytes of the gzip block that begins here, or None where none does."""
    if len(head) < 18 or head[:4] != BLOCK or head[12:16] != b"BC\x02\0":
        return None
    return struct.unpack("<H", head[16:18])[0] + 1


def first_block(f, start: int, size: int) -> int:
    """The place of the first block at or behind ``start``: one that another block, or the end, follows."""
    at, step = start, 1 << 17
    while at < size:
        f.seek(at)
        window = f.read(2 * step)
        i = window.find(BLOCK)
        while 0 <= i < step:
            n = block_size(window[i : i + 18])
            if n:
                f.seek(at + i + n)
                head = f.read(18)
                if at + i + n == size or block_size(head):
                    return at + i
            i = window.find(BLOCK, i + 1)
        at += step
    return size


class Text:
    """The text of a file as pieces from any place that a range may begin at."""

    def __init__(self, path: str, size: int):
        self.f, self.size = opened(path), size
        head = self.f.read(18)
        self.blocks = block_size(head) is not None
        self.codec = CODECS.get(path[path.rfind(".") :].lower())
        self.stream = self.codec is not None or head[:2] == b"\x1f\x8b" and not self.blocks  # one run of text: only range 0 reads it
        self.f.seek(0)

    def pieces(self, start: int, stop: int) -> Iterator[bytes]:
        if self.stream:
            if start == 0:
                with pa.CompressedInputStream(self.f, self.codec) if self.codec else gzip.open(self.f) as g:
                    while piece := g.read(PIECE):
                        yield piece
        elif self.blocks:
            at = first_block(self.f, start, self.size)
            while at < min(stop, self.size):
                self.f.seek(at)
                n = block_size(self.f.read(18))
                if n is None:
                    raise ValueError(f"block gzip is broken at byte {at}")
                self.f.seek(at)
                yield zlib.decompress(self.f.read(n), 31)
                at += n
        else:
            for at in range(start, min(stop, self.size), PIECE):
                self.f.seek(at)
                yield self.f.read(min(PIECE, stop - at))

    def sync(self, start: int) -> int:
        """How many bytes of text lie between ``start`` and its sync point, or the end."""
        done, rest = 0, b""
        for piece in self.pieces(start, self.size):
            rest += piece
            line, ends = 0, []
            while (end := rest.find(b"\n", line)) >= 0:
                ends.append(end + 1)
                line = end + 1
                if len(ends) > 2 and rest[ends[-3] : ends[-3] + 1] == b"@" and rest[line : line + 1] == b"+":
                    return done + ends[-3]
            if len(ends) > 3:  # the last lines stay, with the line end before them: their followers are still to come
                done, rest = done + ends[-4] - 1, rest[ends[-4] - 1 :]
        return done + len(rest)

    def owned(self, start: int, stop: int) -> Iterator[bytes]:
        """The bytes of a range, from its sync point to the next range's."""
        skip = self.sync(start) if start and not self.stream else 0
        tail = self.sync(stop) if stop < self.size and not self.stream else 0
        for piece in self.pieces(start, stop):
            yield piece[skip:]
            skip = max(skip - len(piece), 0)
        for piece in self.pieces(stop, self.size) if tail else ():
            yield piece[:tail][skip:]
            skip, tail = max(skip - len(piece), 0), tail - len(piece)
            if tail <= 0:
                break


def lines_of(pieces: Iterator[bytes]) -> Iterator[list[str]]:
    """Whole records of four lines, some MB at a time; the last list may end within a record."""
    lines, rest = [], b""
    for piece in pieces:
        text, newline, rest = (rest + piece).rpartition(b"\n")
        if newline:
            lines += text.decode("utf-8", "replace").split("\n")
            whole = len(lines) // 4 * 4
            yield lines[:whole]
            lines = lines[whole:]
    if rest:
        lines.append(rest.decode("utf-8", "replace"))
    yield lines


def read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for r in rows.to_pylist():
            done = r["first"]
            for lines in lines_of(Text(r["path"], r["length"]).owned(r["start"], r["stop"])):
                lines += [None] * (-len(lines) % 4)
                n = len(lines) // 4
                columns = [pa.array([r["source"]] * n, pa.string()), pa.array([r["start"]] * n, pa.int64()), pa.array(range(done, done + n), pa.int64())]
                columns += [pa.array(lines[k::4], pa.string()) for k in range(4)]
                done += n
                yield pa.RecordBatch.from_arrays(columns, names=["source", "start", "i", "h", "seq", "plus", "qual"])


def count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for r in rows.to_pylist():
            lines, last = 0, b"\n"
            for piece in Text(r["path"], r["length"]).owned(r["start"], r["stop"]):
                lines, last = lines + piece.count(b"\n"), piece[-1:] or last
            n = (lines + (last != b"\n") + 3) // 4
            yield pa.RecordBatch.from_pylist([r | {"n": n}], pa.schema([*rows.schema, ("n", pa.int64())]))


def ranges_of(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """(source, path, length, start, stop), a row a range, each its own task as far as possible; files are only listed."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("_metadata.file_path").alias("source"), "path", "length")
    cut = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))))
    cut = cut.withColumn("stop", F.least(F.col("start") + size, "length"))
    return spread(cut)


def spread(ranges: DataFrame) -> DataFrame:
    """Each range its own task, as far as possible."""
    return ranges.repartition(max(1, min(ranges.count(), 20_000)))


def records(ranges: DataFrame) -> DataFrame:
    """(source, start, i, h, seq, plus, qual): the lines of each record, and its number within its range, from ``first`` where
    ranges have it. Spark takes the records to be as few as the ranges, so joins of them should not be left to its estimates."""
    first = F.col("first") if "first" in ranges.columns else F.lit(0).cast("long")
    return ranges.withColumn("first", first).mapInArrow(read_ranges, SCHEMA)


def counts(ranges: DataFrame) -> DataFrame:
    """(source, path, length, start, stop, n): records a range."""
    return ranges.mapInArrow(count_ranges, "source string, path string, length long, start long, stop long, n long")


def record_columns(pieces: list[dict], low: int, high: int) -> Iterator[list[list]]:
    """The four lines of records ``low`` to ``high`` of one file, some MB at a time, from those of its ranges that hold them."""
    for r in sorted(pieces, key=lambda r: r["first"]):
        at = r["first"]
        if at >= high or at + r["n"] <= low:
            continue
        for lines in lines_of(Text(r["path"], r["length"]).owned(r["start"], r["stop"])):
            lines += [None] * (-len(lines) % 4)
            n = len(lines) // 4
            a, b = max(low - at, 0), min(high - at, n)
            if a < b:
                yield [lines[4 * a + k : 4 * b : 4] for k in range(4)]
            at += n
            if at >= high:
                break


def in_step(mates: list[list[dict]], low: int, high: int) -> Iterator[tuple[int, list[list[list]]]]:
    """(number of the first record, columns of each mate) of records ``low`` to ``high`` of several files, read in step; a file
    that has ended gives None."""
    streams = [record_columns(pieces, low, high) for pieces in mates]
    held: list = [[[], [], [], []] for _ in mates]
    while True:
        for m, stream in enumerate(streams):
            while stream is not None and not held[m][0]:
                held[m] = next(stream, None)
                if held[m] is None:
                    streams[m] = stream = None
                    held[m] = [[], [], [], []]
        sizes = [len(h[0]) for h in held if h[0]]
        if not sizes:
            return
        n = min(sizes)
        yield low, [[c[:n] for c in h] if h[0] else [[None] * n] * 4 for h in held]
        held = [[c[n:] for c in h] if h[0] else h for h in held]
        low += n


def mates_schema(mates: int) -> str:
    return "pair string, rec_no long, " + ", ".join(f"h{m} string, s{m} string, q{m} string" for m in range(mates))


def read_mates(mates: int):
    """Rows (pair, low, high, pieces of each mate) to the records of all mates by their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in mates_schema(mates).split(", ")]
        for rows in batches:
            for r in rows.to_pylist():
                for at, columns in in_step([[p for p in r["pieces"] if p["mate"] == m] for m in range(mates)], r["low"], r["high"]):
                    n = len(columns[0][0])
                    out = [pa.array([r["pair"]] * n, pa.string()), pa.array(range(at, at + n), pa.int64())]
                    out += [pa.array(c[k], pa.string()) for c in columns for k in (0, 1, 3)]
                    yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def pieces_of(sizes: DataFrame) -> DataFrame:
    """sizes(pair, mate, path, length, start, stop, n) to a row a piece of work: the records from the beginning of a range of one
    of the first two mates up to that of the next, and the ranges of all mates that hold them. Rows are as few as ranges."""
    first = F.coalesce(F.sum("n").over(Window.partitionBy("pair", "mate").orderBy("path", "start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = sizes.withColumn("first", first)
    files = each.groupBy("pair").agg(F.collect_list(F.struct("mate", "path", "length", "start", "stop", "first", "n")).alias("pieces"))
    lows = F.array_sort(F.array_distinct(F.transform(F.filter("pieces", lambda p: (p["mate"] < 2) & (p["n"] > 0)), lambda p: p["first"])))
    each = files.withColumn("lows", lows).select("*", F.posexplode("lows").alias("i", "low"))
    each = each.withColumn("high", F.coalesce(F.get("lows", F.col("i") + 1), F.lit((1 << 62))))
    held = F.filter("pieces", lambda p: (p["first"] < F.col("high")) & (p["first"] + p["n"] > F.col("low")))
    return each.select("pair", "low", "high", held.alias("pieces"))
