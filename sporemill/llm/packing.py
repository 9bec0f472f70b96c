"""Packing of tokenised documents into sequences: bounded-space online best-fit.

1. Documents become token ids. A text is cut where white space begins after other characters: no pre-token of the
   tokeniser reaches over such a place, so each distinct chunk of a batch is encoded once, and the ids of a text are those of
   its chunks in order.
2. Documents longer than a sequence are cut into pieces, the first of which may be shorter.
3. Slim rows (number, piece, length) are dealt to packers by a hash, and come to each in an order by a hash. A packer holds at
   most ``OPEN`` bins, found by a bitset of the free spaces that occur: the lowest set bit at or above a piece's length is
   the best fit. Where none fits, a new bin is opened; if all are in use, the fullest closes first.
4. What lies in bins still open when a packer ends is packed again by fewer packers, and in the end by one that has bins for
   all of it and takes long pieces first. So the space lost at the ends does not grow with the number of packers.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, type_of

SIZE = 2048
#: Bins that a packer holds open.
OPEN = 1024
#: Tokens dealt to a packer, in multiples of what its bins hold.
SHARE = 16
#: White space as Unicode has it (White_Space), which is what the tokeniser's pattern goes by.
SPACE = "\\t-\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
#: Marks the ends of chunks in Arrow; texts that hold this character themselves are encoded whole.
CUT = "\0"
#: Bytes of text encoded at a time, and the longest chunk, in characters, that the quick merge loop gets.
BATCH = 16 << 20
SHORT = 400


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 bytes stand for themselves, the
    others for the letters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts by a byte-level BPE file of the ``tokenizers`` library.

    That library encodes whole texts and long chunks; short chunks go through ``tiktoken``'s merge loop over the same file's
    vocabulary, which gives the same ids in a third of the time (tested). Special tokens in a text are found as the library
    finds them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = byte_of_letter()
        ranks = {bytes(letters[c] for c in token): i for token, i in self.tokenizer.get_vocab().items() if token not in self.added}
        self.quick = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def chunks(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in order, number of ids of each)."""
        quick = self.quick.encode_ordinary
        found = [quick(c) if len(c) <= SHORT else self.whole(c) for c in distinct]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, counts.sum()), counts

    def texts(self, text: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an array of large strings without nulls."""
        whole = pc.match_substring(text, CUT)
        for content in self.added:
            whole = pc.or_(whole, pc.match_substring(text, content))
        text_cut = pc.if_else(whole, "", text)
        # after white space a space begins no chunk: such texts need the slower pattern
        slow = pc.match_substring_regex(text_cut, f"[{SPACE}] ").to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(~slow), np.flatnonzero(slow)])
        fast_rows, slow_rows = text_cut.take(pa.array(order[: (~slow).sum()])), text_cut.take(pa.array(order[(~slow).sum() :]))
        cut = pa.concat_arrays(
            [pc.replace_substring(fast_rows, " ", CUT + " "), pc.replace_substring_regex(slow_rows, f"([^{SPACE}])([{SPACE}])", f"\\1{CUT}\\2")]
        )
        lists = pc.split_pattern(cut, CUT)
        pieces = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        enc = lists.flatten().dictionary_encode()
        codes = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        flat, counts = self.chunks(enc.dictionary.to_pylist())
        starts, lengths = (np.cumsum(counts) - counts)[codes], counts[codes]
        shift = starts - (np.cumsum(lengths) - lengths)
        ids = flat[np.repeat(shift, lengths) + np.arange(lengths.sum())]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(pieces)])]
        out = [None] * len(text)
        for i, a, b in zip(order, ends, ends[1:]):
            out[i] = ids[a:b]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            out[i] = np.array(self.whole(text[int(i)].as_py()), np.uint32)
        return out


def stretches(text: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Stretches of the texts, each of at most BATCH bytes or of one text, with their first row."""
    ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH, side="right")))
        yield a, text.take(pa.array(np.arange(a, b)))  # a copy: Arrow's string functions misread slices
        a = b


def piece_starts(n: int, size: int) -> list[int]:
    """Where the pieces of a document of n ids begin: all but the first have ``size`` ids."""
    return [0, *range(n % size or size, n, size)]


def cutter(path: str, end: int, size: int, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(path)
            for first, texts in stretches(pc.fill_null(batch["text"].cast(pa.large_string()), "")):
                rows, parts = [], []
                for i, got in enumerate(encoder.texts(texts)):
                    got = np.append(got, np.uint32(end)).astype("<u4")
                    starts = piece_starts(len(got), size)
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(got)])):
                        rows.append((first + i, k, a, b - a, zlib.crc32(got[a:b].tobytes())))
                        parts.append(got[a:b])
                at, piece, start, length, crc = (pa.array(c, pa.int64()) for c in zip(*rows))
                columns = [batch["row"].take(at), batch["doc_id"].take(at), piece.cast(pa.int32()), start, length, crc]
                if ids:
                    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
                    flat = pa.array(np.concatenate(parts).view(np.int32))
                    # some 1M ids a batch
                    cuts = np.unique(np.searchsorted(bounds, [*range(0, int(bounds[-1]), 1 << 20), int(bounds[-1])]))
                    for a, b in zip(cuts, cuts[1:]):
                        lists = pa.ListArray.from_arrays(pa.array((bounds[a : b + 1] - bounds[a]).astype(np.int32)), flat[bounds[a] : bounds[b]])
                        yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in columns), lists], names=[*NAMES, "ids"])
                else:
                    yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return run


NAMES = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]


def pieces(docs: DataFrame, tokenizer: str, end: int = 0, size: int = SIZE, doc_id: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """The pieces of all documents: (row, doc_id, piece, start, length, ids_crc32[, ids array<int>]).

    A document is the ids of its whole text by the file ``tokenizer``, then ``end``; null texts are empty. Only documents of
    more than ``size`` ids are cut; all pieces but the first have ``size`` ids. ``row`` numbers the rows of ``docs``, so ids
    may repeat or be null. ids_crc32: check value of the piece's ids, as unsigned little-endian 32-bit numbers. ``ids=False``
    leaves the ids out, for what needs lengths only. An empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"row long, doc_id {type_of(source, 'doc_id')}, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(cutter(tokenizer, end, size, ids), schema + (", ids array<int>" if ids else ""))


class Bins:
    """At most ``most`` open bins of ``size``, by free space; ``mask`` has a bit for each free space that occurs."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.mask, self.open, self.made = size, most, 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes an open bin of the least free space that is ``least`` or more: (bin, free)."""
        fit = self.mask >> least
        if not fit:
            return None
        free = least + (fit & -fit).bit_length() - 1
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.mask ^= 1 << free
        self.open -= 1
        return found, free

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        got = self.take(length)
        if got is None:
            if self.open == self.most:
                self.take(0)  # the fullest closes
            got = self.made, self.size
            self.made += 1
        number, free = got
        left = free - length
        if left:  # else the bin is full, and closed
            self.by_free[left].append(number)
            self.mask |= 1 << left
            self.open += 1
        return number, self.size - free


def packer(size: int, most: int):
    """Rows sorted by packer to rows with bin and offset; bins open at a packer's end follow as rows without a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, now = None, None

        def left() -> Iterator[pa.RecordBatch]:
            numbers = [b for some in bins.by_free for b in some] if bins else []
            none = pa.nulls(len(numbers), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none.cast(pa.int32()), pa.array([now] * len(numbers), pa.int64()), pa.array(numbers, pa.int64()), none], names=OUT)

        for batch in batches:
            dealt, length = batch["packer"].to_pylist(), batch["length"].to_pylist()
            placed = []
            for p, n in zip(dealt, length):
                if p != now:
                    if bins:
                        yield from left()
                    bins, now = Bins(size, most), p
                placed.append(bins.place(n))
            number, offset = zip(*placed) if placed else ((), ())
            yield pa.RecordBatch.from_arrays([batch["row"], batch["piece"], batch["packer"], pa.array(number, pa.int64()), pa.array(offset, pa.int64())], names=OUT)
        if bins:
            yield from left()

    return run


OUT = ["row", "piece", "packer", "bin", "offset"]


def packed(parts: DataFrame, size: int = SIZE, most: int = OPEN, share: int = SHARE) -> DataFrame:
    """``parts`` with sequence_id and offset: each sequence's pieces lie without gaps from 0 to at most ``size``.

    ``parts``: a table with row, piece (together a key) and length, from 1 to ``size``; it is read several times, so it should
    be a written one. Sequence numbers are unique and have gaps. An empty table gives no rows.
    """
    full = parts.where(F.col("length") == size).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    todo, places, last = parts.where(F.col("length") < size).select("row", "piece", "length"), [], False
    for turn in itertools.count():
        tokens = todo.agg(F.sum("length")).first()[0] or 0
        last = last or tokens <= most * size
        packers = 1 if last else -(-tokens // (share * most * size))
        dealt = todo.withColumn("packer", F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(packers)))
        order = [F.desc("length"), "row", "piece"] if last else [F.xxhash64("piece", "row"), "row", "piece"]
        dealt = dealt.repartition("packer").sortWithinPartitions("packer", *order)
        out = materialise(dealt.mapInArrow(packer(size, most), "row long, piece int, packer long, bin long, offset long"), "packed")
        found, ends = out.where("row is not null"), out.where("row is null").select("packer", "bin")
        number = (F.lit(turn) * (1 << 56) + F.col("packer") * (1 << 28) + F.col("bin")).cast("long").alias("sequence_id")
        done = found if last else found.join(ends, ["packer", "bin"], "left_anti")
        places.append(done.select("row", "piece", number, "offset"))
        if last:
            break
        left = found.join(ends, ["packer", "bin"], "left_semi").select("row", "piece")
        todo = materialise(todo.join(left, ["row", "piece"], "left_semi"), "left")
        last = packers == 1
    placed = places[0]
    for more in places[1:]:
        placed = placed.union(more)
    return parts.where(F.col("length") < size).join(placed, ["row", "piece"]).select(*full.columns).unionByName(full)


def sequences(parts: DataFrame, size: int = SIZE, most: int = OPEN, share: int = SHARE) -> DataFrame:
    """The packed sequences: (sequence_id, ids array<int>, documents array<struct<offset, doc_id, piece, start, length>>), the
    ids of ``parts`` (as by ``pieces``, written) end to end, and what lies where."""
    where = packed(parts.drop("ids"), size, most, share)
    rows = where.join(parts.select("row", "piece", "ids"), ["row", "piece"])
    together = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids"))).alias("all"))
    about = F.transform("all", lambda x: F.struct(x.offset.alias("offset"), x.doc_id.alias("doc_id"), x.piece.alias("piece"), x.start.alias("start"), x.length.alias("length")))
    return together.select("sequence_id", F.flatten(F.transform("all", lambda x: x.ids)).alias("ids"), about.alias("documents"))
