"""Toxicity by noisy-channel deobfuscation.

A writer hides a word by look-alike characters ("1d10t"), separators ("i.d.i.o.t", "i d i o t", "id i ot") and repetition
("idiooot"). Suspicious tokens, and runs of single characters, become lattices: each position lists the letters that
may have been meant, with the channel's cost; length does not matter. A Viterbi search under a character trigram model, counted over all
documents, picks the likeliest letters. Restored and plain words are then scored by a lexicon of words and word
beginnings learnt from labelled documents: a feature's score is its smoothed precision, a document's the highest
of its words, or the rate of label 1 among documents without such words. Within runs of single letters, which may hold
several words, features are looked up at every letter. All readings of a lattice share one canonical form, so tokens whose
form is that of no feature are not decoded when documents are scored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_strings, materialise, mix64, tokens, type_of
from .labelled import SAMPLE, labelled_sample
from .quality import slices

#: Look-alikes: a fixed table of what a character may stand for.
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = ".-_*~'`^/\\,:;#=" "\u200b\u00ad"
#: Natural logs of what the channel does: replace a letter, insert a separator, repeat a letter.
REPLACE, SEPARATE, REPEAT = -2.0, -0.7, -1.0
#: The same where a letter stands twice, as it does in many words.
TWICE = -6.0
SYMBOLS = 64
BEAM = 24
#: Lengths of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
#: Letters that a word within a run of single letters has at least.
INSIDE = 4
#: A token mostly of digits that would spell more letters than this is a number or a hash.
SPELT_BY_DIGITS = 12
LEAST_DOCUMENTS = 3
PRECISION = 0.7

EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”„‘’…¿¡–—"
SUSPICIOUS = re.compile(r"[^\W\d_][{0}]|[{0}][^\W\d_]|([^\W\d_])\1\1|([^\W\d_])\2([^\W\d_])\3([^\W\d_])\4".format(re.escape("".join(LOOKALIKE) + SEPARATORS)))
PARTS = re.compile("[%s]+" % re.escape(SEPARATORS))
ADDRESS = re.compile(r"://|^www\.|.@.")
#: One letter for all that a look-alike may stand for; ``l`` and ``i`` share theirs.
SAME = str.maketrans({"l": "i"} | {c: letters[0].replace("l", "i") for c, letters in LOOKALIKE.items()})


def symbol(c: str) -> int:
    """A character's number in the model: 0 the edge of a word, 1-26 a-z, above other letters, several to a number."""
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (SYMBOLS - 27)


def bare(token: str) -> str:
    """A token without what stands around its word."""
    if len(token) > 3 and token[-1] == token[-2] == token[-3]:
        token = token.rstrip(token[-1]) if not token[-1].isalpha() else token
    core = token.strip(EDGE)
    # a look-alike at the edge belongs to the word unless it is common punctuation
    at = token.find(core) if core else 0
    if core and at > 0 and token[at - 1] in "@$(|":
        core = token[at - 1] + core
    while core and token[at + len(core) :][:1] in ("@", "$"):
        core += token[at + len(core)]
    return core


def canonical(text: str) -> str:
    """What all readings of a lattice share: letters by look-alike class, without separators and repetition."""
    return re.sub(r"(.)\1+", r"\1", "".join(filter(str.isalpha, text.translate(SAME))))


class Decoder:
    """Viterbi over lattices; states are the last two letters."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        uni = (c.sum((0, 1)) + 1) / (c.sum() + SYMBOLS)
        bi = (c.sum(0) + 5 * uni) / (c.sum((0, 2))[:, None] + 5)
        self.log = np.log((c + 5 * bi[None]) / (c.sum(2)[:, :, None] + 5)).astype(np.float32)

    @staticmethod
    def lattice(text: str) -> list[list[tuple[str, float]]]:
        """Positions with their readings: (letters, cost)."""
        out = []
        for m in re.finditer(r"(.)\1*", text, re.S):
            c, n = m[1], len(m[0])
            if c.isalpha():
                read = [(c, 0.0)] if n < 2 else [(c * 2, 0.0), (c, TWICE)] if n == 2 else [(c, REPEAT), (c * 2, REPEAT)] + ([(c * 3, 0.0)] if n == 3 else [])
            else:
                read = [(x * k, REPLACE - (0 if k == n else 1)) for x in LOOKALIKE.get(c, "") for k in {1, min(n, 2)}]
                if c in SEPARATORS or not read:
                    read.append(("", SEPARATE))
            out.append(read)
        return out

    def decode(self, text: str) -> str:
        """The likeliest word behind ``text`` (lower case), in time linear in its length."""
        beam = {(0, 0): (0.0, None)}  # state: (score, (what came before, letters))
        for readings in self.lattice(text):
            step: dict = {}
            for (a, b), (score, trail) in beam.items():
                for letters, cost in readings:
                    x, y, s = a, b, score + cost
                    for c in letters:
                        z = symbol(c)
                        s += self.log[x, y, z]
                        x, y = y, z
                    if (x, y) not in step or s > step[x, y][0]:
                        step[x, y] = (s, (trail, letters))
            beam = dict(sorted(step.items(), key=lambda kv: (-kv[1][0], kv[0]))[:BEAM])
        (a, b), (_, trail) = max(beam.items(), key=lambda kv: (kv[1][0] + self.log[kv[0][0], kv[0][1], 0], kv[0]))
        out = []
        while trail:
            trail, letters = trail
            out.append(letters)
        return "".join(reversed(out))


def suspicious(word: str) -> bool:
    if SUSPICIOUS.search(word) is None:
        return False
    return sum(map(str.isdigit, word)) <= max(2, len(word) // 2 + 1) or len(canonical(word)) <= SPELT_BY_DIGITS


def spelled(word: str) -> bool:
    """Whether separators stand between single letters, which may be repeated."""
    parts = [x for x in PARTS.split(word) if x]
    return len(parts) > 2 and all(len(set(x)) == 1 for x in parts)


def readings(token: str, decoder: Decoder, word_may, run_may) -> list[tuple[bool, str]]:
    """(whether it is a run of letters, text) for a token (lower case): the bare word, what it was restored to, and the
    same for the parts that separators leave. ``word_may`` and ``run_may`` tell from a text's canonical form whether its
    restored form can matter; what cannot is not decoded."""
    word = bare(token)
    out = [(False, word)] if word else []
    if word and (core := word.strip(EDGE)) != word:  # what stands at the edge may be a look-alike or not
        out += readings(core, decoder, word_may, run_may)
    if suspicious(word):
        form = canonical(word)
        if spelled(word):
            if run_may(form):
                out.append((True, decoder.decode(word)))
            return out
        if word_may(form) and (restored := decoder.decode(word)) != word:
            out.append((False, restored))
    if not ADDRESS.search(word):
        parts = [x for x in PARTS.split(word) if len(x) > 2]
        if parts and parts != [word]:
            out += [r for x in dict.fromkeys(parts) for r in readings(x, decoder, word_may, run_may)]
    return out


def plain_lower(text: str) -> str:
    return unicodedata.normalize("NFC", text).lower()


def distinct_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    codes, lengths, vocabulary = tokens(text)
    return codes, lengths, [plain_lower(t) for t in vocabulary.to_pylist()]


def trigram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character trigrams of all words of letters, edges included: (trigram, n)."""
    table = np.array([symbol(chr(i)) if chr(i).isalpha() else 0 for i in range(0x3000)], np.int64)
    total = np.zeros(SYMBOLS**3, np.int64)
    for rows in slices(batches):
        codes, _, vocabulary = tokens(rows["text"])
        if not len(codes):
            continue
        n = np.bincount(codes, minlength=len(vocabulary))
        core = pc.utf8_trim(pc.utf8_lower(vocabulary), EDGE)
        good = pc.match_substring_regex(core, r"^\p{L}+$").to_numpy(zero_copy_only=False)
        core, n = core.filter(pa.array(good)).to_pylist(), n[good]
        if not len(core):
            continue
        points = np.frombuffer(("\0\0".join(["", *core, ""])).encode("utf-32-le", "replace"), "<u4")
        s = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 27 + points % (SYMBOLS - 27)).astype(np.int64)
        s[points == 0] = 0
        tri = s[:-2] * SYMBOLS**2 + s[1:-1] * SYMBOLS + s[2:]
        # word i owns the trigrams that end in its letters or in the first edge after them
        owner = np.cumsum((points[1:-1] == 0) & (points[2:] != 0)) - 1
        own = (points[1:-1] != 0) | (points[2:] != 0)
        total += np.bincount(tri[own], weights=n[owner[own]], minlength=len(total)).astype(np.int64)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["trigram", "n"])


def learn_characters(docs: DataFrame) -> Decoder:
    """The character model of all documents; at most SYMBOLS**3 counts come to the driver."""
    got = docs.select("text").mapInArrow(trigram_counts, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**3)
    counts[got["trigram"].to_numpy(np.int64)] = got["n"]
    return Decoder(counts)


def spaced(codes: np.ndarray, lengths: np.ndarray, bares: list[str], least: int = 3) -> list[tuple[int, str]]:
    """(row, joined characters) of every run of at least ``least`` single-character tokens within a row."""
    single = np.array([len(w) == 1 for w in bares], bool)[codes] if len(codes) else np.zeros(0, bool)
    row = np.repeat(np.arange(len(lengths)), lengths)
    start = np.flatnonzero(single & ~(np.r_[False, single[:-1]] & np.r_[False, row[1:] == row[:-1]]))
    out = []
    for i in start.tolist():
        j = i
        while j < len(codes) and single[j] and row[j] == row[i]:
            j += 1
        if j - i >= least:
            out.append((int(row[i]), "".join(bares[c] for c in codes[i:j])))
    return out


def pieced(codes: np.ndarray, lengths: np.ndarray, bares: list[str], lexicon: Lexicon) -> list[tuple[int, str]]:
    """(row, joined tokens) where tokens that follow one another spell a long word of the lexicon, look-alikes counted as
    letters, and most of them are no words of documents with label 0."""
    if len(codes) < 2 or not lexicon.long:
        return []
    same = [w.translate(SAME) if len(w) < lexicon.longest else "" for w in bares]
    opens, inner = (np.array([w in known for w in same], bool) for known in (lexicon.openings, lexicon.pieces))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out = []
    for i in np.flatnonzero(opens[codes[:-1]] & inner[codes[1:]] & (row[:-1] == row[1:])).tolist():
        joined, strange, j = same[codes[i]], int(same[codes[i]] not in lexicon.ordinary), i + 1
        while j < len(codes) and row[j] == row[i] and inner[codes[j]] and len(joined) < lexicon.longest:
            joined, strange, j = joined + same[codes[j]], strange + (same[codes[j]] not in lexicon.ordinary), j + 1
            if joined in lexicon.long and 2 * strange > j - i:
                out.append((int(row[i]), "".join(bares[c] for c in codes[i:j])))
    return out


def each_row(text: pa.Array, decoder: Decoder, word_value, run_value, word_may=bool, run_may=bool, lexicon: Lexicon | None = None) -> list[tuple[int, object]]:
    """(row, value) for the words and the runs of letters of each row, plain and restored, where there is a value; with a
    lexicon also for its words that are split in pieces.

    Each distinct token of the piece is read once, each run where it stands.
    """
    codes, lengths, distinct = distinct_words(text)
    if not len(codes):
        return []
    worth = np.zeros(len(distinct), bool)
    got: list = [None] * len(distinct)
    bares = []
    for i, t in enumerate(distinct):
        bares.append(bare(t) or t)
        found = [v for run, w in readings(t, decoder, word_may, run_may) if (v := (run_value if run else word_value)(w))]
        if found:
            worth[i], got[i] = True, found
    row = np.repeat(np.arange(len(lengths)), lengths)
    hits = np.flatnonzero(worth[codes])
    pairs = np.unique(row[hits] * np.int64(len(distinct)) + codes[hits])
    out = [(int(p // len(distinct)), v) for p in pairs for v in got[int(p % len(distinct))]]
    for r, joined in spaced(codes, lengths, bares):
        if run_may(canonical(joined)) and (v := run_value(decoder.decode(joined))):
            out.append((r, v))
    for r, joined in pieced(codes, lengths, bares, lexicon) if lexicon else ():
        w = joined if joined in lexicon.whole else decoder.decode(joined)
        if w in lexicon.whole:
            out.append((r, word_value(w)))
    return out


def features_of(word: str, run: bool) -> list[str]:
    """A word and its beginnings; of a run of letters the whole, and the beginnings of what starts at each letter."""
    starts = range(len(word)) if run else (0,)
    return [word] + [word[i : i + k] + "-" for i in starts for k in BEGINNINGS if len(word) - i > k]


def least_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a MinHash of five-word shingles, equal for most near copies."""
    for rows in slices(batches):
        codes, lengths, vocabulary = tokens(rows["text"])
        word = mix64(hash_strings(vocabulary))
        out, at = np.zeros(len(lengths), np.uint64), 0
        for i, n in enumerate(lengths):
            h = word[codes[at : at + n]]
            at += n
            if n:
                k = max(n - 4, 1)
                acc = h[:k].copy()
                for j in range(1, min(n, 5)):
                    acc = mix64(acc ^ (h[j : j + k] * np.uint64(2 * j + 1)))
                out[i] = acc.min()
        yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["text"], rows["label"], pa.array(out.view(np.int64))], names=["doc_id", "text", "label", "low"])


READ = "label int, words array<string>, runs array<string>"


def read_rows(decoder: Decoder):
    """(label, distinct words, distinct runs of letters) of each document, restored where need be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            have: list[tuple[set, set]] = [(set(), set()) for _ in range(rows.num_rows)]
            for r, (is_run, w) in each_row(rows["text"], decoder, lambda w: (False, w), lambda w: (True, w)):
                have[r][is_run].add(w)
            columns = [pa.array([sorted(h[i]) for h in have], pa.list_(pa.string())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([rows["label"], *columns], names=["label", "words", "runs"])

    return run


def row_features(words: list[str], runs: list[str]) -> set[str]:
    return {f for is_run, ws in ((False, words), (True, runs)) for w in ws for f in features_of(w, is_run)}


def feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each label a feature occurs: (feature, pos, neg)."""
    for rows in batches:
        count: dict = {}
        for label, words, runs in zip(*(rows[c].to_pylist() for c in ("label", "words", "runs"))):
            for f in row_features(words, runs):
                count.setdefault(f, [0, 0])[int(label > 0)] += 1
        columns = [pa.array(list(count), pa.string())] + [pa.array([v[i] for v in count.values()], pa.int64()) for i in (1, 0)]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "pos", "neg"])


def feature_lists(wanted: dict):
    """Which of the wanted features each document has; within runs, wanted words are found wherever they stand."""
    known = Lexicon({f: 0.0 for f in wanted})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            have = []
            for words, runs in zip(rows["words"].to_pylist(), rows["runs"].to_pylist()):
                names = row_features(words, runs) | {word for r in runs for word in known.within(r)}
                have.append(sorted(wanted[f] for f in names if f in wanted))
            yield pa.RecordBatch.from_arrays([rows["label"], pa.array(have, pa.list_(pa.int64()))], names=["label", "have"])

    return run


def ordinary_pieces(features: dict[str, float]):
    """Which pieces of the lexicon's words are words of documents with label 0, look-alikes as letters."""
    lexicon = Lexicon(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            have = {w for label, words in zip(rows["label"].to_pylist(), rows["words"].to_pylist()) if not label > 0 for w in words if len(w) < lexicon.longest}
            same = {w.translate(SAME) for w in have}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(same & (lexicon.openings | lexicon.pieces)), pa.string())], names=["piece"])

    return run


class Lexicon:
    """Features with their precision, looked up in words and in runs of letters; ``ordinary`` are pieces that are words."""

    def __init__(self, features: dict[str, float], ordinary: Iterable[str] = ()):
        self.ordinary = frozenset(ordinary)
        self.whole = {f: p for f, p in features.items() if not f.endswith("-")}
        self.start = {f[:-1]: p for f, p in features.items() if f.endswith("-")}
        self.lengths = sorted({len(f) for f in self.whole if len(f) >= INSIDE})
        self.long = {f.translate(SAME) for f in self.whole if len(f) >= INSIDE}
        self.longest = max(map(len, self.long), default=0)
        self.openings = {f[:i] for f in self.long for i in range(1, len(f))}
        self.pieces = {f[i:j] for f in self.long for i in range(1, len(f)) for j in range(i + 1, len(f) + 1)}
        self.forms = {canonical(f) for f in self.whole}
        self.start_forms = {canonical(f) for f in self.start}
        self.inner_forms = {canonical(f) for f in self.whole if len(f) >= INSIDE} | self.start_forms
        self.start_form_lengths = sorted({len(f) for f in self.start_forms})
        self.inner_form_lengths = sorted({len(f) for f in self.inner_forms})

    def word_may(self, form: str) -> bool:
        """Whether a word of this canonical form can be in the lexicon or begin as one of its beginnings."""
        return form in self.forms or any(form[:k] in self.start_forms for k in self.start_form_lengths)

    def run_may(self, form: str) -> bool:
        return form in self.forms or any(form[i : i + k] in self.inner_forms for k in self.inner_form_lengths for i in range(len(form) - k + 1))

    def within(self, run: str) -> list[str]:
        """Words of the lexicon at any place of a run of letters."""
        return [run[i : i + k] for k in self.lengths for i in range(len(run) - k + 1) if run[i : i + k] in self.whole]

    def word(self, word: str) -> tuple | None:
        """(precision, word) by the best feature, or None."""
        p = max([self.whole.get(word, 0.0)] + [self.start.get(word[:k], 0.0) for k in BEGINNINGS if len(word) > k])
        return (p, word) if p else None

    def run(self, run: str) -> tuple | None:
        best = [x for x in (self.word(run),) if x] + [(self.whole[w], w) for w in self.within(run)]
        best += [(p, run[i : i + k]) for k in BEGINNINGS for i in range(1, len(run) - k) if (p := self.start.get(run[i : i + k], 0.0))]
        return max(best, default=None)


def learn_lexicon(sample: DataFrame, decoder: Decoder) -> tuple[dict[str, float], float, list[str]]:
    """({feature: precision}, rate of label 1 where no feature occurs, pieces of features that are words), from the
    labelled sample.

    Near copies count once. A feature must be precise, and either frequent among the documents of label 1 or needed to
    explain documents that better features leave unexplained; words that merely stand beside toxic ones are neither.
    """
    once = sample.mapInArrow(least_shingle, f"doc_id {type_of(sample, 'doc_id')}, text string, label int, low long")
    once = once.groupBy("low", "label").agg(F.min_by("text", F.struct("doc_id", "text")).alias("text")).select("text", "label")
    spread = once.repartition(4 * sample.sparkSession.sparkContext.defaultParallelism)
    once = materialise(spread.mapInArrow(read_rows(decoder), READ), "readings")
    n_pos = once.where("label > 0").count()
    counted = once.mapInArrow(feature_counts, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    good = counted.where((F.col("pos") >= LEAST_DOCUMENTS) & (F.col("pos") / (F.col("pos") + F.col("neg") + 1) >= PRECISION)).orderBy("feature").toPandas()
    names = good["feature"].tolist()
    precision = (good["pos"] / (good["pos"] + good["neg"] + 1)).to_numpy()
    lists = once.mapInArrow(feature_lists({f: i for i, f in enumerate(names)}), "label int, have array<long>").toPandas()
    positive = [set(h) for label, h in zip(lists["label"], lists["have"]) if label > 0]
    by_feature: dict[int, set] = {}
    for d, have in enumerate(positive):
        for f in have:
            by_feature.setdefault(f, set()).add(d)
    # a beginning must stand for more than one word, and for more than a longer beginning does
    best: dict[str, list] = {}
    for f, docs_with in by_feature.items():
        name = names[f]
        for k in BEGINNINGS:
            if len(name) > k and name != name[:k] + "-":
                best.setdefault(name[:k] + "-", []).append((len(docs_with), name.endswith("-")))
    for f in [f for f in by_feature if names[f].endswith("-")]:
        mine = len(by_feature[f])
        if any(n >= (0.95 if beginning else 0.7) * mine for n, beginning in best.get(names[f], [])):
            del by_feature[f]
    covered: set = set()
    kept = {}
    for f in sorted(by_feature, key=lambda f: (-len(by_feature[f]) * precision[f], names[f])):
        fresh = by_feature[f] - covered
        if len(by_feature[f]) >= max(LEAST_DOCUMENTS, 0.01 * n_pos) or len(fresh) >= max(LEAST_DOCUMENTS, 0.5 * len(by_feature[f])):
            kept[f] = precision[f]
            covered |= by_feature[f]
    without = [label > 0 for label, have in zip(lists["label"], lists["have"]) if not kept.keys() & set(have)]
    features = {names[f]: float(p) for f, p in kept.items()}
    pieces = once.mapInArrow(ordinary_pieces(features), "piece string").distinct().orderBy("piece").toPandas()
    return features, (sum(without) + 0.5) / (len(without) + 10), pieces["piece"].tolist()


def scorer(features: dict, rest: float, decoder: Decoder, ordinary: Iterable[str] = ()):
    lexicon = Lexicon(features, ordinary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            score, words = [rest] * rows.num_rows, [None] * rows.num_rows
            for r, (p, w) in each_row(rows["text"], decoder, lexicon.word, lexicon.run, lexicon.word_may, lexicon.run_may, lexicon):
                if (p, w) > (score[r] if words[r] else 0.0, words[r] or ""):
                    score[r], words[r] = p, w
            yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["held_out"], pa.array(score, pa.float64()), pa.array(words, pa.string())], names=["doc_id", "held_out", "score", "worst"])

    return run


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3, sample: int = SAMPLE
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), worst (the restored word that decided, or null), predicted.

    ``learn`` is a Column over doc_id: labels are learnt where it holds, from ``sample`` of them at most; held_out is
    its opposite. Character counts come from all documents. Null and empty texts have no words and get the rate of
    documents without lexicon words; so does everything when there are no labels. Repeated rows get the same score; ids may
    be of any type and null. An empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    decoder = learn_characters(source)
    lexicon, rest, ordinary = learn_lexicon(labelled_sample(docs, labels, label, learn, doc_id, text, sample), decoder)
    rows = source.select("doc_id", (~F.coalesce(learn, F.lit(False))).alias("held_out"), "text")
    scored = rows.mapInArrow(scorer(lexicon, rest, decoder, ordinary), f"doc_id {type_of(source, 'doc_id')}, held_out boolean, score double, worst string")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
