"""Benchmark decontamination by a prefix-filtered containment join (DataFrame functions only).

A window is ``width`` consecutive words of a benchmark item; an item with fewer words, but not none, is one window.
Exact containment asks for all words of a window, so the necessary prefix of a window under the rarity order is its
single rarest word: a document that holds the window holds that word. The steps are

1. count in how many documents each benchmark word occurs (rarity);
2. index every window under its rarest word, with the word's offset in the window;
3. join the documents' words with that index; the offset fixes where the window would start, the positional bound
   drops starts before the first word and the length bound ends after the last;
4. compare the words of the span with the window, one by one, over spans of the window's own size.

No document is compared with an item with which it shares no rare word, and no candidate pair is kept that fails. An index
of a checked size is broadcast. A larger one is met by a shuffle: hashes of the rarest words, broadcast in blocks of a
fixed size, leave only those places of a document that may begin a match; each travels with the words around it that a
window can span, salted, since a rarest word may still be frequent. Texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise

#: Everything that separates words; A-Z are letters here, and lower-cased afterwards.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The index is broadcast up to so many windows; a larger one is joined by a shuffle.
BROADCAST_WINDOWS = 200_000
#: Hashes of rarest words that are broadcast at once, 16 bytes or so each.
BLOCK_WORDS = 1_000_000
SALTS = 16


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after lower-casing A-Z; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def count_words(text: Column) -> Column:
    """size(words(text)) without lower-casing."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")).cast("long")


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = 13) -> DataFrame:
    """Distinct windows: (window array<string>, n int, items array of item ids as strings)."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))
    return (
        w.select("item", "w", F.explode(starts).alias("s"))
        .select("item", F.slice("w", F.col("s") + 1, width).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("n", F.size("window"))
    )


def rarity(docs: DataFrame, vocabulary: DataFrame, small: bool, text: str = "text") -> DataFrame:
    """In how many documents each word of ``vocabulary`` (column ``word``) occurs: (word, df). Absent words: 0."""
    seen = docs.select(F.explode(F.array_distinct(words(F.col(text)))).alias("word"))
    if small:
        vocabulary = F.broadcast(vocabulary)
        seen = seen.join(vocabulary, "word", "left_semi")
    counted = seen.groupBy("word").agg(F.count("*").alias("df"))  # a row a word and task, before any shuffle
    return vocabulary.join(counted, "word", "left").select("word", F.coalesce("df", F.lit(0)).alias("df"))


def prefix_index(wins: DataFrame, frequency: DataFrame) -> DataFrame:
    """Each window under its rarest word (ties: the smaller word): (word, offset, n, window, items)."""
    each = wins.select("window", F.posexplode("window").alias("offset", "word")).join(frequency, "word")
    rarest = each.groupBy("window").agg(F.min(F.struct("df", "word", "offset")).alias("r"))
    return wins.join(rarest, "window").select("r.word", "r.offset", "n", "window", "items")


def near_prefixes(spread: DataFrame, index: DataFrame, key: tuple, width: int) -> DataFrame:
    """The places of ``spread`` whose word is some window's rarest: key columns, _p, word, _n (words of the document), _c
    (the words that a window there can span), _lo (where these start)."""
    prefix = materialise(index.select(F.xxhash64("word").alias("_x")).distinct(), "prefix-words")
    blocks = max(1, -(-prefix.count() // BLOCK_WORDS))
    parts = []
    for b in range(blocks):
        some = F.broadcast(prefix.where(F.pmod("_x", F.lit(blocks)) == b))
        at = spread.join(some, F.xxhash64("word") == F.col("_x"), "left_semi")
        lo = F.greatest(F.col("_p") - (width - 1), F.lit(0))
        parts.append(at.select(*key, "_p", "word", F.size("_w").alias("_n"), F.slice("_w", lo + 1, 2 * width - 1).alias("_c"), lo.alias("_lo")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def find_windows(docs: DataFrame, index: DataFrame, small: bool, text: str = "text", key: tuple = ("doc_id",), width: int = 13) -> DataFrame:
    """Every occurrence of a window: key columns, start (0-based word), n, items."""
    spread = docs.select(*key, words(F.col(text)).alias("_w")).select(*key, "_w", F.posexplode("_w").alias("_p", "word"))
    start, n = F.col("_p") - F.col("offset"), F.col("n")
    if small:
        hits = spread.join(F.broadcast(index), "word").withColumns({"_n": F.size("_w"), "_c": F.col("_w"), "_lo": F.lit(0)})
    else:
        salt = F.pmod(F.xxhash64(*key, "_p"), F.lit(SALTS).cast("long"))
        salted = index.select("*", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("_k"))
        hits = near_prefixes(spread, index, key, width).withColumn("_k", salt).join(salted, ["word", "_k"])
    return (
        hits.where((start >= 0) & (start + n <= F.col("_n")))
        .where(F.slice("_c", start - F.col("_lo") + 1, n) == F.col("window"))
        .select(*key, start.alias("start"), "n", "items")
    )


def covered(spans: Column) -> Column:
    """How many words lie in at least one of the spans, an array of struct(start, n): one sweep in start order."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def step(acc, s):
        end = s["start"] + s["n"]
        fresh = F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["total"] + fresh).alias("total"))

    return F.aggregate(F.array_sort(spans), zero, step)["total"].cast("long")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 13,
    share: int = 20,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids (array), items_sha256, contaminated.

    n_hit counts the document's words inside any occurrence of a window; n_items the items with such windows;
    contaminated: n_hit > 0 and share * n_hit >= n_words. Null and empty texts have no words and are clean; null and
    empty items have no windows; an empty benchmark leaves every document clean. Null ids are kept: a null document id
    as null, a null item id as no item (its windows still hit). Ids may be of any type. Repeated rows each get the same
    result, which depends on the text alone; other columns of the inputs are ignored.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    wins = materialise(windows(items, item_id, item_text, width), "windows")
    vocabulary = wins.select(F.explode("window").alias("word")).distinct()
    small = wins.count() <= BROADCAST_WINDOWS
    index = materialise(prefix_index(wins, rarity(d, vocabulary, small, "_t")), "prefix")

    key = d.select("doc_id", F.xxhash64("_t").alias("_h"), F.length("_t").alias("_l"), "_t")
    hits = find_windows(key, index, small, "_t", ("doc_id", "_h", "_l"), width)
    found = hits.groupBy("doc_id", "_h", "_l").agg(
        F.collect_set(F.struct("start", "n")).alias("_s"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_i")
    )
    found = found.select(F.col("doc_id").alias("_d"), F.col("_h").alias("_h2"), F.col("_l").alias("_l2"), covered(F.col("_s")).alias("_n"), "_i")
    every = key.select("doc_id", "_h", "_l", count_words(F.col("_t")).alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_h2")) & (F.col("_l") == F.col("_l2"))
    ids = F.coalesce("_i", F.array().cast("array<string>"))
    n_hit = F.coalesce("_n", F.lit(0).cast("long"))
    return every.join(found, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        ids.alias("item_ids"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


#: The contract's digest in SQL, by another way: windows hashed as strings over all document positions.
SQL = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item, array_to_string(w[s + 1 : s + 13], ' ') AS win, len(w[s + 1 : s + 13]) AS n
  FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS s FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
size AS (SELECT DISTINCT n FROM win),
pos AS (SELECT rid, w, unnest(range(0, len(w))) AS p FROM doc),
hit AS (
  SELECT pos.rid, pos.p, win.n, win.item
  FROM pos, size, win
  WHERE pos.p + size.n <= len(pos.w) AND win.n = size.n AND win.win = array_to_string(pos.w[p + 1 : p + size.n], ' ')),
cov AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hit) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY rid)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
