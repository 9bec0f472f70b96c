"""Mixing sources to target weights by iterative proportional fitting (DataFrame functions only).

Documents are summed to cells (source, language, topic) of tokens. The targets are shares of the sample's tokens; they hold,
and the size of the sample yields: at most ``keep_share`` of all tokens, and no more than a value can give at its target.
Raking scales the cells until the tokens expected of every value are its target's share of the size, cells being held to their
real tokens. As the three marginals together may allow less, many sizes are raked side by side, and the largest that
meets the targets within ``TOLERANCE`` is taken. Where none does, as with targets that contradict one another, that is an error, or the size that
comes nearest with its error in the result. A document is kept with the probability of its cell, by a hash of its id, so a re-run
chooses the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Rounds of raking over the three marginals.
ROUNDS = 16
#: Sizes that are tried, as parts of the largest that every value by itself allows.
LEVELS = tuple(round(0.9**k, 6) for k in range(32))
#: Difference of a share from its target, at most.
TOLERANCE = 0.002
#: How far the default targets raise a value above its present share, before all are scaled to add up.
BOOST = 1.5
#: Cells at all sizes that are raked in one task, and cells whose probabilities are broadcast; more are shuffled.
FEW = 200_000
DIMENSIONS = ("source", "lang", "topic")
ADDED = ("mix_topic", "mix_tokens", "mix_p", "mix_size", "mix_error")
NONE = "(none)"


def count_tokens(text: Column) -> Column:
    """Whitespace tokens; null and empty texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x09-\x0D\x20]+")).cast("long")


def genre(text: Column, tokens: Column) -> Column:
    """A stand-in topic for tables without one, from a text's form: figures (a tenth of the characters are digits), list
    (three lines or more of fewer than 12 tokens on average), or by length note, article and long."""
    t = F.coalesce(text, F.lit(""))
    lines = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(F.regexp_count(t, F.lit("[0-9]")) * 10 >= F.length(t), "figures")
        .when((lines >= 3) & (tokens < lines * 12), "list")
        .when(tokens < 60, "note")
        .when(tokens < 400, "article")
        .otherwise("long")
    )


def root_targets(cells: DataFrame, boost: float = BOOST) -> DataFrame:
    """(dimension, value, share): shares in proportion to the square root of each value's tokens, but none in proportion to
    more than ``boost`` times its tokens, so that rare values do not set the size of the sample."""
    parts = [cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("t")).select(F.lit(d).alias("dimension"), "value", "t") for d in DIMENSIONS]
    union = materialise(parts[0].unionByName(parts[1]).unionByName(parts[2]), "roots")
    total = union.groupBy("dimension").agg(F.sum("t").alias("all"), F.sum(F.sqrt("t")).alias("roots"))  # a row a dimension
    share = F.least(F.sqrt("t") / F.col("roots"), F.col("t") * boost / F.col("all"))
    held = materialise(union.join(F.broadcast(total), "dimension").select("dimension", "value", share.alias("share")), "held")
    sums = held.groupBy("dimension").agg(F.sum("share").alias("sum"))  # a row a dimension
    return held.join(F.broadcast(sums), "dimension").select("dimension", "value", (F.col("share") / F.col("sum")).alias("share"))


def goals(cells: DataFrame, targets: DataFrame, keep_share: float) -> DataFrame:
    """(dimension, value, share, keep): each occurring value's target, as a share of those of its marginal that occur, and the
    share of all tokens that the sample may have so that no value gives more than it has."""
    has = None
    for d in DIMENSIONS:
        own = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("has")).select(F.lit(d).alias("dimension"), "value", "has")
        has = own if has is None else has.unionAll(own)
    values = materialise(has.join(targets.groupBy("dimension", "value").agg(F.sum("share").alias("to")).where(F.col("to") > 0), ["dimension", "value"]), "values")
    total = values.groupBy("dimension").agg(F.sum("to").alias("total"))  # a row a dimension
    grand = cells.agg(F.sum("tokens").alias("grand"))  # one row
    values = values.join(F.broadcast(total), "dimension").withColumn("share", F.col("to") / F.col("total"))
    keep = values.join(F.broadcast(grand)).agg(F.least(F.lit(float(keep_share)), F.min(F.col("has") / F.col("grand") / F.col("share"))).alias("keep"))
    return values.join(F.broadcast(keep)).select("dimension", "value", "share", "keep")


def with_goals(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """Cells for every size, with keep (the size as a share of all tokens), goal_<dimension> and weight, the tokens given so far."""
    grand = cells.agg(F.sum("tokens").alias("grand"))  # one row
    keep = wanted.agg(F.max("keep").alias("keep"))  # one row
    out = cells.select(*DIMENSIONS, "tokens").join(F.broadcast(grand)).join(F.broadcast(keep))
    out = out.withColumn("level", F.explode(F.array(*[F.lit(x) for x in LEVELS]))).withColumn("keep", F.col("level") * F.col("keep"))
    for d in DIMENSIONS:
        own = wanted.where(F.col("dimension") == d).select(F.col("value").alias(d), F.col("share").alias(f"share_{d}"))
        out = out.join(own, d, "left").withColumn(f"goal_{d}", F.coalesce(f"share_{d}", F.lit(0.0)) * F.col("keep") * F.col("grand"))
    return out.select(*KEPT, (F.col("tokens") * F.col("keep")).alias("weight"))


KEPT = [*DIMENSIONS, "tokens", "level", "keep", *[f"goal_{d}" for d in DIMENSIONS]]


def scaled(d: str, now: Column) -> Column:
    weight = F.least(F.col("tokens").cast("double"), F.col("weight") * (F.col(f"goal_{d}") / now))
    return F.when(now > 0, weight).otherwise(0.0).alias("weight")


def raking(cells: DataFrame, rounds: int, few: bool) -> DataFrame:
    """The cells after ``rounds`` of scaling to each marginal in turn.

    Few cells are one partition, where the totals of a marginal need no shuffle, and four rounds are a job. Of many, totals are
    summed before they are shuffled and joined back, so a value with very many cells takes no task of its own; each step is a table, for small plans.
    """
    steps = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            if few:
                cells = (cells if steps else cells.coalesce(1)).select(*KEPT, scaled(d, F.sum("weight").over(Window.partitionBy("level", d))))
            else:
                now = cells.groupBy("level", d).agg(F.sum("weight").alias("now"))
                cells = materialise(cells.join(now, ["level", d]).select(*KEPT, scaled(d, F.col("now"))), "cells")
        steps += 1
        if few and steps % 4 == 0:
            cells, steps = materialise(cells, "cells"), 0
    return cells


def rake(cells: DataFrame, targets: DataFrame, keep_share: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, tokens, keep, weight, error, worst): the tokens that each cell is to give at the size that is taken;
    error: the largest difference of a value's share from its target, and worst: that value as ``dimension=value``."""
    wanted = materialise(goals(cells, targets, keep_share), "goals")
    cells = materialise(with_goals(cells, wanted), "cells")
    few = cells.count() <= FEW
    cells = raking(cells, rounds, few)
    errors = None
    for d in DIMENSIONS:
        own = cells.groupBy("level", d).agg(F.sum("weight").alias("w"), F.first(f"goal_{d}").alias("goal"), F.first("keep").alias("keep"))
        own = own.select("level", F.concat(F.lit(f"{d}="), F.col(d)).alias("value"), F.abs(F.col("w") - F.col("goal")).alias("off"), "w")
        own = own.groupBy("level").agg(F.max(F.struct("off", "value")).alias("m"), F.sum("w").alias("size"))
        errors = own if errors is None else errors.unionAll(own)
    worst = errors.groupBy("level").agg(F.max(F.struct((F.col("m.off") / F.col("size")).alias("error"), F.col("m.value").alias("worst"))).alias("e"))
    worst = worst.select("level", F.round("e.error", 6).alias("error"), "e.worst")
    # a target for a value that has no tokens is missed by all of it
    missing = targets.where("share > 0").join(wanted, ["dimension", "value"], "left_anti").agg(F.max(F.struct("share", F.concat_ws("=", "dimension", "value").alias("name"))).alias("m"))
    gap = F.coalesce("m.share", F.lit(0.0))
    taken = worst.orderBy(F.greatest("error", F.lit(TOLERANCE)), F.desc("level")).limit(1)
    taken = taken.join(F.broadcast(missing)).select("level", F.greatest("error", gap).alias("error"), F.when(gap > F.col("error"), F.col("m.name")).otherwise(F.col("worst")).alias("worst"))
    return cells.join(F.broadcast(materialise(taken, "taken")), "level").select(*DIMENSIONS, "tokens", "keep", "weight", "error", "worst")


def mix(
    docs: DataFrame, topic: Column | None = None, targets=root_targets, keep_share: float = 0.5, strict: bool = True, seed: str = "mix", rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang"
) -> DataFrame:
    """``docs`` sampled to target weights, with columns mix_topic, mix_tokens, mix_p, mix_size and mix_error added.

    ``targets`` is a function from the cells to (dimension, value, share); ``topic`` a Column of docs, ``genre`` by default.
    mix_p is the probability by which the row was kept: what its cell gives over what it has. mix_size is the share of all tokens
    that the sample is expected to hold, mix_error the largest difference of a value's expected share from its target. With ``strict``
    targets that cannot be met within TOLERANCE at any size are an error that names the value; otherwise they are come as
    near to as can be. Null sources, languages and topics are a value of their own, "(none)"; values without a target give
    nothing. Documents without tokens carry no weight and are kept with the probability of the whole (``keep_share`` if nothing has
    tokens). A null id hashes as an empty one; rows repeated under one id and cell are kept or dropped together. An empty
    table gives an empty one. Columns of docs that have the name of an added one are replaced by it, all others are kept.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    name = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    tokens = count_tokens(F.col(text))
    # the row is one column here, so that no name of its own can clash
    # the row is one column here, so that no name of its own can clash; tokens are counted below what uses them
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("string").alias("id"), name(F.col(source)).alias("source"), name(F.col(lang)).alias("lang"), tokens.alias("mix_tokens"), *([] if topic is None else [name(topic).alias("mix_topic")]))
    rows = rows.select("row", "id", "source", "lang", (name(genre(F.col(f"row.`{text}`"), F.col("mix_tokens"))) if topic is None else F.col("mix_topic")).alias("mix_topic"), "mix_tokens")
    cells = rows.groupBy("source", "lang", F.col("mix_topic").alias("topic")).agg(F.sum("mix_tokens").alias("tokens"))
    cells = materialise(cells.where("tokens > 0"), "cells")
    raked = materialise(rake(cells, materialise(targets(cells), "targets"), keep_share, rounds), "raked")
    missed = raked.select("error", "worst").first()
    if strict and missed and missed.error > TOLERANCE:
        raise ValueError(f"the targets cannot be met together: the share of {missed.worst} would be off by {missed.error:.4f}")
    given = raked.select("source", "lang", F.col("topic").alias("mix_topic"), (F.col("weight") / F.col("tokens")).alias("share"))
    u = F.conv(F.substring(F.md5(F.concat(F.coalesce("id", F.lit("")), F.lit(":" + seed))), 1, 8), 16, 10).cast("double") / 4294967296.0
    whole = raked.agg(F.coalesce(F.first("keep"), F.lit(float(keep_share))).alias("mix_size"), F.coalesce(F.first("error"), F.lit(0.0)).alias("mix_error"))
    if raked.count() <= FEW:
        joined = rows.join(F.broadcast(given), ["source", "lang", "mix_topic"], "left")
    else:
        # a hot cell holds many documents and the other side one row: salted, so that no task gets a whole cell
        salt = 64
        given = given.select("*", F.explode(F.expr(f"sequence(0L, {salt - 1}L)")).alias("salt"))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salt).cast("long")))
        joined = rows.join(given, ["source", "lang", "mix_topic", "salt"], "left")
    p = F.when(F.col("mix_tokens") > 0, F.coalesce("share", F.lit(0.0))).otherwise(F.col("mix_size"))
    return joined.join(F.broadcast(whole)).withColumn("mix_p", p).where(u < F.col("mix_p")).select("row.*", *ADDED)


def oracle_sql(rounds: int = ROUNDS, keep_share: float = 0.5, seed: str = "mix") -> str:
    """The query's rows in SQL, raking unrolled."""
    steps, at = [], "c0"
    for _ in range(rounds):
        for d in DIMENSIONS:
            new = f"c{len(steps) + 1}"
            steps.append(f"{new} AS (SELECT * REPLACE (least(tokens, weight * (goal_{d} / sum(weight) OVER (PARTITION BY level, {d}))) AS weight) FROM {at})")
            at = new
    token = r"'[^\x09-\x0D\x20]+'"
    one = lambda d: f"SELECT '{d}' AS dimension, {d} AS value, sum(tokens) AS has, least(sqrt(sum(tokens)) / sum(sqrt(sum(tokens))) OVER (), sum(tokens) * {BOOST} / sum(sum(tokens)) OVER ()) AS s FROM cell GROUP BY {d}"
    has = " UNION ALL ".join(f"SELECT dimension, value, has, s / sum(s) OVER () AS share FROM ({one(d)})" for d in DIMENSIONS)
    joins = " ".join(f"JOIN (SELECT value AS {d}, share AS share_{d} FROM goals WHERE dimension = '{d}') USING ({d})" for d in DIMENSIONS)
    given = ", ".join(f"share_{d} * keep * grand AS goal_{d}" for d in DIMENSIONS)
    errors = " UNION ALL ".join(f"SELECT level, max(off) / sum(w) AS error FROM (SELECT level, {d}, abs(sum(weight) - any_value(goal_{d})) AS off, sum(weight) AS w FROM {at} GROUP BY level, {d}) GROUP BY level" for d in DIMENSIONS)
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, coalesce(text, '') AS t,
    CAST(len(regexp_extract_all(coalesce(text, ''), {token})) AS BIGINT) AS tokens,
    length(coalesce(text, '')) - length(translate(coalesce(text, ''), chr(10), '')) + 1 AS lines
  FROM documents),
r AS (
  SELECT doc_id, source, lang, tokens, CASE
    WHEN (length(t) - length(translate(t, '0123456789', ''))) * 10 >= length(t) THEN 'figures'
    WHEN lines >= 3 AND tokens < lines * 12 THEN 'list' WHEN tokens < 60 THEN 'note' WHEN tokens < 400 THEN 'article' ELSE 'long' END AS topic
  FROM t),
cell AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM r GROUP BY ALL HAVING sum(tokens) > 0),
levels AS (SELECT unnest([{", ".join(f"{x}::DOUBLE" for x in LEVELS)}]) AS level),
goals AS ({has}),
size AS (SELECT least({keep_share}, min(has / (SELECT sum(tokens) FROM cell) / share)) AS most, (SELECT sum(tokens) FROM cell) AS grand FROM goals),
c0 AS (SELECT source, lang, topic, CAST(tokens AS DOUBLE) AS tokens, level, level * most AS keep, {given}, tokens * (level * most) AS weight FROM (SELECT * FROM cell, levels, size) {joins}),
{", ".join(steps)},
worst AS (SELECT level, round(max(error), 6) AS error FROM ({errors}) GROUP BY level),
taken AS (SELECT level FROM worst ORDER BY greatest(error, {TOLERANCE}), level DESC LIMIT 1),
z AS (SELECT source, lang, topic, weight / tokens AS share, keep FROM {at} WHERE level = (SELECT level FROM taken)),
w AS (SELECT coalesce(any_value(keep), {keep_share}) AS keep, coalesce((SELECT error FROM worst WHERE level = (SELECT level FROM taken)), 0) AS error FROM z),
p AS (
  SELECT r.doc_id, r.source, r.lang, r.topic AS mix_topic, r.tokens AS mix_tokens,
    CASE WHEN r.tokens > 0 THEN share ELSE w.keep END AS p, w.keep AS size, w.error,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}'), 1, 8) AS BIGINT) / 4294967296.0 AS u
  FROM r LEFT JOIN z USING (source, lang, topic) CROSS JOIN w)
SELECT doc_id, source, lang, mix_topic, mix_tokens, round(p, 6) AS mix_p, round(size, 6) AS mix_size, round(error, 4) AS mix_error FROM p WHERE u < p
"""
