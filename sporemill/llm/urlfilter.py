"""URL filters by a temporal list join.

A list is a log of dated changes: an entry (a host, a domain with its subdomains, or a URL prefix) is added or removed.
Changes become validity intervals; a capture is blocked if an entry that matches its URL was active when it was fetched.
Matching is by equality: a capture has one key for its host, one for each domain above it, and one for each leading
part of its path, so the as-of join is an equi-join with a time range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A hot host's captures are spread over so many join keys.
SALTS = 16
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]+(/[^?#]*)"


def host(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, change, at) to validity intervals (list, kind, pattern, valid_from, valid_to).

    ``change`` is "add" or "remove". An entry is active from an add until its next remove; repeated adds and removes
    change nothing, and of changes at one time the remove is the last. valid_to is null while the entry is active.
    """
    of = Window.partitionBy("list", "kind", "pattern").orderBy("at", "change")
    seen = entries.where("pattern is not null and at is not null and change in ('add', 'remove')").select("list", "kind", F.lower("pattern").alias("pattern"), "change", "at").distinct()
    turns = seen.withColumn("before", F.lag("change", 1, "remove").over(of)).where("change <> before").withColumn("until", F.lead("at").over(of))
    return turns.where("change = 'add' and (until is null or until > at)").select("list", "kind", "pattern", F.col("at").alias("valid_from"), F.col("until").alias("valid_to"))


def keys(url: Column, deepest: Column) -> Column:
    """What a capture can match: array of struct(kind, pattern). ``deepest`` is the number of parts of the longest prefix on
    the list; longer ones are not built."""
    h, path = host(url), F.lower(F.regexp_extract(url, PATH, 1))
    labels, parts = F.split(h, r"\."), F.split(F.regexp_replace(path, "/+$", ""), "/")
    one = lambda kind, p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: one("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.transform(F.slice(F.sequence(F.lit(1), F.size(parts)), F.lit(1), deepest), lambda i: one("prefix", F.concat(h, F.array_join(F.slice(parts, 1, i), "/"))))
    return F.when(h != "", F.array_distinct(F.concat(F.array(one("host", h)), domains, prefixes))).otherwise(F.array().cast("array<struct<kind:string,pattern:string>>"))


def filter_urls(captures: DataFrame, entries: DataFrame, capture_id: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Per row of ``captures``: its id, host, fetched, n_entries (active entries that match), lists (sorted), blocked.

    Null and malformed URLs match nothing, nor do captures without a fetch time; their host is "". Entries with a null
    pattern or time are ignored. Repeated captures each get a row; a null id is kept. An empty list blocks nothing, an
    empty table of captures gives no rows; other columns are ignored. Host and path are compared without regard to case.
    """
    spans = intervals(entries)
    deepest = spans.where("kind = 'prefix'").agg(F.coalesce(F.max(F.size(F.split("pattern", "/"))), F.lit(0)).alias("deepest"))  # one row
    rows = captures.select(F.col(capture_id).alias("_id"), F.coalesce(F.col(url), F.lit("")).alias("_u"), F.col(fetched).alias("_f"))
    salt = F.pmod(F.xxhash64("_id", "_u"), F.lit(SALTS).cast("long"))
    look = rows.join(F.broadcast(deepest)).select("_id", "_u", "_f", salt.alias("salt"), F.explode(keys(F.col("_u"), F.col("deepest"))).alias("k")).select("_id", "_u", "_f", "salt", "k.kind", "k.pattern").distinct()
    active = spans.select("list", F.col("kind"), "pattern", "valid_from", "valid_to", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    at = (F.col("_f") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_f") < F.col("valid_to")))
    hits = look.join(active, ["kind", "pattern", "salt"]).where(at)
    hits = hits.groupBy(F.col("_id").alias("_i"), F.col("_u").alias("_v"), F.col("_f").alias("_g")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("list")).alias("l"))
    on = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_u") == F.col("_v")) & (F.col("_f") == F.col("_g"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return rows.join(hits, on, "left").select(
        F.col("_id").alias(capture_id), host(F.col("_u")).alias("host"), F.col("_f").alias(fetched), n.alias("n_entries"), F.concat_ws(",", "l").alias("lists"), (n > 0).alias("blocked")
    )


START, MINUTES = "2024-01-01 00:00:00", 43200


def number(c: Column, mod: int) -> Column:
    """A number from a hash of text, the same in other engines."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % mod


def minute(n: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(START)) + n * 60)


def fetch_times(pages: DataFrame) -> DataFrame:
    """Captures of the pages table, which has no fetch time: a minute of January 2024 from a hash of the id."""
    return pages.select("page_id", "url", minute(number(F.concat(F.lit("fetch:"), F.col("page_id").cast("string")), MINUTES)).alias("fetched"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list from the pages' own hosts, as the tables have none: a third of the hosts and of their parent domains
    are added at some minute, half of these are removed later; a third of the first path parts are added as prefixes."""
    h = host(F.col("url"))
    hosts = pages.select(h.alias("h"), F.lower(F.regexp_extract("url", PATH, 1)).alias("path")).where("h <> ''")
    names = hosts.select(F.lit("hosts").alias("list"), F.lit("host").alias("kind"), F.col("h").alias("pattern"))
    domains = hosts.select(F.lit("domains").alias("list"), F.lit("domain").alias("kind"), F.expr("substring_index(h, '.', -3)").alias("pattern"))
    prefixes = hosts.select(F.lit("paths").alias("list"), F.lit("prefix").alias("kind"), F.concat("h", F.lit("/"), F.element_at(F.split("path", "/"), 2)).alias("pattern")).where("pattern is not null")
    named = names.union(domains).union(prefixes).distinct()
    chosen = named.withColumn("id", F.concat_ws(":", "list", "pattern")).where(number(F.col("id"), 3) == 0)
    first, length = number(F.concat(F.lit("a:"), F.col("id")), MINUTES // 2), number(F.concat(F.lit("r:"), F.col("id")), MINUTES // 2)
    adds = chosen.select("list", "kind", "pattern", F.lit("add").alias("change"), minute(first).alias("at"))
    removes = chosen.where(number(F.concat(F.lit("x:"), F.col("id")), 2) == 0).select("list", "kind", "pattern", F.lit("remove").alias("change"), minute(first + 1 + length).alias("at"))
    return adds.union(removes)


def oracle_sql() -> str:
    num = lambda c, m: f"CAST('0x' || substr(md5({c}), 1, 8) AS BIGINT) % {m}"
    minute_ = lambda n: f"TIMESTAMP '{START}' + to_minutes({n})"
    half = MINUTES // 2
    return rf"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS h,
    lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/[^?#]*)', 1)) AS path,
    {minute_(num("'fetch:' || CAST(page_id AS VARCHAR)", MINUTES))} AS fetched
  FROM pages),
named AS (
  SELECT DISTINCT 'hosts' AS list, 'host' AS kind, h AS pattern FROM p WHERE h <> ''
  UNION SELECT 'domains', 'domain', array_to_string(string_split(h, '.')[-3:], '.') FROM p WHERE h <> ''
  UNION SELECT 'paths', 'prefix', h || '/' || string_split(path, '/')[2] FROM p WHERE h <> '' AND len(string_split(path, '/')) >= 2),
chosen AS (SELECT *, list || ':' || pattern AS id FROM named WHERE {num("list || ':' || pattern", 3)} = 0),
timed AS (SELECT *, {num("'a:' || id", half)} AS a, {num("'r:' || id", half)} AS r, {num("'x:' || id", 2)} AS x FROM chosen),
spans AS (SELECT list, kind, pattern, {minute_("a")} AS f, CASE WHEN x = 0 THEN {minute_("a + 1 + r")} END AS t FROM timed),
hit AS (
  SELECT p.page_id, spans.list FROM p JOIN spans
  ON (kind = 'host' AND pattern = h OR kind = 'domain' AND (pattern = h OR ends_with(h, '.' || pattern))
    OR kind = 'prefix' AND (starts_with(h || path || '/', pattern || '/')))
  WHERE fetched >= f AND (t IS NULL OR fetched < t)),
n AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM hit GROUP BY page_id)
SELECT page_id, h AS host, fetched, coalesce(n, 0) AS n_entries, coalesce(lists, '') AS lists, coalesce(n, 0) > 0 AS blocked
FROM p LEFT JOIN n USING (page_id)
"""
