"""URL filters: dated list entries as validity intervals, joined as of each capture's fetch date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: A name of more characters or labels is no host name.
HOST_CHARS, HOST_LABELS = 253, 127


def host_of(url: Column) -> Column:
    """The host of an absolute URL in lower case, without user, port and dots at the end; empty for anything else, names of more than 253 characters or 127 labels included."""
    host = F.rtrim(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1), F.lit("."))
    short = F.when(F.length(host) <= HOST_CHARS, host)
    return F.coalesce(F.when(F.size(F.split(short, r"\.")) <= HOST_LABELS, short), F.lit(""))


def host_keys(host: Column) -> Column:
    """The host and its parent domains of two labels or more; a host of one label is its own key."""
    parts = F.reverse(F.split(host, r"\."))
    deep = F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda n: F.array_join(F.reverse(F.slice(parts, 1, n)), "."))
    return F.when(host == "", F.array().cast("array<string>")).when(F.size(parts) < 2, F.array(host)).otherwise(deep)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(key, category, dated date, action 'add' | 'remove')`` -> ``(key, category, valid_from, valid_to)``.

    An entry is active from the day it is added to the day before it is removed
    (``valid_to``, null: still active). On one day a removal outweighs an addition.
    Repeated additions, repeated removals and removals of what is not listed change
    nothing; rows with a null or an unknown action are ignored.
    """
    known = entries.where(F.col("key").isNotNull() & F.col("category").isNotNull() & F.col("dated").isNotNull() & F.col("action").isin("add", "remove"))
    daily = known.groupBy("key", "category", "dated").agg(F.max(F.col("action") == "remove").alias("off"))
    own = Window.partitionBy("key", "category").orderBy("dated")
    turns = daily.withColumn("was_off", F.coalesce(F.lag("off").over(own), F.lit(True))).where("off <> was_off")
    return turns.withColumn("valid_to", F.lead("dated").over(own)).where("NOT off").select("key", "category", F.col("dated").alias("valid_from"), "valid_to")


def active_entries(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """``(url, fetched_on, ...)`` plus ``host``, ``n_entries`` and ``categories`` (comma-joined, in order): entries active at fetch time for the host or a parent of it.

    Days on which a key is asked for stand among the days on which its entries begin and
    end, each once, however many captures ask; a running sum gives how many are active as
    of each. So a key has at most as many rows as there are days, and a host with a third of all captures
    is one row a day. Null or unusual URLs, and those whose host is too long to be one (``host_of``), have an empty host, and with a null day, no entries;
    repeated captures stay; empty tables give no rows or no entries. Columns of those names are replaced.
    """
    given = captures.drop("host", "n_entries", "categories")
    given = given.withColumn("host", host_of(F.col("url")))
    asked = given.where("host <> '' AND fetched_on IS NOT NULL").select("host", F.col("fetched_on").alias("day")).distinct()
    keyed = asked.select("host", "day", F.explode(host_keys(F.col("host"))).alias("key"))
    listed = intervals.where("valid_to IS NULL OR valid_from < valid_to")
    turns = F.array(F.struct(F.col("valid_from").alias("day"), F.lit(1).alias("step")), F.struct(F.col("valid_to").alias("day"), F.lit(-1).alias("step")))
    turns = listed.select("key", "category", F.explode(turns).alias("e")).select("key", "category", "e.day", "e.step").where("day IS NOT NULL")
    turns = turns.groupBy("key", "category", "day").agg(F.sum("step").alias("step"), F.lit(False).alias("ask"))
    points = keyed.select("key", "day").distinct().join(listed.select("key", "category").distinct(), "key").select("key", "category", "day", F.lit(0).cast("long").alias("step"), F.lit(True).alias("ask"))
    as_of = Window.partitionBy("key", "category").orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    active = turns.unionAll(points).withColumn("n", F.sum("step").over(as_of)).where("ask AND n > 0").select("key", "day", "category", "n")
    found = keyed.join(active, ["key", "day"]).groupBy("host", "day").agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_set("category")), ",").alias("of"))
    found = found.select(F.col("host").alias("__host"), F.col("day").alias("__day"), "n", "of")
    out = given.join(found, (F.col("host") == F.col("__host")) & (F.col("fetched_on") == F.col("__day")), "left")
    return out.select(*given.columns, F.coalesce("n", F.lit(0)).cast("long").alias("n_entries"), F.coalesce("of", F.lit("")).alias("categories"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures of ``pages``: the table has no fetch date, so page_id sets one within ten years."""
    return pages.select("page_id", "url", F.date_add(F.lit("2015-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(3650)).cast("int")).alias("fetched_on"))


CATEGORIES = ("adult", "gambling", "malware", "spam")


def entries_of(captures: DataFrame) -> DataFrame:
    """A dated list over the hosts and domains that occur. A checksum of the key says whether it is listed, as what, when it was added, removed and added again."""
    keys = captures.select(host_of(F.col("url")).alias("host")).distinct().select(F.explode(host_keys(F.col("host"))).alias("key")).distinct()
    digest = F.md5("key")
    number = lambda at, n: F.pmod(F.conv(F.substring(digest, at, 6), 16, 10).cast("long"), F.lit(n)).cast("int")
    start = F.lit("2014-06-01").cast("date")
    first = F.date_add(start, number(1, 3000))
    away = F.date_add(first, number(7, 900) + 1)
    again = F.date_add(away, number(13, 900) + 1)
    event = lambda day, action: F.struct(day.alias("dated"), F.lit(action).alias("action"))
    rows = keys.withColumn("category", F.element_at(F.array(*map(F.lit, CATEGORIES)), number(19, 4) + 1)).where(number(25, 5) < 3)
    rows = rows.select("key", "category", F.explode(F.array(event(first, "add"), event(away, "remove"), event(again, "add"))).alias("e"))
    return rows.select("key", "category", "e.dated", "e.action")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = captures_of(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    out = active_entries(captures, validity_intervals(entries_of(captures)))
    return out.select("page_id", "host", "fetched_on", "n_entries", "categories", (F.col("n_entries") > 0).alias("blocked"))


ORACLE = r"""
WITH u AS (
  SELECT page_id, coalesce(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.'), '') AS name,
    CAST(DATE '2015-01-01' + CAST((page_id * 7919) % 3650 AS INTEGER) AS DATE) AS fetched_on
  FROM pages
), c AS (
  SELECT page_id, CASE WHEN length(name) <= 253 AND len(string_split(name, '.')) <= 127 THEN name ELSE '' END AS host, fetched_on FROM u
), k AS (
  SELECT host, unnest(CASE WHEN host = '' THEN [] WHEN len(string_split(host, '.')) < 2 THEN [host] ELSE
    list_transform(range(1, len(string_split(host, '.'))), lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')) END) AS key
  FROM (SELECT DISTINCT host FROM c)
), n AS (
  SELECT key, CAST('0x' || substr(md5(key), 1, 6) AS BIGINT) AS a, CAST('0x' || substr(md5(key), 7, 6) AS BIGINT) AS b, CAST('0x' || substr(md5(key), 13, 6) AS BIGINT) AS c,
    CAST('0x' || substr(md5(key), 19, 6) AS BIGINT) AS d, CAST('0x' || substr(md5(key), 25, 6) AS BIGINT) AS e
  FROM (SELECT DISTINCT key FROM k)
), l AS (
  SELECT key, ['adult', 'gambling', 'malware', 'spam'][d % 4 + 1] AS category,
    CAST(DATE '2014-06-01' + CAST(a % 3000 AS INTEGER) AS DATE) AS added, CAST(b % 900 + 1 AS INTEGER) AS listed, CAST(c % 900 + 1 AS INTEGER) AS away
  FROM n WHERE e % 5 < 3
), i AS (
  SELECT key, category, added AS valid_from, CAST(added + listed AS DATE) AS valid_to FROM l
  UNION ALL SELECT key, category, CAST(added + listed + away AS DATE), NULL FROM l
), h AS (
  SELECT c.page_id, count(*) AS n, string_agg(DISTINCT i.category, ',' ORDER BY i.category) AS categories
  FROM c JOIN k USING (host) JOIN i ON i.key = k.key AND c.fetched_on >= i.valid_from AND (i.valid_to IS NULL OR c.fetched_on < i.valid_to)
  GROUP BY c.page_id
)
SELECT c.page_id, c.host, c.fetched_on, CAST(coalesce(h.n, 0) AS BIGINT) AS n_entries, coalesce(h.categories, '') AS categories, coalesce(h.n, 0) > 0 AS blocked
FROM c LEFT JOIN h USING (page_id)
"""
