"""Queries of operators that readers and commands are made of: tokens, digits, keys, orders, suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossmill import commands
from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators import batching, quality
from glossmill.plans.register import query
from glossmill.session import table
from glossmill.sources import readers
from glossmill.streaming import logs

# Expected patterns are written out here, so that a wrong one of the library shows.


@query(r"""SELECT doc_id, regexp_matches(t, '(^|[^A-Za-z0-9_]|\\n)The([^A-Za-z0-9_]|$)') AS stands, regexp_matches(t, '(^|[^A-Za-z0-9_])The([^A-Za-z0-9_]|$)') AS plainly FROM (SELECT doc_id, replace(text, chr(10), chr(92) || 'n') AS t FROM documents)""")
def literal_break_tokens(spark, d):
    """Whole tokens where a written-out line feed before a term is a boundary, and where it isn't."""
    rows = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\\n")).alias("t"))
    return rows.select("doc_id", T.contains_token("t", "The", literal_break=True).alias("stands"), T.contains_token("t", "The").alias("plainly"))


@query(r"""SELECT event_id, regexp_full_match(f, '\p{Nd}+:(text|title|choice|narration):\p{Nd}+') AS is_field FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '１２:text:３' WHEN 1 THEN CAST(event_id AS VARCHAR) || ':title:1' WHEN 2 THEN 'x:text:1' WHEN 3 THEN CAST(event_id AS VARCHAR) || ':body:1' ELSE CAST(event_id AS VARCHAR) || ':choice:1' || chr(10) END AS f FROM events)""")
def field_ids_of_any_digits(spark, d):
    """Ids of fields hold decimal digits of any script, and nothing before or after."""
    number = F.col("event_id").cast("string")
    named = F.element_at(F.array(F.lit("１２:text:３"), F.concat(number, F.lit(":title:1")), F.lit("x:text:1"), F.concat(number, F.lit(":body:1")), F.concat(number, F.lit(":choice:1\n"))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", named.rlike(P.FIELD_ID).alias("is_field"))


@query("""SELECT o_custkey, CAST(o_orderdate AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL HAVING count(*) > 1""")
def repeated_keys(spark, d):
    """Keys that occur more than once."""
    rows = table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("string").alias("day"))
    return quality.duplicates(rows, "o_custkey", "day")


@query("""SELECT DISTINCT sha256(event_type || '/' || CAST(user_id AS VARCHAR)) AS cache_key, event_type, user_id FROM events""")
def results_recorded_once(spark, d):
    """The batch view of results that a stream records once: a repeated key is the same result."""
    rows = table(spark, d, "events").select(F.sha2(F.concat_ws("/", "event_type", F.col("user_id").cast("string")), 256).alias("cache_key"), "event_type", "user_id")
    return logs.once(rows, "cache_key")


@query("""SELECT page_id, CAST(row_number() OVER (ORDER BY string_split(url, '/'), page_id) AS BIGINT) AS place FROM pages""")
def paths_in_order(spark, d):
    """Paths by their components, not by their characters."""
    placed = batching.ranked(table(spark, d, "pages").select("page_id", readers._path_order(F.col("url")).alias("path")), ["path", "page_id"], "place")
    return placed.select("page_id", "place")


_SUGGESTED = """g AS (SELECT p_name AS source, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_type || chr(10) ELSE p_type END AS translation, p_partkey AS seq FROM part), i AS (SELECT DISTINCT p_name AS source FROM part WHERE p_size < 30),
k AS (SELECT source, arg_max(translation, seq) AS translation FROM g WHERE translation <> '' AND NOT contains(translation, chr(10)) AND source IN (SELECT source FROM i) GROUP BY source)"""


def _suggested(spark, d):
    part = table(spark, d, "part")
    said = F.when(F.col("p_partkey") % 4 == 0, "").when(F.col("p_partkey") % 4 == 1, F.concat("p_type", F.lit("\n"))).otherwise(F.col("p_type"))
    items = part.where("p_size < 30").select(F.col("p_name").alias("source"), F.lit(False).alias("may_reflow")).distinct()
    return items, readers.suggestions(part.select(F.col("p_name").alias("source"), said.alias("translation"), F.col("p_partkey").alias("seq")), items)


@query(f"WITH {_SUGGESTED} SELECT source, translation FROM k")
def suggestions_kept(spark, d):
    """The last suggestion of each item that is still asked about and meets the rules."""
    return _suggested(spark, d)[1]


@query(f"""WITH {_SUGGESTED}, l AS (SELECT p_name AS source, count(*) AS n FROM part WHERE p_size < 30 GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS "unique", CAST(count(k.translation) AS BIGINT) AS suggested FROM l LEFT JOIN k USING (source)""")
def suggestion_counts(spark, d):
    """Places, distinct sources, and sources with a suggestion."""
    _, told = _suggested(spark, d)
    places = table(spark, d, "part").where("p_size < 30").groupBy(F.col("p_name").alias("source")).agg(F.collect_list("p_partkey").alias("locations"))
    return commands.suggestion_counts(places.join(told.withColumnRenamed("translation", "suggestion"), "source", "left"))
