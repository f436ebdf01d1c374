"""Every query of the library over the driver's tables, with the SQL that must give the same rows.

Each stands for operators of the library: documents are record entries (table = source, field =
lang), conversations dialogue (script = conv_id, speaker = role), events an append-only log,
labels review decisions, benchmark passages evidence, pages notices, parts names with variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators import batching, documents, evidence, memory, model, quality, review, terms
from glossmill.plans.register import oracle_sql, queries, query as _query
from glossmill.session import table

__all__ = ["oracle_sql", "queries"]

WORDS = ["the", "and", "that", "thanedble", "der", "die", "les", "des", "las", "License", "GNU General Public License", "of the", "to", "in the"]
TERMS = [{"source": w, "target": w.upper(), "category": "phrase" if " " in w else "word"} for w in WORDS]
SCOPED = [
    {"source": "the", "target": "THE", "scope": {}},
    {"source": "the", "target": "THE-1", "scope": {"table": "src1*"}},
    {"source": "the", "target": "THE-EN", "scope": {"table": "src1?", "field": "e[mn]"}},
    {"source": "les", "target": "LES", "scope": {"field": "fr"}},
    {"source": "der", "target": "DER", "scope": {"field": "[!ef]*"}},
]


def _sql_list(values: list[str]) -> str:
    return "(VALUES " + ", ".join(f"('{v}')" for v in values) + ")"


_ALTERNATION = "|".join(sorted(set(WORDS), key=lambda t: (-len(t), t)))
_VALUES = ", ".join(f"('{t['source']}', '{t['target']}', '{t['category']}')" for t in TERMS)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# --- scans, projections, coverage -------------------------------------------------------------


@_query("""SELECT d.source, CAST(count(l.doc_id) FILTER (WHERE l.quality = 1) AS BIGINT) AS translated, CAST(count(*) AS BIGINT) AS total
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source""")
def coverage_by_source(spark, d):
    held = table(spark, d, "labels").where("quality = 1").select("doc_id", F.lit("x").alias("translation"))
    rows = _documents(spark, d).select("doc_id", "source").join(held, "doc_id", "left")
    return memory.coverage(rows, "source")


@_query("""SELECT lang, CAST(count(DISTINCT text) AS BIGINT) AS unscoped, CAST(count(*) AS BIGINT) AS scoped FROM documents GROUP BY lang""")
def unscoped_vs_scoped_counts(spark, d):
    return _documents(spark, d).groupBy("lang").agg(F.count_distinct("text").alias("unscoped"), F.count(F.lit(1)).alias("scoped"))


@_query("""SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50""")
def json_props(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").select("event_id", "event_type", k.alias("k")).where("k >= 50")


@_query(r"""SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
 CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS links FROM pages""")
def page_fields(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        T.occurrences("html", "<li>").alias("links"),
    )


@_query(r"""SELECT doc_id, regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS trimmed, CAST(length(text) AS BIGINT) AS n, substr(text, 1, 120) AS excerpt
FROM documents WHERE length(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) BETWEEN 1 AND 120""")
def unicode_trim_filter(spark, d):
    rows = _documents(spark, d).select("doc_id", T.trimmed("text").alias("trimmed"), F.length("text").cast("long").alias("n"), T.excerpt("text").alias("excerpt"))
    return rows.where("length(trimmed) BETWEEN 1 AND 120")


@_query("""SELECT source, lang, sum(CASE WHEN n_chars <= 1000 THEN 1 ELSE 0 END)::BIGINT AS selected, sum(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END)::BIGINT AS excluded,
 sum(CASE WHEN n_chars <= 1000 THEN length(text) ELSE 0 END)::BIGINT AS selected_chars FROM documents GROUP BY source, lang""")
def stratum_counts(spark, d):
    chosen = F.col("n_chars") <= 1000
    return _documents(spark, d).groupBy("source", "lang").agg(
        F.count_if(chosen).alias("selected"), F.count_if(~chosen).alias("excluded"), F.sum(F.when(chosen, F.length("text")).otherwise(0)).cast("long").alias("selected_chars")
    )


@_query("""SELECT doc_id, source, lang FROM documents WHERE (source LIKE 'src1%' OR source LIKE 'src7%') AND lang IN ('en', 'de') ORDER BY doc_id LIMIT 50""")
def slice_plan(spark, d):
    rows = _documents(spark, d).where((F.col("source").startswith("src1") | F.col("source").startswith("src7")) & F.col("lang").isin("en", "de"))
    return rows.select("doc_id", "source", "lang").orderBy("doc_id").limit(50)


# --- joins and memory -------------------------------------------------------------------------


@_query("""SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def pending_anti_join(spark, d):
    return memory.pending(_documents(spark, d).select("doc_id", "source"), table(spark, d, "labels"), ["doc_id"])


@_query("""SELECT l.doc_id, CAST(l.quality AS BIGINT) AS quality FROM labels l WHERE EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id AND d.lang = 'en')""")
def semi_join_log_sources(spark, d):
    rows = table(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return memory.known_sources(rows, _documents(spark, d).where("lang = 'en'"), ["doc_id"])


@_query("""SELECT user_id, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value FROM events GROUP BY user_id""")
def memory_last_wins(spark, d):
    return memory.last_wins(table(spark, d, "events").select("user_id", "event_type", "value", "ts"), ["user_id"], "ts").select("user_id", "event_type", "value")


@_query("""SELECT user_id, arg_min(event_id, ts) AS event_id, arg_min(event_type, ts) AS event_type FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def memory_first_wins(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return memory.first_wins(rows, ["user_id"], "ts", F.col("event_type") != "error").select("user_id", "event_id", "event_type")


@_query("""WITH m AS (SELECT source, arg_min(lang, doc_id) AS remembered FROM documents WHERE n_chars > 100 GROUP BY source)
SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 AND m.remembered IS NOT NULL AND m.remembered <> 'de' THEN m.remembered WHEN d.doc_id % 3 = 0 THEN '' ELSE d.lang END AS translation,
 (d.doc_id % 3 = 0 AND m.remembered IS NOT NULL AND m.remembered <> 'de') AS filled FROM documents d LEFT JOIN m USING (source)""")
def apply_memory_fill(spark, d):
    docs = _documents(spark, d)
    held = memory.first_wins(docs.where("n_chars > 100").select("source", F.col("lang").alias("translation"), "doc_id"), ["source"], "doc_id").select("source", "translation")
    rows = docs.select("doc_id", "source", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("translation"))
    return memory.fill(rows, held, ["source"], valid=F.col("remembered") != "de").select("doc_id", "translation", "filled")


@_query("""SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal > 0 UNION ALL
SELECT s.s_suppkey, s.s_name, s.s_nationkey FROM supplier s WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey = s.s_suppkey)""")
def insert_existing_wins(spark, d):
    held = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey")
    batch = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"))
    return memory.merged_existing_wins(held, batch, ["c_custkey"])


@_query("""SELECT word AS source, CASE WHEN word IN ('the', 'and') THEN upper(word) || '!' ELSE upper(word) END AS target FROM """ + _sql_list(sorted(set(WORDS) | {"new"})) + """ t(word)""")
def glossary_override_union(spark, d):
    flat = terms.terms_frame(spark, TERMS).select("source", "target")
    later = spark.createDataFrame([("the", "THE!"), ("and", "AND!"), ("new", "NEW")], "source string, target string")
    return memory.merged_later_wins(flat, later, ["source"])


@_query("""SELECT o_orderpriority, CAST(count(DISTINCT c.c_custkey) AS BIGINT) AS customers, CAST(count(*) AS BIGINT) AS line_items, CAST(round(sum(l_extendedprice * (1 - l_discount)), 2) AS DOUBLE) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY o_orderpriority""")
def volume_join(spark, d):
    lines = table(spark, d, "lineitem").where("l_shipdate >= TIMESTAMP_NTZ '1995-01-01'").select("l_orderkey", "l_extendedprice", "l_discount")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, d, "customer").select("c_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("c_custkey") == F.col("o_custkey"))
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return joined.groupBy("o_orderpriority").agg(F.count_distinct("c_custkey").alias("customers"), F.count(F.lit(1)).alias("line_items"), revenue.alias("revenue"))


# --- terms ------------------------------------------------------------------------------------


@_query(f"""WITH m AS (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(text, '{_ALTERNATION}')) AS term FROM documents)
SELECT term, t.category, lang, CAST(count(*) AS BIGINT) AS documents FROM m JOIN (VALUES {_VALUES}) t(source, target, category) ON t.source = m.term GROUP BY ALL""")
def term_alternation_mentions(spark, d):
    found = terms.mentions(_documents(spark, d).select("doc_id", "lang", "text"), TERMS, "text").drop("text")
    known = terms.terms_frame(spark, TERMS).select(F.col("source").alias("term"), "category")
    return found.join(known, "term").groupBy("term", "category", "lang").agg(F.count(F.lit(1)).alias("documents"))


@_query(r"""SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '(^|[^A-Za-z0-9_])thanedble([^A-Za-z0-9_]|$)')""")
def term_token_boundary(spark, d):
    return _documents(spark, d).where(T.contains_token("text", "thanedble")).select("doc_id", "lang")


@_query("""SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)""")
def containment_join(spark, d):
    """Texts that hold a passage: its inner words, five at most, which any holder has as whole
    words, are an equi-join key, as a hash; the whole passage is then compared. The key of a passage
    without inner words is its first eight characters, or all if it has fewer."""
    anchor, chars = 5, 8
    passages = table(spark, d, "benchmark").select("item_id", F.col("text").alias("passage"), F.split("text", r"\s+").alias("w")).where("passage IS NOT NULL")
    passages = passages.withColumn("words", F.least(F.size("w") - 2, F.lit(anchor))).withColumn("chars", F.least(F.length("passage"), F.lit(chars)))
    key = F.when(F.col("words") > 0, F.xxhash64(F.slice("w", F.lit(2), F.greatest("words", F.lit(0))))).otherwise(F.xxhash64(F.substring("passage", 1, chars)))
    passages = passages.select("item_id", "passage", key.alias("key"), F.greatest("words", F.lit(0)).alias("words"), F.when(F.col("words") <= 0, F.col("chars")).alias("chars"))
    words = _documents(spark, d).select("doc_id", "text", F.split("text", r"\s+").alias("w")).where("text IS NOT NULL")
    kinds = passages.select("words", "chars").distinct().collect()

    def windows(n: int, whole, of) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.greatest(whole - n + 1, F.lit(1))), lambda i: of(i, n))
        return F.when(whole >= n, F.array_distinct(every)).otherwise(F.array().cast("array<long>"))

    held = [windows(n, F.size("w"), lambda i, n: F.xxhash64(F.slice(F.col("w"), i, n))) for n in sorted({k["words"] for k in kinds} - {0})]
    held += [windows(n, F.length("text"), lambda i, n: F.xxhash64(F.substring(F.col("text"), i, F.lit(n)))) for n in sorted({k["chars"] for k in kinds} - {None})]
    keys = words.select("doc_id", F.explode(F.concat(*held) if held else F.array().cast("array<long>")).alias("key"))
    met = keys.join(passages.select("item_id", "key"), "key").select("doc_id", "item_id").distinct()
    held = met.join(_documents(spark, d).select("doc_id", "text"), "doc_id").join(passages.select("item_id", "passage"), "item_id")
    return held.where(F.contains("text", "passage")).select("doc_id", "item_id")


_GLOB = """(VALUES (0, 'the', 'THE', '*', '*', 0), (1, 'the', 'THE-1', 'src1*', '*', 1), (2, 'the', 'THE-EN', 'src1?', 'e[mn]', 2), (3, 'les', 'LES', '*', 'fr', 1), (4, 'der', 'DER', '*', '[!ef]*', 1)) t(seq, term, target, tbl, fld, specificity)"""
_SCOPE = f"""SELECT d.doc_id, d.source AS tbl, t.* EXCLUDE (tbl, fld) FROM documents d JOIN {_GLOB} ON d.source GLOB t.tbl AND d.lang GLOB t.fld
 AND regexp_matches(d.text, '(^|[^A-Za-z0-9_])' || t.term || '([^A-Za-z0-9_]|$)') AND list_contains(regexp_extract_all(d.text, 'der|les|the'), t.term)"""


def _scoped(spark, d):
    context = {"table": F.col("source"), "field": F.col("lang")}
    return terms.active_terms(_documents(spark, d).select("doc_id", "source", "lang", "text"), SCOPED, context, "text")


@_query(f"""SELECT term, target, CAST(count(*) AS BIGINT) AS documents FROM ({_SCOPE}) GROUP BY term, target""")
def scope_glob_match(spark, d):
    return _scoped(spark, d).groupBy("term", "target").agg(F.count(F.lit(1)).alias("documents"))


@_query(f"""WITH s AS ({_SCOPE}) SELECT doc_id, term, arg_max(target, specificity) AS target, CAST(max(specificity) AS BIGINT) AS specificity FROM s GROUP BY doc_id, term""")
def most_specific_scope(spark, d):
    return terms.resolved(_scoped(spark, d).drop("text"), ["doc_id"]).select("doc_id", "term", "target", "specificity")


@_query("""WITH e AS (SELECT p_partkey AS id, p_name AS source, p_type AS translation FROM part), v AS (SELECT source, translation, count(*) AS n FROM e GROUP BY ALL),
x AS (SELECT source, translation, id, row_number() OVER (PARTITION BY source, translation ORDER BY id) AS rn FROM e)
SELECT v.source, v.translation, CAST(v.n AS BIGINT) AS n, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM x WHERE x.source = v.source AND x.translation = v.translation AND rn <= 2) AS examples
FROM v WHERE v.source IN (SELECT source FROM v GROUP BY source HAVING count(*) > 1)""")
def source_variants(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("source"), F.col("p_type").alias("translation"))
    return terms.source_variants(rows, "source", "translation", "id").select("source", "translation", "n", "examples")


@_query("""SELECT p_name AS key, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS sources FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1""")
def varying_keys(spark, d):
    rows = table(spark, d, "part").select(F.col("p_name").alias("key"), F.col("p_type").alias("source"))
    return terms.varying_keys(rows, "key", "source").select("key", F.array_join("sources", "|").alias("sources"))


@_query("""SELECT p_name AS source, string_agg(DISTINCT p_brand || '/' || p_type, ',' ORDER BY p_brand || '/' || p_type) AS locations FROM part GROUP BY p_name""")
def distinct_source_locations(spark, d):
    rows = table(spark, d, "part").select(F.col("p_name").alias("source"), F.concat_ws("/", "p_brand", "p_type").alias("at"))
    found = terms.distinct_locations(rows, "source", "at")
    return found.select("source", F.array_join(F.transform("locations", lambda x: x["at"]), ",").alias("locations"))


@_query("""WITH r AS (SELECT p_type AS category, p_name AS source, p_brand AS scope, p_partkey AS id FROM part),
g AS (SELECT category, source, scope, count(*) AS n FROM r GROUP BY ALL), x AS (SELECT *, row_number() OVER (PARTITION BY category, source, scope ORDER BY id) AS rn FROM r)
SELECT g.category, g.source, g.scope, CAST(g.n AS BIGINT) AS n, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM x WHERE x.category = g.category AND x.source = g.source AND x.scope = g.scope AND rn <= 2) AS examples,
 CAST(sum(g.n) OVER (PARTITION BY g.category, g.source) AS BIGINT) AS occurrences, g.source IN ('small ring', 'red widget') AS in_glossary FROM g""")
def candidate_discovery(spark, d):
    rows = table(spark, d, "part").select(F.col("p_type").alias("category"), F.col("p_name").alias("source"), F.col("p_brand").alias("scope"), F.col("p_partkey").alias("id"))
    known = spark.createDataFrame([("small ring", "a"), ("red widget", "b")], "source string, target string")
    found = terms.discovered(rows, "source", "category", "scope", "id", known)
    return found.select("category", "source", "scope", "n", "examples", "occurrences", "in_glossary")


@_query("""WITH p AS (SELECT p_name AS source, p_type AS category, p_brand AS suggestion FROM part WHERE p_size <= 10), m AS (SELECT DISTINCT p_name AS source, p_brand AS target FROM part WHERE p_size = 11),
g AS (SELECT DISTINCT p_name AS source, p_brand AS target FROM part WHERE p_size = 12), s AS (SELECT DISTINCT source FROM p),
b AS (SELECT s.source, count(DISTINCT x.target) AS nb, count(g.target) AS ng FROM s LEFT JOIN (SELECT * FROM m UNION SELECT * FROM g) x USING (source) LEFT JOIN g ON g.source = x.source AND g.target = x.target GROUP BY s.source)
SELECT CASE WHEN nb > 1 THEN 'reference_conflict' WHEN ng > 0 THEN 'glossary_reference' WHEN nb > 0 THEN 'master_reference' ELSE 'needs_review' END AS status, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 1""")
def reference_conflict_status(spark, d):
    part = table(spark, d, "part")
    reports = part.where("p_size <= 10").select(F.col("p_name").alias("source"), F.col("p_type").alias("category"), F.col("p_brand").alias("suggestion"))
    held = part.where("p_size = 11").select(F.col("p_name").alias("source"), F.col("p_brand").alias("target"))
    known = part.where("p_size = 12").select(F.col("p_name").alias("source"), F.col("p_brand").alias("target"))
    return evidence.reconciled(reports, held, known).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@_query("""SELECT p_type AS category, p_name AS source, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT p_brand AS k, count(*) AS n FROM part q WHERE q.p_type = p.p_type AND q.p_name = p.p_name GROUP BY 1)) AS suggestions,
 CAST(count(DISTINCT p_partkey) AS BIGINT) AS n_evidence FROM part p GROUP BY p_type, p_name""")
def semantic_aggregate(spark, d):
    rows = table(spark, d, "part").select(
        F.col("p_type").alias("category"), F.col("p_name").alias("source"), F.col("p_brand").alias("suggested_translation"), F.lit("job").alias("job_id"), F.array(F.col("p_partkey").cast("string")).alias("evidence")
    )
    votes = F.array_join(F.transform(F.map_entries("suggested_translations"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return evidence.aggregated(rows).select("category", "source", votes.alias("suggestions"), F.size("evidence").cast("long").alias("n_evidence"))


# --- order: windows, samples, batches ---------------------------------------------------------


@_query("""SELECT conv_id, turn, coalesce(lag(role) OVER w, '') || ':' || coalesce(substr(lag(text) OVER w, 1, 120), '') AS before, coalesce(substr(lead(text) OVER w, 1, 120), '') AS after
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def neighbor_context(spark, d):
    rows = batching.neighbours(table(spark, d, "conversations"), "conv_id", "turn", "turn", "role", "text")
    after = F.filter("neighbors", lambda x: x["turn"] > F.col("turn"))
    said = lambda x: F.coalesce(T.excerpt(x["text"]), F.lit(""))
    rows = rows.withColumn("_b", F.get(F.filter("neighbors", lambda x: x["turn"] < F.col("turn")), F.lit(0))).withColumn("_a", F.get(after, F.lit(0)))
    return rows.select("conv_id", "turn", F.concat(F.coalesce("_b.role", F.lit("")), F.lit(":"), said(F.col("_b"))).alias("before"), said(F.col("_a")).alias("after"))


@_query("""SELECT source, lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 3""")
def stratified_sample(spark, d):
    return batching.first_of_each(_documents(spark, d).select("source", "lang", "doc_id"), ["source", "lang"], ["doc_id"], 3).drop("at")


@_query("""SELECT min(doc_id) AS doc_id, CAST(count(*) - 1 AS BIGINT) AS aliases FROM documents GROUP BY text""")
def dedupe_representatives(spark, d):
    rows = _documents(spark, d).select(F.sha2("text", 256).alias("signature"), "doc_id")
    return batching.representatives(rows, ["signature"], "doc_id").select("doc_id", "aliases")


_GREEDY = """WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY id) AS rn FROM ({rows})),
b(g, rn, id, batch, n, total) AS (SELECT g, rn, id, 0, 1, size FROM r WHERE rn = 1 UNION ALL
SELECT r.g, r.rn, r.id, CASE WHEN b.n >= {cap} OR b.total + r.size > {max} THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.n >= {cap} OR b.total + r.size > {max} THEN 1 ELSE b.n + 1 END,
 CASE WHEN b.n >= {cap} OR b.total + r.size > {max} THEN r.size ELSE b.total + r.size END FROM b JOIN r ON r.g = b.g AND r.rn = b.rn + 1)
SELECT g AS source, id AS doc_id, CAST(batch AS BIGINT) AS batch FROM b"""


@_query(_GREEDY.format(rows="SELECT source AS g, doc_id AS id, length(text) AS size FROM documents", cap=12, max=1600))
def greedy_batches(spark, d):
    rows = _documents(spark, d).select("source", "doc_id", F.length("text").cast("long").alias("size"))
    return batching.greedy_batches(rows, "source", "doc_id", "size", 12, 1600).select("source", "doc_id", "batch")


@_query(_GREEDY.format(rows="SELECT source || CASE WHEN n_chars < 400 THEN '/short' ELSE '/normal' END AS g, doc_id AS id, n_chars AS size FROM documents", cap=8, max=3000))
def two_lane_batches(spark, d):
    rows = _documents(spark, d).select("source", "doc_id", "n_chars")
    laned = batching.two_lane_batches(rows, "source", "doc_id", "n_chars", F.col("n_chars") < 400, {"short": 8, "normal": 8}, 3000)
    return laned.select(F.concat_ws("/", "source", "lane").alias("source"), "doc_id", "batch")


@_query(_GREEDY.replace("SELECT g AS source, id AS doc_id, CAST(batch AS BIGINT) AS batch FROM b", "SELECT c.source, c.doc_id, CAST(b.batch AS BIGINT) AS batch FROM b JOIN documents c ON c.source = b.g AND c.lang = b.lang").replace("b(g, rn, id, batch", "b(g, rn, id, lang, batch").replace("rn, id, 0, 1", "rn, id, lang, 0, 1").replace("r.rn, r.id, CASE", "r.rn, r.id, r.lang, CASE").replace("b.n >= {cap}", "b.n + r.k > {cap}").replace("THEN 1 ELSE b.n + 1 END", "THEN r.k ELSE b.n + r.k END").replace("lang, 0, 1, size", "lang, 0, k, size").format(
    rows="SELECT source AS g, lang, min(doc_id) AS id, count(*) AS k, sum(n_chars) AS size FROM documents GROUP BY source, lang", cap=40, max=60000))
def packed_parts(spark, d):
    rows = _documents(spark, d).select("source", "lang", "doc_id", "n_chars")
    return batching.packed_parts(rows, "source", "doc_id", "lang", 40, 60_000, "n_chars").select("source", "doc_id", "batch")


@_query("""SELECT conv_id, turn, CAST(floor((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) / 2) AS BIGINT) AS chunk FROM conversations""")
def fixed_chunks(spark, d):
    return batching.fixed_chunks(table(spark, d, "conversations").select("conv_id", "turn"), "conv_id", "turn", 2)


@_query("""WITH i AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER w AS island FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
f AS (SELECT user_id, event_id, ts, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts) AS failures FROM i)
SELECT user_id, event_id, CAST(failures AS BIGINT) AS failures, max(failures >= 3) OVER (PARTITION BY user_id ORDER BY ts) AS open FROM f""")
def failure_runs(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    return batching.failure_runs(rows, "user_id", "ts", F.col("event_type") != "error", 3).select("user_id", "event_id", "failures", "open")


@_query("""SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn <= 5""")
def topn_examples_per_group(spark, d):
    rows = _documents(spark, d).select("lang", "doc_id", (-F.col("n_chars")).alias("less"))
    return batching.first_of_each(rows, ["lang"], ["less", "doc_id"], 5).select("lang", "doc_id")


# --- text rules -------------------------------------------------------------------------------


@_query(r"""WITH p AS (SELECT page_id, html, regexp_replace(html, '<li>', '', 'g') AS target FROM pages)
SELECT page_id, list_sort(regexp_extract_all(html, '</?[a-z]+>')) = list_sort(regexp_extract_all(target, '</?[a-z]+>')) AS same_tags, CAST(len(regexp_extract_all(html, '</?[a-z]+>')) AS BIGINT) AS n FROM p""")
def placeholder_multiset(spark, d):
    rows = table(spark, d, "pages").select("page_id", "html", F.replace("html", F.lit("<li>"), F.lit("")).alias("target"))
    pattern = "</?[a-z]+>"
    return rows.select("page_id", T.same_multiset("html", "target", pattern).alias("same_tags"), F.size(T.matches("html", pattern)).cast("long").alias("n"))


@_query(r"""WITH p AS (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN text ELSE replace(text, '1', '2') END AS target FROM documents)
SELECT doc_id, regexp_extract_all(text, '[0-9]+(?:[,.][0-9]+)*') = regexp_extract_all(target, '[0-9]+(?:[,.][0-9]+)*') AS same_numbers FROM p WHERE regexp_matches(text, '[0-9]')""")
def number_sequence(spark, d):
    rows = _documents(spark, d).where(F.col("text").rlike("[0-9]"))
    target = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.replace("text", F.lit("1"), F.lit("2")))
    return rows.withColumn("target", target).select("doc_id", T.same_sequence("text", "target", P.NUMBER).alias("same_numbers"))


@_query(r"""SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS breaks, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS BIGINT) AS the FROM documents""")
def linebreak_counts(spark, d):
    return _documents(spark, d).select("doc_id", T.occurrences("text", "\n").alias("breaks"), T.occurrences("text", "the").alias("the"))


@_query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[0-9]+')) AS BIGINT) AS masks, text AS restored FROM documents WHERE regexp_matches(text, '[0-9]')""")
def mask_markers(spark, d):
    """Digits masked by markers and put back: the texts must be as they were."""
    rows = _documents(spark, d).where(F.col("text").rlike("[0-9]")).withColumn("masked", T.masked("text", "[0-9]+"))
    return rows.select("doc_id", F.size(T.matches("masked", "⟦[0-9]+⟧")).cast("long").alias("masks"), T.unmasked("masked", "text", "[0-9]+").alias("restored"))


@_query(r"""SELECT conv_id, turn, replace(text, chr(10), chr(13) || chr(10)) AS fixed FROM conversations""")
def line_endings_imposed(spark, d):
    rows = table(spark, d, "conversations").withColumn("source", F.replace("text", F.lit("\n"), F.lit("\r\n")))
    return rows.select("conv_id", "turn", T.imposed_line_endings("source", "text").alias("fixed"))


@_query(r"""WITH p AS (SELECT doc_id, text AS s, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN '' WHEN 2 THEN text || chr(10) ELSE text || '<' END AS t FROM documents)
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN trim(t, ' ' || chr(10)) = '' THEN 'blank' WHEN (length(t) - length(replace(t, '<', ''))) <> (length(s) - length(replace(s, '<', ''))) THEN 'brackets'
 WHEN (length(t) - length(replace(t, chr(10), ''))) <> (length(s) - length(replace(s, chr(10), ''))) THEN 'line_breaks' END AS reason FROM p) WHERE reason IS NOT NULL GROUP BY reason""")
def record_violations(spark, d):
    kind = F.col("doc_id") % 4
    target = F.when(kind == 0, F.col("text")).when(kind == 1, "").when(kind == 2, F.concat("text", F.lit("\n"))).otherwise(F.concat("text", F.lit("<")))
    rows = _documents(spark, d).select("doc_id", F.col("text").alias("s"), target.alias("t"))
    return quality.violations(rows, quality.record_line("s", "t")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@_query("""SELECT doc_id, sha256(text) AS text_sha256, substr(sha256('{"c00":' || CAST(doc_id AS VARCHAR) || ',"c01":"' || lang || '"}'), 1, 24) AS row_id FROM documents""")
def content_hash_ids(spark, d):
    return _documents(spark, d).select("doc_id", F.sha2("text", 256).alias("text_sha256"), T.short_id("doc_id", "lang").alias("row_id"))


@_query("""SELECT conv_id, string_agg(text || chr(10), '' ORDER BY turn) AS whole, sha256(string_agg(text || chr(10), '' ORDER BY turn)) AS whole_sha256 FROM conversations GROUP BY conv_id""")
def legal_concat(spark, d):
    rows = table(spark, d, "conversations").withColumn("ending", F.lit("\n"))
    return documents.joined_in_order(rows, "conv_id", "turn", "text", "ending")


@_query(r"""SELECT p.page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS source FROM pages p WHERE p.page_id % 5 <> 0
 AND NOT EXISTS (SELECT 1 FROM pages a WHERE a.page_id % 7 = 0 AND regexp_extract(a.html, '<title>([^<]*)</title>', 1) = regexp_extract(p.html, '<title>([^<]*)</title>', 1))""")
def pending_notices(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("source"))
    done = rows.where("page_id % 5 = 0").select("page_id", "source")
    aliased = rows.where("page_id % 7 = 0").select("source").distinct()
    return memory.pending(memory.pending(rows, done, ["page_id", "source"]), aliased, ["source"])


# --- review -----------------------------------------------------------------------------------

_DECIDED = """WITH n AS (SELECT CAST(doc_id AS VARCHAR) AS id, CAST(quality AS VARCHAR) AS np FROM labels WHERE doc_id % 10 <> 0),
o AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE CAST(quality AS VARCHAR) END AS op, CASE WHEN doc_id % 2 = 0 THEN 'accept' ELSE 'pending' END AS decision FROM labels WHERE doc_id % 7 <> 0)"""


def _decided(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.col("doc_id").cast("string").alias("review_id"), F.col("quality").cast("string").alias("input_fingerprint"))
    changed = F.when(F.col("doc_id") % 3 == 0, "x").otherwise(F.col("input_fingerprint"))
    decision = F.when(F.col("doc_id") % 2 == 0, "accept").otherwise("pending")
    empty = F.lit("")
    old = labels.where("doc_id % 7 <> 0").select("review_id", changed.alias("input_fingerprint"), decision.alias("decision"), empty.alias("selected_target"), empty.alias("notes"), empty.alias("reviewer"))
    return review.merged_decisions(labels.where("doc_id % 10 <> 0"), old)


@_query(_DECIDED + """ SELECT n.id AS review_id, n.np AS input_fingerprint, CASE WHEN o.op = n.np THEN o.decision ELSE 'pending' END AS decision FROM n LEFT JOIN o USING (id)""")
def decision_merge(spark, d):
    return _decided(spark, d)[0].select("review_id", "input_fingerprint", "decision")


@_query(_DECIDED + """ SELECT o.id AS review_id, o.op AS input_fingerprint, o.decision FROM o LEFT JOIN n USING (id) WHERE n.id IS NULL OR (o.op <> n.np AND o.decision <> 'pending')""")
def stale_decisions(spark, d):
    return _decided(spark, d)[1].select("review_id", "input_fingerprint", "decision")


@_query("""WITH a AS (SELECT CAST(doc_id AS VARCHAR) AS source, n_chars AS occurrences FROM documents WHERE doc_id % 11 <> 0),
b AS (SELECT CAST(doc_id AS VARCHAR) AS source, CASE WHEN doc_id % 13 = 0 THEN n_chars + 1 ELSE n_chars END AS occurrences FROM documents WHERE doc_id % 17 <> 0)
SELECT coalesce(a.source, b.source) AS source, CASE WHEN b.source IS NULL THEN 'omitted' WHEN a.source IS NULL THEN 'invented' ELSE 'occurrences' END AS problem FROM a FULL JOIN b ON a.source = b.source
WHERE a.source IS NULL OR b.source IS NULL OR a.occurrences <> b.occurrences""")
def review_bijection(spark, d):
    rows = _documents(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("source"), F.col("n_chars").alias("occurrences"))
    changed = F.when(F.col("doc_id") % 13 == 0, F.col("occurrences") + 1).otherwise(F.col("occurrences"))
    reviewed = rows.where("doc_id % 17 <> 0").withColumn("occurrences", changed)
    return review.unmatched_reviews(rows.where("doc_id % 11 <> 0"), reviewed).select("source", "problem")


@_query("""SELECT flag, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(list_filter([CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END, 'labelled'], lambda x: x IS NOT NULL)) AS flag FROM labels) GROUP BY flag""")
def flag_counts(spark, d):
    flags = F.array_compact(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic"), F.lit("labelled")))
    return review.flag_counts(table(spark, d, "labels").select(flags.alias("flags")))


# --- sets and models --------------------------------------------------------------------------


@_query("""SELECT doc_id AS key FROM documents EXCEPT SELECT doc_id FROM labels""")
def set_except_pages(spark, d):
    return _documents(spark, d).select(F.col("doc_id").alias("key")).subtract(table(spark, d, "labels").select("doc_id"))


@_query("""SELECT p_name AS key FROM part WHERE p_size < 5 UNION SELECT p_name FROM part WHERE p_brand = 'Brand#2'""")
def set_union_keys(spark, d):
    part = table(spark, d, "part")
    return part.where("p_size < 5").select(F.col("p_name").alias("key")).union(part.where("p_brand = 'Brand#2'").select("p_name")).distinct()


@_query("""SELECT doc_id, '«' || text || '»' AS translation, 'done' AS status FROM documents""")
def model_stub_batch(spark, d):
    """Batches of every source answered by the offline stand-in."""
    rows = _documents(spark, d).select(F.col("source").alias("g"), "doc_id", "text", F.length("text").cast("long").alias("size"))
    numbered = batching.greedy_batches(rows.drop("text"), "g", "doc_id", "size", 12, 1600)
    packed = rows.join(numbered.select("g", "doc_id", "batch"), ["g", "doc_id"]).select("doc_id", "text", F.concat_ws("/", "g", F.col("batch").cast("string")).alias("batch"))
    return model.run_batches(packed, model.echo_service, lambda s, t: t == f"«{s}»", id="doc_id", source="text")


from glossmill.plans import asking, checks, corpora, reports  # noqa: E402, F401  (they add their queries)
