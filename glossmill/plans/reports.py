"""Queries over reports of models and reviews: what is united, merged, counted and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.operators import batching, evidence, memory, quality, terms
from glossmill.plans.fixtures import ENTITY, ENTRIES_SQL, entries
from glossmill.plans.register import query
from glossmill.session import table
from glossmill.sources import readers


@query("""SELECT 'story' AS kind, role AS speaker, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS tables FROM conversations GROUP BY role
UNION ALL SELECT 'master', NULL, CAST(count(*) AS BIGINT), CAST(count(DISTINCT source) AS BIGINT) FROM documents""")
def corpora_united(spark, d):
    master = table(spark, d, "documents").select(F.lit("master").alias("kind"), F.col("source").alias("tbl"), F.col("text").alias("source"))
    story = table(spark, d, "conversations").select(F.lit("story").alias("kind"), F.col("role").alias("speaker"), F.col("text").alias("source"))
    return readers.united(master, story).groupBy("kind", "speaker").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("tbl").alias("tables"))


def _reports(spark, d):
    part = table(spark, d, "part")
    one = part.where("p_size <= 25").select(F.col("p_name").alias("source"), F.col("p_type").alias("category"), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_brand")).alias("suggestion"), F.array(F.col("p_brand"), F.col("p_type")).alias("evidence"))
    other = part.where("p_size >= 20").select(F.col("p_name").alias("source"), F.col("p_type").alias("category"), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_brand")).alias("suggestion"), F.array(F.col("p_brand"), F.col("p_type")).alias("evidence"))
    return evidence.united_reports(one, other)


@query("""WITH r AS (SELECT p_name AS source, p_type AS category, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS suggestion, p_brand, p_type FROM part), e AS (SELECT DISTINCT source, category, suggestion, unnest([p_brand, p_type]) AS ref FROM r)
SELECT source, category, suggestion, string_agg(ref, '|' ORDER BY ref) AS evidence FROM e GROUP BY ALL""")
def reports_united(spark, d):
    """Candidates of two reports that overlap: evidence given twice counts once."""
    return _reports(spark, d).select("source", "category", "suggestion", F.array_join("evidence", "|").alias("evidence"))


@query(f"""WITH {ENTRIES_SQL}, r AS (SELECT DISTINCT source FROM e WHERE seq % 2 = 0), f AS (SELECT source, translation FROM e WHERE {ENTITY}), g AS (SELECT '鍵' AS source, '钥匙' AS target),
m AS (SELECT r.source, list_distinct(list(translation) FILTER (WHERE translation <> '')) AS held, count(f.source) FILTER (WHERE translation = '') AS untranslated FROM r LEFT JOIN f USING (source) GROUP BY r.source),
b AS (SELECT m.*, g.target, list_distinct(coalesce(held, []) || CASE WHEN g.target IS NULL THEN [] ELSE [g.target] END) AS every FROM m LEFT JOIN g USING (source))
SELECT source, CASE WHEN len(every) > 1 THEN 'reference_conflict' WHEN target IS NOT NULL THEN 'glossary_reference' WHEN len(coalesce(held, [])) > 0 THEN 'master_reference' ELSE 'needs_review' END AS status, len(every) > 0 AND NOT list_contains(every, 'S') AS disagreement, CAST(untranslated AS BIGINT) AS untranslated FROM b""")
def reconciled_terms(spark, d):
    """Candidates against the entries that name something and the glossary."""
    own = entries(spark, d)
    reports = own.where("seq % 2 = 0").select("source", F.lit("item").alias("category"), F.lit("S").alias("suggestion"))
    glossary = spark.createDataFrame([("鍵", "钥匙")], "source string, target string")
    return evidence.reconciled(reports, evidence.references(own), glossary).select("source", "status", "disagreement", F.col("untranslated").cast("long").alias("untranslated"))


@query(f"""WITH {ENTRIES_SQL} SELECT DISTINCT tbl FROM e WHERE kind = 'master' AND tbl NOT IN (SELECT tbl FROM e WHERE translation <> '' AND tbl IS NOT NULL AND tbl NOT LIKE '%Story%')""")
def missing_tables(spark, d):
    own = entries(spark, d).where("kind = 'master'")
    return memory.missing_tables(own, own.where("translation <> '' AND tbl NOT LIKE '%Story%'"))


_ALIASES = """v AS (SELECT source AS job_id, lang AS category, 'the' AS term, min(doc_id) AS ref FROM documents WHERE lang IN ('en', 'de') GROUP BY 1, 2), a AS (SELECT source AS job_id, doc_id AS row_id, text, doc_id % 5 = 0 AS credit, min(doc_id) OVER (PARTITION BY source, lang) AS head FROM documents WHERE lang IN ('en', 'de'))"""


@query(f"""WITH {_ALIASES} SELECT category, job_id, ref AS row_id, TRUE AS cited FROM v UNION
SELECT v.category, a.job_id, a.row_id, FALSE FROM v JOIN a ON a.job_id = v.job_id AND a.head = v.ref AND a.row_id <> a.head AND NOT credit AND regexp_matches(text, '(^|[^A-Za-z0-9_])the([^A-Za-z0-9_]|$)')""")
def evidence_aliases(spark, d):
    """Rows that candidates cite, and aliases of those that hold the term too."""
    docs = table(spark, d, "documents").where("lang IN ('en', 'de')")
    heads = docs.groupBy(F.col("source").alias("job_id"), F.col("lang").alias("category")).agg(F.min("doc_id").alias("head"))
    valid = heads.select("job_id", "category", F.lit("the").alias("source"), F.array("head").alias("evidence"))
    named = docs.select(F.col("source").alias("job_id"), F.col("lang").alias("category"), F.col("doc_id").alias("row_id"), F.col("text").alias("source"), (F.col("doc_id") % 5 == 0).alias("is_credit"))
    aliases = named.join(heads, ["job_id", "category"]).where("row_id <> head").drop("category")
    return evidence.with_aliases(valid, aliases).select("category", "job_id", "row_id", "cited")


@query("""WITH p AS (SELECT DISTINCT source AS job_id FROM documents), c AS (SELECT DISTINCT source AS job_id FROM documents WHERE doc_id % 30 = 0) SELECT CAST(count(*) AS BIGINT) AS jobs, CAST(count(c.job_id) AS BIGINT) AS completed_jobs, CAST(count(*) - count(c.job_id) AS BIGINT) AS pending_jobs FROM p LEFT JOIN c USING (job_id)""")
def job_progress(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("job_id"), "doc_id")
    return evidence.progress(docs.select("job_id").distinct(), docs.where("doc_id % 30 = 0"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS cache_key, 'other' AS job_id FROM labels WHERE toxic = 1""")
def disagreeing_jobs(spark, d):
    plan = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("cache_key"), F.col("source").alias("job_id"))
    labels = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("cache_key"), "toxic")
    results = labels.join(plan, "cache_key").select("cache_key", F.when(F.col("toxic") == 1, "other").otherwise(F.col("job_id")).alias("job_id"))
    return evidence.disagreeing_jobs(plan, results).select("cache_key", "job_id")


_NAMES = "n AS (SELECT DISTINCT p_name AS source FROM part WHERE p_size = 3), t AS (SELECT DISTINCT p_name AS source FROM part WHERE p_size = 4)"


def _candidates(spark, d):
    part = table(spark, d, "part")
    names = part.where("p_size = 3").select(F.col("p_name").alias("source"), F.lit("name").alias("target")).distinct()
    known = part.where("p_size = 4").select(F.col("p_name").alias("source"), F.lit("term").alias("target")).distinct()
    return evidence.in_glossary(part.select(F.col("p_type").alias("category"), F.col("p_name").alias("source")).distinct(), names, known)


@query(f"""WITH {_NAMES}, c AS (SELECT DISTINCT p_type AS category, p_name AS source FROM part) SELECT category, source, (t.source IS NOT NULL OR n.source IS NOT NULL) AS in_glossary, CASE WHEN t.source IS NOT NULL THEN 'term' WHEN n.source IS NOT NULL THEN 'name' END AS glossary_target FROM c LEFT JOIN n USING (source) LEFT JOIN t USING (source)""")
def candidate_glossary(spark, d):
    """Candidates with what the glossaries hold; terms override names."""
    return _candidates(spark, d).select("category", "source", "in_glossary", "glossary_target")


@query(f"""WITH {_NAMES}, c AS (SELECT DISTINCT p_type AS category, p_name AS source FROM part) SELECT category, CAST(count(*) AS BIGINT) AS candidates, CAST(count(*) FILTER (WHERE source NOT IN (SELECT source FROM n UNION SELECT source FROM t)) AS BIGINT) AS unknown FROM c GROUP BY category""")
def candidates_by_category(spark, d):
    return evidence.by_category(_candidates(spark, d))


@query(f"""WITH {ENTRIES_SQL}, s AS (SELECT source, coalesce(tbl = 'Music' AND field IN ('composer', 'lyricist', 'arranger'), FALSE) AS credit, CASE WHEN source = '鍵' AND tbl GLOB 'Ca*' AND field GLOB '*a*' THEN '键' WHEN source = '鍵' AND tbl GLOB 'C*' THEN '钥匙' ELSE '' END AS asked FROM e WHERE kind = 'master')
SELECT source, CAST(count(DISTINCT asked || CAST(credit AS VARCHAR)) AS BIGINT) AS signatures FROM s GROUP BY source HAVING count(DISTINCT asked || CAST(credit AS VARCHAR)) > 1""")
def conflicting_contexts(spark, d):
    """Sources whose places ask for different scoped terms."""
    rows = entries(spark, d).where("kind = 'master'").drop("speaker")
    policy = [{"source": "鍵", "target": "钥匙", "scope": {"table": "C*"}}, {"source": "鍵", "target": "键", "scope": {"table": "Ca*", "field": "*a*"}}]
    asked = terms.preferences(rows, policy, {}, {"table": F.col("tbl"), "field": F.col("field")}, ["seq"])
    return terms.conflicting_contexts(asked, rows, ["seq"])


@query("""SELECT event_id FROM events WHERE len(list_filter(json_keys(props), lambda k: k NOT IN ('k', 'v'))) > 0 OR event_id % 10 = 0""")
def unknown_record_fields(spark, d):
    """Records with keys that their kind doesn't have."""
    kinds = F.from_json("props", "map<string,string>")
    extra = F.when(F.col("event_id") % 10 == 0, F.map_concat(kinds, F.create_map(F.lit("colour"), F.lit("x")))).otherwise(kinds)
    return readers.unknown_fields(table(spark, d, "events").select("event_id", extra.alias("fields")), "fields", ["k", "v"]).select("event_id")


@query("""WITH r AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN 'scope' WHEN 1 THEN 'source' WHEN 2 THEN 'category' WHEN 3 THEN 'suggestions' WHEN 4 THEN 'evidence' ELSE CASE WHEN p_size % 2 = 0 THEN 'row_id' END END AS reason FROM part) SELECT id, reason FROM r WHERE reason IS NOT NULL""")
def report_shapes(spark, d):
    n = F.col("p_partkey") % 6
    none = F.array().cast("array<string>")
    rows = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.when(n == 0, "x").otherwise("semantic_review_only_no_dictionary_changes").alias("scope"), F.when(n == 1, "").otherwise(F.col("p_name")).alias("source"), F.when(n == 2, "").otherwise("item").alias("category"),
        F.when(n == 3, none).otherwise(F.array("p_brand")).alias("suggested_translations"), F.when(n == 4, none).when(F.col("p_size") % 2 == 0, F.array(F.lit(""))).otherwise(F.array("p_brand")).alias("evidence"),
    )
    # An even size gives an empty row id, which the earlier rules come before.
    return quality.violations(rows, evidence.report_rules()).select("id", "reason")


@query("""SELECT csv FROM (SELECT CAST(doc_id AS VARCHAR) AS csv, doc_id FROM documents) WHERE doc_id % 3 = 1 OR doc_id % 5 = 0""")
def stale_sources(spark, d):
    """Files whose source changed since their footer was written, or is gone."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("csv"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_name"), F.sha2("text", 256).alias("sha"), "doc_id")
    footers = docs.select("csv", "source_name", F.when(F.col("doc_id") % 3 == 1, F.lit("0" * 64)).otherwise(F.col("sha")).alias("source_sha256"))
    files = docs.where("doc_id % 5 <> 0").select(F.concat(F.lit("/data/orig/"), "source_name").alias("path"), F.col("sha").alias("sha256"))
    return readers.stale_sources(footers, files).select("csv")


@query("""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/home/u/work/corpus/' || page_id || '.csv' WHEN 1 THEN '/home/u/' || page_id || '.csv' WHEN 2 THEN 'C:' || chr(92) || 'Users' || chr(92) || 'u' || chr(92) || 'corpus' || chr(92) || page_id ELSE '/data/' || page_id END AS path FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'corpus/' || page_id || '.csv' WHEN 1 THEN page_id || '.csv' WHEN 2 THEN 'corpus/' || page_id ELSE path END AS portable FROM p""")
def portable_paths(spark, d):
    rows = table(spark, d, "pages").selectExpr(
        "page_id", "CASE page_id % 4 WHEN 0 THEN '/home/u/work/corpus/' || page_id || '.csv' WHEN 1 THEN '/home/u/' || page_id || '.csv' WHEN 2 THEN 'C:' || chr(92) || 'Users' || chr(92) || 'u' || chr(92) || 'corpus' || chr(92) || page_id ELSE '/data/' || page_id END AS path"
    )
    return rows.select("page_id", T.portable_path("path", ["corpus", "other"]).alias("portable"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 2 THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def fenced_answers(spark, d):
    """JSON from a model's answers: plain, in a code fence, or in one that was cut off."""
    fence = F.lit("```")
    n = F.col("event_id") % 3
    answer = F.when(n == 0, F.concat(F.lit(" "), "props", F.lit("\n"))).when(n == 1, F.concat(fence, F.lit("json\n"), "props", F.lit("\n"), fence)).otherwise(F.concat(fence, F.lit("json\n"), "props"))
    return table(spark, d, "events").select("event_id", F.coalesce(F.get_json_object(T.fenced_json(answer), "$.k").cast("long"), F.lit(-1)).cast("long").alias("k"))


@query("""SELECT r.conv_id, r.turn FROM conversations r WHERE r.turn % 2 = 1 AND r.role <> 'user'""")
def unanswered_turns(spark, d):
    """Set equality of what was asked and answered: what an answer lacks."""
    asked = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return memory.pending(asked.where("role <> 'user'"), asked.where("turn % 2 = 0"), ["conv_id", "turn"]).select("conv_id", "turn")


@query("""WITH c AS (SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents)
SELECT source, lang, doc_id, CAST((rn - 1) // 3 AS BIGINT) AS part FROM c""")
def field_chunks(spark, d):
    """Rows of each field in chunks, before they are packed."""
    rows = table(spark, d, "documents").select("source", "lang", "doc_id", F.concat_ws("/", "source", "lang").alias("g"))
    return batching.fixed_chunks(rows, "g", "doc_id", 3).select("source", "lang", "doc_id", F.col("chunk").alias("part"))
