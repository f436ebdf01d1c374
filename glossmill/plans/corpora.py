"""Queries over record and dialogue entries, notices, legal lines and interfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators import batching, documents, evidence, memory, model, planning, quality, review, terms
from glossmill.plans import fixtures as X
from glossmill.plans.fixtures import ENTRIES_SQL, LINES_SQL, entries, lines
from glossmill.plans.register import query
from glossmill.session import table

# --- planning ---------------------------------------------------------------------------------------

_CATEGORY = f"""CASE WHEN field IN ('composer', 'lyricist', 'arranger') THEN NULL WHEN tbl = 'StoryPart' AND field = 'name' AND starts_with(id, 'st-part-group-') THEN 'group'
 WHEN tbl IN ('Music', 'PhotoQuestMusic', 'PhotoContestQuestMusic') AND field = 'singer' AND (source LIKE '%事務所' OR source LIKE '%プロダクション') AND NOT regexp_matches(source, 'with |×|、|/|&') THEN 'agency'
 WHEN field = 'name' AND tbl IN ('Music', 'PhotoQuestMusic', 'PhotoContestQuestMusic') THEN 'song' WHEN tbl = 'EventStory' AND field = 'description' THEN 'event'
 WHEN field = 'name' AND tbl IN ('Story', 'ExtraStory', 'ExtraStoryPart') OR tbl = 'HomeTalk' AND field = 'title' THEN 'story_title' WHEN tbl = 'Card' AND field = 'name' THEN 'card_title'
 WHEN tbl = 'Costume' AND field = 'name' THEN 'costume' WHEN tbl = 'CostumeType' AND field = 'name' THEN 'costume_type' WHEN tbl = 'MessageGroup' AND field = 'name' THEN 'chat_group' END"""
_CREDIT = f"(field IN ('composer', 'lyricist', 'arranger') OR {X.credit_line('source')})"
_PROSE = X.matches("source", P.PROSE_KANA_OR_HAN)
_ELIGIBLE = f"""length({X.trimmed('source')}) <= 1000 AND NOT {_CREDIT} AND CASE WHEN kind = 'master' THEN CASE WHEN ({_CATEGORY}) IS NOT NULL OR {X.ENTITY} THEN {X.is_candidate('source')}
 ELSE length({X.trimmed('source')}) >= 8 AND {_PROSE} END ELSE split_part(field, ':', 2) IN ('text', 'choice', 'narration') AND {X.trimmed('source')} <> '' AND {_PROSE} END"""
_FOCUSED, _NAMES = (", ".join(map(X.quoted, names)) for names in (planning.FOCUSED_TABLES, planning.EXTRA_TABLES))
_INCLUDED = f"(kind = 'story' OR coalesce(tbl IN ({_FOCUSED}), FALSE) OR coalesce(tbl IN ({_NAMES}), FALSE) AND {X.ENTITY} AND {X.is_candidate('source')})"


@query(f"WITH {ENTRIES_SQL} SELECT seq, kind, field FROM e WHERE {_ELIGIBLE}")
def eligible_entries(spark, d):
    return entries(spark, d).where(planning.eligible()).select("seq", "kind", "field")


@query(f"WITH {ENTRIES_SQL} SELECT tbl, field, {_CATEGORY} AS category, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE {_CREDIT}) AS BIGINT) AS credits FROM e WHERE kind = 'master' GROUP BY ALL")
def entry_categories(spark, d):
    rows = entries(spark, d).where("kind = 'master'").withColumn("category", planning.category())
    return rows.groupBy("tbl", "field", "category").agg(F.count(F.lit(1)).alias("n"), F.count_if(planning.is_credit()).alias("credits"))


@query(f"""WITH {ENTRIES_SQL} SELECT CASE WHEN tbl = 'Music' AND field IN ('composer', 'lyricist', 'arranger') THEN 'music_credit' WHEN tbl = 'Music' AND field IN ('name', 'description') THEN 'song'
 WHEN tbl = 'Character' AND field IN ('name', 'firstName', 'lastName', 'fullName') THEN 'character' WHEN tbl LIKE '%Group%' AND field = 'name' THEN 'group' WHEN tbl LIKE '%Event%' AND field = 'name' THEN 'event' ELSE 'text' END AS category,
 CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE tbl = 'Music' AND field IN ('composer', 'lyricist', 'arranger')) AS BIGINT) AS credit_keys FROM e GROUP BY 1""")
def audit_categories(spark, d):
    rows = entries(spark, d).withColumn("category", terms.audit_category())
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if(terms.credit_key()).alias("credit_keys"))


@query("""WITH n AS (SELECT DISTINCT CASE WHEN p_size % 5 = 0 THEN 'IIIX' WHEN p_size % 5 = 1 THEN p_name || 'プロ' WHEN p_size % 5 = 2 THEN '{' || p_name || '}' ELSE p_name END AS source, CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'x' END AS target FROM part WHERE p_size < 25),
b AS (SELECT *, 'speaker_or_role' AS kind FROM n UNION ALL SELECT source || '2', target, 'term' FROM n)
SELECT CASE WHEN source = 'IIIX' THEN 'group' WHEN source LIKE '%プロ' OR source LIKE '%プロダクション' THEN 'agency' ELSE kind END AS category, CASE WHEN source = target THEN 'retain' ELSE 'prefer' END AS action, CAST(count(*) AS BIGINT) AS n
FROM b WHERE NOT regexp_matches(source, '\\{[^{}]+\\}') GROUP BY ALL""")
def glossary_actions(spark, d):
    names = table(spark, d, "part").where("p_size < 25").selectExpr(
        "CASE WHEN p_size % 5 = 0 THEN 'IIIX' WHEN p_size % 5 = 1 THEN p_name || 'プロ' WHEN p_size % 5 = 2 THEN '{' || p_name || '}' ELSE p_name END AS source", "CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'x' END AS target"
    ).distinct()
    found = planning.glossary_terms(names, names.select(F.concat("source", F.lit("2")).alias("source"), "target"))
    return found.groupBy("category", "action").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {ENTRIES_SQL}, s AS (SELECT *, {X.STRATUM} AS stratum, {_INCLUDED} AS inc FROM e) SELECT stratum, CAST(count(*) FILTER (WHERE inc) AS BIGINT) AS selected, CAST(count(*) FILTER (WHERE NOT inc) AS BIGINT) AS excluded,
 CAST(sum(CASE WHEN inc THEN length(source) ELSE 0 END) AS BIGINT) AS selected_chars, CAST(sum(CASE WHEN inc THEN 0 ELSE length(source) END) AS BIGINT) AS excluded_chars FROM s GROUP BY stratum""")
def table_profile_coverage(spark, d):
    return planning.coverage(planning.selected(entries(spark, d)))


@query(f"WITH {ENTRIES_SQL} SELECT seq FROM e WHERE kind = 'story' AND starts_with(script, 'adv_src1') OR coalesce(tbl IN ('Gacha', 'Music'), FALSE)")
def explicit_selection(spark, d):
    return planning.selected(entries(spark, d), tables=["Gacha", "Music"], prefixes=["adv_src1"]).where("included").select("seq")


@query(f"""WITH {ENTRIES_SQL}, s AS (SELECT *, {X.STRATUM} AS stratum FROM e WHERE {_INCLUDED}), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY seq) AS rn FROM s) WHERE rn <= 40),
k AS (SELECT seq, CASE WHEN kind = 'master' THEN tbl || '/' || regexp_replace(field, '\\[[0-9]+\\]', '[]', 'g') || '/' || source ELSE script || '/' || field || '/' || CAST(seq AS VARCHAR) END AS sig, kind FROM f)
SELECT min(seq) AS seq, CAST(count(*) - 1 AS BIGINT) AS aliases FROM k GROUP BY sig""")
def planned_representatives(spark, d):
    """The first rows of each stratum, equal records reduced to one with the others as aliases."""
    own = entries(spark, d).withColumn("record_labels", F.lit(None).cast("map<string,string>"))
    rows = planning.selected(own.withColumn("script", F.concat("script", F.lit("/"), F.col("seq").cast("string"))))
    heads, aliases = planning.planned(rows, 40)
    counted = aliases.groupBy("head").agg(F.count(F.lit(1)).alias("aliases"))
    return heads.select("seq", F.col("row_id").alias("head")).join(counted, "head", "left").select("seq", F.coalesce("aliases", F.lit(0)).cast("long").alias("aliases"))


_PART = "CASE WHEN source LIKE 'src1%' THEN 'Story' ELSE 'Item' END"


@query(f"""WITH RECURSIVE d AS (SELECT {_PART} AS tbl, source AS id, lang AS field, doc_id, text, (row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1) // 4 AS chunk FROM documents),
p AS (SELECT tbl, id, field, chunk, min(doc_id) AS first, count(*) AS k, sum(length(text)) AS size FROM d WHERE tbl = 'Item' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY first) AS rn FROM p),
b AS (SELECT field, id, chunk, rn, 0 AS batch, k AS n, size AS total FROM r WHERE rn = 1 UNION ALL SELECT r.field, r.id, r.chunk, r.rn, CASE WHEN b.n + r.k > 8 OR b.total + r.size > 9000 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.n + r.k > 8 OR b.total + r.size > 9000 THEN r.k ELSE b.n + r.k END,
 CASE WHEN b.n + r.k > 8 OR b.total + r.size > 9000 THEN r.size ELSE b.total + r.size END FROM b JOIN r ON r.field = b.field AND r.rn = b.rn + 1), c AS (SELECT *, count(*) OVER (PARTITION BY field, batch) AS parts FROM b)
SELECT d.doc_id, CASE WHEN d.tbl = 'Story' THEN 'Story/' || d.id WHEN parts = 1 THEN 'Item/' || d.id || '/' || d.field || '/' || CAST(d.chunk AS VARCHAR) ELSE 'Item/' || d.field || '/packed/' || CAST(batch AS VARCHAR) END AS job FROM d LEFT JOIN c ON c.id = d.id AND c.field = d.field AND c.chunk = d.chunk AND d.tbl = 'Item'""")
def packed_record_jobs(spark, d):
    rows = table(spark, d, "documents").selectExpr(f"{_PART} AS tbl", "source AS id", "lang AS field", "doc_id AS seq", "text AS source")
    return planning.packed_jobs(rows, 8, 9000, part_rows=4).select(F.col("seq").alias("doc_id"), "job")


#: Jobs of eight rows of a source.
_JOBBED = "j AS (SELECT *, source || '/' || CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8 AS VARCHAR) AS job_id FROM documents)"


def _jobbed(spark, d):
    rows = batching.fixed_chunks(table(spark, d, "documents").select("doc_id", "source", "lang", "text"), "source", "doc_id", 8)
    return rows.withColumn("job_id", F.concat_ws("/", "source", F.col("chunk").cast("string"))).drop("chunk")


@query(f"""WITH {_JOBBED}, r AS (SELECT source AS stratum, job_id AS job, '[' || string_agg('{{"id":' || to_json(CAST(doc_id AS VARCHAR)) || ',"source":' || to_json(text) || '}}', ',' ORDER BY doc_id) || ']' AS rows FROM j GROUP BY ALL)
SELECT stratum, job, sha256('{{"job":' || rows || ',"model":"m","prompt_sha256":"p","repair_of":null,"schema_version":1}}') AS cache_key, substr(sha256('{{"group":' || to_json(stratum) || ',"kind":"master","rows":' || rows || '}}'), 1, 24) AS job_id FROM r""")
def job_identities(spark, d):
    """Ids and cache keys of jobs: canonical JSON with its keys in order."""
    rows = _jobbed(spark, d).select(F.col("source").alias("stratum"), F.col("job_id").alias("job"), "doc_id", F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("source")).alias("r"))
    jobs = rows.groupBy("stratum", "job").agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "r"))), lambda x: x["r"]).alias("rows"))
    return jobs.select("stratum", "job", planning.cache_key("p", "m").alias("cache_key"), planning.job_id("stratum", "rows").alias("job_id"))


_PLAN = "SELECT job_id, min(doc_id) AS first, CASE WHEN min(doc_id) % 2 = 0 THEN 'master:' || list_extract(['Music', 'Story', 'Item'], 1 + CAST(min(doc_id) % 3 AS INT)) ELSE 'story:adv_' || min(lang) END AS stratum FROM j GROUP BY job_id"


def _plan(spark, d):
    rows = _jobbed(spark, d).groupBy("job_id").agg(F.min("doc_id").alias("first"), F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("source")))).alias("rows"))
    named = F.element_at(F.array(*map(F.lit, ("Music", "Story", "Item"))), (1 + F.col("first") % 3).cast("int"))
    stratum = F.when(F.col("first") % 2 == 0, F.concat(F.lit("master:"), named)).otherwise(F.concat(F.lit("story:adv_"), "lang"))
    return rows.select("job_id", "first", stratum.alias("stratum"), "rows")


@query(f"""WITH {_JOBBED}, p AS ({_PLAN}) SELECT CAST(count(*) FILTER (WHERE stratum IN ('master:Music', 'master:Item')) AS BIGINT) AS tables, CAST(count(*) FILTER (WHERE starts_with(stratum, 'story:adv_e')) AS BIGINT) AS prefixed,
 CAST(count(*) FILTER (WHERE stratum = 'master:Story' OR starts_with(stratum, 'story:')) AS BIGINT) AS narrative, CAST(count(*) FILTER (WHERE stratum IN ('master:Music', 'master:Item')) AS BIGINT) AS independent FROM p""")
def slice_counts(spark, d):
    """How many jobs of a plan each kind of slice holds."""
    plan = _plan(spark, d).drop("rows")
    kinds = {"tables": {"tables": ["Music", "Item"]}, "prefixed": {"prefix": "adv_e"}, "narrative": {"phase": "narrative"}, "independent": {"phase": "independent"}}
    return plan.agg(*(F.count_if(planning.in_slice(**how)).alias(name) for name, how in kinds.items()))


_LOG = "SELECT job_id, doc_id AS seq, CASE doc_id % 4 WHEN 0 THEN 'partial' ELSE 'complete' END AS status, doc_id % 3 AS n_terms FROM j WHERE doc_id % 5 = 1"


def _log(spark, d):
    """What a log holds: one document in five is a result of its job."""
    return _jobbed(spark, d).where("doc_id % 5 = 1").selectExpr("job_id", "doc_id AS seq", "CASE doc_id % 4 WHEN 0 THEN 'partial' ELSE 'complete' END AS status", "doc_id % 3 AS n_terms")


@query(f"""WITH {_JOBBED}, l AS ({_LOG}), m AS (SELECT job_id, arg_max(status, seq) AS status, arg_max(n_terms, seq) AS n FROM l GROUP BY job_id)
SELECT job_id, CASE WHEN status = 'partial' THEN 'partial' ELSE 'empty' END AS state FROM m WHERE status = 'partial' OR n = 0""")
def repair_selection(spark, d):
    plan, log = _plan(spark, d).select("job_id"), _log(spark, d)
    empty = planning.to_repair(plan, log, ("empty",)).withColumn("state", F.lit("empty"))
    return empty.unionByName(planning.to_repair(plan, log, ("partial",)).withColumn("state", F.lit("partial")))


@query(f"""WITH {_JOBBED}, l AS ({_LOG}) SELECT job_id, doc_id AS id FROM j WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.job_id = j.job_id AND l.status <> 'partial')""")
def unverified_rows(spark, d):
    """Rows of jobs without a complete result; partial ones never count."""
    return planning.unverified(_plan(spark, d), _log(spark, d)).select("job_id", "id")


@query(f"""WITH {_JOBBED}, l AS ({_LOG}) SELECT job_id, max(seq) AS seq, arg_max(n_terms, seq) AS n_terms FROM l WHERE status <> 'partial' GROUP BY job_id""")
def latest_complete_results(spark, d):
    log = _log(spark, d).withColumn("cache_key", F.col("job_id")).withColumn("terms", F.struct("n_terms", "seq"))
    return evidence.latest_complete(log).select("job_id", "terms.seq", "terms.n_terms")


@query("""SELECT p_name AS source, min(p_brand) AS current, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY CAST(p_partkey AS VARCHAR)) AS ids, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE p_partkey % 2 = 0) AS BIGINT) AS even
FROM (SELECT *, min(p_brand) OVER (PARTITION BY p_name) AS b FROM part) WHERE p_brand = b AND p_partkey % 3 = 0 AND p_type <> 'PROMO TIN' AND p_partkey % 11 <> 0 GROUP BY p_name""")
def kana_items(spark, d):
    rows = table(spark, d, "part").where("p_type <> 'PROMO TIN'").select(F.when(F.col("p_partkey") % 11 == 0, "ConditionDescription").otherwise("Item").alias("tbl"), F.col("p_partkey").cast("string").alias("id"), F.lit("name").alias("field"), F.col("p_name").alias("source"), "p_brand", "p_partkey")
    lowest = table(spark, d, "part").groupBy(F.col("p_name").alias("source")).agg(F.min("p_brand").alias("p_brand"))
    own = rows.join(lowest, ["source", "p_brand"])
    issues = own.where("p_partkey % 3 = 0").select("tbl", "id", "field")
    found = planning.kana_items(issues, own, own.select("tbl", "id", "field", F.col("p_brand").alias("source")))
    ids = F.transform("locations", lambda x: x["id"])
    even = F.size(F.filter(ids, lambda i: i.cast("long") % 2 == 0)).cast("long")
    return found.select("source", "current", F.array_join(F.array_sort(ids), ",").alias("ids"), F.size(ids).cast("long").alias("total"), even.alias("even"))


# --- rules of lines ---------------------------------------------------------------------------------


def _violations(rules):
    def run(spark, d):
        return quality.violations(lines(spark, d), rules).select("id", "reason")

    return run


def _rule_sql(rules):
    return f"WITH {LINES_SQL}, r AS (SELECT id, {X.chain(rules)} AS reason FROM p) SELECT id, reason FROM r WHERE reason IS NOT NULL"


_STORY = [
    ("empty", "t <> ''"), ("forbidden_character", f"NOT {X.matches('t', chr(91) + chr(92) + 'r' + chr(92) + 'n' + chr(92) + '[' + chr(92) + ']]')}"),
    ("placeholders", f"list_sort({X.found('s', P.STORY_PLACEHOLDER)}) = list_sort({X.found('t', P.STORY_PLACEHOLDER)})"), ("line_breaks", X.same("s", "t", "chr(92) || 'n'")),
]
_NOTICE = [*X.record_rules("s", "t"), ("numbers", f"{X.found('s', P.NUMBER)} = {X.found('t', P.NUMBER)}")]
_BLANK = f"{X.trimmed('s')} = ''"
_LEGAL = [
    ("blank_changed", f"NOT ({_BLANK}) OR s = t"), *((n, f"{_BLANK} OR ({g})") for n, g in X.record_rules("s", "t")),
    ("protected", f"{X.found('s', P.LEGAL_PROTECTED)} = {X.found('t', P.LEGAL_PROTECTED)}"), ("marker_left", f"NOT {X.matches('t', '⟦[0-9]+⟧')}"),
]
_INTERFACE = [("placeholders", f"t = '' OR list_sort({X.found('s', P.RECORD_TOKEN)}) = list_sort({X.found('t', P.RECORD_TOKEN)})"), ("line_breaks", f"t = '' OR {X.same('s', 't', 'chr(10)', 'chr(92) || ' + X.quoted('n'))}")]


@query(_rule_sql(_STORY))
def story_line_violations(spark, d):
    return _violations(quality.story_line("s", "t"))(spark, d)


@query(_rule_sql(_NOTICE))
def notice_line_violations(spark, d):
    return _violations(quality.notice_line("s", "t"))(spark, d)


@query(_rule_sql(_LEGAL))
def legal_line_violations(spark, d):
    return _violations(quality.legal_line("s", "t"))(spark, d)


@query(_rule_sql(_INTERFACE))
def interface_line_violations(spark, d):
    return _violations(quality.interface_line("s", "t"))(spark, d)


@query(f"""WITH {LINES_SQL}, r AS (SELECT id, {X.chain([(n, g + (' OR id % 2 = 0' if n == 'line_breaks' else '')) for n, g in X.record_rules('s', 't')])} AS reason FROM p) SELECT reason, CAST(count(*) AS BIGINT) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def reflowed_titles(spark, d):
    """Record rules where every other line may reflow, as titles of stories may."""
    rows = lines(spark, d).withColumn("tbl", F.when(F.col("id") % 2 == 0, "Story").otherwise("Item")).withColumn("field", F.lit("name"))
    return quality.violations(rows, quality.record_line("s", "t", quality.may_reflow())).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH t AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS source, CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE p_brand END AS target, list_extract(['prefer', 'retain', 'drop'], 1 + CAST(p_partkey % 3 AS INT)) AS action, list_extract(['table', 'field', 'colour'], 1 + CAST(p_size % 3 AS INT)) AS k, CASE WHEN p_size % 4 = 0 THEN '' ELSE '*' END AS v FROM part)
SELECT id, CASE WHEN source = '' THEN 'source' WHEN action = 'drop' THEN 'action' WHEN action = 'retain' AND source <> target THEN 'retain_target' WHEN k = 'colour' THEN 'scope_key' WHEN v = '' THEN 'scope_pattern' END AS reason FROM t
WHERE source = '' OR action = 'drop' OR (action = 'retain' AND source <> target) OR k = 'colour' OR v = ''""")
def policy_term_violations(spark, d):
    rows = table(spark, d, "part").selectExpr(
        "p_partkey AS id", "CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS source", "CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE p_brand END AS target",
        "element_at(array('prefer', 'retain', 'drop'), int(1 + p_partkey % 3)) AS action", "map(element_at(array('table', 'field', 'colour'), int(1 + p_size % 3)), CASE WHEN p_size % 4 = 0 THEN '' ELSE '*' END) AS scope",
    )
    return quality.violations(rows, quality.policy_term()).select("id", "reason")


@query(f"""WITH {LINES_SQL} SELECT id, CAST(len({X.found('s || t', P.STORY_PLACEHOLDER)}) AS BIGINT) AS story, CAST(len({X.found('s || t', P.RECORD_TOKEN)}) AS BIGINT) AS record, CAST(len({X.found('s || t', P.CANDIDATE_PLACEHOLDER)}) AS BIGINT) AS candidate,
 CAST(len({X.found('s || t', P.NOTICE_PROTECTED)}) AS BIGINT) AS notice, CAST(len({X.found('s || t', P.NUMBER)}) AS BIGINT) AS numbers FROM p""")
def placeholder_counts(spark, d):
    both = F.concat("s", "t")
    kinds = {"story": P.STORY_PLACEHOLDER, "record": P.RECORD_TOKEN, "candidate": P.CANDIDATE_PLACEHOLDER, "notice": P.NOTICE_PROTECTED, "numbers": P.NUMBER}
    return lines(spark, d).select("id", *(F.size(T.matches(both, p)).cast("long").alias(n) for n, p in kinds.items()))


@query(f"""WITH {ENTRIES_SQL} SELECT seq, CASE WHEN {X.is_candidate('source')} THEN {X.trimmed('source')} END AS candidate, regexp_replace(field, '\\[[0-9]+\\]', '[]', 'g') AS field, {X.ENTITY} AS entity, {X.credit_line('source')} AS credit, {X.matches('source', P.KANA_OR_HAN)} AS kana FROM e""")
def candidate_texts(spark, d):
    return entries(spark, d).select(
        "seq", T.candidate_text("source", literal_breaks=True).alias("candidate"), T.normal_field("field").alias("field"), F.col("field").rlike(P.ENTITY_FIELD).alias("entity"), T.is_credit_line("source").alias("credit"), T.has_kana_or_han("source").alias("kana")
    )


@query(r"""WITH p AS (SELECT conv_id, turn, replace(text, ' the ', chr(92) || 'n') || '[1]' AS s, replace(text, ' the ', chr(10)) || '[1]' AS t FROM conversations),
q AS (SELECT *, length(t) - length(replace(t, chr(10), '')) AS n, (length(s) - length(replace(s, chr(92) || 'n', ''))) // 2 AS w, (length(t) - length(replace(t, chr(92) || 'n', ''))) // 2 AS v FROM p)
SELECT conv_id, turn, replace(replace(CASE WHEN n > 0 AND w = n + v THEN replace(t, chr(10), chr(92) || 'n') ELSE t END, '[', '［'), ']', '］') AS story,
 CASE WHEN w > 0 AND position(chr(10) IN s) = 0 THEN replace(t, chr(10), chr(92) || 'n') WHEN w = 0 AND position(chr(10) IN s) > 0 THEN replace(t, chr(92) || 'n', chr(10)) ELSE t END AS interface FROM q""")
def model_texts_normalised(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.replace("text", F.lit(" the "), F.lit("\\n")), F.lit("[1]")).alias("s"), F.concat(F.replace("text", F.lit(" the "), F.lit("\n")), F.lit("[1]")).alias("t"))
    return rows.select("conv_id", "turn", T.story_normalised("s", "t").alias("story"), T.interface_normalised("s", "t").alias("interface"))


# --- notices, legal texts, interfaces ---------------------------------------------------------------

_PAGES = """n AS (SELECT source AS page, CASE doc_id % 6 WHEN 0 THEN '2030/1/2 10:00' WHEN 1 THEN '開催中 ' || lang WHEN 2 THEN '作詞・編曲： ' || lang WHEN 3 THEN '作曲：' || CAST(doc_id AS VARCHAR) WHEN 4 THEN lang ELSE '鍵' || CAST(doc_id AS VARCHAR) END AS source, min(doc_id) AS id FROM documents GROUP BY 1, 2)"""


def _notices(spark, d):
    source = "CASE doc_id % 6 WHEN 0 THEN '2030/1/2 10:00' WHEN 1 THEN '開催中 ' || lang WHEN 2 THEN '作詞・編曲： ' || lang WHEN 3 THEN '作曲：' || CAST(doc_id AS STRING) WHEN 4 THEN lang ELSE '鍵' || CAST(doc_id AS STRING) END AS source"
    return table(spark, d, "documents").selectExpr("source AS page", source, "doc_id").groupBy("page", "source").agg(F.min("doc_id").alias("id"))


_OPEN = f"{X.matches('source', P.KANA_OR_HAN)} AND NOT (regexp_matches(source, '[0-9]') AND regexp_matches(source, '^[0-9\\s/\\-:().~〜～年月火水木金土日]+$'))"
_PENDING = f"""SELECT page, source FROM n WHERE {_OPEN} AND id % 3 <> 0 AND source NOT IN ('開催中 en')"""


def _pending(spark, d):
    rows = _notices(spark, d)
    aliases = spark.createDataFrame([("開催中 en", "进行中"), ("開催中 de", "開催中 de")], "source string, target string")
    return documents.pending_notices(rows, rows.where("id % 3 = 0").select("page", "source"), aliases)


@query(f"WITH {_PAGES} {_PENDING}")
def pending_notice_texts(spark, d):
    """Neither translated nor aliased; an alias that is the text itself doesn't count, dates never do."""
    return _pending(spark, d).select("page", "source")


@query(f"""WITH {_PAGES}, o AS ({_PENDING}) SELECT page, string_agg(DISTINCT source, '|' ORDER BY source) AS sources, CAST(count(*) AS BIGINT) AS n FROM o GROUP BY page""")
def notice_texts_by_page(spark, d):
    return documents.texts_by_page(_pending(spark, d)).select("page", F.array_join("sources", "|").alias("sources"), F.size("sources").cast("long").alias("n"))


@query(f"""WITH {_PAGES}, o AS ({_PENDING}) SELECT page, source FROM o WHERE length(source) % 2 = 0""")
def unapproved_notices(spark, d):
    """Pending texts that an approval lacks; the strict form raises on them."""
    rows = _pending(spark, d).select("page", "source")
    return documents.unapproved(rows, rows.where("length(source) % 2 = 1"))


_CREDITS = f"""{_PAGES}, c AS (SELECT page, source, id, replace(replace(source, '作詞', '作词'), '編曲', '编曲') AS wanted FROM n WHERE regexp_matches(source, '^(?:作詞|作曲|編曲)(?:・(?:作詞|作曲|編曲))*[ \\t\\x{{3000}}]*[:：][^\\r\\n]+$')),
a AS (SELECT *, CASE WHEN id % 5 = 0 THEN CASE WHEN id % 2 = 0 THEN wanted ELSE '词：X' END END AS initial, CASE id % 4 WHEN 0 THEN wanted WHEN 1 THEN '旧' END AS current FROM c),
b AS (SELECT page, source, coalesce(initial, wanted) AS target, CASE WHEN initial IS NOT NULL THEN CASE WHEN initial = wanted THEN 'preserved' ELSE 'preserved_conflict' END WHEN current IS NULL THEN 'filled' WHEN current = wanted THEN 'already_correct' ELSE 'changed' END AS action, id FROM a)"""


def _credits(spark, d):
    rows = _notices(spark, d)
    wanted = F.replace(F.replace("source", F.lit("作詞"), F.lit("作词")), F.lit("編曲"), F.lit("编曲"))
    initial = rows.where("id % 5 = 0").select("page", "source", F.when(F.col("id") % 2 == 0, wanted).otherwise("词：X").alias("translation"))
    current = rows.where("id % 4 < 2").select("page", "source", F.when(F.col("id") % 4 == 0, wanted).otherwise("旧").alias("translation"))
    log = rows.where("id % 7 = 0").select("page", "source", wanted.alias("translation"), F.lit("keep").alias("policy"))
    return documents.credit_actions(rows.select("page", "source"), initial, current, log, "keep")


@query(f"WITH {_CREDITS} SELECT page, source, target, action, (id % 7 <> 0 AND NOT starts_with(action, 'preserved')) AS to_log FROM b")
def notice_credits(spark, d):
    return _credits(spark, d)


@query(f"""WITH {_CREDITS} SELECT CAST(count(*) AS BIGINT) AS matched_nodes, CAST(count(*) FILTER (WHERE starts_with(action, 'preserved')) AS BIGINT) AS protected_initial_nodes, CAST(count(*) FILTER (WHERE action = 'preserved_conflict') AS BIGINT) AS initial_policy_conflicts, CAST(0 AS BIGINT) AS restored_initial_nodes,
 CAST(count(*) FILTER (WHERE action = 'changed') AS BIGINT) AS changed_new_nodes, CAST(count(*) FILTER (WHERE action = 'filled') AS BIGINT) AS filled_new_nodes, CAST(count(*) FILTER (WHERE action = 'already_correct') AS BIGINT) AS already_correct_new_nodes, CAST(count(*) FILTER (WHERE id % 7 <> 0 AND NOT starts_with(action, 'preserved')) AS BIGINT) AS log_records_added FROM b""")
def credit_report(spark, d):
    return documents.credit_report(_credits(spark, d))


@query(f"WITH {_PAGES} SELECT page, source FROM n WHERE id % 4 = 1 AND NOT regexp_matches(source, '^作')")
def snapshot_changes(spark, d):
    """Reviewed texts that changed; credits whose names were put back may."""
    rows = _notices(spark, d)
    initial = rows.select("page", "source", F.when(F.col("source").startswith("作"), F.lit("词：Y")).otherwise(F.col("source")).alias("translation"))
    names = F.regexp_extract("source", "[:：](.*)", 1)
    now = F.when(F.col("source").startswith("作"), F.concat(F.lit("词："), names)).when(F.col("id") % 4 == 1, F.lit("x")).otherwise(F.col("source"))
    return documents.snapshot_changes(initial, rows.select("page", "source", now.alias("translation")), restore=True).select("page", "source")


_SEGMENTS = f"""s AS (SELECT CAST(1 + conv_id % 7 AS VARCHAR) AS rule, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, CASE WHEN turn % 3 = 0 THEN '第' || CAST(turn AS VARCHAR) || '条 ' || role ELSE role END AS source, conv_id, turn FROM conversations),
i AS (SELECT rule, id, source, rule <> '6' AND {X.matches('source', P.KANA_OR_HAN)} AS needs, CASE WHEN turn % 2 = 0 THEN CASE WHEN rule <> '6' AND {X.matches('source', P.KANA_OR_HAN)} THEN '译' ELSE source END END AS held FROM s)"""


def _segments(spark, d):
    rows = table(spark, d, "conversations").selectExpr(
        "CAST(1 + conv_id % 7 AS STRING) AS rule", "CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS id", "CASE WHEN turn % 3 = 0 THEN '第' || CAST(turn AS STRING) || '条 ' || role ELSE role END AS source", "turn"
    )
    needs = (F.col("rule") != "6") & T.has_kana_or_han("source")
    existing = rows.where("turn % 2 = 0").select("rule", "id", F.when(needs, "译").otherwise(F.col("source")).alias("target"))
    return documents.legal_initialised(rows.drop("turn"), existing)


@query(f"WITH {_SEGMENTS} SELECT rule, id, needs, coalesce(held, CASE WHEN needs THEN '' ELSE source END) AS target FROM i")
def legal_targets(spark, d):
    return _segments(spark, d).select("rule", "id", "needs", "target")


@query(f"WITH {_SEGMENTS} SELECT rule || '/' || id AS id, source FROM i WHERE needs AND held IS NULL")
def legal_pending(spark, d):
    return documents.legal_pending(_segments(spark, d)).select("id", "source")


@query("""WITH c AS (SELECT conv_id, string_agg(text || chr(10), '' ORDER BY turn) AS whole FROM conversations GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS rule, CASE WHEN conv_id NOT BETWEEN 1 AND 7 THEN 'rule' WHEN conv_id % 3 = 0 THEN 'hash' WHEN conv_id % 3 = 1 THEN 'line_ending' END AS reason FROM c WHERE conv_id NOT BETWEEN 1 AND 7 OR conv_id % 3 < 2""")
def legal_integrity(spark, d):
    ending = F.when(F.col("conv_id") % 3 == 1, F.lit("|")).otherwise(F.lit("\n"))
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.struct(F.col("turn").cast("string").alias("id"), F.col("text").alias("source"), ending.alias("line_ending")).alias("s"))
    whole = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "s"))), lambda x: x["s"]).alias("segments"))
    source = F.array_join(F.transform("segments", lambda s: F.concat(s["source"], F.lit("\n"))), "")
    hashed = F.when(F.col("conv_id") % 3 == 0, F.lit("x")).otherwise(F.sha2(source, 256))
    rules = whole.select(F.col("conv_id").cast("string").alias("rule"), source.alias("source"), hashed.alias("source_sha256"), "segments")
    return quality.violations(rules, documents.legal_source_rules()).select("rule", "reason")


@query("""SELECT p_name AS key, p_partkey AS id FROM part WHERE p_type <> '' AND p_partkey % 3 <> 0 AND p_name NOT IN (SELECT p_name FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 40) AND p_name NOT IN ('small ring', 'red widget')""")
def stable_interface_keys(spark, d):
    part = table(spark, d, "part").select(F.col("p_name").alias("key"), F.col("p_partkey").alias("id"), F.col("p_type").alias("source"), "p_brand")
    varying = part.groupBy("key").agg(F.count_distinct("p_brand").alias("n")).where("n > 40")
    curated = spark.createDataFrame([("small ring",), ("red widget",)], "key string")
    keyed = part.withColumn("key", F.col("key"))
    open_ = documents.pending_stable(keyed.where("id % 3 <> 0"), part.where("id < 0"), varying, curated)
    return open_.select("key", "id")


@query("""SELECT DISTINCT p_name AS source FROM part WHERE p_size % 2 = 0 AND p_name NOT IN (SELECT p_name FROM part WHERE p_size = 11)""")
def reviewed_interface_texts(spark, d):
    part = table(spark, d, "part").select(F.col("p_name").alias("source"), "p_size")
    reviewed = part.withColumn("decision", F.when(F.col("p_size") % 2 == 0, "translate").otherwise("skip"))
    known = part.select("source", F.col("source").alias("target"))
    return documents.pending_reviewed(reviewed, known, part.where("p_size = 11").select("source"))


# --- terms ------------------------------------------------------------------------------------------

_GLOSSARY = [
    {"source": "青い鍵", "target": "蓝钥匙", "category": "item"},
    {"source": "鍵", "target": "钥匙", "category": "word"},
    {"source": "the", "target": "the", "category": "word", "scope": {"table": "M*"}},
]
_SCOPED = [{"source": "鍵", "target": "钥匙", "scope": {"table": "C*"}}, {"source": "鍵", "target": "键", "scope": {"table": "Ca*", "field": "*a*"}}, {"source": "the", "target": "THE", "action": "retain", "scope": {"kind": "story"}}]
_TERMS = "(VALUES (0, '青い鍵', '蓝钥匙', 'item', '*'), (1, '鍵', '钥匙', 'word', '*'), (2, 'the', 'the', 'word', 'M*')) t(term_seq, term, target, term_category, tbl_glob)"
_HELD = "list_contains(regexp_extract_all(source, '青い鍵|the|鍵'), term) AND (term <> 'the' OR regexp_matches(source, '(^|[^A-Za-z0-9_])the([^A-Za-z0-9_]|$)'))"
_AUDIT = f"""{ENTRIES_SQL}, d AS (SELECT * FROM e WHERE translation <> ''), k AS (SELECT *, tbl = 'Music' AND field IN ('composer', 'lyricist', 'arranger') AS credit FROM d),
m AS (SELECT k.*, t.* FROM k JOIN {_TERMS} ON {_HELD} AND coalesce(tbl, '') GLOB tbl_glob WHERE NOT coalesce(credit, FALSE))"""
_MISSED = "(length(term) > 1 OR source = term) AND NOT CASE WHEN target = 'the' THEN regexp_matches(translation, '(^|[^A-Za-z0-9_])the([^A-Za-z0-9_]|$)') ELSE contains(translation, target) END"


def _context():
    return {"table": F.col("tbl"), "field": F.col("field"), "kind": F.col("kind")}


@query(f"""WITH {_AUDIT} SELECT seq, 'music_credit_changed' AS type, NULL AS term, source AS suggestion FROM k WHERE credit AND source <> translation
UNION ALL SELECT seq, 'term_preference_mismatch', term, CASE WHEN source = term THEN target END FROM m WHERE {_MISSED}""")
def audit_findings(spark, d):
    return terms.findings(entries(spark, d), _GLOSSARY, _context(), ["seq"])


@query(f"""WITH {_AUDIT}, f AS (SELECT 'music_credit_changed' AS type FROM k WHERE credit AND source <> translation UNION ALL SELECT 'term_preference_mismatch' FROM m WHERE {_MISSED}) SELECT type, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY type""")
def findings_by_type(spark, d):
    return terms.findings_by_type(terms.findings(entries(spark, d), _GLOSSARY, _context(), ["seq"]))


@query(f"""WITH {_AUDIT} SELECT CAST((SELECT count(*) FROM e) AS BIGINT) AS entries, CAST((SELECT count(*) FROM d) AS BIGINT) AS translated, CAST((SELECT count(*) FROM e WHERE translation = '') AS BIGINT) AS untranslated, CAST((SELECT count(*) FROM k WHERE credit) AS BIGINT) AS music_credit_fields, CAST((SELECT count(DISTINCT seq) FROM m) AS BIGINT) AS entries_with_terms""")
def audit_counters(spark, d):
    return terms.audit_counters(entries(spark, d), _GLOSSARY, _context(), ["seq"])


@query(f"""WITH {_AUDIT} SELECT term_category AS category, CAST(count(*) AS BIGINT) AS mentions FROM m GROUP BY term_category""")
def mentions_by_category(spark, d):
    return terms.mentions_by_category(entries(spark, d), _GLOSSARY, _context())


@query(f"""WITH {_AUDIT}, v AS (SELECT DISTINCT seq, source, translation FROM m), g AS (SELECT source, translation, count(*) AS n FROM v GROUP BY ALL), x AS (SELECT *, row_number() OVER (PARTITION BY source, translation ORDER BY seq) AS rn FROM v)
SELECT g.source, g.translation, CAST(g.n AS BIGINT) AS n, (SELECT string_agg(CAST(seq AS VARCHAR), ',' ORDER BY seq) FROM x WHERE x.source = g.source AND x.translation = g.translation AND rn <= 2) AS examples FROM g WHERE g.source IN (SELECT source FROM g GROUP BY source HAVING count(*) > 1)""")
def audit_variants(spark, d):
    """Variants among translated entries that mention an active term and are no credits."""
    return terms.audit_variants(entries(spark, d), _GLOSSARY, _context(), "seq").select("source", "translation", "n", "examples")


@query(f"""WITH {ENTRIES_SQL} SELECT seq, '鍵' AS term FROM e WHERE source = '鍵' UNION ALL SELECT seq, '青い鍵' FROM e WHERE contains(source, '青い鍵')""")
def one_character_terms(spark, d):
    """A term of one character counts only where it is the whole text."""
    found = terms.mentions(entries(spark, d).select("seq", "source"), _GLOSSARY[:2])
    return found.where(terms.counts()).select("seq", "term")


@query(f"""WITH {ENTRIES_SQL} SELECT seq, array_to_string(list_filter(['the', '鍵', '青い鍵'], lambda k: contains(source || coalesce(' ' || speaker, ''), k)), '|') AS known FROM e""")
def relevant_glossary(spark, d):
    told = F.concat(F.col("source"), F.coalesce(F.concat(F.lit(" "), F.col("speaker")), F.lit("")))
    rows = model.relevant_glossary(entries(spark, d), {"the": "x", "青い鍵": "y", "鍵": "z"}, told)
    return rows.select("seq", F.array_join(F.array_sort(F.map_keys("glossary")), "|").alias("known"))


_POLICY = "(VALUES (0, '鍵', '钥匙', 'C*', '*', '*', 1), (1, '鍵', '键', 'Ca*', '*a*', '*', 2), (2, 'the', 'THE', '*', '*', 'story', 1)) p(term_seq, spelling, target, tbl_glob, field_glob, kind_glob, specificity)"


@query(f"""WITH {ENTRIES_SQL}, a AS (SELECT seq, spelling, arg_max(p.target, specificity) AS target FROM e JOIN {_POLICY} ON CASE WHEN term_seq = 2 THEN kind = 'story' ELSE tbl GLOB tbl_glob AND field GLOB field_glob END
 AND CASE WHEN spelling = 'the' THEN regexp_matches(source, '(^|[^A-Za-z0-9_])the([^A-Za-z0-9_]|$)') ELSE contains(source, spelling) END AND (length(spelling) > 1 OR source = spelling) GROUP BY seq, spelling),
f AS (SELECT seq, g.spelling, g.target FROM e JOIN (VALUES ('鍵', '匙'), ('the', '这')) g(spelling, target) ON CASE WHEN g.spelling = 'the' THEN regexp_matches(source || ' ' || coalesce(speaker, ''), '(^|[^A-Za-z0-9_])the([^A-Za-z0-9_]|$)') ELSE contains(source || ' ' || coalesce(speaker, ''), g.spelling) END
 WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.seq = e.seq AND a.spelling = g.spelling))
SELECT seq, spelling AS term, target, 'policy' AS origin FROM a UNION ALL SELECT seq, spelling, target, 'glossary' FROM f""")
def policy_per_line(spark, d):
    """Scoped terms of each line; a spelling that a policy overrides elsewhere falls back to the flat glossary."""
    found = terms.preferences(entries(spark, d), _SCOPED, {"鍵": "匙", "the": "这", "other": "x"}, _context(), ["seq"])
    return found.select("seq", "term", "target", "origin")


# --- evidence, reviews, memory ----------------------------------------------------------------------

_FOUND = """r AS (SELECT source AS job_id, doc_id AS row_id, text AS text, doc_id % 13 = 0 AS credit FROM documents),
c AS (SELECT job_id, row_id AS "at", CASE row_id % 5 WHEN 0 THEN 'the' WHEN 1 THEN split_part(text, ' ', 1) WHEN 2 THEN '{x}' ELSE 'und' END AS term, CASE WHEN row_id % 6 = 0 THEN 'colour' ELSE 'item' END AS category, CASE row_id % 7 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE row_id END AS ref, row_id, text, credit FROM r),
v AS (SELECT job_id, "at", CASE WHEN NOT (term <> '' AND length(term) <= 80 AND NOT regexp_matches(term, '\\{[^{}]+\\}|<[^<>]+>|\\$[\\p{L}\\p{N}_]+|%[A-Za-z0-9]+|\\\\[nrt]') AND NOT regexp_matches(term, '\\A[^\\p{L}\\p{Nl}\\p{No}]*\\z') AND NOT regexp_matches(term, '\\A[\\p{Nd}\\s\\x{3000}年月日時分秒./:：_-]+\\z') AND regexp_replace(term, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') = term AND length(term) - length(replace(term, chr(10), '')) <= 2 AND NOT regexp_matches(term, '[\\x00-\\x09\\x0B-\\x1F\\x7F]')) THEN 'source_form'
 WHEN category = 'colour' THEN 'category' WHEN ref IS NULL THEN 'missing_evidence' WHEN ref = -1 THEN 'unknown_row' WHEN credit THEN 'credit_row'
 WHEN NOT CASE WHEN regexp_matches(term, '^[A-Za-z0-9]') AND regexp_matches(term, '[A-Za-z0-9]$') THEN regexp_matches(text, '(^|[^A-Za-z0-9_])' || regexp_escape(term) || '([^A-Za-z0-9_]|$)') WHEN regexp_matches(term, '^[A-Za-z0-9]') THEN regexp_matches(text, '(^|[^A-Za-z0-9_])' || regexp_escape(term))
  WHEN regexp_matches(term, '[A-Za-z0-9]$') THEN regexp_matches(text, regexp_escape(term) || '([^A-Za-z0-9_]|$)') ELSE contains(text, term) END THEN 'source_absent' END AS reason FROM c)"""


def _checked(spark, d):
    rows = table(spark, d, "documents").selectExpr("source AS job_id", "CAST(doc_id AS STRING) AS row_id", "text AS source", "doc_id % 13 = 0 AS is_credit", "doc_id")
    term = F.expr("CASE doc_id % 5 WHEN 0 THEN 'the' WHEN 1 THEN substring_index(source, ' ', 1) WHEN 2 THEN '{x}' ELSE 'und' END")
    ref = F.expr("CASE doc_id % 7 WHEN 0 THEN array() WHEN 1 THEN array('-1') ELSE array(row_id) END").cast("array<string>")
    found = rows.select("job_id", F.col("doc_id").alias("at"), term.alias("source"), F.when(F.col("doc_id") % 6 == 0, "colour").otherwise("item").alias("category"), F.lit("x").alias("suggested_translation"), ref.alias("evidence"))
    return evidence.checked(found, rows.drop("doc_id"))


@query(f'WITH {_FOUND} SELECT job_id, "at", reason FROM v')
def evidence_check(spark, d):
    """Candidates against the rows that they cite: null, or the first rule that fails."""
    return _checked(spark, d).select("job_id", "at", "reason")


@query(f"WITH {_FOUND} SELECT job_id, reason, CAST(count(*) AS BIGINT) AS n FROM v WHERE reason IS NOT NULL GROUP BY ALL")
def rejections_by_job(spark, d):
    return evidence.rejections(_checked(spark, d))


@query(f"WITH {_FOUND} SELECT job_id, CAST(count(*) AS BIGINT) AS candidates, CAST(count(reason) AS BIGINT) AS rejected, CASE WHEN count(reason) = 0 THEN 'complete' ELSE 'partial' END AS status FROM v GROUP BY job_id")
def strict_evidence(spark, d):
    """A job's answer counts as complete only if none of its candidates breaks a rule."""
    return evidence.job_status(_checked(spark, d))


@query("""WITH u AS (SELECT p_name AS source, p_brand AS target FROM part WHERE p_size < 20 UNION SELECT p_name, p_brand FROM part WHERE p_size >= 20) SELECT source, CAST(count(*) AS BIGINT) AS targets FROM u GROUP BY source HAVING count(*) > 1""")
def glossary_conflicts(spark, d):
    part = table(spark, d, "part").select(F.col("p_name").alias("source"), F.col("p_brand").alias("target"), "p_size")
    return memory.conflicts(part.where("p_size < 20"), part.where("p_size >= 20"), "source", "target").select("source", F.col("n").alias("targets"))


@query("""WITH x AS (SELECT p_name AS source, p_type AS tbl, p_brand AS field, p_size % 2 = 0 AS may_reflow, row_number() OVER (PARTITION BY p_name ORDER BY p_size % 2 = 0, p_type, p_brand) AS rn FROM part) SELECT source, tbl, field, may_reflow FROM x WHERE rn = 1""")
def strictest_contexts(spark, d):
    rows = table(spark, d, "part").select(F.col("p_name").alias("source"), F.col("p_type").alias("tbl"), F.col("p_brand").alias("field"), (F.col("p_size") % 2 == 0).alias("may_reflow"))
    return memory.strictest_context(rows)


_QUEUE = """t AS (SELECT p_name AS source, CASE WHEN min(p_size) < 5 THEN 'needs_review' ELSE 'glossary_reference' END AS status, count(*) % 2 = 0 AS disagreement, count(DISTINCT p_brand) > 1 AS several FROM part GROUP BY p_name)"""


def _queue(spark, d):
    part = table(spark, d, "part")
    status = F.when(F.min("p_size") < 5, "needs_review").otherwise("glossary_reference")
    references = part.groupBy(F.col("p_name").alias("source")).agg(status.alias("status"), (F.count(F.lit(1)) % 2 == 0).alias("disagreement"), F.array_sort(F.collect_set("p_brand")).alias("suggestions"))
    unverified = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("row_id"), F.col("quality").cast("string").alias("source"))
    classes = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("row_id"), F.lit("toxic").alias("classification"))
    return review.queue(references, unverified, classes)


@query(f"""WITH {_QUEUE} SELECT 'term' AS kind, source, array_to_string(list_filter([CASE WHEN status <> 'glossary_reference' THEN status END, CASE WHEN disagreement THEN 'model_reference_disagreement' END, CASE WHEN several THEN 'several_suggestions' END], lambda x: x IS NOT NULL), '|') AS flags FROM t
UNION ALL SELECT 'coverage', CAST(quality AS VARCHAR), CASE WHEN toxic = 1 THEN 'unverified|toxic' ELSE 'unverified' END FROM labels""")
def review_queue(spark, d):
    return _queue(spark, d).select("kind", "source", F.array_join("flags", "|").alias("flags"))


@query(f"""WITH {_QUEUE}, f AS (SELECT 'term' AS kind, unnest(list_filter([CASE WHEN status <> 'glossary_reference' THEN status END, CASE WHEN disagreement THEN 'model_reference_disagreement' END, CASE WHEN several THEN 'several_suggestions' END], lambda x: x IS NOT NULL)) AS flag FROM t
UNION ALL SELECT 'coverage', 'unverified' FROM labels UNION ALL SELECT 'coverage', 'toxic' FROM labels WHERE toxic = 1), n AS (SELECT 'term' AS kind, count(*) AS items FROM t UNION ALL SELECT 'coverage', count(*) FROM labels)
SELECT 'kind' AS counted, kind AS name, CAST(items AS BIGINT) AS n FROM n UNION ALL SELECT 'flag', flag, CAST(count(*) AS BIGINT) FROM f GROUP BY flag""")
def queue_counts(spark, d):
    return review.queue_counts(_queue(spark, d))


@query("""SELECT CAST(doc_id AS VARCHAR) AS source, CASE WHEN quality = 1 THEN 'translate' ELSE 'retain' END AS decision FROM labels WHERE toxic = 0""")
def selected_reviews(spark, d):
    decision = F.when(F.col("toxic") == 1, "skip").when(F.col("quality") == 1, "translate").otherwise("retain")
    return review.selected(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("source"), decision.alias("decision")))


@query("""SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def not_yet_answered(spark, d):
    log = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "done").otherwise("partial").alias("status"))
    return model.not_yet_done(table(spark, d, "documents").select("doc_id"), log, "doc_id")


@query("""WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) SELECT user_id, event_id, event_type FROM e WHERE rn = 1""")
def latest_of_stream_view(spark, d):
    """The batch view of an append-only log, as its stream keeps it."""
    from glossmill.streaming import logs

    return logs.latest(table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", "ts").select("user_id", "event_id", "event_type")
