"""Queries of the rounds in which a text model is asked: a service that errs by rule, and what came of it."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from glossmill.operators import batching, planning, quality, rounds
from glossmill.plans import corpora
from glossmill.plans.register import query
from glossmill.session import table
from glossmill.sources import readers

_WORD = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z]{2,20}(?![A-Za-z0-9_])")


def _erring(lines: list[dict]) -> dict[str, str]:
    """Adds a bracket to every fifth line unless it is asked alone, and never answers every thirty-fifth."""
    out = {}
    for line in lines:
        n = int(line["id"])
        out[line["id"]] = "" if n % 35 == 0 else f"译{line['source']}" + ("<" if n % 5 == 0 and len(lines) > 1 else "")
    return out


_ASKED = """b AS (SELECT doc_id, count(*) OVER (PARTITION BY source, chunk) AS n FROM (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 12 AS chunk FROM documents)),
x AS (SELECT doc_id, CASE WHEN doc_id % 35 = 0 THEN 'blank' WHEN doc_id % 5 = 0 AND n > 1 THEN 'brackets' END AS reason FROM b)"""


def _rounds(spark, d):
    rows = batching.fixed_chunks(table(spark, d, "documents").select("doc_id", "source", "text"), "source", "doc_id", 12)
    batches = rows.select("doc_id", F.col("text").alias("source"), F.concat_ws("/", "source", F.col("chunk").cast("string")).alias("batch"))
    return rounds.asked(batches, _erring, quality.record_line, rounds.once_more(12), key="doc_id")


@query(f"""WITH {_ASKED} SELECT CAST(0 AS INTEGER) AS round, reason, CAST(count(*) AS BIGINT) AS n FROM x WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 1, 'blank', CAST(count(*) AS BIGINT) FROM x WHERE reason = 'blank' HAVING count(*) > 0""")
def rejections_by_round(spark, d):
    """Answers that broke a rule, by round: a batch at first, then each line that failed alone."""
    return _rounds(spark, d)[1].groupBy("round", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_ASKED} SELECT x.doc_id, CASE WHEN reason = 'blank' THEN NULL ELSE sha256('译' || text) END AS translation_sha256, CASE WHEN reason = 'blank' THEN 'failed' ELSE 'done' END AS status, CAST(CASE WHEN reason IS NULL THEN 0 ELSE 1 END AS INTEGER) AS round FROM x JOIN documents USING (doc_id)""")
def answers_of_rounds(spark, d):
    """Every line with its answer, or as failed, and the round that settled it."""
    return _rounds(spark, d)[0].select("doc_id", F.sha2("translation", 256).alias("translation_sha256"), "status", "round")


def _proposing(rows: list[dict], turn: int) -> list[dict]:
    """The first plain word of the row; for every fourth job also one that stands nowhere, which every
    eighth never takes back; nothing at all for some."""
    n = int(rows[0]["id"])
    if n % 16 == 5:
        raise ValueError("no answer")
    found = _WORD.search(rows[0]["source"])
    term = {"category": "item", "suggested_translation": "x", "evidence": [rows[0]["id"]]}
    out = [{**term, "source": found.group()}] if found else []
    return out + ([{**term, "source": "无此词"}] if n % 8 == 0 or n % 4 == 0 and turn == 0 else [])


@query(r"""WITH x AS (SELECT doc_id, regexp_matches(text, '(^|[^A-Za-z0-9_])[A-Za-z]{2,20}($|[^A-Za-z0-9_])') AS has FROM documents),
s AS (SELECT CASE WHEN doc_id % 16 = 5 THEN 'failed' WHEN doc_id % 8 = 0 THEN 'partial' ELSE 'complete' END AS status, CASE WHEN doc_id % 16 = 5 THEN 1 WHEN doc_id % 8 = 0 THEN 3 WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END AS rounds, has FROM x)
SELECT status, CAST(rounds AS INTEGER) AS rounds, CAST(count(*) AS BIGINT) AS jobs, CAST(count(*) FILTER (WHERE has AND status <> 'failed') AS BIGINT) AS terms, CAST(count(*) FILTER (WHERE status = 'partial') AS BIGINT) AS source_absent FROM s GROUP BY status, rounds""")
def extraction_rounds(spark, d):
    """Jobs of one row under strict evidence: how many rounds they took and what was kept and rejected."""
    row = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("source"))
    jobs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("job_id"), F.array(row).alias("rows"))
    got = rounds.extracted(jobs, _proposing)
    absent = F.sum(F.coalesce(F.try_element_at("reject_reasons", F.lit("source_absent")), F.lit(0)))
    return got.groupBy("status", "rounds").agg(F.count(F.lit(1)).alias("jobs"), F.sum(F.size("terms")).alias("terms"), absent.alias("source_absent"))


# --- repairs, slices, rejections -------------------------------------------------------------------


@query(f"""WITH {corpora._JOBBED}, l AS ({corpora._LOG}), m AS (SELECT job_id, arg_max(status, seq) AS status, arg_max(n_terms, seq) AS n FROM l GROUP BY job_id),
p AS (SELECT job_id, doc_id, (row_number() OVER (PARTITION BY job_id ORDER BY doc_id) - 1) // 3 * 3 AS start FROM j JOIN m USING (job_id) WHERE m.status <> 'partial' AND m.n = 0)
SELECT job_id AS repair_of, CAST(start AS INTEGER) AS start, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids FROM p GROUP BY ALL""")
def repair_jobs(spark, d):
    """Jobs with an empty result as smaller ones of three rows."""
    plan = corpora._plan(spark, d).withColumn("rows", F.transform("rows", lambda r: F.struct(r["id"].cast("string").alias("id"), r["source"].alias("source"))))
    made = planning.repairs(plan, corpora._log(spark, d), "empty", max_rows=3)
    return made.select("repair_of", "start", F.array_join(F.transform("rows", lambda r: r["id"]), ",").alias("ids"))


@query(f"""WITH {corpora._JOBBED}, p AS ({corpora._PLAN}) SELECT stratum, CAST(count(*) AS BIGINT) AS jobs FROM p
WHERE stratum IN ('master:Music', 'master:Story') OR starts_with(stratum, 'story:adv_e') OR starts_with(stratum, 'story:adv_f') GROUP BY stratum""")
def slice_by_stratum(spark, d):
    """Jobs of a slice of narrative tables, a named one and two prefixes, by stratum."""
    kept = corpora._plan(spark, d).where(planning.chosen(("Music",), ("adv_e", "adv_f"), "narrative"))
    return kept.groupBy("stratum").agg(F.count(F.lit(1)).alias("jobs"))


_TABLE = """'{"props": ' || props || ', "kind": {"name": "' || event_type || '", "user": "' || CAST(user_id AS STRING) || '"}' || CASE event_id % 5 WHEN 0 THEN ', "list": [1, 2]' WHEN 1 THEN ', "none": null' ELSE '' END || CASE WHEN event_id % 7 = 0 THEN '' ELSE '}' END"""


@query(f"""WITH t AS (SELECT event_id, CASE WHEN event_id % 11 = 3 THEN '[1]' ELSE {_TABLE.replace('STRING', 'VARCHAR')} END AS v FROM events), g AS (SELECT event_id, v FROM t WHERE json_valid(v)),
r AS (SELECT event_id, key AS id, value AS rec, type FROM (SELECT event_id, unnest(json_keys(v)) AS key, v FROM g WHERE json_type(v) = 'OBJECT') k, LATERAL (SELECT json_extract(k.v, '$.' || k.key) AS value, json_type(json_extract(k.v, '$.' || k.key)) AS type)),
f AS (SELECT event_id, id, field, json_type(json_extract(rec, '$.' || field)) AS type FROM (SELECT event_id, id, rec, unnest(json_keys(rec)) AS field FROM r WHERE type = 'OBJECT'))
SELECT event_id, NULL AS id, NULL AS field, 'malformed' AS reason FROM t WHERE NOT json_valid(v) UNION ALL SELECT event_id, NULL, NULL, 'not_a_table' FROM g WHERE json_type(v) <> 'OBJECT'
UNION ALL SELECT event_id, id, NULL, 'not_a_record' FROM r WHERE type <> 'OBJECT' UNION ALL SELECT event_id, id, field, 'not_text' FROM f WHERE type <> 'VARCHAR'""")
def rejected_records(spark, d):
    """Events as JSON tables of records, some broken: what of each is no text in a record in a table."""
    rows = table(spark, d, "events").selectExpr("event_id", f"CASE WHEN event_id % 11 = 3 THEN '[1]' ELSE {_TABLE} END AS value")
    return readers.rejected_records(rows, "event_id")
