"""Term candidates of a text model: validity against their evidence, aggregation, reconciliation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators.quality import Rules, reason

# Categories that a model may give.
CATEGORIES = (
    "character", "group", "agency", "song", "event", "story_title", "costume", "item", "place", "organization", "other",
)


def candidates(results: DataFrame) -> DataFrame:
    """(job_id, at, source, category, suggested_translation, evidence) of the jobs' term lists."""
    return results.select("job_id", F.posexplode("terms").alias("at", "t")).select("job_id", "at", "t.*")


def _pattern(term: Column | str) -> Column:
    """A term stands in its row as a token: bounded where its edges are ASCII alphanumerics."""
    term = T.col(term)
    escaped = F.concat(F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    left = F.when(term.rlike("^[A-Za-z0-9]"), F.lit(r"(?:(?<![A-Za-z0-9_])|(?<=\\n))")).otherwise(F.lit(""))
    right = F.when(term.rlike("[A-Za-z0-9]$"), F.lit("(?![A-Za-z0-9_])")).otherwise(F.lit(""))
    return F.concat(left, escaped, right)


def _rules(of: Callable[[str], Column], unknown: Column, credits: Column, absent: Column, repeated: Column) -> Rules:
    """The strict rules of a candidate. ``of`` gives its fields; the others say what is wrong with the rows
    that it cites, and whether it was proposed before."""
    source, cited = of("source"), of("evidence")
    return [
        ("source_form", (T.candidate_text(source, literal_breaks=True) == source) & (F.length(source) <= 80) & (T.occurrences(source, "\n") <= 2) & ~source.rlike(r"[\x00-\x09\x0B-\x1F\x7F]")),
        ("category", of("category").isin(*CATEGORIES)),
        ("suggestion", F.length(of("suggested_translation")) <= 120),
        ("missing_evidence", F.size(cited) > 0),
        ("unknown_row", ~unknown),
        ("duplicate_evidence", F.size(F.array_distinct(cited)) == F.size(cited)),
        ("credit_row", ~credits),
        ("source_absent", ~absent),
        ("duplicate_candidate", ~repeated),
    ]


def judged(found: str, rows: str) -> Column:
    """(candidate, reason) of each of a job's candidates, in order, by the rules of ``checked``; null stays null.

    For candidates that lie in one row with the rows that they cite: ``rows`` holds (row_id, source), and
    nothing is shuffled to judge them.
    """

    def one(t: Column, at: Column) -> Column:
        cites = lambda r: F.array_contains(t["evidence"], r["row_id"])
        some = lambda test: F.coalesce(F.exists(rows, lambda r: cites(r) & F.coalesce(test(r), F.lit(False))), F.lit(False))
        known = lambda e: F.exists(rows, lambda r: (r["row_id"] == e) & r["source"].isNotNull())
        same = lambda o: (o["source"] == t["source"]) & (o["category"] == t["category"]) & (o["evidence"] == t["evidence"])
        broken = _rules(
            lambda name: t[name],
            F.exists(t["evidence"], lambda e: ~known(e)),
            some(lambda r: T.is_credit_line(r["source"])),
            some(lambda r: ~F.rlike(r["source"], _pattern(t["source"]))),
            F.exists(F.slice(found, F.lit(1), at), same),
        )
        return F.struct(t.alias("candidate"), reason(broken).alias("reason"))

    return F.transform(found, one)


def checked(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Candidates with ``reason``: null if valid, else the first rule that fails.

    ``rows``: (job_id, row_id, source, is_credit) of what the jobs were asked about.
    """
    asked = rows.select("job_id", F.col("row_id").alias("ref"), F.col("source").alias("row_source"), "is_credit")
    per_ref = found.select("job_id", "at", F.col("source").alias("term"), F.explode_outer("evidence").alias("ref")).join(asked, ["job_id", "ref"], "left")
    per_ref = per_ref.withColumn("_pattern", _pattern("term")).withColumn("_stands", F.expr("row_source rlike _pattern"))
    refs = per_ref.groupBy("job_id", "at").agg(
        F.count_if(F.col("ref").isNotNull() & F.col("row_source").isNull()).alias("unknown"),
        F.count_if(F.coalesce("is_credit", F.lit(False))).alias("credits"),
        F.count_if(F.col("row_source").isNotNull() & ~F.coalesce("_stands", F.lit(False))).alias("absent"),
    )
    seen = found.groupBy("job_id", "source", "category", F.col("evidence")).agg(F.min("at").alias("first"))
    joined = found.join(refs, ["job_id", "at"], "left").join(seen, ["job_id", "source", "category", "evidence"], "left")
    some = lambda c: F.coalesce(c, F.lit(0)) > 0
    rules = _rules(F.col, some("unknown"), some("credits"), some("absent"), F.coalesce(F.col("first"), F.col("at")) != F.col("at"))
    return joined.withColumn("reason", reason(rules)).drop("unknown", "credits", "absent", "first")


def rejections(candidates_checked: DataFrame) -> DataFrame:
    """How many candidates of each job were rejected for each reason."""
    return candidates_checked.where("reason IS NOT NULL").groupBy("job_id", "reason").agg(F.count(F.lit(1)).alias("n"))


def job_status(candidates_checked: DataFrame) -> DataFrame:
    """Candidates and rejections of each job; strictly, an answer is complete only without any."""
    counts = candidates_checked.groupBy("job_id").agg(F.count(F.lit(1)).alias("candidates"), F.count("reason").alias("rejected"))
    return counts.withColumn("status", F.when(F.col("rejected") == 0, "complete").otherwise("partial"))


def latest_complete(log: DataFrame) -> DataFrame:
    """The last result of each cache key, without partial ones."""
    full = log.where(F.coalesce("status", F.lit("complete")) != "partial")
    return full.groupBy("cache_key").agg(F.max_by(F.struct("job_id", "terms"), "seq").alias("r")).select("cache_key", "r.*")


def with_aliases(valid: DataFrame, aliases: DataFrame) -> DataFrame:
    """(category, source, job_id, row_id, cited) of what candidates rest on: the rows that they cite,
    and those of their aliases that hold the term as well and are no credits.

    aliases: job_id, head (the row that stands for it), row_id, source, is_credit.
    """
    cited = valid.select("category", "source", "job_id", F.explode("evidence").alias("row_id"))
    others = cited.withColumnRenamed("row_id", "head").join(aliases.select("job_id", "head", "row_id", F.col("source").alias("row_source"), "is_credit"), ["job_id", "head"])
    held = others.withColumn("_pattern", _pattern("source")).where(F.expr("row_source rlike _pattern") & ~F.col("is_credit"))
    both = cited.withColumn("cited", F.lit(True)).unionByName(held.select("category", "source", "job_id", "row_id", F.lit(False).alias("cited")))
    return both.distinct()


def progress(plan: DataFrame, complete: DataFrame) -> DataFrame:
    """One row: jobs of a plan, those with a complete result, and those without."""
    done = plan.select("job_id").join(complete.select("job_id").distinct().withColumn("done", F.lit(True)), "job_id", "left")
    return done.agg(F.count(F.lit(1)).alias("jobs"), F.count("done").alias("completed_jobs"), (F.count(F.lit(1)) - F.count("done")).alias("pending_jobs"))


def disagreeing_jobs(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose cache key is a job's but whose job id is not. Both: cache_key, job_id."""
    own = plan.select("cache_key", F.col("job_id").alias("planned_id"))
    return results.join(own, "cache_key").where(F.col("job_id") != F.col("planned_id"))


def in_glossary(candidates: DataFrame, names: DataFrame, terms: DataFrame) -> DataFrame:
    """Candidates with in_glossary and glossary_target; terms override names."""
    both = terms.select("source", "target").unionByName(names.select("source", "target").join(terms.select("source"), "source", "left_anti"))
    known = both.select("source", F.col("target").alias("glossary_target"), F.lit(True).alias("in_glossary"))
    return candidates.join(known, "source", "left").withColumn("in_glossary", F.coalesce("in_glossary", F.lit(False)))


def by_category(candidates: DataFrame) -> DataFrame:
    """Candidates of each category, and those that no glossary holds."""
    return candidates.groupBy("category").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(~F.col("in_glossary")).alias("unknown"))


def references(entries: DataFrame) -> DataFrame:
    """(source, target) of the entries that name something, translated or not."""
    return entries.where(F.col("field").rlike(P.ENTITY_FIELD)).select("source", F.col("translation").alias("target"))


def united_reports(*reports: DataFrame) -> DataFrame:
    """Candidates of several reports as one: source, category, suggestion, evidence; evidence that
    occurs twice counts once."""
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    rows = out.groupBy("source", "category", "suggestion").agg(F.array_distinct(F.flatten(F.collect_list("evidence"))).alias("evidence"))
    return rows.withColumn("evidence", F.array_sort("evidence"))


def report_rules() -> list:
    """Rules of a report that is to be reconciled: scope, source, categories, suggestions, evidence."""
    return [
        ("scope", F.col("scope") == "semantic_review_only_no_dictionary_changes"),
        ("source", F.col("source") != ""),
        ("category", F.col("category") != ""),
        ("suggestions", F.size("suggested_translations") > 0),
        ("evidence", F.size("evidence") > 0),
        ("row_id", F.forall("evidence", lambda e: F.coalesce(e != "", F.lit(False)))),
    ]


def aggregated(valid: DataFrame) -> DataFrame:
    """Valid candidates by category and source: counts of suggestions, and evidence in order."""
    suggested = valid.groupBy("category", "source", "suggested_translation").agg(F.count(F.lit(1)).alias("n"))
    votes = suggested.groupBy("category", "source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("suggested_translation", "n")))).alias("suggested_translations"))
    refs = valid.select("category", "source", "job_id", F.explode("evidence").alias("row_id")).distinct()
    evidence = refs.groupBy("category", "source").agg(F.array_sort(F.collect_list(F.struct("job_id", "row_id"))).alias("evidence"))
    return votes.join(evidence, ["category", "source"])


def reconciled(reports: DataFrame, references: DataFrame, glossary: DataFrame) -> DataFrame:
    """Status of each candidate source against references and glossary.

    reports: source, category, suggestion ('' abstains); references: source, target ('' if not
    translated); glossary: source, target.
    """
    asked = reports.groupBy("source").agg(
        F.sort_array(F.collect_set("category")).alias("categories"),
        F.sort_array(F.collect_set(F.when(F.col("suggestion") != "", F.col("suggestion")))).alias("suggestions"),
        F.bool_or(F.col("suggestion") == "").alias("abstains"),
    )
    held = references.groupBy("source").agg(
        F.sort_array(F.collect_set(F.when(F.col("target") != "", F.col("target")))).alias("master_targets"), F.count_if(F.col("target") == "").alias("untranslated")
    )
    known = glossary.groupBy("source").agg(F.sort_array(F.collect_set("target")).alias("glossary_targets"))
    none = F.array().cast("array<string>")
    out = asked.join(held, "source", "left").join(known, "source", "left")
    out = out.withColumns({c: F.coalesce(c, none) for c in ("master_targets", "glossary_targets")}).withColumn("untranslated", F.coalesce("untranslated", F.lit(0)))
    both = F.array_union("master_targets", "glossary_targets")
    status = (
        F.when(F.size(both) > 1, "reference_conflict")
        .when(F.size("glossary_targets") > 0, "glossary_reference")
        .when(F.size("master_targets") > 0, "master_reference")
        .otherwise("needs_review")
    )
    return out.withColumn("status", status).withColumn("disagreement", (F.size(both) > 0) & (F.size(F.array_except("suggestions", both)) > 0))
