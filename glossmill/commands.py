"""What users run: one function for each task, of a session and of paths or frames.

Plans return frames of counts, translations write their logs and return what was done. A service is
any picklable callable of the model seam (see ``operators.model``); nothing here knows a network.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators import batching, documents, evidence, memory, model, planning, quality, review, rounds, terms
from glossmill.operators.quality import Violation, assert_none
from glossmill.session import written
from glossmill.sources import readers, sinks

MEMORY = "source string, translation string"
SCOPED_MEMORY = "tbl string, id string, field string, source string, translation string"
NOTICE_MEMORY = "page string, source string, translation string, policy string"
RESULTS = f"cache_key string, job_id string, status string, n_terms long, rejected_count long, reject_reasons map<string,long>, rejected_candidates array<struct<candidate:{rounds.TERM},reason:string>>, terms array<{rounds.TERM}>"
FIELD = ["tbl", "id", "field"]


def _refusing(inputs: tuple[str, ...], outputs: tuple[str, ...] = ()):
    """The command with its named paths guarded: outputs may not lie within inputs, nor inputs change."""

    def keep(command):
        @wraps(command)
        def run(*args, **named):
            given = signature(command).bind(*args, **named).arguments
            paths = lambda names: [given[n] for n in names if given.get(n)]
            with readers.guarded(given["spark"], paths(inputs), paths(outputs)):
                return command(*args, **named)

        return run

    return keep


def glossary(spark: SparkSession, paths: list[str], strict: bool = False) -> DataFrame:
    """source, target of several dictionaries; later ones override, or with ``strict`` may not differ."""
    out = spark.createDataFrame([], "source string, target string")
    for path in paths:
        later = readers.flat_glossary(spark, path)
        out = memory.merged_or_conflict(out, later, "source", "target") if strict else memory.merged_later_wins(out, later, ["source"])
    return out


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a log, which need not exist yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)
    return readers.log(spark, path, schema) if there else spark.createDataFrame([], f"{schema}, seq long")


def _ask(
    rows: DataFrame, service: model.Service, rules: Callable[[str, str], quality.Rules], key: str, group: str, order: str, max_rows: int, max_chars: int,
    caps: list[int] | None = None, also: tuple[str, ...] = (), **how,
) -> DataFrame:
    """Answers to rows in order-preserving batches, in rounds; key names the column that tells rows apart."""
    sized = rows.withColumn("size", F.length("source").cast("long"))
    numbered = batching.greedy_batches(sized.select(*dict.fromkeys((group, order, key, "size"))), group, order, "size", max_rows, max_chars)
    dealt = sized.join(numbered.select(key, "batch"), key)
    dealt = dealt.withColumn("batch", F.concat_ws("/", F.col(group).cast("string"), F.col("batch").cast("string")))
    return rounds.asked(dealt, service, rules, caps or rounds.halved(max_rows), key, also=also, **how)[0]


# --- dialogue ---------------------------------------------------------------------------------------


def story_plan(spark: SparkSession, path: str, sources: str | None = None, names: list[str] | None = None, prefixes: list[str] | None = None) -> DataFrame:
    """csv, translated, total of every file; files must be whole and written for their sources."""
    rows = readers.dialogue(spark, path, names, prefixes)
    assert_none(readers.story_violations(rows), "rows that break a rule")
    if sources is not None:
        files = spark.read.format("binaryFile").load(sources).select("path", F.sha2("content", 256).alias("sha256"))
        assert_none(readers.stale_sources(readers.story_footer(rows), files), "files written for other sources")
    return memory.coverage(readers.story_rows(rows), "csv", target="trans")


def story_translate(spark: SparkSession, path: str, service: model.Service, sources: str | None = None, names: list[str] | None = None, prefixes: list[str] | None = None, batch_rows: int = 12, max_batches: int = 0) -> DataFrame:
    """csv, status, reason, done, failed, sha256 of every file: its untranslated lines are asked in batches
    and the file is written with what came back.

    Files stand for themselves: one that is broken, stale or changed meanwhile is told as such and left alone,
    the others are written. status: rejected, complete (nothing was open), written, unwritten (no answer held), changed.
    ``max_batches``: batches of a file that are asked, 0 for all.
    """
    hashes = readers.file_hashes(spark, path, "adv_*.csv")
    rows, shapes = readers.dialogue_leniently(spark, path, names, prefixes)
    rows = written(rows.join(hashes, "path"), "dialogue")
    bad = shapes.unionByName(readers.story_violations(rows).groupBy("csv").agg(F.min("reason").alias("reason")))
    if sources is not None:
        stale = readers.stale_sources(readers.story_footer(rows), readers.file_hashes(spark, sources, "*"))
        bad = bad.unionByName(stale.select("csv", F.lit("stale_source").alias("reason")))
    bad = written(bad.groupBy("csv").agg(F.min("reason").alias("reason")), "rejected")
    good = rows.join(bad.select("csv"), "csv", "left_anti")
    open_ = readers.story_rows(good).where("trans = ''")
    chunks = batching.fixed_chunks(open_, "csv", "at", batch_rows)
    if max_batches:
        chunks = chunks.where(F.col("chunk") < max_batches)
    keyed = chunks.select(F.concat_ws("\x1f", "csv", "id").alias("key"), F.col("text").alias("source"), F.concat_ws("/", "csv", F.col("chunk").cast("string")).alias("batch"))
    got, _ = rounds.asked(keyed, service, quality.story_line, rounds.halved(batch_rows), normalise=T.story_normalised)
    part = F.split("key", "\x1f")
    answers = written(got.select(part[0].alias("csv"), part[1].alias("id"), F.col("translation").alias("_new"), F.col("status").alias("_status")), "answers")
    counted = answers.groupBy("csv").agg(F.count_if(F.col("_status") == "done").alias("done"), F.count_if(F.col("_status") == "failed").alias("failed"))
    files = good.groupBy("csv").agg(F.first("path").alias("path"), F.first("sha256").alias("_read")).join(counted, "csv", "left")
    new = {r["path"]: r["_read"] for r in files.where("done > 0").select("path", "_read").collect()}  # a name a file
    filled = good.join(answers.drop("_status"), ["csv", "id"], "left").withColumn("trans", F.when((F.col("trans") == "") & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("trans")))
    made = sinks.dialogue_files(filled.where(F.col("path").isin(*new)), new)
    told = spark.createDataFrame([(p, s, h) for p, (s, h) in made.items()], "path string, _made string, _new_hash string")
    status = F.when(F.col("_made").isNotNull(), F.col("_made")).when(F.coalesce("failed", F.lit(0)) > 0, "unwritten").otherwise("complete")
    zero = F.lit(0).cast("long")
    ready = files.join(told, "path", "left").select("csv", status.alias("status"), F.lit(None).cast("string").alias("reason"), F.coalesce("done", zero).alias("done"), F.coalesce("failed", zero).alias("failed"), F.coalesce("_new_hash", "_read").alias("sha256"))
    return ready.unionByName(bad.select("csv", F.lit("rejected").alias("status"), "reason", zero.alias("done"), zero.alias("failed"), F.lit(None).cast("string").alias("sha256")))


# --- records ----------------------------------------------------------------------------------------


def _records(spark: SparkSession, source: str, target: str) -> DataFrame:
    readers.not_in_progress(spark, source)
    own, held = readers.record_tables(spark, source), readers.record_tables(spark, target)
    assert_none(memory.missing_tables(own, held), "tables without a target")
    return readers.master_entries(own, held).withColumn("may_reflow", quality.may_reflow())


def _memory(rows: DataFrame, log: DataFrame) -> DataFrame:
    """source, translation that may be used again: what tables hold comes first, then the log's first valid row."""
    rules = quality.record_line("source", "translation", F.col("may_reflow"))
    strict = memory.strictest_context(rows.where("source <> ''"))
    held = memory.first_wins(rows.where("translation <> ''").select("source", "translation", "seq"), ["source"], "seq").select("source", "translation")
    told = log.join(strict.select("source", "may_reflow"), "source").where(quality.reason(rules).isNull())
    return memory.merged_existing_wins(held, memory.first_wins(told.select("source", "translation", "seq"), ["source"], "seq").select("source", "translation"), ["source"])


def _record_rules(source: str, target: str) -> quality.Rules:
    return quality.record_line(source, target, F.col("may_reflow"))


@_refusing(("source", "target"))
def master_plan(spark: SparkSession, source: str, target: str, log: str, policy: list[terms.Term] | None = None) -> DataFrame:
    """ready, pending, total: of distinct texts, or with a policy of fields."""
    rows = _records(spark, source, target).where("source <> ''")
    if policy is None:
        known = _memory(rows, _log(spark, log, MEMORY))
        every = rows.select("source").distinct()
        open_ = memory.pending(every, known, ["source"])
    else:
        every = rows.where(~terms.credit_key())
        known = memory.last_wins(_log(spark, log, SCOPED_MEMORY), [*FIELD, "source"], "seq")
        open_ = memory.pending(every.where("translation = ''"), known, [*FIELD, "source"])
    counts = every.agg(F.count(F.lit(1)).alias("total")).join(open_.agg(F.count(F.lit(1)).alias("pending")), F.lit(True))  # one row each
    return counts.select((F.col("total") - F.col("pending")).alias("ready"), "pending", "total")


@_refusing(("source",), ("log",))
def master_translate(spark: SparkSession, source: str, target: str, log: str, service: model.Service, policy: list[terms.Term] | None = None, flat: dict[str, str] | None = None, batch_rows: int = 12, max_chars: int = 1600, write: bool = False) -> DataFrame:
    """Asks for what is pending, appends the answers to the log, and returns the filled entries; with
    ``write`` the target's tables are written with them, each as one document.

    Without a policy every distinct text is asked once; with one, every field by itself, with the
    terms that hold there. Credits are kept as they are and never asked for.
    """
    rows = _records(spark, source, target).where("source <> ''")
    if policy is None:
        known = _memory(rows, _log(spark, log, MEMORY))
        open_ = memory.pending(memory.strictest_context(rows.where(~terms.credit_key())).select("source", "may_reflow"), known, ["source"]).withColumn("key", F.sha2("source", 256))
        got = _ask(open_.withColumn("g", F.substring("key", 1, 2)), service, _record_rules, "key", "g", "key", batch_rows, max_chars, normalise=T.imposed_line_endings, split=True)
        done = open_.join(got.where("status = 'done'"), "key").select("source", "translation")
        sinks.append_log(done, log)
        known = memory.merged_existing_wins(_memory(rows, _log(spark, log, MEMORY)), rows.where(terms.credit_key()).select("source", F.col("source").alias("translation")).distinct(), ["source"])
        held = known.select("source", "translation")
        return _written_tables(memory.fill(rows, held, ["source"], valid=F.lit(True)), target, write)
    known = memory.last_wins(_log(spark, log, SCOPED_MEMORY), [*FIELD, "source"], "seq")
    open_ = memory.pending(rows.where("translation = ''").where(~terms.credit_key()), known, [*FIELD, "source"])
    context = {"kind": F.lit("master"), "table": F.col("tbl"), "id": F.col("id"), "field": F.col("field")}
    lines = open_.drop("speaker", "record", "record_labels", "neighbors").withColumn("key", F.concat_ws("\x1f", *FIELD))
    asked = terms.preferences(lines, policy, flat or {}, context, ["key"])
    preferred = asked.groupBy("key").agg(F.to_json(F.array_sort(F.collect_list(F.struct("term", "target", "action")))).alias("term_preferences"))
    got = _ask(lines.join(preferred, "key", "left"), service, _record_rules, "key", "tbl", "seq", batch_rows, max_chars, also=("term_preferences",), normalise=T.imposed_line_endings, split=True)
    done = lines.join(got.where("status = 'done'").select("key", F.col("translation").alias("answer")), "key").select(*FIELD, "source", F.col("answer").alias("translation"))
    sinks.append_log(done, log)
    known = memory.last_wins(_log(spark, log, SCOPED_MEMORY), [*FIELD, "source"], "seq").select(*FIELD, "source", "translation")
    credits = rows.where(terms.credit_key()).select(*FIELD, "source", F.col("source").alias("translation"))
    return _written_tables(memory.fill(rows, memory.merged_existing_wins(known, credits, [*FIELD, "source"]), [*FIELD, "source"]), target, write)


def _written_tables(filled: DataFrame, target: str, write: bool) -> DataFrame:
    if write:
        filled = written(filled, "filled")  # before what it was read from is replaced
        sinks.record_documents(filled.select("tbl", "id", "field", F.col("translation").alias("source"), "seq"), target)
    return filled


# --- notices ----------------------------------------------------------------------------------------


def _notice_frames(spark: SparkSession, source: str, translations: str, interface: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    texts, held = readers.notices(spark, source), readers.notice_translations(spark, translations)
    assert_none(held.select("page").distinct().join(texts.select("page").distinct(), "page", "left_anti"), "translated pages that don't exist")
    aliases = readers.interface(spark, interface).where("section = 'text'").select("source", "target") if interface else spark.createDataFrame([], "source string, target string")
    return texts.select("page", "source").distinct(), held, aliases


@_refusing(("source", "translations", "interface"), ("output",))
def notice_plan(spark: SparkSession, source: str, translations: str, interface: str | None, log: str, output: str | None = None) -> DataFrame:
    """page, source of what is pending; with ``output`` also a list by page for approval."""
    before = readers.file_hash(spark, source)
    texts, held, aliases = _notice_frames(spark, source, translations, interface)
    known = memory.last_wins(_log(spark, log, NOTICE_MEMORY), ["page", "source"], "seq")
    open_ = memory.pending(documents.pending_notices(texts, held, aliases), known, ["page", "source"])
    if output is not None:
        sinks.pending_list(documents.texts_by_page(open_), output, before)
    if readers.file_hash(spark, source) != before:
        raise Violation(f"{source} changed while it was read")
    return open_


@_refusing(("source", "translations", "interface", "approved"), ("log",))
def notice_translate(spark: SparkSession, source: str, translations: str, interface: str | None, log: str, approved: str, service: model.Service, protect: bool = False) -> DataFrame:
    """Asks for approved texts, appends the answers to the log, returns page, source, translation, filled.

    ``protect``: numbers, addresses and marks are hidden from the service and put back.
    """
    listed = spark.read.schema("page string, sources array<string>, source_sha256 string").json(approved)
    assert_none(listed.where(F.col("source_sha256") != readers.file_hash(spark, source)).select("page"), "approvals of another document")
    allowed = listed.select("page", F.explode("sources").alias("source"))
    open_ = documents.approved_only(notice_plan(spark, source, translations, interface, log), allowed).withColumn("key", F.concat_ws("\x1f", "page", "source"))
    got = _ask(open_, service, quality.notice_line, "key", "page", "key", 12, 1600, mask=P.NOTICE_PROTECTED if protect else None, normalise=T.imposed_line_endings, split=not protect)
    done = open_.join(got.where("status = 'done'").select("key", "translation"), "key")
    sinks.append_log(done.select("page", "source", "translation", F.lit(None).cast("string").alias("policy")), log)
    texts, held, _ = _notice_frames(spark, source, translations, interface)
    known = memory.last_wins(_log(spark, log, NOTICE_MEMORY), ["page", "source"], "seq").join(allowed, ["page", "source"], "left_semi")
    return memory.fill(texts.join(held, ["page", "source"], "left"), known.select("page", "source", "translation"), ["page", "source"])


def notice_repair(spark: SparkSession, source: str, translations: str, interface: str | None, log: str, approved: str, service: model.Service) -> DataFrame:
    """Like notice_translate, for texts whose marks a service doesn't keep: they are hidden from it."""
    return notice_translate(spark, source, translations, interface, log, approved, service, protect=True)


@_refusing(("source", "translations", "initial"), ("log",))
def notice_credit_policy(spark: SparkSession, source: str, translations: str, initial: str, log: str, policy: str, restore: bool = False) -> tuple[DataFrame, DataFrame]:
    """(actions, report): credits keep their names as they are written; new actions go to the log.

    Both tell of the log as it was before: what a frame reads is settled when it is made.
    """
    texts, held, _ = _notice_frames(spark, source, translations, None)
    reviewed = readers.notice_translations(spark, initial)
    assert_none(documents.snapshot_changes(reviewed, held, restore), "reviewed translations that changed")
    latest = memory.last_wins(_log(spark, log, NOTICE_MEMORY), ["page", "source"], "seq")
    actions = documents.credit_actions(texts, reviewed, held, latest, policy, restore)
    report = spark.createDataFrame(documents.credit_report(actions).collect())  # one row
    sinks.append_log(actions.where("to_log").select("page", "source", F.col("target").alias("translation"), F.lit(policy).alias("policy")), log)
    return actions, report


# --- legal texts ------------------------------------------------------------------------------------


@_refusing(("source",))
def legal_targets(spark: SparkSession, source: str, target: DataFrame | None = None) -> DataFrame:
    """Segments of checked rules with their targets: what exists, else empty or kept."""
    rules = readers.legal_rules(spark, source)
    assert_none(quality.violations(rules, documents.legal_source_rules()).select("rule", "reason"), "rules that don't hold together")
    held = spark.createDataFrame([], "rule string, id string, target string") if target is None else target
    return documents.legal_initialised(documents.legal_segments(rules), held)


def legal_translate(spark: SparkSession, source: str, target: DataFrame, service: model.Service) -> DataFrame:
    """Targets with what was pending answered; prefixes, numbers and addresses are hidden from the service.

    A batch is asked once; each of its lines that failed is asked once more, alone."""
    rows = legal_targets(spark, source, target)
    open_ = rows.where("needs AND target = ''").withColumn("key", F.concat_ws("/", "rule", "id"))
    got = _ask(open_.drop("target"), service, quality.legal_line, "key", "rule", "at", 12, 1600, rounds.once_more(12), mask=P.LEGAL_PROTECTED).where("status = 'done'")
    part = F.split("key", "/", 2)
    answers = got.select(part[0].alias("rule"), part[1].alias("id"), F.col("translation").alias("answer"))
    return rows.join(answers, ["rule", "id"], "left").withColumn("target", F.coalesce("answer", "target")).drop("answer")


def legal_compile(spark: SparkSession, source: str, target: DataFrame) -> DataFrame:
    """Whole translations by rule, if nothing is pending."""
    return documents.legal_compiled(legal_targets(spark, source, target))


# --- interfaces -------------------------------------------------------------------------------------


@_refusing(("source", "target", "captures", "curated"))
def interface_pending(spark: SparkSession, source: str, target: str, captures: str, curated: str, mode: str = "stable", reviewed: DataFrame | None = None) -> DataFrame:
    """key, source of what is pending: stable keys, curated variants of keys, or reviewed texts."""
    held = readers.interface(spark, target)
    if mode == "variants":
        wanted = readers.variants(spark, curated)
        return memory.pending(wanted, held.where("section = 'i18n_by_source'"), ["key", "source"])
    if mode == "text":
        if reviewed is None:
            raise Violation("reviewed texts are needed")
        own = readers.interface(spark, source).where("section = 'text'")
        return documents.pending_reviewed(reviewed, own, held.where("section = 'text' AND target <> ''")).select(F.lit("").alias("key"), "source")
    own = readers.interface(spark, source).where("section = 'i18n'").select("key", F.col("target").alias("source"))
    seen = readers.captured(spark, captures).where("kind = 'i18n'")
    varying = terms.varying_keys(seen, "key", "source")
    done = held.where("section = 'i18n' AND target <> ''")
    return documents.pending_stable(own, done, varying, readers.variants(spark, curated).select("key").distinct()).select("key", "source")


def interface_translate(pending: DataFrame, existing: DataFrame, service: model.Service) -> DataFrame:
    """key, source, translation: what exists and new answers to what is pending; what exists wins."""
    open_ = pending.withColumn("id", F.concat_ws("\x1f", "key", "source")).withColumn("g", F.lit("ui"))
    got = _ask(open_, service, quality.interface_line, "id", "g", "id", 16, 1200, normalise=T.interface_normalised)
    good = open_.join(got.where("status = 'done'").select("id", "translation"), "id")
    return memory.merged_existing_wins(existing.select("key", "source", "translation"), good.select("key", "source", "translation"), ["key", "source"])


# --- terms ------------------------------------------------------------------------------------------


def term_audit(entries: DataFrame, policy: list[terms.Term], flat: list[terms.Term]) -> dict[str, DataFrame]:
    """counters, findings, findings_by_type, mentions, variants; policy terms override flat ones."""
    named = {t["source"] for t in policy}
    every = [t for t in flat if t["source"] not in named] + policy
    context = {c: F.col(n) for c, n in (("kind", "kind"), ("table", "tbl"), ("id", "id"), ("field", "field"), ("script", "script"), ("speaker", "speaker"))}
    keys = ["kind", "tbl", "id", "script", "field"]
    found = terms.findings(entries, every, context, keys)
    return {
        "counters": terms.audit_counters(entries.withColumn("_k", F.struct(*keys)), every, context, ["_k"]),
        "findings": found,
        "findings_by_type": terms.findings_by_type(found),
        "mentions": terms.mentions_by_category(entries, every, context),
        "variants": terms.audit_variants(entries, every, context, "seq"),
    }


def extract_candidates(entries: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Candidates of record fields that name something and of speakers, with counts and examples."""
    named = entries.where("kind = 'master'").withColumn("category", planning.category()).where("category IS NOT NULL")
    named = named.select("category", T.candidate_text("source").alias("source"), F.concat_ws("/", "tbl", "field").alias("scope"), "seq")
    said = entries.where("kind = 'story'").select(F.lit("speaker_or_role").alias("category"), T.candidate_text("speaker").alias("source"), F.col("script").alias("scope"), "seq")
    return terms.discovered(named.unionByName(said).where("source IS NOT NULL"), "source", "category", "scope", "seq", known).orderBy("category", "source")


def semantic_plan(entries: DataFrame, tables: list[str] | None = None, prefixes: list[str] | None = None, per_stratum: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(jobs, aliases, coverage) of the eligible entries of a selection."""
    rows = planning.selected(entries.where(planning.eligible()), tables, prefixes)
    heads, aliases = planning.planned(rows, per_stratum)
    return planning.jobs(heads), aliases, planning.coverage(rows)


PLAN = "job_id string, stratum string, lane string, rows array<struct<id:string,source:string,field:string>>, repair_of string"


def semantic_plan_written(jobs: DataFrame, path: str, selection: dict | None = None, parent: dict | None = None) -> dict:
    """Writes a plan with its header, which names its jobs' hash and, of a part, its parent's; returns it."""
    spark = jobs.sparkSession
    jobs = written(spark.createDataFrame([], PLAN).unionByName(jobs, allowMissingColumns=True), "plan")
    counts = planning.counted(jobs)
    header = {"schema_version": 1, "kind": "plan", "jobs_sha256": planning.plan_sha256(jobs), "selection": {**((parent or {}).get("selection") or {}), **(selection or {})}, "coverage": counts}
    if parent:
        header["parent_sha256"] = parent["jobs_sha256"]
        header["coverage"]["parent_jobs"] = parent["coverage"]["jobs"]
    sinks.plan_jobs(jobs, path, header)
    return header


@_refusing(("path",), ("output",))
def semantic_slice(spark: SparkSession, path: str, output: str, tables: tuple[str, ...] = (), prefixes: tuple[str, ...] = (), mode: str = "none") -> dict:
    """Whole jobs of a plan that a slice takes in, with their ids, as a plan of its own; returns its header."""
    parent, jobs = readers.plan(spark, path, PLAN)
    kept = jobs.where(planning.chosen(tuple(tables), tuple(prefixes), mode))
    if kept.isEmpty():
        raise Violation("the slice holds no job")
    return semantic_plan_written(kept, output, {"tables": list(tables), "prefixes": list(prefixes), "mode": mode}, parent)


@_refusing(("path", "log"), ("output",))
def semantic_repair(spark: SparkSession, path: str, log: str, output: str, prompt_hash: str, name: str, status: str = "empty", scope: str = "all", max_rows: int = 4) -> dict:
    """Smaller jobs for the empty or partial results of a plan, as a plan of its own; returns its header."""
    parent, jobs = readers.plan(spark, path, PLAN)
    keyed = jobs.withColumn("cache_key", planning.cache_key(prompt_hash, name, repair_of=F.col("repair_of")))
    held = _log(spark, log, RESULTS).join(keyed.select("cache_key", F.col("job_id").alias("planned")), "cache_key").where("job_id = planned")
    results = held.select("job_id", F.coalesce("status", F.lit("complete")).alias("status"), F.size("terms").cast("long").alias("n_terms"), "seq")
    made = planning.repairs(jobs, results, status, scope, max_rows)
    chosen = {"repair_status": status, "repair_scope": scope, "repair_max_rows": max_rows}
    header = semantic_plan_written(made.withColumn("lane", F.lit("repair")).drop("start"), output, chosen, parent)
    return header


def semantic_extract(jobs: DataFrame, log: str, ask: Callable, prompt_hash: str, name: str) -> DataFrame:
    """Jobs that the log holds no complete result for, asked in rounds under the strict rules of evidence;
    their results go to the log, whose latest row of each job is returned."""
    spark = jobs.sparkSession
    keyed = jobs.withColumn("cache_key", planning.cache_key(prompt_hash, name, repair_of=F.col("repair_of") if "repair_of" in jobs.columns else None))
    held = _log(spark, log, RESULTS)
    done = evidence.latest_complete(held).select("cache_key")
    open_ = keyed.join(done, "cache_key", "left_anti")
    got = rounds.extracted(open_, ask)
    rows = open_.select("job_id", "cache_key").join(got, "job_id").where("status <> 'failed'").withColumn("n_terms", F.size("terms").cast("long"))
    sinks.append_log(rows.select("cache_key", "job_id", "status", "n_terms", "rejected_count", "reject_reasons", "rejected_candidates", "terms"), log)
    return memory.last_wins(_log(spark, log, RESULTS), ["cache_key"], "seq").join(keyed.select("cache_key"), "cache_key", "left_semi")


def semantic_review(jobs: DataFrame, log: str, prompt_hash: str, name: str, names: DataFrame, glossary_terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, unverified rows) of the complete results of a plan; results must agree on their jobs."""
    keyed = jobs.withColumn("cache_key", planning.cache_key(prompt_hash, name, repair_of=F.col("repair_of") if "repair_of" in jobs.columns else None))
    held = _log(jobs.sparkSession, log, RESULTS)
    complete = evidence.latest_complete(held)
    assert_none(evidence.disagreeing_jobs(keyed, complete), "results of other jobs")
    own = complete.join(keyed.select("cache_key"), "cache_key", "left_semi")
    rows = jobs.select("job_id", F.explode("rows").alias("r")).select("job_id", F.col("r.id").alias("row_id"), F.col("r.source").alias("source"), T.is_credit_line("r.source").alias("is_credit"))
    valid = evidence.checked(evidence.candidates(own), rows)
    assert_none(valid.where("reason IS NOT NULL").select("job_id", "at", "reason"), "candidates that break a rule")
    return evidence.in_glossary(evidence.aggregated(valid.drop("reason")), names, glossary_terms), planning.unverified(jobs, held)


def term_review(reports: list[DataFrame], entries: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reconciled candidates, counts by status) of several reports; all have source, category,
    suggestion and evidence. The glossary is flat: a scoped one has no target to compare with."""
    if "scope" in known.columns:
        assert_none(known.where("scope IS NOT NULL AND size(scope) > 0").select("source", "scope"), "terms with a scope")
    out = evidence.reconciled(evidence.united_reports(*reports), evidence.references(entries), known)
    return out, out.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if("disagreement").alias("disagreements"))


def term_review_export(references: DataFrame, unverified: DataFrame, path: str, classifications: DataFrame | None = None, previous: DataFrame | None = None, inputs: dict[str, str] | None = None) -> DataFrame:
    """Writes the package for review; returns its queue."""
    queued = review.queue(references, unverified, classifications)
    sinks.review_package(queued, path, previous, inputs)
    return queued


def suggest_kana(issues: DataFrame, source: DataFrame, target: DataFrame, log: str, service: model.Service, with_conditions: bool = False) -> DataFrame:
    """source, current, locations, suggestion of reported fields; what the log suggests already is kept."""
    spark = issues.sparkSession
    items = planning.kana_items(issues, source, target, with_conditions)
    reflow = F.forall("locations", lambda x: (x["tbl"] == "Story") & (x["field"] == "name"))
    items = items.withColumn("may_reflow", reflow)
    held = readers.suggestions(_log(spark, log, MEMORY), items)
    open_ = memory.pending(items.select("source", "may_reflow"), held, ["source"]).withColumn("key", F.sha2("source", 256)).withColumn("g", F.lit("kana"))
    got = _ask(open_, service, _record_rules, "key", "g", "key", 6, 1400, normalise=T.imposed_line_endings, split=True)
    done = open_.join(got.where("status = 'done'"), "key").select("source", "translation")
    sinks.append_log(done, log)
    told = readers.suggestions(_log(spark, log, MEMORY), items)
    return items.drop("may_reflow").join(told.withColumnRenamed("translation", "suggestion"), "source", "left")


def suggestion_counts(suggested: DataFrame) -> DataFrame:
    """One row: locations, distinct sources, and sources with a suggestion."""
    return suggested.agg(F.sum(F.size("locations")).alias("total"), F.count(F.lit(1)).alias("unique"), F.count("suggestion").alias("suggested"))
