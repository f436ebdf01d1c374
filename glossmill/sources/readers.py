"""Readers of the corpora, each into one flat frame; nothing is inferred.

Map order and repeated keys follow the documents (the last of a repeated key wins).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.operators.quality import Violation, assert_none, policy_term, record_line, story_line
from glossmill.operators.quality import reason as rule_broken

ENTRIES = (
    "kind string, tbl string, id string, script string, csv string, field string, source string, translation string, speaker string,"
    " record_labels map<string,string>, neighbors array<struct<field:string,speaker:string,source:string,translation:string>>, seq long"
)
STORY = "id string, name string, text string, trans string"
FOOTER = ("info", "译者")


def _base(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _path_order(path: Column) -> Column:
    """Component-wise order of paths."""
    return F.split(path, "/")


def dialogue(spark: SparkSession, path: str, names: list[str] | None = None, prefixes: list[str] | None = None) -> DataFrame:
    """All rows of dialogue CSV files, footers included: csv, at, id, name, text, trans ('' for none).

    Files are those of the given names, each once and all of them there, or those whose names begin
    with one of the prefixes, or all.
    """
    if names and prefixes:
        raise Violation("files are chosen by name or by prefix")
    if names and (len(set(names)) < len(names) or not all(n.startswith("adv_") and n.endswith(".csv") and "/" not in n for n in names)):
        raise Violation("each name is one adv_*.csv file, given once")
    # columnNameOfCorruptRecord is not asked for: a row of another shape fails the read.
    raw = (
        spark.read.schema(STORY)
        .options(header=True, enforceSchema=False, multiLine=True, quote='"', escape='"', mode="FAILFAST", pathGlobFilter="adv_*.csv", recursiveFileLookup=True)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    )
    rows = raw.select(_base(F.col("path")).alias("csv"), "path", "at", *(F.coalesce(c, F.lit("")).alias(c) for c in ("id", "name", "text", "trans")))
    if names:
        found = {r["csv"] for r in rows.where(F.col("csv").isin(*names)).select("csv").distinct().collect()}
        if found != set(names):
            raise Violation(f"no such files: {sorted(set(names) - found)}")
        return rows.where(F.col("csv").isin(*names))
    if prefixes:
        chosen = F.lit(False)
        for prefix in prefixes:
            chosen = chosen | F.col("csv").startswith(prefix)
        return rows.where(chosen)
    return rows


def dialogue_leniently(spark: SparkSession, path: str, names: list[str] | None = None, prefixes: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): the rows of ``dialogue`` of files that are whole, and csv, reason of those that
    aren't: a row of another shape, or another header. Names that don't exist are rejected as missing."""
    if names and prefixes:
        raise Violation("files are chosen by name or by prefix")
    kind = f"{STORY}, _corrupt string"
    raw = (
        spark.read.schema(kind)
        .options(header=False, multiLine=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", pathGlobFilter="adv_*.csv", recursiveFileLookup=True)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    )
    rows = raw.withColumn("csv", _base(F.col("path")))
    if names:
        rows = rows.where(F.col("csv").isin(*names))
    if prefixes:
        rows = rows.where(F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.startswith("csv", p)))
    header = F.struct("id", "name", "text", "trans")
    wanted = F.struct(*(F.lit(c.split()[0]).alias(c.split()[0]) for c in STORY.split(", ")))
    files = rows.groupBy("csv").agg(F.min("at").alias("first"), F.min_by(header, "at").alias("head"), F.count_if(F.col("_corrupt").isNotNull()).alias("bad"))
    reason = F.when(F.col("bad") > 0, "shape").when(F.col("head") != wanted, "header")
    rejected = files.select("csv", reason.alias("reason")).where("reason IS NOT NULL")
    if names:
        listed = spark.createDataFrame([(n,) for n in names], "csv string")
        rejected = rejected.unionByName(listed.join(files, "csv", "left_anti").select("csv", F.lit("missing").alias("reason")))
    good = rows.join(files.where(reason.isNull()).select("csv", "first"), "csv").where("at > first")
    return good.select("csv", "path", "at", *(F.coalesce(c, F.lit("")).alias(c) for c in ("id", "name", "text", "trans"))), rejected


def story_rows(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("id").isin(*FOOTER))


def story_footer(rows: DataFrame) -> DataFrame:
    """csv, source_name, source_sha256, translator."""
    info, by = F.col("id") == FOOTER[0], F.col("id") == FOOTER[1]
    return rows.where(info | by).groupBy("csv").agg(
        F.max(F.when(info, F.col("name"))).alias("source_name"), F.max(F.when(info, F.col("text"))).alias("source_sha256"), F.max(F.when(by, F.col("name"))).alias("translator")
    )


def story_violations(rows: DataFrame) -> DataFrame:
    """Body rows of a wrong shape or with a translation that breaks a rule, and files without a
    proper footer: csv, id, reason."""
    body = story_rows(rows)
    broken = F.when(F.col("trans") != "", rule_broken(story_line("text", "trans")))
    reason = F.when(~F.col("id").rlike(P.FIELD_ID), "field_id").when(F.col("text") == "", "empty_text").otherwise(broken)
    bad = body.select("csv", "id", reason.alias("reason")).where("reason IS NOT NULL")
    twice = body.groupBy("csv", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("csv", "id", F.lit("repeated_id").alias("reason"))
    files = rows.select("csv").distinct().join(story_footer(rows), "csv", "left")
    named = F.col("source_name") == F.regexp_replace("csv", r"\.csv$", ".txt")
    wrong = files.where(~F.coalesce(F.col("source_sha256").rlike(P.HASH) & named & F.col("translator").isNotNull(), F.lit(False))).select("csv", F.lit(FOOTER[0]).alias("id"), F.lit("footer").alias("reason"))
    return bad.unionByName(twice).unionByName(wrong)


def story_entries(spark: SparkSession, path: str) -> DataFrame:
    """Story entries with the rows before and after each."""
    rows = story_rows(dialogue(spark, path))
    assert_none(rows.groupBy("path", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated ids in a file")
    w = Window.partitionBy("path").orderBy("at")
    here = F.struct(F.col("id").alias("field"), F.col("name").alias("speaker"), F.col("text").alias("source"), F.col("trans").alias("translation"))
    none = F.lit(None).cast("string")
    return rows.select(
        F.lit("story").alias("kind"),
        none.alias("tbl"),
        none.alias("id"),
        F.regexp_replace("csv", r"\.csv$", ".txt").alias("script"),
        "csv",
        F.col("id").alias("field"),
        F.col("text").alias("source"),
        F.col("trans").alias("translation"),
        F.col("name").alias("speaker"),
        F.lit(None).cast("map<string,string>").alias("record_labels"),
        F.array_compact(F.array(F.lag(here).over(w), F.lead(here).over(w))).alias("neighbors"),
        F.col("at").alias("seq"),
    )


def _whole(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    return spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))


def _parsed(whole: DataFrame, kind: str) -> DataFrame:
    return whole.select("path", F.from_json("value", kind, {"mode": "FAILFAST"}).alias("v"))


def record_tables(spark: SparkSession, path: str) -> DataFrame:
    """tbl, id, field, source, record (all fields), seq of a folder of record tables."""
    tables = _parsed(_whole(spark, path), "map<string,map<string,string>>").select(F.regexp_replace(_base(F.col("path")), r"\.json$", "").alias("tbl"), "v")
    # A repeated key keeps its first place and its last value, as a dictionary does.
    records = tables.select("tbl", F.posexplode("v").alias("r", "id", "record")).groupBy("tbl", "id").agg(F.min("r").alias("first"), F.max_by("record", "r").alias("record"))
    fields = records.select("tbl", "id", "first", "record", F.posexplode("record").alias("f", "field", "source"))
    seq = F.col("first").cast("long") * (1 << 20) + F.col("f")
    return fields.groupBy("tbl", "id", "field").agg(F.max_by("source", "f").alias("source"), F.first("record").alias("record"), F.min(seq).alias("seq"))


def rejected_records(documents: DataFrame, key: str, text: str = "value") -> DataFrame:
    """key, id, field, reason of what is no table of records in JSON texts: malformed (the text itself),
    not_a_table, not_a_record (of an id), not_text (of its field). A text without rejections gives no row."""
    spark = documents.sparkSession
    parsed = documents.select(F.col(key).alias("_key"), F.try_parse_json(F.col(text)).alias("_v"))
    kind = lambda c: F.regexp_extract(F.schema_of_variant(c), "^[A-Z]+", 0)
    none = F.lit(None).cast("string")
    is_table = kind(F.col("_v")) == "OBJECT"
    whole = F.when(F.col("_v").isNull(), "malformed").when(~is_table, "not_a_table")
    texts = parsed.select("_key", none.alias("id"), none.alias("field"), whole.alias("reason")).where("reason IS NOT NULL")
    tables = parsed.where(F.col("_v").isNotNull() & is_table)
    records = spark.sql("SELECT _key, r.key AS id, r.value AS _r FROM {t}, LATERAL variant_explode(_v) AS r", t=tables)
    is_record = F.col("_r").isNotNull() & (kind(F.col("_r")) == "OBJECT")
    others = records.where(~is_record).select("_key", "id", none.alias("field"), F.lit("not_a_record").alias("reason"))
    fields = spark.sql("SELECT _key, id, f.key AS field, f.value AS _f FROM {r}, LATERAL variant_explode(_r) AS f", r=records.where(is_record))
    wrong = fields.where(F.col("_f").isNull() | (kind(F.col("_f")) != "STRING")).select("_key", "id", "field", F.lit("not_text").alias("reason"))
    return texts.unionByName(others).unionByName(wrong).withColumnRenamed("_key", key)


def record_tables_leniently(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(fields, rejected): ``record_tables`` of what holds, and path, id, field, reason of what doesn't.

    A malformed document loses all, a record or a field of a wrong kind only itself."""
    whole = _whole(spark, path)
    rejected = rejected_records(whole, "path")
    bad = rejected.where("id IS NULL").select("path")
    good = whole.join(bad, "path", "left_anti").select("path", F.from_json("value", "map<string,string>").alias("v"))
    tables = good.select(F.regexp_replace(_base(F.col("path")), r"\.json$", "").alias("tbl"), "path", F.posexplode("v").alias("r", "id", "text"))
    tables = tables.join(rejected.where("id IS NOT NULL AND field IS NULL").select("path", "id"), ["path", "id"], "left_anti")
    records = tables.withColumn("record", F.from_json("text", "map<string,string>")).groupBy("tbl", "path", "id").agg(F.min("r").alias("first"), F.max_by("record", "r").alias("record"))
    fields = records.select("tbl", "path", "id", "first", F.posexplode("record").alias("f", "field", "source"))
    fields = fields.join(rejected.where("field IS NOT NULL").select("path", "id", "field"), ["path", "id", "field"], "left_anti")
    seq = F.col("first").cast("long") * (1 << 20) + F.col("f")
    return fields.groupBy("tbl", "id", "field").agg(F.max_by("source", "f").alias("source"), F.min(seq).alias("seq")), rejected


def master_entries(source: DataFrame, target: DataFrame | None) -> DataFrame:
    """Record entries with what is translated ('' if not)."""
    if target is not None:
        held = target.select("tbl", "id", "field", F.col("source").alias("translation"))
        source = source.join(held, ["tbl", "id", "field"], "left")
    else:
        source = source.withColumn("translation", F.lit(""))
    labels = F.map_filter("record", lambda k, v: k.isin("name", "fullName", "singer") & (v != ""))
    none = F.lit(None).cast("string")
    neighbors = F.array().cast("array<struct<field:string,speaker:string,source:string,translation:string>>")
    return source.select(
        F.lit("master").alias("kind"), "tbl", "id", none.alias("script"), none.alias("csv"), "field", "source", F.coalesce("translation", F.lit("")).alias("translation"),
        none.alias("speaker"), labels.alias("record_labels"), neighbors.alias("neighbors"), "seq",
    )


def flat_glossary(spark: SparkSession, path: str) -> DataFrame:
    """source, target of a JSON dictionary; neither may be empty."""
    rows = _parsed(_whole(spark, path, "*"), "map<string,string>").select(F.explode("v").alias("source", "target"))
    assert_none(rows.where("source = '' OR coalesce(target, '') = ''"), "empty glossary entries")
    return rows


def policy(spark: SparkSession, path: str) -> DataFrame:
    """Scoped terms of a policy file: source, target, category, action, scope; each meets the rules of a term."""
    kind = "struct<schema_version:int,terms:array<struct<source:string,target:string,category:string,action:string,scope:map<string,string>>>>"
    rows = _parsed(_whole(spark, path, "*"), kind)
    assert_none(rows.where("v.schema_version IS DISTINCT FROM 1").select("path"), "unknown schema versions")
    terms = rows.select(F.posexplode("v.terms").alias("seq", "t")).select("seq", "t.*")
    assert_none(terms.select("seq", "source", rule_broken(policy_term()).alias("reason")).where("reason IS NOT NULL"), "terms of a wrong shape")
    return terms


def notices(spark: SparkSession, path: str) -> DataFrame:
    """page, at, source: the title (at -1) and texts of each page."""
    rows = _parsed(_whole(spark, path, "*"), "struct<pages:map<string,struct<title:string,texts:array<string>>>>").select(F.explode("v.pages").alias("page", "p"))
    assert_none(rows.where(~F.col("page").rlike(P.NOTICE_PAGE) | (F.size(F.array_distinct("p.texts")) != F.size("p.texts"))).select("page"), "pages of a wrong shape")
    title = rows.select("page", F.lit(-1).alias("at"), F.col("p.title").alias("source")).where("source <> ''")
    return title.unionByName(rows.select("page", F.posexplode("p.texts").alias("at", "source")))


def notice_translations(spark: SparkSession, path: str) -> DataFrame:
    rows = _parsed(_whole(spark, path, "*"), "struct<pages:map<string,map<string,string>>>")
    return rows.select(F.explode("v.pages").alias("page", "p")).select("page", F.explode("p").alias("source", "translation"))


def legal_rules(spark: SparkSession, path: str) -> DataFrame:
    kind = "struct<schema_version:int,rules:map<string,struct<rule_type:int,category:string,source:string,source_sha256:string,segments:array<struct<id:string,source:string,line_ending:string>>>>>"
    return _parsed(_whole(spark, path, "*"), kind).select(F.explode("v.rules").alias("rule", "r")).select("rule", "r.*")


def interface(spark: SparkSession, path: str) -> DataFrame:
    """section, key, source, target of an interface dictionary; key is '' in the section text."""
    kind = "struct<text:map<string,string>,i18n:map<string,string>,i18n_by_source:map<string,map<string,string>>>"
    rows = _parsed(_whole(spark, path, "*"), kind)
    text = rows.select(F.explode("v.text").alias("source", "target")).select(F.lit("text").alias("section"), F.lit("").alias("key"), "source", "target")
    keyed = rows.select(F.explode("v.i18n").alias("key", "target")).select(F.lit("i18n").alias("section"), "key", F.lit("").alias("source"), "target")
    by = rows.select(F.explode("v.i18n_by_source").alias("key", "m")).select("key", F.explode("m").alias("source", "target"))
    return text.unionByName(keyed).unionByName(by.select(F.lit("i18n_by_source").alias("section"), "key", "source", "target"))


def variants(spark: SparkSession, path: str) -> DataFrame:
    """key, source of curated variants; each key has two distinct non-empty ones at least."""
    rows = _parsed(_whole(spark, path, "*"), "map<string,array<string>>").select(F.explode("v").alias("key", "sources"))
    good = (F.size(F.array_distinct("sources")) == F.size("sources")) & (F.size("sources") >= 2) & ~F.array_contains("sources", "")
    assert_none(rows.where(~good), "variants of a wrong shape")
    return rows.select("key", F.explode("sources").alias("source"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line (from 1), value: true line numbers of text files that are read in splits.

    The lines of each split are counted first; a running sum over a file's splits, of which there are few,
    then gives where each begins. No file goes through one task.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    splits = lines.groupBy("path", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = splits.withColumn("before", before).drop("n")
    return lines.join(placed, ["path", "block"]).select("path", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "value")


def captured(spark: SparkSession, path: str) -> DataFrame:
    """kind, key, source, original, recovered, at (the line's number in its file) of a capture dump; NULs
    before a line are dropped."""
    lines = numbered_lines(spark, path).where("value <> ''")
    clean = F.regexp_replace("value", r"^\x00+", "")
    rows = lines.select(F.from_json(clean, "kind string, key string, source string").alias("v"), F.col("value").alias("original"), (clean != F.col("value")).alias("recovered"), F.col("line").alias("at"), "path")
    bad = rows.where(~F.coalesce(F.col("v.kind").isin("text", "i18n"), F.lit(False)) | F.col("v.source").isNull())
    assert_none(bad.select("path", F.col("at").alias("line"), "original"), "capture lines of a wrong shape")
    return rows.select("v.*", "original", "recovered", "at")


def candidate_list(spark: SparkSession, path: str) -> DataFrame:
    """source, occurrences, category, bucket of a list of texts to be reviewed."""
    kind = "struct<audit_schema_version:int,scope:string,texts:array<struct<source:string,occurrences:bigint,category:string,bucket:string>>>"
    rows = _parsed(_whole(spark, path, "*"), kind)
    assert_none(rows.where("NOT coalesce(v.audit_schema_version = 2 AND v.scope = 'local_review_only_no_automatic_translation', false)").select("path"), "outdated candidate lists")
    texts = rows.select(F.explode("v.texts").alias("t")).select("t.*")
    good = (F.col("source") != "") & (F.col("category") == "still_unmatched") & F.substring_index("bucket", "_", 1).isin("kana", "han") & (F.col("occurrences") >= 1)
    assert_none(texts.where(~F.coalesce(good, F.lit(False))), "candidates of a wrong shape")
    assert_none(texts.groupBy("source").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "candidates that occur twice")
    return texts


def reviewed_texts(spark: SparkSession, candidates_path: str, path: str) -> DataFrame:
    """Reviewed texts that were not skipped; the review must match its list row for row."""
    from glossmill.operators.review import selected, unmatched_reviews

    kind = "struct<scope:string,candidate_sha256:string,entries:array<struct<source:string,occurrences:bigint,decision:string,translation:string>>>"
    rows = _parsed(_whole(spark, path, "*"), kind)
    held = file_hash(spark, candidates_path)
    assert_none(rows.where(~F.coalesce((F.col("v.scope") == "runtime_text_human_review") & (F.col("v.candidate_sha256") == held), F.lit(False))).select("path"), "reviews of another list")
    entries = rows.select(F.explode("v.entries").alias("e")).select("e.*")
    shape = [
        ("shape", (F.col("source") != "") & (F.col("occurrences") >= 1) & F.col("decision").isin("skip", "translate", "retain") & F.col("translation").isNotNull()),
        ("kept_is_translated", (F.col("decision") == "translate") | (F.col("translation") == "")),
        *((name, (F.col("translation") == "") | good) for name, good in record_line("source", "translation")),
    ]
    assert_none(entries.select("*", rule_broken(shape).alias("reason")).where("reason IS NOT NULL"), "review rows that break a rule")
    assert_none(unmatched_reviews(candidate_list(spark, candidates_path), entries), "reviews that don't match their list")
    return selected(entries)


def plan_jobs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Jobs of a plan; their ids occur once."""
    jobs = spark.read.schema(schema).json(path)
    assert_none(jobs.groupBy("job_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "job ids that occur twice")
    return jobs


def plan(spark: SparkSession, path: str, schema: str) -> tuple[dict, DataFrame]:
    """(header, jobs) of a plan with a header, which must be of these jobs."""
    from glossmill.operators.planning import plan_sha256

    lines = spark.read.text(f"{path}.header", wholetext=True).limit(2).collect()
    header = json.loads(lines[0]["value"]) if len(lines) == 1 else {}
    if header.get("schema_version") != 1 or header.get("kind") != "plan":
        raise Violation(f"{path} has no header of a plan")
    jobs = plan_jobs(spark, path, schema)
    if header.get("jobs_sha256") != plan_sha256(jobs):
        raise Violation(f"{path} is not what its header was written for")
    return header, jobs


def suggestions(logged: DataFrame, items: DataFrame) -> DataFrame:
    """source, translation: the last suggestion of each item that still exists and is still valid.

    logged: source, translation, seq; items: source, may_reflow."""
    rows = logged.join(items.select("source", "may_reflow"), "source")
    valid = rows.where(rule_broken(record_line("source", "translation", F.col("may_reflow"))).isNull())
    return valid.groupBy("source").agg(F.max_by("translation", "seq").alias("translation"))


# The instructions that each kind of work is given unless others are named.
PROMPTS = {
    "story": "default", "record": "master", "notice": "notice", "notice_repair": "notice-protected", "legal": "legal", "interface": "ui",
    "extraction": "term-extraction", "suggestion": "master-kana-review",
}


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    """name, text, sha256 of the instructions for a text model in a folder of .txt files."""
    whole = _whole(spark, folder, "*.txt")
    return whole.select(F.regexp_replace(_base(F.col("path")), r"\.txt$", "").alias("name"), F.col("value").alias("text"), F.sha2(F.col("value").cast("binary"), 256).alias("sha256"))


def prompt(spark: SparkSession, folder: str, kind: str, name: str | None = None) -> tuple[str, str]:
    """(text, hash) of what a kind of work is instructed with, by default or by name; the hash is part of the
    identity of what comes back."""
    if kind not in PROMPTS:
        raise Violation(f"no such kind of work: {kind}")
    found = prompts(spark, folder).where(F.col("name") == (name or PROMPTS[kind])).limit(2).collect()
    if len(found) != 1 or not found[0]["text"].strip():
        raise Violation(f"{folder} has no instructions {name or PROMPTS[kind]}")
    return found[0]["text"], found[0]["sha256"]


def file_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of one file, read where Spark can read it."""
    rows = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h")).limit(2).collect()
    if len(rows) != 1:
        raise Violation(f"{path} is not one file")
    return rows[0]["h"]


def not_in_progress(spark: SparkSession, folder: str, marker: str = ".in-progress") -> None:
    """Raise if an export into the folder has begun and not ended."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{marker}")
    if where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        raise Violation(f"{folder} is being written")


def settings(text: str, keys: tuple[str, ...]) -> dict[str, str]:
    """KEY=value lines of a settings file; comments and quotes are dropped, other keys are an error."""
    out = {}
    for number, raw in enumerate(text.splitlines(), 1):
        line = raw.strip()
        if line and not line.startswith("#"):
            key, found, value = (x.strip() for x in line.partition("="))
            if not found or key not in keys:
                raise Violation(f"line {number}: unknown setting")
            out[key] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSONL log with ``seq``; a last line that was cut off is dropped, any other that
    doesn't parse fails.

    Lines are read as lines, so a log of any size is split among tasks; only the last bytes of each
    file are looked at apart, to know whether its last line was ended.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    # Each append writes files of its own, whose names are drawn: when they were written is their order.
    # Ids of lines grow within a block and blocks within a file, so (block, id) is their order.
    rows = lines.where(F.trim("value") != "").withColumn("bad", F.get_json_object("value", "$").isNull())
    spoilt = rows.where("bad").select("path", "block", "id")
    last = rows.groupBy("path").agg(F.max(F.struct("block", "id")).alias("last"))
    suspects = spoilt.join(last, "path").select("path", (F.struct("block", "id") == F.col("last")).alias("is_last"))
    files = [r["path"] for r in suspects.where("is_last").select("path").distinct().limit(1001).collect()]
    if len(files) > 1000:
        raise Violation("more than a thousand logs end in lines that don't parse")
    ended = {f for f in files if _ends_line(spark, f)}
    assert_none(suspects.where(~F.col("is_last") | F.col("path").isin(*ended) if ended else ~F.col("is_last")).select("path"), "log lines that don't parse")
    seq = F.struct("at", _path_order(F.col("path")).alias("p"), "block", "id")
    return rows.where(~F.col("bad")).select(F.from_json("value", schema).alias("v"), seq.alias("seq")).select("v.*", "seq")


def _ends_line(spark: SparkSession, path: str) -> bool:
    """Whether a file's last byte is a line feed, read through the file system that holds it."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    size = fs.getFileStatus(where).getLen()
    stream = fs.open(where)
    try:
        stream.seek(max(0, size - 1))
        return size > 0 and stream.read() == 10
    finally:
        stream.close()


def file_hashes(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """path, sha256 of the files below a folder whose names match; files are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.sha2("content", 256).alias("sha256"))


def listing(spark: SparkSession, paths: list[str]) -> dict[str, tuple[int, int]]:
    """Length and time of change of every file at or below the paths, as the file system tells them."""
    jvm, conf, out = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf(), {}
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(conf)
        if fs.exists(where):
            files = fs.listFiles(where, True)
            while files.hasNext():
                f = files.next()
                out[f.getPath().toString()] = (f.getLen(), f.getModificationTime())
    return out


@contextmanager
def guarded(spark: SparkSession, inputs: list[str], outputs: list[str] = ()) -> Iterator[None]:
    """What runs within refuses outputs that lie within an input, and fails if an input changed meanwhile."""
    for path in outputs:
        own = path.rstrip("/") + "/"
        if any(own.startswith(i.rstrip("/") + "/") for i in inputs):
            raise Violation(f"{path} lies within an input")
    before = listing(spark, inputs)
    yield
    if listing(spark, inputs) != before:
        raise Violation("inputs changed while they were read")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 of the JSON and CSV files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,csv}").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256")).orderBy(_path_order(F.col("path")))


def unchanged(before: DataFrame, after: DataFrame) -> None:
    """Raise if the two manifests differ."""
    other = before.join(after.withColumnRenamed("sha256", "then"), "path", "full_outer").where("sha256 IS DISTINCT FROM then")
    if not other.isEmpty():
        raise Violation("inputs changed while they were read")


def united(*corpora: DataFrame) -> DataFrame:
    """Entries of several corpora in one frame; what one lacks is null."""
    out = corpora[0]
    for other in corpora[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def stale_sources(footers: DataFrame, files: DataFrame) -> DataFrame:
    """Files whose source text is not the one that their footer was written for, or is missing.

    footers: of ``story_footer``; files: path, sha256 of the source texts.
    """
    held = files.select(_base(F.col("path")).alias("source_name"), "sha256")
    joined = footers.join(held, "source_name", "left")
    return joined.where(~F.coalesce(F.col("sha256") == F.col("source_sha256"), F.lit(False)))


def unknown_fields(rows: DataFrame, found: str, wanted: list[str]) -> DataFrame:
    """Rows with a key that is not one of ``wanted``."""
    return rows.where(F.size(F.array_except(F.map_keys(found), F.array(*map(F.lit, wanted)))) > 0)
