"""What is sent to a text model, and in which jobs: eligibility, strata, samples, aliases, packs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators import batching
from glossmill.operators.quality import Violation, assert_none

# Fields of credits; which table and field names which kind of thing.
CREDIT_FIELDS = ("composer", "lyricist", "arranger")
FIELD_CATEGORIES = {
    ("Music", "name"): "song",
    ("PhotoQuestMusic", "name"): "song",
    ("PhotoContestQuestMusic", "name"): "song",
    ("EventStory", "description"): "event",
    ("Story", "name"): "story_title",
    ("ExtraStory", "name"): "story_title",
    ("ExtraStoryPart", "name"): "story_title",
    ("HomeTalk", "title"): "story_title",
    ("Card", "name"): "card_title",
    ("Costume", "name"): "costume",
    ("CostumeType", "name"): "costume_type",
    ("MessageGroup", "name"): "chat_group",
}
AGENCY_SUFFIXES = ("事務所", "プロダクション")
GLOSSARY_AGENCY_SUFFIXES = ("プロ", "プロダクション")
SEVERAL_ARTISTS = ("with ", "×", "、", "/", "&")
GROUP_PREFIX = "st-part-group-"
GROUP_NAMES = ("IIIX", "ⅢX", "LizNoir", "TRINITYAiLE", "サニピ", "サニーピース", "月のテンペスト", "月のテンぺスト", "月スト", "トリエル", "リズノワ", "スリクス", "どりきゅん")

# Tables of the first pass, tables of which only names are taken, and prose tables.
FOCUSED_TABLES = (
    "Accessory", "Card", "Character", "CharacterGroup", "Costume", "EventStory", "ExtraStory", "ExtraStoryPart", "Hair", "HomeAction", "HomeTalk", "Item",
    "LoveHomeAction", "Message", "MessageGroup", "Music", "Story", "Telephone", "Wording",
)
EXTRA_TABLES = (
    "ActivityPromotion", "Area", "CostumeType", "Decoration", "DutyPoint", "Emblem", "Gacha", "GachaStamp", "HelpCategory", "HomeBackground", "LiveBonus",
    "Loading", "LoginBonus", "PhotoActivity", "PhotoAllInOne", "PhotoContestActivity", "PhotoContestQuestMusic", "PhotoContestQuestStage",
    "PhotoContestSection", "PhotoExpression", "PhotoPose", "PhotoQuestMusic", "PhotoQuestStage", "ShowcaseFrame", "ShowcaseMusicFilter", "ShowcaseToy",
    "ShowcaseToyCategory", "Stage", "StatusEffectName", "StoryPart",
)
NARRATIVE_TABLES = ("Message", "HomeTalk", "Story")
NARRATIVE_PHASE = (*NARRATIVE_TABLES, "HomeAction", "LoveHomeAction", "Telephone")


def _ends(text: Column, suffixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for suffix in suffixes:
        out = out | text.endswith(suffix)
    return out


def is_credit(field: str = "field", source: str = "source") -> Column:
    return F.coalesce(F.col(field).isin(*CREDIT_FIELDS), F.lit(False)) | T.is_credit_line(source)


def category(table: str = "tbl", field: str = "field", record: str = "id", source: str = "source") -> Column:
    """What a record field names, or null."""
    t, f, s = F.col(table), F.col(field), F.col(source)
    several = F.lit(False)
    for mark in SEVERAL_ARTISTS:
        several = several | s.contains(mark)
    singer = t.isin("Music", "PhotoQuestMusic", "PhotoContestQuestMusic") & (f == "singer")
    kinds = F.create_map(*(F.lit(x) for (tbl, fld), kind in FIELD_CATEGORIES.items() for x in (f"{tbl}\x1f{fld}", kind)))
    return (
        F.when(f.isin(*CREDIT_FIELDS), F.lit(None))
        .when((t == "StoryPart") & (f == "name") & F.col(record).startswith(GROUP_PREFIX), "group")
        .when(singer & _ends(s, AGENCY_SUFFIXES) & ~several, "agency")
        .otherwise(F.try_element_at(kinds, F.concat_ws("\x1f", t, f)))
    )


def glossary_terms(names: DataFrame, terms: DataFrame) -> DataFrame:
    """Typed terms of two flat dictionaries: source, target, category, action."""
    both = names.select("source", "target", F.lit("speaker_or_role").alias("kind")).unionByName(terms.select("source", "target", F.lit("term").alias("kind")))
    kind = F.when(F.col("source").isin(*GROUP_NAMES), "group").when(_ends(F.col("source"), GLOSSARY_AGENCY_SUFFIXES), "agency").otherwise(F.col("kind"))
    action = F.when(F.col("source") == F.col("target"), "retain").otherwise("prefer")
    return both.where(~F.col("source").rlike(P.GLOSSARY_PLACEHOLDER)).select("source", "target", kind.alias("category"), action.alias("action"))


def eligible() -> Column:
    """Whether an entry goes to term extraction; columns as in ``entries``."""
    s = T.trimmed("source")
    prose = s.rlike(P.PROSE_KANA_OR_HAN)
    names = category().isNotNull() | F.col("field").rlike(P.ENTITY_FIELD)
    master = F.when(names, T.candidate_text("source", literal_breaks=True).isNotNull()).otherwise((F.length(s) >= 8) & prose)
    story = F.split("field", ":")[1].isin("text", "choice", "narration") & (s != "") & prose
    fits = (F.length(s) <= 1000) & ~is_credit()
    return F.coalesce(fits & F.when(F.col("kind") == "master", master).otherwise(story), F.lit(False))


def table_profile(spark: SparkSession) -> DataFrame:
    rows = [(t, "focused") for t in FOCUSED_TABLES] + [(t, "names_only") for t in EXTRA_TABLES]
    return spark.createDataFrame(rows, "tbl string, profile string")


def selected(entries: DataFrame, tables: list[str] | None = None, prefixes: list[str] | None = None) -> DataFrame:
    """Entries with ``stratum`` and ``included``: by the profile of their table, or by the given
    tables and script prefixes, which override it."""
    rows = entries.withColumn("stratum", T.stratum("kind", "tbl", "script"))
    if tables or prefixes:
        chosen = F.lit(False)
        for prefix in prefixes or ():
            chosen = chosen | ((F.col("kind") == "story") & F.col("script").startswith(prefix))
        if tables:
            chosen = chosen | F.coalesce(F.col("tbl").isin(*tables), F.lit(False))
        return rows.withColumn("included", F.coalesce(chosen, F.lit(False)))
    rows = rows.join(table_profile(entries.sparkSession), "tbl", "left")
    named = F.col("field").rlike(P.ENTITY_FIELD) & T.candidate_text("source").isNotNull()
    keep = (F.col("kind") == "story") | (F.col("profile") == "focused") | ((F.col("profile") == "names_only") & named)
    return rows.withColumn("included", F.coalesce(keep, F.lit(False))).drop("profile")


def coverage(rows: DataFrame) -> DataFrame:
    chosen = F.col("included")
    return rows.groupBy("stratum").agg(
        F.count_if(chosen).alias("selected"),
        F.count_if(~chosen).alias("excluded"),
        F.sum(F.when(chosen, F.length("source")).otherwise(0)).alias("selected_chars"),
        F.sum(F.when(~chosen, F.length("source")).otherwise(0)).alias("excluded_chars"),
    )


def planned(rows: DataFrame, per_stratum: int = 0) -> tuple[DataFrame, DataFrame]:
    """(representatives, aliases) of the included rows: the cap comes before the dedupe, and only
    record rows are deduplicated, by table, field, source and labels."""
    rows = rows.where("included")
    if per_stratum:
        rows = batching.first_of_each(rows, ["stratum"], ["seq"], per_stratum).drop("at")
    labels = F.when(F.col("kind") == "master", F.to_json(F.array_sort(F.map_entries("record_labels"))))
    signature = F.when(F.col("kind") == "master", T.content_hash("tbl", T.normal_field("field"), "source", labels)).otherwise(T.content_hash("script", "field"))
    rows = rows.withColumn("row_id", T.short_id("kind", "tbl", "id", "script", "field", "source")).withColumn("signature", signature)
    heads = rows.groupBy("signature").agg(F.min_by("row_id", "seq").alias("head"))
    marked = rows.join(heads, "signature")
    return marked.where("row_id = head").drop("head"), marked.where("row_id <> head").select("head", "row_id", "tbl", "id", "field", "source")


def jobs(heads: DataFrame, max_rows: int = 16, short_rows: int = 8, max_chars: int = 3000) -> DataFrame:
    """job_id and rows of each job: greedy batches of a stratum in two lanes, short story rows apart."""
    around = F.aggregate(F.transform("neighbors", lambda n: F.length(T.excerpt(n["source"]))), F.lit(0), lambda a, b: a + b) if "neighbors" in heads.columns else F.lit(0)
    sized = heads.withColumn("size", (F.length("source") + F.coalesce(around, F.lit(0))).cast("long"))
    short = (F.col("kind") == "story") & (F.length(T.trimmed("source")) < 8)
    laned = batching.two_lane_batches(sized.select("stratum", "seq", "row_id", "source", "kind", "size"), "stratum", "seq", "size", short, {"short": short_rows, "normal": max_rows}, max_chars)
    rows = F.transform(F.array_sort(F.collect_list(F.struct("seq", "row_id", "source"))), lambda r: F.struct(r["row_id"].alias("id"), r["source"].alias("source")))
    made = laned.groupBy("stratum", "lane", "batch").agg(rows.alias("rows"))  # at most max_rows a job
    return made.withColumn("job_id", job_id("stratum", "rows"))


def packed_jobs(rows: DataFrame, max_rows: int = 16, max_chars: int = 3000, part_rows: int | None = None) -> DataFrame:
    """Record rows with ``job``: what is asked together.

    Rows of one record and field, at most part_rows (max_rows) at once, are a part; whole parts of a table and
    field are packed in the order of their first rows. A part that stays alone keeps its own name, as
    do the records of narrative tables, which are never packed. rows: tbl, id, field, seq, source.
    """
    own = rows.withColumn("_field", T.normal_field("field")).withColumn("_size", F.length("source").cast("long"))
    told = own.where(F.col("tbl").isin(*NARRATIVE_TABLES)).withColumn("job", F.concat_ws("/", "tbl", "id"))
    other = own.where(~F.col("tbl").isin(*NARRATIVE_TABLES)).withColumn("_record", F.concat_ws("\x1f", "tbl", "_field", "id"))
    chunked = batching.fixed_chunks(other, "_record", "seq", part_rows or max_rows)
    chunked = chunked.withColumn("_group", F.concat_ws("/", "tbl", "_field")).withColumn("_part", F.concat_ws("/", "tbl", "id", "_field", F.col("chunk").cast("string")))
    packed = batching.packed_parts(chunked, "_group", "seq", "_part", max_rows, max_chars, "_size")
    named = F.when(F.col("parts") == 1, F.col("_part")).otherwise(F.concat_ws("/", "_group", F.lit("packed"), F.col("batch").cast("string")))
    return told.select(*rows.columns, "job").unionByName(packed.withColumn("job", named).select(*rows.columns, "job"))


def job_id(stratum: str, rows: str) -> Column:
    """Identity of a job: its kind, what its rows belong to, and the rows."""
    kind = F.when(F.col(stratum).startswith("story:"), "story").otherwise("master")
    return T.short_id(kind=kind, group=stratum, rows=rows)


def cache_key(prompt_hash: str, model: str, schema_version: int = 1, rows: str = "rows", repair_of: Column | None = None) -> Column:
    """Identity of a job's answer: its rows, the job that it repairs and what asks, but not its aliases."""
    repaired = F.lit(None).cast("string") if repair_of is None else repair_of
    return T.content_hash(schema_version=F.lit(schema_version), job=rows, repair_of=repaired, prompt_sha256=F.lit(prompt_hash), model=F.lit(model))


def in_slice(tables: list[str] | None = None, prefix: str | None = None, phase: str | None = None) -> Column:
    """Whether a job is of given tables, of a story prefix, or of a phase (narrative, independent)."""
    keep = F.lit(True)
    master = F.regexp_extract("stratum", "^master:(.*)$", 1)
    if tables:
        keep = keep & master.isin(*tables)
    if prefix:
        keep = keep & F.col("stratum").startswith(f"story:{prefix}")
    if phase:
        told = master.isin(*NARRATIVE_PHASE) | F.col("stratum").startswith("story:")
        keep = keep & (told if phase == "narrative" else ~told)
    return keep


def sliced(plan: DataFrame, tables: list[str] | None = None, prefix: str | None = None, phase: str | None = None) -> DataFrame:
    """The jobs of a slice, which may not be empty."""
    out = plan.where(in_slice(tables, prefix, phase))
    if out.isEmpty():
        raise Violation("the slice holds no job")
    return out


def to_repair(plan: DataFrame, log: DataFrame, statuses: tuple[str, ...] = ("empty", "partial")) -> DataFrame:
    """Jobs whose latest result, partial ones counted, is empty or partial.

    log: job_id, status, n_terms, seq."""
    latest = log.groupBy("job_id").agg(F.max_by(F.struct("status", "n_terms"), "seq").alias("r"))
    state = F.when(F.col("r.status") == "partial", "partial").when(F.col("r.n_terms") == 0, "empty").otherwise("done")
    return plan.join(latest.where(state.isin(*statuses)).select("job_id"), "job_id", "left_semi")


def plan_sha256(jobs: DataFrame) -> str:
    """What identifies a plan, whatever the order of its jobs: a hash of hashes of its jobs' contents, in
    two levels, so that no task sees more than a share of them."""
    names = sorted(jobs.columns)
    each = jobs.select(F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256).alias("h"))
    shares = each.groupBy(F.substring("h", 1, 3).alias("share")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
    whole = shares.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("share", "h"))), lambda x: x["h"]), ""), 256).alias("h"))  # 4096 at most
    return whole.first()["h"]


def chosen(tables: tuple[str, ...] = (), prefixes: tuple[str, ...] = (), mode: str = "none") -> Column:
    """Whether a job is of a story with one of the prefixes, or of a table that is named or that
    the mode takes in (all, narrative, independent)."""
    if mode not in ("none", "all", "narrative", "independent"):
        raise Violation(f"no such mode: {mode}")
    if not tables and not prefixes and mode == "none":
        raise Violation("a slice needs tables, prefixes or a mode")
    table = F.regexp_extract("stratum", "^master:(.*)$", 1)
    told = table.isin(*NARRATIVE_PHASE)
    of_mode = {"none": F.lit(False), "all": F.lit(True), "narrative": told, "independent": ~told}[mode]
    keep = F.col("stratum").startswith("master:") & (table.isin(*tables) | of_mode)
    for prefix in prefixes:
        keep = keep | F.col("stratum").startswith(f"story:{prefix}")
    return keep


def short_or_entity() -> Column:
    """Whether a job has a short line of a story or a field that names something. rows: id, source, field."""
    short = F.col("stratum").startswith("story:") & F.exists("rows", lambda r: F.length(T.trimmed(r["source"])) < 8)
    return short | F.col("stratum").startswith("master:") & F.exists("rows", lambda r: F.coalesce(r["field"].rlike(P.ENTITY_FIELD), F.lit(False)))


def repairs(plan: DataFrame, log: DataFrame, status: str = "empty", scope: str = "all", max_rows: int = 4) -> DataFrame:
    """Jobs of at most max_rows rows made of those whose latest result is empty or partial: stratum, rows,
    repair_of, start (their first row's place there), job_id.

    plan: job_id, stratum, rows; log: job_id, status, n_terms, seq. scope: all, or short-and-entity.
    """
    if not 1 <= max_rows <= 8 or status not in ("empty", "partial") or scope not in ("all", "short-and-entity"):
        raise Violation("repairs take 1 to 8 rows, of empty or partial results, of all or of short-and-entity jobs")
    broken = to_repair(plan, log, (status,))
    if scope == "short-and-entity":
        broken = broken.where(short_or_entity())
    starts = F.sequence(F.lit(0), F.greatest(F.size("rows") - 1, F.lit(0)), F.lit(max_rows))
    parts = broken.select(F.col("job_id").alias("repair_of"), "stratum", F.explode(starts).alias("start"), "rows")
    parts = parts.withColumn("rows", F.slice("rows", F.col("start") + 1, F.lit(max_rows)))
    group = F.concat_ws(":", "stratum", F.lit("repair"), "repair_of", F.col("start").cast("string"))
    return parts.withColumn("job_id", T.short_id(group=group, rows="rows"))


def counted(jobs: DataFrame) -> dict:
    """Jobs and rows of a plan, by stratum; there are as many strata as tables and stories."""
    found = jobs.groupBy("stratum").agg(F.count(F.lit(1)).alias("jobs"), F.sum(F.size("rows")).alias("rows")).collect()
    return {"jobs": sum(r["jobs"] for r in found), "rows": sum(r["rows"] for r in found), "by_stratum": {r["stratum"]: r["jobs"] for r in sorted(found)}}


def unverified(plan: DataFrame, log: DataFrame) -> DataFrame:
    """(job_id, row id, source) of jobs without a complete result."""
    done = log.where("coalesce(status, 'complete') <> 'partial'").select("job_id").distinct()
    return plan.join(done, "job_id", "left_anti").select("job_id", F.explode("rows").alias("r")).select("job_id", "r.*")


def kana_items(issues: DataFrame, source: DataFrame, target: DataFrame, with_conditions: bool = False) -> DataFrame:
    """source, current, locations of reported fields; each source has one current translation.

    issues: tbl, id, field; source and target: these and source."""
    rows = issues if with_conditions else issues.where("tbl <> 'ConditionDescription'")
    keys = ["tbl", "id", "field"]
    held = rows.join(source.select(*keys, "source"), keys, "left").join(target.select(*keys, F.col("source").alias("current")), keys, "left")
    assert_none(held.where("source IS NULL OR current IS NULL"), "reported fields that don't exist")
    out = held.groupBy("source").agg(F.collect_set("current").alias("currents"), F.array_sort(F.collect_set(F.struct(*keys))).alias("locations"))
    assert_none(out.where("size(currents) > 1"), "sources with several translations")
    return out.select("source", F.col("currents")[0].alias("current"), "locations")
