"""Notices, line-segmented legal texts and interface dictionaries: pending work and compilation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators.quality import Rules, assert_none, or_raise

#: Legal rules whose text is translated; the others are kept as they are.
LEGAL_TRANSLATED = ("1", "2", "3", "4", "5", "7")


def needs_notice(text: str) -> Column:
    return T.has_kana_or_han(text) & ~F.col(text).rlike(P.DATE_ONLY)


def pending_notices(texts: DataFrame, translations: DataFrame, aliases: DataFrame) -> DataFrame:
    """Notice texts without a translation and without an alias that differs from the text.

    texts: page, source; translations: page, source; aliases: source, target.
    """
    open_ = texts.where(needs_notice("source")).join(translations.select("page", "source"), ["page", "source"], "left_anti")
    return open_.join(aliases.where("source <> target").select("source"), "source", "left_anti")


def unapproved(pending: DataFrame, approved: DataFrame) -> DataFrame:
    return pending.join(approved.select("page", "source"), ["page", "source"], "left_anti")


def approved_only(pending: DataFrame, approved: DataFrame) -> DataFrame:
    """Pending texts, all of which must have been approved."""
    assert_none(unapproved(pending, approved), "texts that were not approved")
    return pending


def credit_actions(sources: DataFrame, initial: DataFrame, current: DataFrame, log: DataFrame, policy: str, restore: bool = False) -> DataFrame:
    """What the credit policy does with each credit text of the notices.

    sources: page, source; initial and current: page, source, translation; log: page, source,
    translation, policy (its latest row for each text). Adds target, action, and whether to log it.
    """
    keys = ["page", "source"]
    rows = sources.withColumn("c", T.credit_parts("source")).where(F.col("c").isNotNull())
    for name, frame in (("initial", initial), ("current", current)):
        rows = rows.join(frame.select(*keys, F.col("translation").alias(name)), keys, "left")
    rows = rows.join(log.select(*keys, F.col("translation").alias("logged"), F.col("policy").alias("logged_policy")), keys, "left")
    wanted = F.concat("c.label", "c.separator", "c.names")
    head = F.regexp_extract(F.col("initial"), r"(?s)\A([^:：]*[:：])", 1)
    restored = or_raise(F.concat(head, F.col("c.names")), head == "", "a credit without a separator can't be restored")
    kept = F.col("initial").isNotNull() & F.lit(not restore)
    target = F.when(kept, F.col("initial")).when(F.col("initial").isNotNull(), restored).otherwise(wanted)
    action = (
        F.when(kept, F.when(F.col("initial") == wanted, "preserved").otherwise("preserved_conflict"))
        .when(F.col("initial").isNotNull(), F.when(F.col("current").eqNullSafe(F.col("target")), "already_restored").otherwise("restored"))
        .when(F.col("current").isNull(), "filled")
        .when(F.col("current") == F.col("target"), "already_correct")
        .otherwise("changed")
    )
    rows = rows.withColumn("target", target).withColumn("action", action)
    same = F.coalesce((F.col("logged") == F.col("target")) & (F.col("logged_policy") == policy), F.lit(False))
    return rows.select(*keys, "target", "action", (~same & ~F.col("action").startswith("preserved")).alias("to_log"))


def credit_report(actions: DataFrame) -> DataFrame:
    """One row of counts: nodes matched, kept, in conflict, restored, filled, changed, right, logged."""

    def n(*names: str) -> Column:
        return F.count_if(F.col("action").isin(*names))

    return actions.agg(
        F.count(F.lit(1)).alias("matched_nodes"), n("preserved", "preserved_conflict").alias("protected_initial_nodes"), n("preserved_conflict").alias("initial_policy_conflicts"),
        n("restored").alias("restored_initial_nodes"), n("changed").alias("changed_new_nodes"), n("filled").alias("filled_new_nodes"),
        n("already_correct").alias("already_correct_new_nodes"), F.count_if("to_log").alias("log_records_added"),
    )


def snapshot_changes(initial: DataFrame, current: DataFrame, restore: bool = False) -> DataFrame:
    """Reviewed translations that are no longer what they were; with ``restore``, credits whose
    names were put back may differ. All: page, source, translation."""
    keys = ["page", "source"]
    both = initial.join(current.select(*keys, F.col("translation").alias("current")), keys, "left")
    changed = ~F.col("translation").eqNullSafe(F.col("current"))
    if restore:
        names = T.credit_parts("source")["names"]
        restored = F.concat(F.regexp_extract("translation", r"(?s)\A([^:：]*[:：])", 1), names)
        changed = changed & ~F.coalesce(F.col("current") == restored, F.lit(False))
    return both.where(changed)


def texts_by_page(pending: DataFrame, order: str = "source") -> DataFrame:
    """page, sources: the pending texts of each page, for a list to be approved."""
    return pending.groupBy("page").agg(F.array_sort(F.collect_set(order)).alias("sources"))


def legal_source_rules() -> Rules:
    """Rules of one legal rule row: rule, category, source, source_sha256, segments."""
    joined = F.array_join(F.transform("segments", lambda s: F.concat(s["source"], s["line_ending"])), "")
    ids = F.transform("segments", lambda s: s["id"])
    return [
        ("rule", F.col("rule").isin(*(str(i) for i in range(1, 8)))),
        ("hash", F.sha2("source", 256) == F.col("source_sha256")),
        ("segment_ids", F.size(F.array_distinct(ids)) == F.size(ids)),
        ("line_ending", F.forall("segments", lambda s: s["line_ending"].isin("", "\n", "\r\n", "\r"))),
        ("lossless", joined == F.col("source")),
    ]


def legal_segments(rules: DataFrame) -> DataFrame:
    """(rule, at, id, source, line_ending) of all segments in order."""
    return rules.select("rule", F.posexplode("segments").alias("at", "s")).select("rule", "at", "s.*")


def legal_initialised(segments: DataFrame, existing: DataFrame) -> DataFrame:
    """Segments with targets: what exists, else '' if translated and the source if kept."""
    needs = F.col("rule").isin(*LEGAL_TRANSLATED) & T.has_kana_or_han("source")
    joined = segments.join(existing.select("rule", "id", F.col("target").alias("held")), ["rule", "id"], "left")
    joined = joined.withColumn("needs", needs)
    assert_none(joined.where(~F.col("needs") & F.col("held").isNotNull() & (F.col("held") != F.col("source"))), "kept segments that were changed")
    return joined.withColumn("target", F.coalesce("held", F.when(F.col("needs"), F.lit("")).otherwise(F.col("source")))).drop("held")


def legal_pending(initialised: DataFrame) -> DataFrame:
    return initialised.where("needs AND target = ''").select(F.concat_ws("/", "rule", "id").alias("id"), "source")


def joined_in_order(rows: DataFrame, key: str, order: str, text: str, ending: str | None = None) -> DataFrame:
    """Texts of each key end to end in order, with the hash of the whole."""
    piece = F.col(text) if ending is None else F.concat(F.col(text), F.col(ending))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("p"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["p"]), "").alias("whole")).withColumn("whole_sha256", F.sha2("whole", 256))


def legal_compiled(initialised: DataFrame) -> DataFrame:
    """Whole translations by rule; nothing may be pending."""
    assert_none(legal_pending(initialised), "segments that are still pending")
    return joined_in_order(initialised, "rule", "at", "target", "line_ending")


def pending_stable(source: DataFrame, translated: DataFrame, varying: DataFrame, curated: DataFrame) -> DataFrame:
    """Interface keys with a text, not translated, and of one source only. All have ``key``."""
    skipped = varying.select("key").union(curated.select("key")).distinct()
    return source.where("source <> ''").join(translated.select("key"), "key", "left_anti").join(skipped, "key", "left_anti")


def pending_reviewed(reviewed: DataFrame, source: DataFrame, translated: DataFrame) -> DataFrame:
    """Texts that a review wants translated and that lack it; the source must hold each as itself."""
    wanted = reviewed.where("decision = 'translate'").select("source").distinct()
    assert_none(wanted.join(source.where("source = target").select("source"), "source", "left_anti"), "reviewed texts that the source lacks")
    return wanted.join(translated.select("source"), "source", "left_anti")
