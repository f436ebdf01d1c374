"""Human review: queues, decisions kept over new queues, and reviews that must match their lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.operators.quality import assert_none

DECISION = ("decision", "selected_target", "notes", "reviewer")


def queue(references: DataFrame, unverified: DataFrame, classifications: DataFrame | None = None) -> DataFrame:
    """review_id, kind, source, flags, input_fingerprint of terms and of rows without evidence.

    references: source, status, disagreement, suggestions; unverified: row_id, source.
    """
    from glossmill.functions.text import content_hash, short_id

    flags = F.array_compact(
        F.array(
            F.when(F.col("status") != "glossary_reference", F.col("status")),
            F.when(F.col("disagreement"), F.lit("model_reference_disagreement")),
            F.when(F.size("suggestions") > 1, F.lit("several_suggestions")),
        )
    )
    terms = references.select(
        short_id(F.lit("term"), "source").alias("review_id"), F.lit("term").alias("kind"), "source", flags.alias("flags"), content_hash("source", "status", "suggestions").alias("input_fingerprint")
    )
    rows = unverified if classifications is None else unverified.join(classifications, "row_id", "left")
    label = F.col("classification") if classifications is not None else F.lit(None).cast("string")
    rows = rows.select(
        short_id(F.lit("row"), "row_id").alias("review_id"),
        F.lit("coverage").alias("kind"),
        "source",
        F.array_compact(F.array(F.lit("unverified"), label)).alias("flags"),
        content_hash("row_id", "source", label).alias("input_fingerprint"),
    )
    both = terms.unionByName(rows)
    assert_none(both.groupBy("review_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "review ids that occur twice")
    return both


def flag_counts(queued: DataFrame) -> DataFrame:
    """How many items carry each flag; an item may carry several."""
    return queued.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def queue_counts(queued: DataFrame) -> DataFrame:
    """counted (kind or flag), name, n: items of each kind, and how many carry each flag."""
    kinds = queued.groupBy(F.col("kind").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    flags = flag_counts(queued).withColumnRenamed("flag", "name")
    return kinds.select(F.lit("kind").alias("counted"), "name", "n").unionByName(flags.select(F.lit("flag").alias("counted"), "name", "n"))


def merged_decisions(new: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, stale): decisions for a new queue, and old ones that no longer fit.

    new: review_id, input_fingerprint; old: these and the columns of DECISION. Equal fingerprints
    keep the old decision; untouched ones take the new fingerprint; touched ones start over and
    go stale, as do decisions on items that left the queue.
    """
    a = new.select("review_id", F.col("input_fingerprint").alias("new_print"))
    b = old.select("review_id", F.col("input_fingerprint").alias("old_print"), *DECISION)
    blank = (F.col("decision") == "pending") & (F.concat_ws("", "selected_target", "notes", "reviewer") == "")
    joined = a.join(b, "review_id", "full_outer").withColumn("untouched", F.coalesce(blank, F.lit(False)))
    same = F.coalesce(F.col("new_print") == F.col("old_print"), F.lit(False))
    keeps = same | (F.col("old_print").isNotNull() & F.col("untouched"))
    fresh = {"decision": F.lit("pending"), "selected_target": F.lit(""), "notes": F.lit(""), "reviewer": F.lit("")}
    items = joined.where("new_print IS NOT NULL").select("review_id", F.col("new_print").alias("input_fingerprint"), *(F.when(keeps, F.col(c)).otherwise(v).alias(c) for c, v in fresh.items()))
    gone = joined.where(F.col("old_print").isNotNull() & (F.col("new_print").isNull() | ~(same | F.col("untouched"))))
    return items, gone.select("review_id", F.col("old_print").alias("input_fingerprint"), *DECISION)


def unmatched_reviews(listed: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Rows that keep a review from matching its list one to one: omitted, invented, repeated or
    with another number of occurrences. Both: source, occurrences."""
    a = listed.groupBy("source").agg(F.count(F.lit(1)).alias("n_listed"), F.max("occurrences").alias("occ_listed"))
    b = reviewed.groupBy("source").agg(F.count(F.lit(1)).alias("n_reviewed"), F.max("occurrences").alias("occ_reviewed"))
    out = a.join(b, "source", "full_outer")
    problem = (
        F.when(F.col("n_reviewed").isNull(), "omitted")
        .when(F.col("n_listed").isNull(), "invented")
        .when((F.col("n_reviewed") > 1) | (F.col("n_listed") > 1), "repeated")
        .when(~F.col("occ_listed").eqNullSafe(F.col("occ_reviewed")), "occurrences")
    )
    return out.withColumn("problem", problem).where("problem IS NOT NULL")


def selected(reviewed: DataFrame) -> DataFrame:
    return reviewed.where("decision <> 'skip'")
