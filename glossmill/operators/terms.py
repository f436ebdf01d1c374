"""Dictionary terms in texts: mentions, scoped policies, audit and candidate discovery.

A glossary is a dimension: a few thousand terms given as a Python list, compiled into one
alternation that scans each text once. Mentions then meet the glossary by an equi-join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T
from glossmill.operators.quality import or_raise

Term = dict  # source, target, category, action, scope

TERM_SCHEMA = "source string, target string, category string, action string, scope map<string,string>, seq long"
#: One alternation is built of at most so many terms; more are joined on their first characters.
MOST_TERMS = 5_000
#: Up to so many terms are looked for one by one, each an expression of the plan; more are joined.
FEW_TERMS = 200


def terms_frame(spark: SparkSession, terms: list[Term]) -> DataFrame:
    rows = [(t["source"], t["target"], t.get("category", "term"), t.get("action", "prefer"), t.get("scope") or {}, i) for i, t in enumerate(terms)]
    return spark.createDataFrame(rows, TERM_SCHEMA)


def mentions(rows: DataFrame, terms: list[Term], text: str = "source", most: int = MOST_TERMS, keys: list[str] | None = None) -> DataFrame:
    """One row for each distinct term of a text, as ``term``.

    With more than ``most`` terms every text meets the terms that begin like two of its neighbouring
    characters; of those that it holds, an alternation of its own finds the mentions, so the result
    is the same. ``keys`` then name the columns that tell rows apart (all, if not given).
    """
    sources = sorted({t["source"] for t in terms if t["source"]})
    if len(sources) <= most:
        return rows.withColumn("term", F.explode(T.mentions(text, sources)))
    keys = keys or rows.columns
    held = contained(rows, sources, text, keys)
    quoted = F.transform(F.array_sort(F.collect_list(F.struct((-F.length("candidate")).alias("less"), "candidate"))), lambda x: F.concat(F.lit("\\Q"), F.replace(x["candidate"], F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    own = held.groupBy(*keys).agg(F.array_join(quoted, "|").alias("_pattern"))  # at most the terms that one text holds
    found = rows.join(own, keys).withColumn("term", F.explode(F.array_distinct(F.expr(f"regexp_extract_all(`{text}`, _pattern, 0)"))))
    return found.drop("_pattern")


def contained(rows: DataFrame, sources: list[str], text: str, keys: list[str]) -> DataFrame:
    """keys, the text, and ``candidate``: each term that stands anywhere in a text, also within others. A text
    meets the terms that begin like two of its neighbouring characters, or are one of its characters."""
    listed = rows.sparkSession.createDataFrame([(s[:2], s) for s in sources], "start string, candidate string")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(F.col(text), i, F.lit(2)))
    singles = F.split(F.col(text), "")
    own = list(dict.fromkeys([*keys, text]))
    starts = rows.where(F.length(text) > 0).select(*own, F.explode(F.array_distinct(F.concat(pairs, singles))).alias("start"))
    return starts.join(listed, "start").where(F.contains(text, "candidate")).drop("start").distinct()


#: Lengths of the literal beginnings by which globs are found; longer ones are cut to the next below.
STARTS = (0, 1, 2, 4, 8, 16)
WHOLE = -1
#: Terms are sent to every task while their texts take less than this many characters.
FEW_CHARACTERS = 4_000_000


def _start(glob: str) -> tuple[int, str]:
    """What a value surely begins with if a glob matches it: how long that is, WHOLE for a glob
    without wildcards, and the text."""
    literal = re.match(r"[^*?\[]*", glob).group()
    if literal == glob:
        return WHOLE, glob
    n = max(x for x in STARTS if x <= len(literal))
    return n, literal[:n]


def scope_index(spark: SparkSession, terms: list[Term]) -> tuple[DataFrame, list[tuple[str, int]]]:
    """The terms as rows, each under one key of its scope with the longest literal beginning, and the kinds
    (key, length) of beginnings that occur. Patterns are data here, so a plan is as long for any number of terms."""
    rows, kinds = [], set()
    for i, t in enumerate(terms):
        scope = t.get("scope") or {}
        key, (n, start) = max(((k, _start(g)) for k, g in scope.items()), key=lambda x: (x[1][0] == WHOLE, len(x[1][1]), x[0]), default=("", (0, "")))
        kinds.add((key, n))
        tokens = [None if P.token_pattern(x) == P.java_literal(x) else P.token_pattern(x) for x in (t["source"], t["target"])]
        rows.append((t["source"], key, n, start, *tokens, {k: P.glob_regex(g) for k, g in scope.items()}, t["target"], t.get("category", "term"), t.get("action", "prefer"), len(scope), i))
    schema = "term string, _key string, _n int, _start string, _token string, target_token string, _globs map<string,string>, target string, category string, action string, specificity long, term_seq long"
    out = spark.createDataFrame(rows, schema)
    small = sum(len(t["source"]) + len(t["target"]) + sum(map(len, (t.get("scope") or {}).values())) for t in terms) < FEW_CHARACTERS
    return (F.broadcast(out) if small else out), sorted(kinds)


def active_terms(rows: DataFrame, terms: list[Term], context: dict[str, Column], text: str = "source", missing_fails: bool = True) -> DataFrame:
    """Rows for the terms of each text that stand as tokens and whose scope holds: every glob matches
    its context value. ``missing_fails``: an absent value fails (policies); otherwise it counts as '' (audits).

    Adds term, target, category, action, specificity (how many keys the scope names), term_seq, and
    target_token, the pattern of a target that only counts as a token. A mention meets the terms of its
    spelling and of the beginning of one context value; only for those the whole globs are tried.
    """
    index, kinds = scope_index(rows.sparkSession, terms)
    held = {k: c if missing_fails else F.coalesce(c, F.lit("")) for k, c in context.items()}
    absent = F.lit(None if missing_fails else "").cast("string")
    values = F.create_map(*(x for k, c in held.items() for x in (F.lit(k), c.cast("string")))) if held else F.create_map().cast("map<string,string>")

    def kind(key: str, n: int) -> Column:
        value = held.get(key, absent).cast("string") if key else F.lit("")
        return F.struct(F.lit(key).alias("key"), F.lit(n).alias("n"), (value if n == WHOLE else F.substring(value, 1, n)).alias("start"))

    found = mentions(rows, terms, text).withColumn("_values", values)
    looked = found.withColumn("_k", F.explode(F.array(*(kind(*k) for k in kinds) if kinds else [kind("", 0)])))
    met = looked.join(index.withColumnRenamed("term", "_term"), (F.col("term") == F.col("_term")) & (F.col("_k.key") == F.col("_key")) & (F.col("_k.n") == F.col("_n")) & (F.col("_k.start") == F.col("_start")))
    default = "NULL" if missing_fails else "''"
    fits = F.expr(f"forall(map_entries(_globs), g -> coalesce(coalesce(_values[g.key], {default}) rlike g.value, false))")
    met = met.where(fits & (F.col("_token").isNull() | F.expr(f"`{text}` rlike _token")))
    return met.select(*(c for c in found.columns if c != "_values"), "target", "category", "action", "specificity", "term_seq", "target_token")


def resolved(active: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """The most specific term of each (row, spelling); equals of one target: the later one.

    Two targets among the most specific are an error, in whatever order they were given.
    """
    rest = [c for c in active.columns if c not in (*keys, "term")]
    order = F.struct("specificity", "term_seq")
    # Of each specificity its targets' extremes: where those of the largest differ, two targets clash.
    levels = active.groupBy(*keys, "term", "specificity").agg(F.max_by(F.struct(*rest), order).alias("_r"), F.min("target").alias("_low"), F.max("target").alias("_high"))
    picked = levels.groupBy(*keys, "term").agg(F.max_by(F.struct("_r", "_low", "_high"), "specificity").alias("_p"))
    row = or_raise(F.col("_p._r"), F.col("_p._low") != F.col("_p._high"), "terms of one scope with two targets") if strict else F.col("_p._r")
    picked = picked.select(*keys, "term", row.alias("_r"))
    return picked.select(*keys, "term", *(F.col(f"_r.{c}").alias(c) for c in rest))


def counts(term: str = "term", text: str = "source") -> Column:
    """A term of one character counts only where it is the whole text."""
    return (F.length(term) > 1) | (F.col(text) == F.col(term))


def preferences(rows: DataFrame, policy: list[Term], glossary: dict[str, str], context: dict[str, Column], keys: list[str]) -> DataFrame:
    """keys, term, target, action, origin: what is to be preferred in each line.

    Scoped terms are resolved on the source and, where there is one, on the speaker. A flat glossary
    loses every spelling that the policy names, but gives it back to the lines that hold it, and in
    which no scoped term with that spelling holds.
    """
    def of(text: str) -> DataFrame:
        active = active_terms(rows.where(F.col(text).isNotNull()), policy, context, text)
        return resolved(active.where(counts(text=text)), keys).select(*keys, "term", "target", "action")

    matched = of("source")
    if "speaker" in rows.columns:
        matched = matched.unionByName(of("speaker")).distinct()
    back = sorted({t["source"] for t in policy} & glossary.keys())
    told = F.concat_ws(" ", "source", *(["speaker"] if "speaker" in rows.columns else []))
    if len(back) <= FEW_TERMS:
        held = F.array_compact(F.array(*(F.when(T.contains_token(told, s), F.struct(F.lit(s).alias("term"), F.lit(glossary[s]).alias("target"))) for s in back)))
        none = F.array().cast("array<struct<term:string,target:string>>")
        flat = rows.select(*keys, F.explode(held if back else none).alias("_g")).select(*keys, "_g.term", "_g.target", F.lit("prefer").alias("action"))
    else:
        known = rows.sparkSession.createDataFrame([(s, glossary[s], P.token_pattern(s)) for s in back], "candidate string, target string, _token string")
        met = contained(rows.withColumn("_told", told), back, "_told", keys).join(known, "candidate").where(F.expr("_told rlike _token"))
        flat = met.select(*keys, F.col("candidate").alias("term"), "target", F.lit("prefer").alias("action"))
    flat = flat.join(matched.select(*keys, "term"), [*keys, "term"], "left_anti")
    return matched.withColumn("origin", F.lit("policy")).unionByName(flat.withColumn("origin", F.lit("glossary")))


def conflicting_contexts(preferred: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sources that may not be translated once for all: their places ask for different terms.

    preferred: of ``preferences``; a place without any counts as one that asks for none, and a credit
    asks for its own text.
    """
    asked = preferred.where("origin = 'policy'").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("term", "target", "action"))).alias("asked"))
    none = F.array().cast("array<struct<term:string,target:string,action:string>>")
    signature = F.struct(F.coalesce("asked", none).alias("asked"), credit_key().alias("credit"))
    return rows.join(asked, keys, "left").groupBy("source").agg(F.count_distinct(signature).alias("signatures")).where("signatures > 1")


def credit_key(table: str = "tbl", field: str = "field") -> Column:
    return F.coalesce((F.col(table) == "Music") & F.col(field).isin("composer", "lyricist", "arranger"), F.lit(False))


def audit_category(table: str = "tbl", field: str = "field") -> Column:
    t, f = F.col(table), F.col(field)
    return (
        F.when(credit_key(table, field), "music_credit")
        .when((t == "Music") & f.isin("name", "description"), "song")
        .when((t == "Character") & f.isin("name", "firstName", "lastName", "fullName"), "character")
        .when(t.contains("Group") & (f == "name"), "group")
        .when(t.contains("Event") & (f == "name"), "event")
        .otherwise("text")
    )


def findings(entries: DataFrame, terms: list[Term], context: dict[str, Column], keys: list[str]) -> DataFrame:
    """Audit findings: changed credits, and translations that lack a preferred target.

    Returns the keys, type, term (null for credits) and suggestion.
    """
    done = _audited(entries)
    credits = done.where((F.col("audit_category") == "music_credit") & (F.col("source") != F.col("translation")))
    credits = credits.select(*keys, F.lit("music_credit_changed").alias("type"), F.lit(None).cast("string").alias("term"), F.col("source").alias("suggestion"))
    active = active_terms(done.where("audit_category <> 'music_credit'"), terms, context, missing_fails=False)
    counted = active.where(counts())
    lacks = F.when(F.col("target_token").isNull(), ~F.col("translation").contains(F.col("target"))).otherwise(~F.expr("translation rlike target_token"))
    suggestion = F.when(F.col("source") == F.col("term"), F.col("target"))
    missed = counted.where(lacks).select(*keys, F.lit("term_preference_mismatch").alias("type"), "term", suggestion.alias("suggestion"))
    return credits.unionByName(missed)


def _audited(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("translation") != "").withColumn("audit_category", audit_category())


def _mentioning(entries: DataFrame, terms: list[Term], context: dict[str, Column]) -> DataFrame:
    return active_terms(_audited(entries).where("audit_category <> 'music_credit'"), terms, context, missing_fails=False)


def findings_by_type(found: DataFrame) -> DataFrame:
    return found.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def audit_counters(entries: DataFrame, terms: list[Term], context: dict[str, Column], keys: list[str]) -> DataFrame:
    """One row: entries, translated, untranslated, credit fields, and entries with terms."""
    done = F.col("translation") != ""
    plain = entries.agg(F.count(F.lit(1)).alias("entries"), F.count_if(done).alias("translated"), F.count_if(~done).alias("untranslated"), F.count_if(done & credit_key()).alias("music_credit_fields"))
    with_terms = _mentioning(entries, terms, context).agg(F.count_distinct(*keys).alias("entries_with_terms"))
    return plain.join(with_terms, F.lit(True))  # one row each


def mentions_by_category(entries: DataFrame, terms: list[Term], context: dict[str, Column]) -> DataFrame:
    """Active terms by category, counted before those of one character are left out."""
    return _mentioning(entries, terms, context).groupBy("category").agg(F.count(F.lit(1)).alias("mentions"))


def audit_variants(entries: DataFrame, terms: list[Term], context: dict[str, Column], order: str, examples: int = 2) -> DataFrame:
    """Variants of sources among the entries that mention an active term."""
    rows = _mentioning(entries, terms, context).select("source", "translation", order).distinct()
    return source_variants(rows, "source", "translation", order, examples)


def source_variants(rows: DataFrame, source: str, translation: str, order: str, examples: int = 2) -> DataFrame:
    """Translations of each source that has several: count and the first examples' orders."""
    w = Window.partitionBy(source, translation).orderBy(order)
    counted = rows.groupBy(source, translation).agg(F.count(F.lit(1)).alias("n"))
    several = counted.groupBy(source).agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    first = rows.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= examples)
    shown = first.groupBy(source, translation).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.col(order))), lambda x: x.cast("string")), ",").alias("examples"))
    return counted.join(several, source, "left_semi").join(shown, [source, translation])


def discovered(rows: DataFrame, source: str, category: str, scope: str, order: str, known: DataFrame | None = None, examples: int = 2) -> DataFrame:
    """Candidates: for each category, source and scope the count and first examples, with totals.

    ``known``: glossary (source, target) for ``in_glossary``.
    """
    w = Window.partitionBy(category, source, scope).orderBy(order)
    first = rows.withColumn("_at", F.row_number().over(w))
    shown = first.groupBy(category, source, scope).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_at") <= examples, F.col(order)))), lambda x: x.cast("string")), ",").alias("examples"),
    )
    totals = rows.groupBy(category, source).agg(F.count(F.lit(1)).alias("occurrences"))
    out = shown.join(totals, [category, source])
    if known is None:
        return out
    return out.join(known.select(F.col("source").alias(source), F.lit(True).alias("_known")), source, "left").withColumn("in_glossary", F.coalesce("_known", F.lit(False))).drop("_known")


def distinct_locations(rows: DataFrame, source: str, *location: str) -> DataFrame:
    return rows.groupBy(source).agg(F.array_sort(F.collect_set(F.struct(*location))).alias("locations"))


def varying_keys(rows: DataFrame, key: str, source: str) -> DataFrame:
    """Keys that were seen with more than one source, and those, sorted."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_set(source)).alias("sources")).where(F.size("sources") > 1)
