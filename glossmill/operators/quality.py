"""Row rules as named conditions: the first that fails, in order, is a row's reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T

Rules = list[tuple[str, Column]]  # (reason, condition that a good row meets)


class Violation(ValueError):
    """Rows break a rule that must hold."""


def reason(rules: Rules) -> Column:
    """The name of the first broken rule, or null. A condition that is null is broken."""
    out = F.lit(None).cast("string")
    for name, good in reversed(rules):
        out = F.when(~F.coalesce(good, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def violations(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule, with its name as ``reason``. The rules are evaluated once, in order,
    and only up to the first that a row breaks: an explode keeps Spark from doing it twice."""
    return df.withColumn("reason", F.explode(F.array_compact(F.array(reason(rules)))))


def or_raise(value: Column, bad: Column, what: str) -> Column:
    """The value, or an error where ``bad`` holds: a check that needs no pass of its own."""
    return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(what))).otherwise(value)


#: Rows that a report of broken rules shows.
SHOWN = 30


def assert_none(bad: DataFrame, what: str, shown: int = SHOWN) -> None:
    """Raise with the first examples if the frame has rows; reads no more than it shows."""
    examples = bad.limit(shown).collect()
    if examples:
        raise Violation(f"{what}: {[r.asDict() for r in examples]}")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def may_reflow(table: str = "tbl", field: str = "field") -> Column:
    """Names of stories may be broken into other lines than their source."""
    return (F.col(table) == "Story") & (F.col(field) == "name")


def story_line(source: str, target: str) -> Rules:
    return [
        ("empty", F.col(target) != ""),
        ("forbidden_character", ~F.col(target).rlike(r"[\r\n\[\]]")),
        ("placeholders", T.same_multiset(source, target, P.STORY_PLACEHOLDER)),
        ("line_breaks", T.same_occurrences(source, target, "\\n")),
    ]


def record_line(source: str, target: str, may_reflow: Column | None = None) -> Rules:
    breaks = T.same_occurrences(source, target, "\n", "\r")
    return [
        ("blank", T.trimmed(target) != ""),
        ("placeholders", T.same_multiset(source, target, P.RECORD_TOKEN)),
        ("brackets", T.same_occurrences(source, target, "<", ">")),
        ("line_breaks", breaks if may_reflow is None else breaks | may_reflow),
        ("literal_breaks", T.same_occurrences(source, target, "\\n")),
    ]


def notice_line(source: str, target: str) -> Rules:
    return [*record_line(source, target), ("numbers", T.same_sequence(source, target, P.NUMBER))]


def legal_line(source: str, target: str) -> Rules:
    blank = T.trimmed(source) == ""
    rules = [("blank_changed", ~blank | (F.col(source) == F.col(target)))]
    rules += [(name, blank | good) for name, good in record_line(source, target)]
    return [
        *rules,
        ("protected", T.same_sequence(source, target, P.LEGAL_PROTECTED)),
        ("marker_left", ~F.col(target).rlike("⟦[0-9]+⟧")),
    ]


def interface_line(source: str, target: str) -> Rules:
    empty = F.col(target) == ""
    return [
        ("placeholders", empty | T.same_multiset(source, target, P.RECORD_TOKEN)),
        ("line_breaks", empty | T.same_occurrences(source, target, "\n", "\\n")),
    ]


def policy_term(strict: bool = True) -> Rules:
    """Rules of a scoped term: source, target, action, scope keys; strict: non-empty patterns."""
    keys = F.array(*(F.lit(k) for k in ("kind", "table", "id", "field", "script", "speaker")))
    scope = F.coalesce(F.col("scope"), F.create_map().cast("map<string,string>"))
    rules = [
        ("source", F.col("source") != ""),
        ("target", F.col("target") != ""),
        ("action", F.col("action").isin("prefer", "retain")),
        ("retain_target", (F.col("action") != "retain") | (F.col("source") == F.col("target"))),
        ("scope_key", F.size(F.array_except(F.map_keys(scope), keys)) == 0),
    ]
    return rules + ([("scope_pattern", F.forall(F.map_values(scope), lambda p: p != ""))] if strict else [])
