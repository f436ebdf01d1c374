"""The driver's tables as the corpora of the library: record and dialogue entries, notices, legal
lines, reviews. Each is a list of SQL columns that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossmill.functions import patterns as P
from glossmill.session import table


def pick(values: list[str | None], of: str) -> str:
    """One of the values, by the remainder of a number."""
    cases = " ".join(f"WHEN {i} THEN {'NULL' if v is None else quoted(v)}" for i, v in enumerate(values))
    return f"CASE {of} % {len(values)} {cases} END"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TABLES = ["Music", "Character", "EventStory", "Story", "Card", "StoryPart", "Gacha", "Unlisted", "CharacterGroup", "HomeTalk"]
_SOURCE = """CASE doc_id % 7 WHEN 0 THEN text WHEN 1 THEN '青い鍵 ' || source || ' ' || lang WHEN 2 THEN '{0}個 鍵 ' || text WHEN 3 THEN '2030/1/2 10:00'
 WHEN 4 THEN '作詞：' || lang WHEN 5 THEN '鍵' || text ELSE '鍵' END"""

#: Columns of ``entries`` over documents: two thirds records, one third dialogue.
ENTRY = [
    "doc_id AS seq",
    "CASE WHEN doc_id % 3 = 0 THEN 'story' ELSE 'master' END AS kind",
    f"CASE WHEN doc_id % 3 <> 0 THEN {pick(_TABLES, 'doc_id')} END AS tbl",
    "CASE WHEN doc_id % 5 = 0 THEN 'st-part-group-' || CAST(doc_id AS STRING) ELSE CAST(doc_id AS STRING) END AS id",
    "CASE WHEN doc_id % 3 = 0 THEN 'adv_' || source || '_' || lang || '.txt' END AS script",
    f"CASE WHEN doc_id % 3 = 0 THEN '1:' || {pick(['text', 'title', 'choice', 'narration'], 'doc_id')} || ':2' ELSE {pick(['name', 'description', 'composer', 'texts[0]', 'singer', 'item.Title'], 'doc_id')} END AS field",
    f"{_SOURCE} AS source",
    f"CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN {_SOURCE} WHEN 2 THEN replace({_SOURCE}, '鍵', '钥匙') ELSE '译 蓝钥匙' END AS translation",
    "CASE WHEN doc_id % 3 = 0 THEN source END AS speaker",
]
#: Lines with translations that break rules: id, s, t.
LINE = [
    "doc_id AS id",
    "'{0}' || text || ' 12,5' AS s",
    """CASE doc_id % 9 WHEN 0 THEN '' WHEN 1 THEN '{0}' || text || ' 12,5' || chr(10) WHEN 2 THEN '{0}' || text || ' 12,5<' WHEN 3 THEN '{1}' || text || ' 12,5'
 WHEN 4 THEN '[{0}' || text || ' 12,5' WHEN 5 THEN '{0}' || text || ' 12,6' WHEN 6 THEN '{0}' || text || ' 12,5' || chr(92) || 'n' WHEN 7 THEN '{0}' || text || ' 12,5⟦3⟧'
 ELSE '{0}' || text || ' 12,5' END AS t""",
]


def entries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr(*ENTRY)


def lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr(*LINE)


ENTRIES_SQL = f"e AS (SELECT {', '.join(ENTRY)} FROM documents)"
LINES_SQL = f"p AS (SELECT {', '.join(LINE)} FROM documents)"


# --- the library's rules once more, in DuckDB's SQL ------------------------------------------------


def found(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {quoted(pattern)})"


def matches(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {quoted(pattern)})"


def trimmed(text: str) -> str:
    return f"regexp_replace({text}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def count(text: str, part: str) -> str:
    return f"(length({text}) - length(replace({text}, {part}, '')))"


def is_candidate(text: str) -> str:
    """With written-out line feeds taken for real ones."""
    v = trimmed(text)
    broken = f"replace({v}, chr(92) || 'n', chr(10))"
    return f"({v} <> '' AND length({v}) <= 120 AND NOT {matches(broken, P.CANDIDATE_PLACEHOLDER)} AND NOT {matches(v, P.NON_WORD_ONLY)} AND NOT {matches(v, P.DATE_LIKE)})"


def chain(rules: list[tuple[str, str]]) -> str:
    """The first rule that is not met."""
    return "CASE " + " ".join(f"WHEN NOT coalesce({good}, FALSE) THEN '{name}'" for name, good in rules) + " END"


def same(a: str, b: str, *parts: str) -> str:
    return "(" + " AND ".join(f"{count(a, p)} = {count(b, p)}" for p in parts) + ")"


def record_rules(s: str, t: str) -> list[tuple[str, str]]:
    return [
        ("blank", f"{trimmed(t)} <> ''"),
        ("placeholders", f"list_sort({found(s, P.RECORD_TOKEN)}) = list_sort({found(t, P.RECORD_TOKEN)})"),
        ("brackets", same(s, t, "'<'", "'>'")),
        ("line_breaks", same(s, t, "chr(10)", "chr(13)")),
        ("literal_breaks", same(s, t, "chr(92) || 'n'")),
    ]


def credit_line(text: str) -> str:
    return matches(text, P.CREDIT_LINE)


ENTITY = matches("field", P.ENTITY_FIELD)
STRATUM = "CASE WHEN kind = 'master' THEN 'master:' || tbl ELSE 'story:' || split_part(script, '_', 1) || '_' || split_part(script, '_', 2) END"
