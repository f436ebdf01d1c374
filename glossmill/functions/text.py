"""Column functions over text: matches, counts, normalisers, masks and identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossmill.functions import patterns as P


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches(text: Column | str, pattern: str) -> Column:
    """All matches in order."""
    return F.regexp_extract_all(col(text), F.lit(pattern), F.lit(0))


def same_multiset(a: Column | str, b: Column | str, pattern: str) -> Column:
    return F.array_sort(matches(a, pattern)) == F.array_sort(matches(b, pattern))


def same_sequence(a: Column | str, b: Column | str, pattern: str) -> Column:
    return matches(a, pattern) == matches(b, pattern)


def occurrences(text: Column | str, part: str) -> Column:
    """How often a plain text occurs, without overlaps."""
    return ((F.length(col(text)) - F.length(F.replace(col(text), F.lit(part), F.lit("")))) / len(part)).cast("long")


def same_occurrences(a: Column | str, b: Column | str, *parts: str) -> Column:
    out = F.lit(True)
    for part in parts:
        out = out & (occurrences(a, part) == occurrences(b, part))
    return out


def trimmed(text: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col(text), P.SPACE_ENDS, "")


def has_kana_or_han(text: Column | str) -> Column:
    return col(text).rlike(P.KANA_OR_HAN)


def is_credit_line(text: Column | str) -> Column:
    return col(text).rlike(P.CREDIT_LINE)


def candidate_text(text: Column | str, literal_breaks: bool = False) -> Column:
    """The trimmed text if it may be a term, else null."""
    value = trimmed(text)
    tested = F.replace(value, F.lit("\\n"), F.lit("\n")) if literal_breaks else value
    bad = (
        (value == "")
        | (F.length(value) > 120)
        | tested.rlike(P.CANDIDATE_PLACEHOLDER)
        | value.rlike(P.NON_WORD_ONLY)
        | value.rlike(P.DATE_LIKE)
    )
    return F.when(~bad, value)


def contains_token(text: Column | str, term: str, literal_break: bool = False) -> Column:
    return col(text).rlike(P.token_pattern(term, literal_break))


def mentions(text: Column | str, terms: list[str]) -> Column:
    """Distinct terms by longest-first alternation, in order of their first place."""
    return F.array_distinct(matches(text, P.alternation(terms))) if terms else F.array().cast("array<string>")


def imposed_line_endings(source: Column | str, target: Column | str) -> Column:
    """The target with the source's line breaks, where both have as many."""
    breaks = matches(source, P.LINE_BREAK)
    lines = F.split(col(target), P.LINE_BREAK, -1)
    joined = F.array_join(F.zip_with(lines, breaks, lambda line, end: F.concat(line, F.coalesce(end, F.lit("")))), "")
    return F.when(F.size(breaks) == F.size(lines) - 1, joined).otherwise(col(target))


def story_normalised(source: Column | str, target: Column | str) -> Column:
    """Real line feeds become written-out ones where the source has as many; full-width brackets."""
    written, real = occurrences(source, "\\n"), occurrences(target, "\n")
    broken = F.when((real > 0) & (written == real + occurrences(target, "\\n")), F.replace(col(target), F.lit("\n"), F.lit("\\n"))).otherwise(col(target))
    return F.translate(broken, "[]", "［］")


def _with_markers(pattern: str, open_mark: str, close_mark: str) -> str:
    """The pattern, or a marker that the text itself holds, so that it can't be taken for ours."""
    return f"{P.java_literal(open_mark)}[0-9]+{P.java_literal(close_mark)}|{pattern}"


def masked(text: Column | str, pattern: str, open_mark: str = "⟦", close_mark: str = "⟧") -> Column:
    """The text with every match replaced by a numbered marker. The pattern never matches empty.

    What looks like a marker in the text is masked as well.
    """
    pattern = _with_markers(pattern, open_mark, close_mark)
    found = matches(text, pattern)
    between = F.split(col(text), pattern, -1)
    marks = F.transform(found, lambda _, i: F.concat(F.lit(open_mark), i.cast("string"), F.lit(close_mark)))
    return F.array_join(F.zip_with(between, marks, lambda plain, mark: F.concat(plain, F.coalesce(mark, F.lit("")))), "")


def unmasked(masked_text: Column | str, source: Column | str, pattern: str, open_mark: str = "⟦", close_mark: str = "⟧") -> Column:
    """Markers replaced by what they stand for in the source."""
    marker = f"{P.java_literal(open_mark)}([0-9]+){P.java_literal(close_mark)}"
    numbers = F.regexp_extract_all(col(masked_text), F.lit(marker), F.lit(1))
    between = F.split(col(masked_text), marker, -1)
    found = matches(source, _with_markers(pattern, open_mark, close_mark))
    spans = F.transform(numbers, lambda n: F.coalesce(F.get(found, n.cast("int")), F.lit("")))
    return F.array_join(F.zip_with(between, spans, lambda plain, span: F.concat(plain, F.coalesce(span, F.lit("")))), "")


def normal_field(field: Column | str) -> Column:
    """A field path without its array positions."""
    return F.regexp_replace(col(field), r"\[[0-9]+\]", "[]")


def excerpt(text: Column | str, n: int = 120) -> Column:
    return F.substring(col(text), 1, n)


def stratum(kind: Column | str, table: Column | str, script: Column | str) -> Column:
    return F.when(col(kind) == "master", F.concat(F.lit("master:"), col(table))).otherwise(F.concat(F.lit("story:"), F.substring_index(col(script), "_", 2)))


def canonical_json(**parts: Column | str) -> Column:
    """A JSON object with its keys in order and nothing between; nulls are kept, as are letters."""
    return F.to_json(F.struct(*(col(parts[name]).alias(name) for name in sorted(parts))), {"ignoreNullFields": "false"})


def content_hash(*parts: Column | str, **named: Column | str) -> Column:
    """SHA-256 of the canonical JSON of the parts; those without a name are c00, c01 and so on."""
    return F.sha2(canonical_json(**{f"c{i:02d}": p for i, p in enumerate(parts)}, **named), 256)


def short_id(*parts: Column | str, **named: Column | str) -> Column:
    return F.substring(content_hash(*parts, **named), 1, 24)


def credit_parts(text: Column | str) -> Column:
    """label as translations write it, separator and names of a one-line credit of a notice; null
    for any other text."""
    label, separator, names = (F.regexp_extract(col(text), P.NOTICE_CREDIT, i) for i in (1, 2, 3))
    for old, new in P.CREDIT_LABELS.items():
        label = F.replace(label, F.lit(old), F.lit(new))
    return F.when(col(text).rlike(P.NOTICE_CREDIT) & (trimmed(names) != ""), F.struct(label.alias("label"), separator.alias("separator"), names.alias("names")))


def interface_normalised(source: Column | str, target: Column | str) -> Column:
    """Written-out line feeds become real ones where the source has real ones only, or the reverse."""
    s, t = col(source), col(target)
    real = F.when((occurrences(s, "\n") > 0) & (occurrences(s, "\\n") == 0), F.replace(t, F.lit("\\n"), F.lit("\n")))
    return F.coalesce(real, F.when((occurrences(s, "\\n") > 0) & (occurrences(s, "\n") == 0), F.replace(t, F.lit("\n"), F.lit("\\n"))), t)


def portable_path(path: Column | str, projects: list[str]) -> Column:
    """A path below somebody's home as it is below one of the projects, or else its last part."""
    p = col(path)
    plain = F.replace(p, F.lit("\\"), F.lit("/"))
    out = F.substring_index(plain, "/", -1)
    for project in reversed(projects):
        at = F.locate(f"/{project}/", plain)
        out = F.when(at > 0, F.substring(plain, at + 1, F.length(plain))).otherwise(out)
    return F.when(p.rlike(r"\A(?:/Users/|/home/|[A-Za-z]:[\\/]Users[\\/])"), out).otherwise(p)


def fenced_json(answer: Column | str) -> Column:
    """The JSON of a model's answer, without a code fence around it; null if a fence is not closed."""
    text = trimmed(answer)
    inner = F.regexp_extract(text, r"(?s)\A```[^\n]*\n(.*)```", 1)
    closed = text.rlike(r"(?s)\A```[^\n]*\n.*```")
    return F.when(~text.startswith("```"), text).when(closed, trimmed(inner))
