"""Patterns of the corpora, in the regular expressions that Spark runs, and helpers that build them."""

from __future__ import annotations

import re

# The patterns of placeholders, protected spans and line kinds in each corpus. Where
# any digit counts, \p{Nd} stands for \d, which takes ASCII alone in Java; for the same reason
# \p{L}, \p{N} and \x{...} stand for \w and \u....
STORY_PLACEHOLDER = r"\{[A-Za-z_][A-Za-z_0-9]*(?::[^{}]+)?\}|\{\p{Nd}+(?::[^{}]+)?\}|<[^>]+>"
RECORD_TOKEN = r"\{\p{Nd}+(?::[^{}]+)?\}|%(?:\p{Nd}+\$)?[-+#0 ]*\p{Nd}*(?:\.\p{Nd}+)?[sdif]|<[/]?[A-Za-z][^>]*>|<#[0-9A-Fa-f]{6,8}>"
CANDIDATE_PLACEHOLDER = r"\{[^{}]+\}|<[^<>]+>|\$[\p{L}\p{N}_]+|%[A-Za-z0-9]+|\\[nrt]"
GLOSSARY_PLACEHOLDER = r"\{[^{}]+\}"
NUMBER = r"[0-9０-９]+(?:[,.][0-9０-９]+)*"
URL = r"https?://[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]+"
NOTICE_PROTECTED = rf"{RECORD_TOKEN}|{URL}|[0-9０-９]+(?:[/：:／.,，．\-－][0-9０-９]+)+|{NUMBER}|\r\n|\r|\n|\\n|[<>]"
LEGAL_PREFIX = r"^[ \t\x{3000}]*(?:(?:[（(][0-9０-９]+[）)])|(?:[0-9０-９]+[.．])|(?:[0-9０-９]+[ \t]+)|[■◆●・○※])[ \t\x{3000}]*"
LEGAL_PROTECTED = rf"{LEGAL_PREFIX}|{URL}|[0-9０-９]+|^[ \t\x{{3000}}]+|[ \t\x{{3000}}]+$"
KANA_OR_HAN = r"[\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]"
PROSE_KANA_OR_HAN = r"[ぁ-んァ-ヶ一-龯]"
DATE_ONLY = r"\A(?=[^0-9]*[0-9])[0-9\s\x{3000}/\-:().~〜～年月火水木金土日]+\z"
DATE_LIKE = r"\A[\p{Nd}\s\x{3000}年月日時分秒./:：_-]+\z"
NON_WORD_ONLY = r"\A[^\p{L}\p{Nl}\p{No}]*\z"
CREDIT_LINE = r"(?i)\A[\s\x{3000}]*(?:(?:作詞|作曲|編曲)(?:[・/／＆&](?:作詞|作曲|編曲))*|Lyrics|Music|Arrangement)[\s\x{3000}]*[:：]"
NOTICE_CREDIT = r"\A((?:作詞|作曲|編曲)(?:・(?:作詞|作曲|編曲))*)([ \t\x{3000}]*[:：])([^\r\n]+)\z"
#: Labels of credits as they are written in translations.
CREDIT_LABELS = {"作詞": "作词", "編曲": "编曲"}
ENTITY_FIELD = r"(?i)(?:^|\.)(?:name|title|fullName)$"
FIELD_ID = r"\A\p{Nd}+:(?:text|title|choice|narration):\p{Nd}+\z"
NOTICE_PAGE = r"\A/notice/[0-9a-f]{64}/index\.html\z"
HASH = r"\A[0-9a-f]{64}\z"
LINE_BREAK = r"\r\n|\r|\n"

SPACE_ENDS = r"(?U)^\s+|\s+$"


def java_literal(text: str) -> str:
    """A regular expression that matches a text itself; safe for any text."""
    return re.sub(r"([^\w\s]|_)", r"\\\1", text, flags=re.ASCII) if text.isascii() else "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def alternation(terms: list[str]) -> str:
    """Longest first, so that a longer term shadows one inside it; then by code points."""
    return "|".join(java_literal(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))


def glob_regex(glob: str) -> str:
    """A glob (``*``, ``?``, ``[seq]``, ``[!seq]``) as a pattern of the whole text."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        i += 1
        close = glob.find("]", i + 1 + glob.startswith("!", i)) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif close > 0:
            body = re.sub(r"([\\\[\]^&])", r"\\\1", glob[i + glob.startswith("!", i) : close])
            out.append(f"[{'^' if glob.startswith('!', i) else ''}{body}]")
            i = close + 1
        else:
            out.append(java_literal(c))
    return r"(?s)\A" + "".join(out) + r"\z"


def token_pattern(term: str, literal_break: bool = False) -> str:
    """The term as a whole token: bounded only on sides where its own edge is ASCII alphanumeric.

    ``literal_break``: a written-out ``\\n`` before the term is a boundary as well.
    """
    edge = re.compile("[A-Za-z0-9]")
    before = r"(?<![A-Za-z0-9_])"
    left = (rf"(?:{before}|(?<=\\n))" if literal_break else before) if edge.match(term[:1]) else ""
    right = r"(?![A-Za-z0-9_])" if edge.match(term[-1:]) else ""
    return left + java_literal(term) + right
