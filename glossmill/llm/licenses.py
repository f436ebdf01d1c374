"""Operator 9: license scan by template-markup matching.

A template is license wording with markup: ``[[...]]`` is optional and may be nested, ``{{n}}``
stands for one to n words of any kind. Each template compiles to a token automaton; a text is
accepted where the mandatory words follow one another exactly, with nothing between but what the
markup allows. A label has templates of the whole license and of the notices that refer to it.
Automata run over the words of texts that hold the template's rarest words at all.

Base phrases are plain: their words stand consecutively.

Edge cases: a null text is empty: no words, no places, empty labels and score 0; a null doc_id is
kept; repeated rows give repeated results; a template may match anywhere in a text of any length;
columns beyond the two named are left out. An empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.bytewords import slices

# Phrases and labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license wording, marked up.
TEMPLATES = {
    "gpl-3.0": [
        "licensed under the gnu general public license version 3 [[0]]",
        "this {{4}} is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free"
        " software foundation either version 3 of the license or [[at your option]] any later version [[this {{4}} is distributed in the hope that it will be"
        " useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general"
        " public license for more details]]",
        "either version 3 of the license or [[at your option]] any later version",
        "gnu general public license version 3 29 june 2007",
    ],
    "gpl-2.0": [
        "licensed under the gnu general public license version 2 [[0]]",
        "this {{4}} is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free"
        " software foundation either version 2 of the license or [[at your option]] any later version",
        "either version 2 of the license or [[at your option]] any later version",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "apache license version 2 0 january 2004",
        "licensed under the apache license version 2 0 the license you may not use {{6}} except in compliance with the license you may obtain a copy of the"
        " license at [[http www apache org licenses license 2 0]] [[https www apache org licenses license 2 0]] unless required by applicable law or agreed to"
        " in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or"
        " implied see the license for the specific language governing permissions and limitations under the license",
    ],
    "cc-by-4.0": [
        "licensed under [[a]] [[the]] [[creative commons attribution]] cc by 4 0",
        "licensed under [[a]] [[the]] creative commons attribution 4 0 [[international]] license",
    ],
    "cc-by-nc-4.0": [
        "licensed under [[a]] [[the]] cc by nc 4 0",
        "licensed under [[a]] [[the]] creative commons attribution noncommercial 4 0 [[international]] license",
    ],
    "cc-by-sa-4.0": [
        "licensed under [[a]] [[the]] cc by sa 4 0",
        "licensed under [[a]] [[the]] creative commons attribution sharealike 4 0 [[international]] license",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "[[the]] [[mit license]] [[mit]] [[copyright {{40}}]] permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the"
        " following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or"
        " substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the"
        " warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {{20}} be liable for any claim damages or other"
        " liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in"
        " the software",
    ],
    "bsd-2-clause": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
        " [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
        " [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the"
        " documentation and or other materials provided with the distribution this software is provided by {{20}} as is and any express or implied warranties"
        " including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
        " in no event shall {{20}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to"
        " procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability"
        " whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised"
        " of the possibility of such damage",
    ],
    "bsd-3-clause": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
        " [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
        " [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the"
        " documentation and or other materials provided with the distribution [[3]] neither the name of {{20}} may be used to endorse or promote"
        " products derived from this software without specific prior written permission this software is provided by {{20}} as is and any express or"
        " implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
        " in no event shall {{20}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to"
        " procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability"
        " whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised"
        " of the possibility of such damage",
    ],
    "isc": [
        "[[isc license]] [[copyright {{40}}]] permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided"
        " that the above copyright notice and this permission notice appear in all copies the software is provided as is and {{20}} disclaims all warranties"
        " with regard to this software including all implied warranties of merchantability and fitness in no event shall {{20}} be liable for any special"
        " direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract"
        " negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ],
}

_FOLD = bytes(
    32 if (c <= 0x2F or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F) else c + 32 if 0x41 <= c <= 0x5A else c
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]."""
    return text.encode().translate(_FOLD).split()


def _tokens(template: str) -> list[str]:
    return re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", template)


@dataclass
class Automaton:
    """States 0 .. final; ``step[s]``: (word or None for any, next state); ``skip[s]``: free moves."""

    step: list[list[tuple[bytes | None, int]]] = field(default_factory=lambda: [[]])
    skip: list[list[int]] = field(default_factory=lambda: [[]])

    def _state(self) -> int:
        self.step.append([])
        self.skip.append([])
        return len(self.step) - 1

    @classmethod
    def compiled(cls, template: str) -> Automaton:
        self, at, opened, needs = cls(), 0, [], set()
        for token in _tokens(template):
            if token == "[[":
                opened.append(at)
            elif token == "]]":
                if not opened:
                    raise ValueError(f"]] without [[ in {template!r}")
                self.skip[opened.pop()].append(at)
            elif token.startswith("{{"):
                end = self._state()
                for _ in range(int(token[2:-2])):
                    nxt = self._state()
                    self.step[at].append((None, nxt))
                    self.skip[nxt].append(end)
                    at = nxt
                at = end
            else:
                nxt = self._state()
                self.step[at].append((token.encode(), nxt))
                at = nxt
                if not opened:
                    needs.add(token.encode())
        if opened:
            raise ValueError(f"[[ without ]] in {template!r}")
        self.final = at
        self.starts = {word for s in self._closed({0}) for word, _ in self.step[s]}
        #: Words that every accepted text holds.
        self.needs = sorted(needs, key=lambda w: (-len(w), w))[:2]
        return self

    def _closed(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accepts(self, words: list[bytes]) -> bool:
        """Whether the wording stands anywhere in the words."""
        live: set[int] = set()
        for word in words:
            if word in self.starts or None in self.starts:
                live |= self._closed({0})
            if live:
                live = self._closed({n for s in live for w, n in self.step[s] if w is None or w == word})
                if self.final in live:
                    return True
        return False


def _places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> tuple[list[int], set[str]]:
    heads = {p[0] for p, _ in phrases}
    at = [i for i, w in enumerate(words) if w in heads]
    found = [(i, label) for i in at for p, label in phrases if words[i : i + len(p)] == p]
    return [i for i, _ in found], {label for _, label in found}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document: n_words, places and labels of phrases, labels with those of templates.

    score: 1 if a template accepts the text, 0.5 if only a phrase stands in it, else 0.
    """
    plain = [([w.encode() for w in p.split()], label) for p, label in (PHRASES if phrases is None else phrases).items()]
    automata = [(label, Automaton.compiled(t)) for label, ts in (TEMPLATES if templates is None else templates).items() for t in ts]
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    rare = [max(p, key=len) for p, _ in plain]

    def one(text: str) -> tuple:
        folded = text.encode().translate(_FOLD)
        words = folded.split()
        at, base = _places(words, plain) if any(w in folded for w in rare) else ([], set())
        more = {label for label, a in automata if all(w in folded for w in a.needs) and a.accepts(words)}
        score = 1.0 if more else 0.5 if base else 0.0
        return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), score

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                columns = list(zip(*(one(t or "") for t in part.column(1).to_pylist())))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def labels(spark, sf_dir: str) -> DataFrame:
    """The scan once more with -1 for places that there are not, so that SQL can be held against it."""
    found = query(spark, sf_dir)
    return found.withColumns({c: F.coalesce(c, F.lit(-1)).cast("long") for c in ("first_word", "last_word")})


def _regex(template: str) -> str:
    """The template as a regular expression over words that are each led by a blank."""
    out = []
    for token in _tokens(template):
        out.append("(?:" if token == "[[" else ")?" if token == "]]" else f"(?: [^ ]+){{1,{token[2:-2]}}}" if token[0] == "{" else f" {token}")
    return "".join(out) + " "


def _sql() -> str:
    at = ", ".join(
        f"list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(p.split()) - 1}] = {p.split()!r}), lambda i: i - 1) AS p{n}" for n, p in enumerate(PHRASES)
    )
    places = " || ".join(f"p{n}" for n in range(len(PHRASES)))
    base = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN '{label}' END" for n, label in enumerate(PHRASES.values()))
    more = ", ".join(f"CASE WHEN {' OR '.join(f"regexp_matches(line, '{_regex(t)}')" for t in ts)} THEN '{label}' END" for label, ts in TEMPLATES.items())
    return rf"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p AS (
  SELECT doc_id, len(w) AS n, ' ' || array_to_string(w, ' ') || ' ' AS line, {at} FROM t
), l AS (
  SELECT doc_id, n, {places} AS spots, list_filter([{base}], lambda x: x IS NOT NULL) AS base, list_filter([{more}], lambda x: x IS NOT NULL) AS more FROM p
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(spots) AS BIGINT) AS n_base, CAST(coalesce(list_min(spots), -1) AS BIGINT) AS first_word, CAST(coalesce(list_max(spots), -1) AS BIGINT) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || more)), ',') AS labels,
       CAST(CASE WHEN len(more) > 0 THEN 1 WHEN len(base) > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
FROM l
"""


LABELS_ORACLE = _sql()
