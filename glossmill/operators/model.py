"""The one seam of a text model: a function of a batch of lines, run where the batches are.

A service is any picklable callable ``lines -> {id: text}`` with lines as dicts. Calls go out from
tasks; a failed batch is tried again, then halved, then split on line breaks, and what succeeded is
kept. Answers are rows, so a job that starts over asks only for what the log lacks.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.operators import terms

Service = Callable[[list[dict]], dict[str, str]]
Check = Callable[[str, str], bool]
_BREAK = re.compile(r"(\r\n|\r|\n)")


def answered(lines: list[dict], service: Service, check: Check, tries: int = 3) -> dict[str, str]:
    """Valid answers by id; ids without one are missing."""
    for _ in range(tries):
        try:
            got = service(lines)
        except ValueError:
            continue
        if sorted(got) == sorted(line["id"] for line in lines) and all(check(line["source"], got[line["id"]]) for line in lines):
            return got
    if len(lines) > 1:
        half = len(lines) // 2
        return answered(lines[:half], service, check, tries) | answered(lines[half:], service, check, tries)
    line = lines[0] if lines else {"id": "", "source": ""}
    parts = _BREAK.split(line["source"])
    if len(parts) == 1:
        return {}
    out = []
    for i, part in enumerate(parts):
        if i % 2 or not part.strip():
            out.append(part)
            continue
        got = answered([{**line, "id": f"{line['id']}#{i}", "source": part}], service, check, tries)
        if not got:
            return {}
        out += got.values()
    return {line["id"]: "".join(out)}


def run_batches(batches: DataFrame, service: Service, check: Check, id: str = "id", source: str = "source", batch: str = "batch", also: tuple[str, ...] = ()) -> DataFrame:
    """(id, translation, status) of every row; status done or failed.

    ``batches`` carries the batch of each row; a batch is asked in one task. Columns named in
    ``also``, such as a line's preferred terms, are given to the service with each line.
    """

    def run(frames):
        held = None

        def ask(part):
            lines = [{"id": str(i), "source": s, **dict(zip(also, rest))} for i, s, *rest in zip(part[id], part[source], *(part[c] for c in also))]
            got = answered(lines, service, check)
            texts = [got.get(line["id"]) for line in lines]
            return part[[id]].assign(translation=texts, status=["done" if t is not None else "failed" for t in texts])

        import pandas as pd

        for frame in frames:  # a batch may go on in the next frame
            frame = frame if held is None else pd.concat([held, frame])
            last = frame[batch].iloc[-1] if len(frame) else None
            held = frame[frame[batch] == last]
            for _, part in frame[frame[batch] != last].groupby(batch, sort=False):
                yield ask(part)
        if held is not None and len(held):
            yield ask(held)

    kind = dict(batches.dtypes)[id]
    dealt = batches.select(id, source, batch, *also).repartition(batch).sortWithinPartitions(batch, id)
    return dealt.mapInPandas(run, f"`{id}` {kind}, translation string, status string")


def not_yet_done(rows: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Rows that the log holds no complete result for; partial ones don't count."""
    return rows.join(log.where("status = 'done'").select(key), key, "left_anti")


def relevant_glossary(rows: DataFrame, glossary: dict[str, str], text: Column, keys: list[str] | None = None) -> DataFrame:
    """Adds ``glossary``: the entries whose source stands in the text. A large glossary is joined; ``keys``
    then name the columns that tell rows apart (all, if not given)."""
    if len(glossary) <= terms.FEW_TERMS:
        whole = F.create_map(*(F.lit(x) for kv in glossary.items() for x in kv)) if glossary else F.create_map().cast("map<string,string>")
        return rows.withColumn("glossary", F.map_filter(whole, lambda k, _: F.contains(text, k)))
    keys = keys or rows.columns
    told = rows.withColumn("_told", text)
    known = rows.sparkSession.createDataFrame(list(glossary.items()), "candidate string, target string")
    met = terms.contained(told, sorted(k for k in glossary if k), "_told", keys).join(known, "candidate")
    own = met.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("candidate", "target")))).alias("glossary"))
    return rows.join(own, keys, "left").withColumn("glossary", F.coalesce("glossary", F.create_map().cast("map<string,string>")))


def reply(content: object, finish_reason: str | None = None) -> dict[str, str]:
    """id to translation of what a model wrote: JSON of a list ``translations``, perhaps fenced or with
    words around it. Anything else, a cut answer or an id given twice is an error, so its batch is asked again."""
    if not isinstance(content, str) or finish_reason == "length":
        raise ValueError("no whole text")
    fenced = re.fullmatch(r"\s*```[^\n]*\n(.*)```\s*", content, re.DOTALL)
    text = (fenced[1] if fenced else content).strip()
    first, last = text.find("{"), text.rfind("}")
    if not text.startswith("{") and 0 <= first < last:
        text = text[first : last + 1]
    try:
        listed = json.loads(text)["translations"]
        pairs = [(entry["id"], entry.get("translation", entry.get("source"))) for entry in listed]
    except (ValueError, KeyError, TypeError, AttributeError) as error:
        raise ValueError("not the JSON that was asked for") from error
    if not isinstance(listed, list) or not all(isinstance(x, str) for pair in pairs for x in pair):
        raise ValueError("ids and translations are texts")
    if len({i for i, _ in pairs}) < len(pairs):
        raise ValueError("an id was answered twice")
    return dict(pairs)


def echo_service(lines: list[dict]) -> dict[str, str]:
    """The offline stand-in: every text in brackets that no rule counts."""
    return {line["id"]: f"«{line['source']}»" for line in lines}


def patient(service: Service, attempts: int = 6, wait: Callable[[float], None] = time.sleep, longest: float = 8.0) -> Service:
    """The service, asked again after growing pauses while it can't be reached. An error may carry
    ``retry_after`` seconds of its own."""

    def ask(lines: list[dict]) -> dict[str, str]:
        for turn in range(attempts):
            try:
                return service(lines)
            except (ConnectionError, TimeoutError) as error:
                if turn == attempts - 1:
                    raise
                wait(max(getattr(error, "retry_after", 0.0), min(2.0**turn, longest)))
        return {}

    return ask
