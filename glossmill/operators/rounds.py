"""Asking a text model in rounds: what failed is asked again, in smaller batches, until it holds.

Each round is one Spark job. Lines go out in batches, one call of the service for each; what comes back is
put back in place of markers, normalised and judged by the JVM's rules, line by line. Lines that hold are
done. Those that don't, and only those, are the next round's: with ``caps`` first together, then in
halves, at last alone. A line that fails alone is split on its line breaks and its parts are asked.
Rounds are written as tables in the shared folder, so that no answer is asked for twice within a run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.operators import evidence
from glossmill.operators.model import Service
from glossmill.operators.quality import Rules, reason
from glossmill.session import written

BREAK = r"\r\n|\r|\n"
UNANSWERED = "unanswered"


def halved(rows: int, tries: int = 3) -> list[int]:
    """Batches as they are ``tries`` times, then half as long each round, and a line alone ``tries`` times."""
    caps = [rows] * tries
    while caps[-1] > 1:
        caps.append((caps[-1] + 1) // 2)
    return [*caps, *([1] * (tries - 1) if rows > 1 else [])]


def once_more(rows: int) -> list[int]:
    """A batch once, and each line of it that failed once more alone."""
    return [rows, 1]


def _called(lines: DataFrame, service: Service, also: tuple[str, ...]) -> DataFrame:
    """The lines with ``_answer``: one call for each value of ``_group``. An answer to other ids than were
    asked, or none at all, leaves the whole group without. Lines pass through as they are, so that no answer
    has to find its line again."""
    names = lines.columns
    where = {c: names.index(c) for c in ("_id", "_asked", "_group", *also)}

    def run(batches):
        held = None

        def ask(part: pa.Table) -> list[str | None]:
            columns = {c: part.column(i).to_pylist() for c, i in where.items()}
            asked = [{"id": i, "source": s, **{c: columns[c][n] for c in also}} for n, (i, s) in enumerate(zip(columns["_id"], columns["_asked"]))]
            try:
                got = service(asked)
            except ValueError:
                got = {}
            if not isinstance(got, dict) or set(got) != {line["id"] for line in asked}:
                got = {}
            return [a if isinstance(a := got.get(line["id"]), str) else None for line in asked]

        def answered(table: pa.Table, groups: list) -> Iterator[pa.RecordBatch]:
            """The groups of a table, which are all there."""
            cuts = [0, *(i for i in range(1, len(groups)) if groups[i] != groups[i - 1]), len(groups)]
            answers = [x for i, j in zip(cuts, cuts[1:]) if j > i for x in ask(table.slice(i, j - i))]
            yield from table.append_column("_answer", pa.array(answers, pa.string())).to_batches()

        for batch in batches:  # a group may go on in the next batch
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            groups = table.column(where["_group"]).to_pylist()
            end = next((i for i in range(len(groups) - 1, -1, -1) if groups[i] != groups[-1]), -1) + 1
            held = table.slice(end)
            if end:
                yield from answered(table.slice(0, end), groups[:end])
        if held is not None and held.num_rows:
            yield from answered(held, held.column(where["_group"]).to_pylist())

    schema = ", ".join(f"`{c}` {kind}" for c, kind in lines.dtypes) + ", _answer string"
    return lines.repartition("_group").sortWithinPartitions("_group", "_id").mapInArrow(run, schema)


def _round(lines: DataFrame, service: Service, rules: Callable[[str, str], Rules], mask: str | None, normalise: Callable[[str, str], Column] | None, also: tuple[str, ...]) -> DataFrame:
    """The lines with ``translation`` and ``reason``, null where the answer holds; written. Of lines that are
    done the source is no longer kept."""
    got = _called(lines.withColumn("_asked", T.masked("source", mask) if mask else F.col("source")), service, also)
    if mask:
        got = got.withColumn("translation", T.unmasked("_answer", "source", mask))
        marks = r"⟦([0-9]+)⟧"
        count = lambda c: F.array_sort(F.regexp_extract_all(F.col(c), F.lit(marks), F.lit(1)))
        kept = [("markers", count("_asked") == count("_answer"))]
    else:
        got, kept = got.withColumn("translation", F.col("_answer")), []
    if normalise:
        got = got.withColumn("translation", normalise("source", "translation"))
    why = reason([(UNANSWERED, F.col("_answer").isNotNull()), *kept, *rules("source", "translation")])
    judged = got.withColumn("reason", why).drop("_asked", "_answer")
    failed = F.col("reason").isNotNull()
    return written(judged.withColumns({"source": F.when(failed, F.col("source")), "translation": F.when(~failed, F.col("translation"))}), "round")


def asked(
    rows: DataFrame, service: Service, rules: Callable[[str, str], Rules], caps: list[int], key: str = "key", batch: str = "batch",
    mask: str | None = None, normalise: Callable[[str, str], Column] | None = None, also: tuple[str, ...] = (), split: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(answers, rejected).

    answers: ``key``, translation, status (done, failed), reason of the last rejection or null, round
    in which it was settled, from 0. rejected: key, round, reason of every answer that broke a rule.

    rows: a key that tells rows apart, source, the batch of each, and what ``rules`` and ``also`` name. ``rules`` are
    given the names of the source's and the translation's columns; ``mask``: a pattern whose
    matches the service doesn't see. ``caps``: rows of a batch asked together, for each round.
    """
    kind = dict(rows.dtypes)[key]
    frontier = rows.withColumn("_id", F.col(key).cast("string")).withColumn("_group", F.col(batch).cast("string"))
    done, rejected = [], []
    for turn, cap in enumerate(caps):
        at = F.row_number().over(Window.partitionBy("_group").orderBy("_id")) - 1  # a batch
        if turn and cap < caps[turn - 1]:
            frontier = frontier.withColumn("_group", F.concat_ws("/", "_group", F.floor(at / cap).cast("string")))
        judged = _round(frontier, service, rules, mask, normalise, also)
        done.append(judged.where("reason IS NULL").select(key, "translation", F.lit("done").alias("status"), "reason", F.lit(turn).alias("round")))
        rejected.append(judged.where("reason IS NOT NULL").select(key, F.lit(turn).alias("round"), "reason"))
        frontier = judged.where("reason IS NOT NULL").drop("translation", "reason")
        left = judged.where("reason IS NOT NULL").select(key, "reason")
        if left.isEmpty():
            break
    turn = len(rejected)
    parted = frontier.where(F.col("source").rlike(BREAK)) if split else frontier.where("false")
    if split and not parted.isEmpty():
        joined = written(_by_parts(parted, service, rules, caps, mask, normalise, also), "parts")
        good = joined.withColumn("reason", reason([(UNANSWERED, F.col("translation").isNotNull()), *rules("source", "translation")]))
        done.append(good.where("reason IS NULL").select(key, "translation", F.lit("done").alias("status"), "reason", F.lit(turn).alias("round")))
        left = left.join(good.where("reason IS NULL").select(key), key, "left_anti")
    failed = left.select(key, F.lit(None).cast("string").alias("translation"), F.lit("failed").alias("status"), "reason", F.lit(turn - 1).alias("round"))
    answers, told = failed, rejected[0]
    for frame in done:
        answers = answers.unionByName(frame)
    for frame in rejected[1:]:
        told = told.unionByName(frame)
    return answers.withColumn(key, F.col(key).cast(kind)), told


def _by_parts(lines: DataFrame, service, rules, caps: list[int], mask, normalise, also) -> DataFrame:
    """The lines with the translation that their parts between line breaks make, or null."""
    ends = F.regexp_extract_all("source", F.lit(f"({BREAK})"), F.lit(1))
    cut = lines.withColumn("_ends", ends).withColumn("_parts", F.split("source", BREAK, -1))
    parts = cut.select("*", F.posexplode("_parts").alias("_n", "_part"))
    wanted = parts.where(T.trimmed("_part") != "")
    own = wanted.withColumn("source", F.col("_part")).withColumn("_key", F.concat_ws("#", "_id", F.col("_n").cast("string"))).drop("_id", "_group")
    got, _ = asked(own.withColumn("_batch", F.col("_key")), service, rules, [1] * sum(c == 1 for c in caps), "_key", "_batch", mask, normalise, also)
    told = got.where("status = 'done'").select(F.col("_key"), F.col("translation").alias("_told"))
    whole = parts.withColumn("_key", F.concat_ws("#", "_id", F.col("_n").cast("string"))).join(told, "_key", "left")
    whole = whole.withColumn("_told", F.when(T.trimmed("_part") == "", F.col("_part")).otherwise(F.col("_told")))
    text = F.array_sort(F.collect_list(F.struct("_n", F.concat("_told", F.coalesce(F.get("_ends", F.col("_n")), F.lit(""))).alias("t"))))
    made = whole.groupBy("_id").agg(text.alias("_texts"))
    join = F.when(F.exists("_texts", lambda x: x["t"].isNull()), F.lit(None)).otherwise(F.array_join(F.transform("_texts", lambda x: x["t"]), ""))
    return lines.join(made.select("_id", join.alias("translation")), "_id")


# --- extraction -------------------------------------------------------------------------------------

TERM = "struct<source:string,category:string,suggested_translation:string,evidence:array<string>>"
_KEYS = ("source", "category", "suggested_translation", "evidence")
_JUDGED = f"array<struct<candidate:{TERM},reason:string>>"
SCHEMA = "schema"


_TERM = pa.struct([*((k, pa.string()) for k in _KEYS[:3]), ("evidence", pa.list_(pa.string()))])
_CITED = pa.struct([("row_id", pa.string()), ("source", pa.string())])
_JOBS_AT_ONCE = 256


def _proposed(jobs: DataFrame, ask: Callable[[list[dict], int], list[dict]], turn: int, short: bool) -> DataFrame:
    """The jobs with found, malformed and cited: what the model proposes for each, and the rows that it
    cites; found is null if it gave no answer. Jobs pass through as they are."""

    def proposed(rows: list[dict]) -> tuple[list[dict] | None, int, list[dict]]:
        try:
            items = ask([{"id": r["id"], "source": r["source"]} for r in rows] if short else rows, turn)
        except ValueError:
            return None, 0, []
        good = [c for c in items or [] if isinstance(c, dict) and set(c) == set(_KEYS) and all(isinstance(c[k], str) for k in _KEYS[:3]) and isinstance(c["evidence"], list) and all(isinstance(e, str) for e in c["evidence"])]
        named = {e for c in good for e in c["evidence"]}
        return good if items is not None else None, len(items or []) - len(good), [{"row_id": r["id"], "source": r["source"]} for r in rows if r["id"] in named]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _JOBS_AT_ONCE):
                part = batch.slice(start, _JOBS_AT_ONCE)
                found, malformed, cited = zip(*(proposed(rows) for rows in part.column(1).to_pylist()))
                columns = [*part.columns, pa.array(found, pa.list_(_TERM)), pa.array(malformed, pa.int64()), pa.array(cited, pa.list_(_CITED))]
                yield pa.RecordBatch.from_arrays(columns, ["job_id", "rows", "found", "malformed", "cited"])

    jobs = jobs.select("job_id", "rows")
    kinds = ", ".join(f"{c} {kind}" for c, kind in jobs.dtypes)
    return jobs.mapInArrow(run, f"{kinds}, found array<{TERM}>, malformed long, cited array<struct<row_id:string,source:string>>")


def extracted(jobs: DataFrame, ask: Callable[[list[dict], int], list[dict]], rounds: int = 3) -> DataFrame:
    """job_id, status, terms, rejected_count, reject_reasons, rejected_candidates, rounds of each job.

    ask(rows, turn): candidates as dicts of source, category, suggested_translation and evidence. The strict
    rules of evidence judge them between rounds. A job with none rejected is complete; others are asked
    again, in the last round with ids and sources alone. What is rejected then makes the job partial: its
    valid candidates are kept, the others told. A job that gets no answer has failed, and is not asked again.
    """
    settled, frontier = [], jobs
    none = lambda kind: F.array().cast(kind)
    for turn in range(rounds):
        last = turn == rounds - 1
        each = _proposed(frontier, ask, turn, last and rounds > 1).withColumn("_each", F.coalesce(evidence.judged("found", "cited"), none(_JUDGED)))
        names = F.concat(F.transform("rejected_candidates", lambda x: x["reason"]), F.array_repeat(F.lit(SCHEMA), F.col("malformed").cast("int")))
        counted = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(names)), lambda n: F.struct(n, F.size(F.filter(names, lambda m: m == n)).cast("long"))))
        status = F.when(F.col("found").isNull(), "failed").when(F.col("rejected_count") == 0, "complete").otherwise("partial")
        told = each.withColumns({
            "terms": F.transform(F.filter("_each", lambda x: x["reason"].isNull()), lambda x: x["candidate"]),
            "rejected_candidates": F.filter("_each", lambda x: x["reason"].isNotNull()),
        })
        told = told.withColumn("rejected_count", F.size("rejected_candidates").cast("long") + F.col("malformed")).withColumn("reject_reasons", counted)
        told = told.withColumn("status", status)
        kept = F.when((F.col("status") == "partial") & F.lit(not last), F.col("rows")).alias("rows")  # of jobs that are asked again
        got = written(told.select("job_id", "status", "terms", "rejected_count", "reject_reasons", "rejected_candidates", F.lit(turn + 1).alias("rounds"), kept), "extraction")
        frontier = got.where("status = 'partial'").select("job_id", "rows")
        settled.append((got if last else got.where("status <> 'partial'")).drop("rows"))
        if last or frontier.isEmpty():
            break
    out = settled[0]
    for frame in settled[1:]:
        out = out.unionByName(frame)
    return out
