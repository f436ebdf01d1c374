"""Rounds of asking: what failed is asked again, and nothing else is."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.operators import quality, rounds

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Recorded:
    """A service that keeps what it was asked, by call, in a folder that all tasks see."""

    def __init__(self, folder, answer):
        self.folder, self.answer = str(folder), answer
        os.makedirs(self.folder, exist_ok=True)

    def __call__(self, lines):
        name = f"{self.folder}/{len(os.listdir(self.folder)):04d}-{os.getpid()}-{id(lines)}"
        with open(name, "w", encoding="utf-8") as out:
            json.dump([line["source"] for line in lines], out, ensure_ascii=False)
        return self.answer(lines, len(os.listdir(self.folder)))

    def calls(self):
        return [json.load(open(f"{self.folder}/{n}", encoding="utf-8")) for n in sorted(os.listdir(self.folder))]


def frame(spark, *sources, batch="b"):
    return spark.createDataFrame([(str(i), s, batch) for i, s in enumerate(sources)], "key string, source string, batch string")


def of(answers):
    return {r["key"]: (r["translation"], r["status"], r["round"]) for r in answers.collect()}


def test_a_mark_that_breaks_once_is_answered_in_the_next_round(spark, tmp_path):
    def answer(lines, call):
        return {x["id"]: x["source"].replace("⟦0⟧", "") if call == 1 and "七" in x["source"] else x["source"].replace("個", "个") for x in lines}

    service = Recorded(tmp_path / "calls", answer)
    answers, rejected = rounds.asked(frame(spark, "鍵5個", "七7個"), service, quality.notice_line, rounds.halved(8), mask="[0-9]+")
    assert of(answers) == {"0": ("鍵5个", "done", 0), "1": ("七7个", "done", 1)}
    assert [tuple(r) for r in rejected.collect()] == [("1", 0, "markers")]
    assert service.calls() == [["鍵⟦0⟧個", "七⟦0⟧個"], ["七⟦0⟧個"]]  # what was done isn't asked again


def test_a_batch_once_and_then_each_line_alone(spark, tmp_path):
    def answer(lines, call):
        if len(lines) > 1:
            raise ValueError("no JSON")
        return {lines[0]["id"]: "" if lines[0]["source"] == "b" else lines[0]["source"].upper()}

    service = Recorded(tmp_path / "calls", answer)
    answers, rejected = rounds.asked(frame(spark, "a", "b", "c"), service, quality.record_line, rounds.once_more(12))
    assert of(answers) == {"0": ("A", "done", 1), "1": (None, "failed", 1), "2": ("C", "done", 1)}
    assert sorted(service.calls()) == [["a"], ["a", "b", "c"], ["b"], ["c"]]
    assert sorted((r["round"], r["reason"]) for r in rejected.collect()) == [(0, "unanswered")] * 3 + [(1, "blank")]


def test_halves_then_parts_between_line_breaks(spark, tmp_path):
    def answer(lines, call):
        if len(lines) > 2 or any("\n" in x["source"] for x in lines):
            raise ValueError
        return {x["id"]: x["source"].upper() for x in lines}

    assert rounds.halved(5, 2) == [5, 5, 3, 2, 1, 1] and rounds.halved(1, 3) == [1, 1, 1]
    service = Recorded(tmp_path / "calls", answer)
    answers, _ = rounds.asked(frame(spark, "a", "b", "c", "d", "e\r\n\nf"), service, quality.record_line, rounds.halved(5, 2), split=True)
    got = of(answers)
    assert {k: v[0] for k, v in got.items()} == {"0": "A", "1": "B", "2": "C", "3": "D", "4": "E\r\n\nF"}
    assert all(v[1] == "done" for v in got.values()) and got["0"][2] == 3 and got["4"][2] == 6


def test_ids_that_were_not_asked_fail_the_batch_and_wrong_types_a_line(spark):
    answers, rejected = rounds.asked(frame(spark, "a", "b"), lambda lines: {x["id"]: 5 if x["source"] == "a" else "x" for x in lines}, quality.record_line, [2])
    assert of(answers) == {"0": (None, "failed", 0), "1": ("x", "done", 0)}
    answers, _ = rounds.asked(frame(spark, "a", "b"), lambda lines: {"0": "x"}, quality.record_line, [2])
    assert {v[1] for v in of(answers).values()} == {"failed"}
    answers, _ = rounds.asked(frame(spark), lambda lines: {}, quality.record_line, [2])
    assert answers.count() == 0


def test_answers_are_normalised_before_they_are_judged(spark):
    answers, _ = rounds.asked(frame(spark, "a\r\nb"), lambda lines: {x["id"]: "x\ny" for x in lines}, quality.record_line, [1], normalise=T.imposed_line_endings)
    assert of(answers) == {"0": ("x\r\ny", "done", 0)}


JOBS = "job_id string, rows array<struct<id:string,source:string,speaker:string>>"


def term(source, *evidence, category="item", suggestion="x"):
    return {"source": source, "category": category, "suggested_translation": suggestion, "evidence": list(evidence)}


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame([("j", [("r1", "a string of words", "ring"), ("r2", "the ring", "x")]), ("k", [("r3", "青い鍵", "y")])], JOBS)


def test_what_the_strict_rules_reject_is_asked_again(spark, jobs):
    bad = [term("ring", "r1"), term("ring", "r2", category="weapon"), term("ring", "r2", suggestion="x" * 500), term("ring", "r2", "r2"), term("ring"), term("ring", "r9"), {"source": "ring"}]

    def ask(rows, turn):
        if rows[0]["id"] == "r3":
            return [term("青い鍵", "r3")]
        assert ("speaker" in rows[0]) == (turn < 2)  # the last round gives ids and sources alone
        return [term("ring", "r2"), *(bad if turn < 2 else bad[:1])]

    got = {r["job_id"]: r for r in rounds.extracted(jobs, ask).collect()}
    assert (got["k"]["status"], got["k"]["rounds"], got["k"]["rejected_count"]) == ("complete", 1, 0)
    assert (got["j"]["status"], got["j"]["rounds"], got["j"]["reject_reasons"]) == ("partial", 3, {"source_absent": 1})
    assert [t["source"] for t in got["j"]["terms"]] == ["ring"] and got["j"]["rejected_candidates"][0]["candidate"]["evidence"] == ["r1"]
    once = {r["job_id"]: r["reject_reasons"] for r in rounds.extracted(jobs, ask, rounds=1).collect()}
    assert once["j"] == {"source_absent": 1, "category": 1, "suggestion": 1, "duplicate_evidence": 1, "missing_evidence": 1, "unknown_row": 1, "schema": 1}


def test_a_job_that_errs_once_is_complete_and_one_without_answer_has_failed(spark, jobs):
    def ask(rows, turn):
        if rows[0]["id"] == "r3":
            raise ValueError("no JSON")
        return [term("ring", "r1" if turn == 0 else "r2")]

    got = {r["job_id"]: (r["status"], r["rounds"], len(r["terms"])) for r in rounds.extracted(jobs, ask).collect()}
    assert got == {"j": ("complete", 2, 1), "k": ("failed", 1, 0)}
    none = rounds.extracted(jobs, lambda rows, turn: []).select("status", F.size("terms").alias("n")).distinct().collect()
    assert [tuple(r) for r in none] == [("complete", 0)]
    assert rounds.extracted(jobs.limit(0), lambda rows, turn: []).count() == 0
