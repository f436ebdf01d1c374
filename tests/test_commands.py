"""The commands over small corpora, with a service that is a function."""

import hashlib
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glossmill import commands as C
from glossmill.operators import memory, model, quality
from glossmill.operators.quality import Violation
from glossmill.sources import readers, sinks
from glossmill.streaming import logs


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # services run where this module can't be imported


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def echo(lines):
    return {line["id"]: f"译{line['source']}" for line in lines}


@pytest.fixture
def story(tmp_path):
    source = "原文"
    rows = ["id,name,text,trans", "1:text:1,案内役,進もう,", "2:text:2,,{user}章,", "3:text:3,,終,终", f"info,adv_a.txt,{hashlib.sha256(source.encode()).hexdigest()},", "译者,me,,"]
    write(tmp_path / "txt/adv_a.txt", source)
    write(tmp_path / "d/adv_a.csv", "\n".join(rows) + "\n")
    return tmp_path


def test_story(spark, story):
    path, texts = str(story / "d"), str(story / "txt")
    assert C.story_plan(spark, path, texts).first().asDict() == {"csv": "adv_a.csv", "translated": 1, "total": 3}
    with pytest.raises(Violation):
        C.story_plan(spark, path, names=["adv_b.csv"])
    with pytest.raises(Violation):
        C.story_plan(spark, path, names=["adv_a.csv"], prefixes=["adv"])
    assert C.story_plan(spark, path, prefixes=["adv_b"]).isEmpty()
    write(story / "txt/adv_a.txt", "other")
    with pytest.raises(Violation):
        C.story_plan(spark, path, texts)


def test_broken_files_leave_the_others_written(spark, tmp_path):
    body = "id,name,text,trans\n1:text:1,案内役,\"進もう, {user}\",\n2:text:2,,終,终\n"
    for i in range(20):
        write(tmp_path / f"txt/adv_{i}.txt", f"原文{i}")
        write(tmp_path / f"d/adv_{i}.csv", body + f"info,adv_{i}.txt,{hashlib.sha256(f'原文{i}'.encode()).hexdigest()},\n译者,me,,\n")
    write(tmp_path / "d/adv_3.csv", body.replace("终\n", "终,extra,more\n"))
    write(tmp_path / "d/adv_4.csv", body.replace("id,name", "name,id"))
    write(tmp_path / "d/adv_5.csv", body)  # no footer
    write(tmp_path / "txt/adv_6.txt", "other")
    path, texts = str(tmp_path / "d"), str(tmp_path / "txt")
    got = {r["csv"]: r for r in C.story_translate(spark, path, echo, texts).collect()}
    assert {k: r["reason"] for k, r in got.items() if r["status"] == "rejected"} == {"adv_3.csv": "shape", "adv_4.csv": "header", "adv_5.csv": "footer", "adv_6.csv": "stale_source"}
    done = [r for r in got.values() if r["status"] == "written"]
    assert len(done) == 16 and all((r["done"], r["failed"]) == (1, 0) and r["sha256"] == hashlib.sha256((tmp_path / "d" / r["csv"]).read_bytes()).hexdigest() for r in done)
    assert "译進もう, {user}" in (tmp_path / "d/adv_0.csv").read_text() and (tmp_path / "d/adv_6.csv").read_text().endswith("\n译者,me,,\n") and "译" not in (tmp_path / "d/adv_3.csv").read_text()
    again = C.story_translate(spark, path, lambda lines: 1 / 0, texts, names=["adv_0.csv", "adv_1.csv", "adv_99.csv"])
    assert {(r["csv"], r["status"], r["reason"]) for r in again.collect()} == {("adv_0.csv", "complete", None), ("adv_1.csv", "complete", None), ("adv_99.csv", "rejected", "missing")}

    def meddling(lines):
        write(tmp_path / "e/adv_1.csv", body)
        return {x["id"]: "" if x["id"].startswith("adv_2") else x["source"] for x in lines}

    for i in range(3):
        write(tmp_path / f"e/adv_{i}.csv", body + f"info,adv_{i}.txt,{hashlib.sha256(f'原文{i}'.encode()).hexdigest()},\n译者,me,,\n")
    got = {r["csv"]: (r["status"], r["done"], r["failed"]) for r in C.story_translate(spark, str(tmp_path / "e"), meddling).collect()}
    assert got == {"adv_0.csv": ("written", 1, 0), "adv_1.csv": ("changed", 1, 0), "adv_2.csv": ("unwritten", 0, 1)}
    assert (tmp_path / "e/adv_1.csv").read_text() == body


def test_inputs_are_guarded(spark, tmp_path):
    write(tmp_path / "in/a.json", "{}")
    with readers.guarded(spark, [str(tmp_path / "in")], [str(tmp_path / "out")]):
        write(tmp_path / "out/x", "")
    with pytest.raises(Violation), readers.guarded(spark, [str(tmp_path / "in")]):
        write(tmp_path / "in/b.json", "{}")
    with pytest.raises(Violation), readers.guarded(spark, [str(tmp_path / "in")], [str(tmp_path / "in/c")]):
        raise AssertionError


def test_dialogue_file_is_replaced_as_one(spark, story):
    file, source = str(story / "d/adv_a.csv"), str(story / "txt/adv_a.txt")
    held = readers.file_hash(spark, file)
    rows = spark.createDataFrame(readers.dialogue(spark, str(story / "d")).drop("path", "csv").collect())
    done = spark.createDataFrame([("1:text:1", "走吧"), ("3:text:3", "x")], "id string, trans string")
    new = sinks.dialogue_progress(rows, done, file, source, held)
    assert new == readers.file_hash(spark, file) != held
    again = {r["id"]: r["trans"] for r in readers.dialogue(spark, str(story / "d")).collect()}
    assert (again["1:text:1"], again["3:text:3"], again["2:text:2"]) == ("走吧", "终", "")
    assert [p.name for p in (story / "d").iterdir() if not p.name.startswith(".")] == ["adv_a.csv"]
    with pytest.raises(Violation):  # not as it was read
        sinks.dialogue_progress(rows, done, file, source, held)


@pytest.fixture
def master(tmp_path):
    write(tmp_path / "orig/Item.json", json.dumps({"i1": {"name": "青い鍵", "text": "青い鍵で開く"}, "i2": {"name": "赤い鍵"}}))
    write(tmp_path / "orig/Music.json", json.dumps({"m1": {"name": "歌", "composer": "山田"}}))
    write(tmp_path / "zh/Item.json", json.dumps({"i1": {"name": "蓝钥匙"}}))
    write(tmp_path / "zh/Music.json", json.dumps({"m1": {"name": ""}}))
    return tmp_path


def test_master(spark, master):
    source, target, log = str(master / "orig"), str(master / "zh"), str(master / "log")
    assert C.master_plan(spark, source, target, log).first().asDict() == {"ready": 1, "pending": 4, "total": 5}
    got = {(r["tbl"], r["id"], r["field"]): r["translation"] for r in C.master_translate(spark, source, target, log, echo).collect()}
    assert got[("Item", "i1", "name")] == "蓝钥匙" and got[("Music", "m1", "composer")] == "山田" and got[("Item", "i2", "name")] == "译赤い鍵"
    assert C.master_plan(spark, source, target, log).first()["pending"] == 1  # the credit, which is never asked for
    told = readers.log(spark, log, C.MEMORY).count()
    C.master_translate(spark, source, target, log, echo)
    assert readers.log(spark, log, C.MEMORY).count() == told  # nothing was asked again
    (master / "orig/.in-progress").touch()
    with pytest.raises(Violation):
        C.master_plan(spark, source, target, log)
    write(master / "orig2/New.json", '{"a": {"b": "c"}}')
    with pytest.raises(Violation):
        C.master_plan(spark, str(master / "orig2"), target, log)


def test_master_by_policy(spark, master):
    source, target, log = str(master / "orig"), str(master / "zh"), str(master / "log")
    policy = [{"source": "鍵", "target": "钥", "scope": {"table": "Item", "field": "te*"}}, {"source": "青い鍵", "target": "蓝钥", "scope": {"table": "It*"}}]

    def told(lines):
        return {line["id"]: "".join(t["target"] for t in json.loads(line["term_preferences"] or "[]")) or "-" for line in lines}

    assert C.master_plan(spark, source, target, log, policy).first()["pending"] == 3
    got = {(r["tbl"], r["id"], r["field"]): r["translation"] for r in C.master_translate(spark, source, target, log, told, policy, {"赤い": "红"}).collect()}
    assert got[("Item", "i1", "text")] == "蓝钥" and got[("Item", "i2", "name")] == "-" and got[("Music", "m1", "composer")] == "山田"
    assert C.master_plan(spark, source, target, log, policy).first()["pending"] == 0


def test_notices(spark, tmp_path):
    page = f"/notice/{'a' * 64}/index.html"
    source = write(tmp_path / "n.json", json.dumps({"pages": {page: {"title": "", "texts": ["開催中 10", "2030/1/2", "作詞：山田", "終了"]}}}))
    held = write(tmp_path / "t.json", json.dumps({"pages": {page: {"終了": "结束"}}}))
    log, listed = str(tmp_path / "log"), str(tmp_path / "list")
    assert {r["source"] for r in C.notice_plan(spark, source, held, None, log, listed).collect()} == {"開催中 10", "作詞：山田"}
    got = {r["source"]: r["translation"] for r in C.notice_translate(spark, source, held, None, log, listed, echo).collect()}
    assert got == {"開催中 10": "译開催中 10", "2030/1/2": "", "作詞：山田": "译作詞：山田", "終了": "结束"}
    assert C.notice_plan(spark, source, held, None, log).isEmpty()
    other = write(tmp_path / "n2.json", json.dumps({"pages": {page: {"title": "", "texts": ["新"]}}}))
    with pytest.raises(Violation):
        C.notice_translate(spark, other, held, None, log, listed, echo)
    repaired = C.notice_repair(spark, source, held, None, str(tmp_path / "log2"), listed, lambda lines: {x["id"]: x["source"].replace("開催中", "进行中") for x in lines})
    assert {r["source"]: r["translation"] for r in repaired.collect()}["開催中 10"] == "进行中 10"
    empty = write(tmp_path / "i.json", json.dumps({"pages": {page: {}}}))
    actions, report = C.notice_credit_policy(spark, source, held, empty, log, "keep")
    assert actions.first()["target"] == "作词：山田" and report.first()["filled_new_nodes"] == 1
    actions, report = C.notice_credit_policy(spark, source, held, empty, log, "keep")
    assert report.first()["log_records_added"] == 0


def test_legal(spark, tmp_path):
    text = "1. 総則\r\n本文 https://x.jp/a\n"
    rule = {"rule_type": 1, "category": "c", "source": text, "source_sha256": hashlib.sha256(text.encode()).hexdigest(), "segments": [{"id": "l0", "source": "1. 総則", "line_ending": "\r\n"}, {"id": "l1", "source": "本文 https://x.jp/a", "line_ending": "\n"}]}
    source = write(tmp_path / "l.json", json.dumps({"schema_version": 1, "rules": {"1": rule}}))
    target = C.legal_targets(spark, source)
    assert target.where("needs AND target = ''").count() == 2
    with pytest.raises(Violation):
        C.legal_compile(spark, source, target.select("rule", "id", "target"))

    def swap(lines):
        return {x["id"]: x["source"].replace("総則", "总则").replace("本文", "正文") for x in lines}

    done = C.legal_translate(spark, source, target.select("rule", "id", "target"), swap)
    whole = C.legal_compile(spark, source, done.select("rule", "id", "target")).first()["whole"]
    assert whole == "1. 总则\r\n正文 https://x.jp/a\n"


def test_interface(spark, tmp_path):
    source = write(tmp_path / "s.json", json.dumps({"text": {"は": "は"}, "i18n": {"a": "あ", "b": "い", "c": "う"}, "i18n_by_source": {}}))
    target = write(tmp_path / "t.json", json.dumps({"text": {}, "i18n": {"a": "x"}, "i18n_by_source": {"c": {"う": "u"}}}))
    seen = write(tmp_path / "c.jsonl", "".join(json.dumps({"kind": "i18n", "key": "b", "source": s}) + "\n" for s in ("い", "ゐ")))
    curated = write(tmp_path / "v.json", json.dumps({"c": ["う", "宇"]}))
    assert C.interface_pending(spark, source, target, seen, curated).isEmpty()  # b varies, c is curated
    pending = C.interface_pending(spark, source, target, seen, curated, "variants")
    assert [tuple(r) for r in pending.collect()] == [("c", "宇")]
    existing = spark.createDataFrame([("c", "う", "u")], "key string, source string, translation string")
    assert {tuple(r) for r in C.interface_translate(pending, existing, echo).collect()} == {("c", "う", "u"), ("c", "宇", "译宇")}
    reviewed = spark.createDataFrame([("は", "translate")], "source string, decision string")
    assert C.interface_pending(spark, source, target, seen, curated, "text", reviewed).first()["source"] == "は"


def test_terms(spark, master, tmp_path):
    source, target = (readers.record_tables(spark, str(master / p)) for p in ("orig", "zh"))
    entries = readers.master_entries(source, target)
    audit = C.term_audit(entries, [{"source": "青い鍵", "target": "青钥"}], [{"source": "青い鍵", "target": "蓝钥匙"}, {"source": "歌", "target": "歌"}])
    assert audit["counters"].first()["entries"] == 5 and [r["suggestion"] for r in audit["findings"].collect()] == ["青钥"]
    assert audit["findings_by_type"].first()["n"] == 1 and audit["mentions"].first()["mentions"] == 1 and audit["variants"].isEmpty()
    assert [(r["category"], r["source"]) for r in C.extract_candidates(entries).collect()] == [("song", "歌")]
    jobs, aliases, coverage = C.semantic_plan(entries)
    assert aliases.isEmpty() and coverage.agg(F.sum("selected")).first()[0] == 3  # names; the short text is no prose

    def ask(rows, turn):
        good = [{"source": r["source"], "category": "item", "suggested_translation": "x", "evidence": [r["id"]]} for r in rows]
        return good if turn == 2 or len(rows) == 1 else [*good, {**good[0], "source": "no"}]

    log = str(tmp_path / "results")
    jobs = spark.createDataFrame(jobs.collect(), jobs.schema)
    assert {r["status"] for r in C.semantic_extract(jobs, log, ask, "p", "m").collect()} == {"complete"}
    names = spark.createDataFrame([("青い鍵", "蓝钥匙")], "source string, target string")
    found, unverified = C.semantic_review(jobs, log, "p", "m", names, names.limit(0))
    assert unverified.isEmpty() and {(r["source"], r["in_glossary"]) for r in found.collect()} == {("青い鍵", True), ("赤い鍵", False), ("歌", False)}
    reports = found.select("source", "category", F.lit("x").alias("suggestion"), F.transform("evidence", lambda e: e["row_id"]).alias("evidence"))
    out, counts = C.term_review([reports, reports], entries, names)
    assert {(r["source"], r["status"]) for r in out.collect()} == {("青い鍵", "glossary_reference"), ("赤い鍵", "needs_review"), ("歌", "needs_review")} and counts.count() == 2
    queued = C.term_review_export(out, unverified.select(F.lit("r").alias("row_id"), "source"), str(tmp_path / "package"), inputs={"/in/a.json": "0"})
    assert queued.count() == 3 and spark.read.json(str(tmp_path / "package/decisions.new")).count() == 3
    with pytest.raises(Violation):
        sinks.outside("/in/a/b", ["/in/a"])


def test_kana(spark, master, tmp_path):
    source, target = (readers.record_tables(spark, str(master / p)) for p in ("orig", "zh"))
    issues = spark.createDataFrame([("Item", "i1", "name")], "tbl string, id string, field string")
    got = C.suggest_kana(issues, source, target, str(tmp_path / "k"), echo)
    assert got.select("source", "current", "suggestion").first() == ("青い鍵", "蓝钥匙", "译青い鍵")
    C.suggest_kana(issues, source, target, str(tmp_path / "k"), echo)
    assert readers.log(spark, str(tmp_path / "k"), C.MEMORY).count() == 1 and C.suggestion_counts(got).first().asDict() == {"total": 1, "unique": 1, "suggested": 1}


def test_record_document_keeps_order(spark, tmp_path):
    rows = [("i2", "b", 'x"\n', 0), ("i2", "a", "y", 1), ("i1", "c", "日", 2)]
    path = str(tmp_path / "T.json")
    sinks.record_table_document(spark.createDataFrame(rows, "id string, field string, source string, seq long"), path)
    text = open(path, encoding="utf-8").read()
    assert list(json.loads(text).items()) == [("i2", {"b": 'x"\n', "a": "y"}), ("i1", {"c": "日"})]
    assert text.startswith('{\n  "i2": {\n    "b": ')


def test_reviews_match_their_lists(spark, tmp_path):
    listed = {"audit_schema_version": 2, "scope": "local_review_only_no_automatic_translation", "texts": [{"source": "あ", "occurrences": 2, "category": "still_unmatched", "bucket": "kana_1"}, {"source": "字", "occurrences": 1, "category": "still_unmatched", "bucket": "han_1"}]}
    path = write(tmp_path / "c.json", json.dumps(listed))
    entries = [{"source": "あ", "occurrences": 2, "decision": "translate", "translation": "a"}, {"source": "字", "occurrences": 1, "decision": "skip", "translation": ""}]

    def review(rows, held=None):
        return write(tmp_path / "r.json", json.dumps({"scope": "runtime_text_human_review", "candidate_sha256": held or readers.file_hash(spark, path), "entries": rows}))

    assert [r["source"] for r in readers.reviewed_texts(spark, path, review(entries)).collect()] == ["あ"]
    for rows, held in [(entries[:1], None), ([entries[0], {**entries[1], "translation": "x"}], None), ([entries[0], {**entries[1], "occurrences": 3}], None), (entries, "0")]:
        with pytest.raises(Violation):
            readers.reviewed_texts(spark, path, review(rows, held))


def test_plans_settings_and_logs(spark, tmp_path):
    jobs = spark.createDataFrame([("j1", 1), ("j2", 2)], "job_id string, n int")
    sinks.plan_jobs(jobs, str(tmp_path / "plan"), {"schema": 1})
    assert readers.plan_jobs(spark, str(tmp_path / "plan"), "job_id string, n int").count() == 2
    sinks.plan_jobs(jobs.union(jobs), str(tmp_path / "plan"), {})
    with pytest.raises(Violation):
        readers.plan_jobs(spark, str(tmp_path / "plan"), "job_id string, n int")
    assert readers.settings("# x\nA = 'b'\n\nC=d=e", ("A", "C")) == {"A": "b", "C": "d=e"}
    with pytest.raises(Violation):
        readers.settings("B=1", ("A",))
    assert logs.each_file(["a", "b"], lambda p: 1 / (p == "a")) == [("a", None), ("b", "ZeroDivisionError: division by zero")]


def test_patient_service():
    calls, waits = [], []

    def flaky(lines):
        calls.append(1)
        if len(calls) < 4:
            raise ConnectionError
        return {"1": "x"}

    assert model.patient(flaky, wait=waits.append)([]) == {"1": "x"} and waits == [1.0, 2.0, 4.0]
    with pytest.raises(TimeoutError):
        model.patient(lambda lines: (_ for _ in ()).throw(TimeoutError()), attempts=2, wait=waits.append)([])


def test_glossaries(spark, tmp_path):
    a, b = write(tmp_path / "a.json", '{"鍵": "钥匙", "歌": "歌"}'), write(tmp_path / "b.json", '{"鍵": "键"}')
    assert {tuple(r) for r in C.glossary(spark, [a, b]).collect()} == {("鍵", "键"), ("歌", "歌")}
    with pytest.raises(Violation):
        C.glossary(spark, [a, b], strict=True)
    assert memory.missing_tables(spark.createDataFrame([("A",)], "tbl string"), spark.createDataFrame([("B",)], "tbl string")).first()["tbl"] == "A"


def test_slices_and_repairs_of_plans(spark, tmp_path):
    rows = lambda *xs: [{"id": f"{i}", "source": s, "field": f} for i, (s, f) in enumerate(xs)]
    jobs = spark.createDataFrame(
        [("j1", "master:Music", "normal", rows(("歌", "name"), *[("長い文章です", "text")] * 4)), ("j2", "master:Item", "normal", rows(("本文", "text"))), ("j3", "story:adv_a", "short", rows(("短い", "1:text:1")))],
        "job_id string, stratum string, lane string, rows array<struct<id:string,source:string,field:string>>",
    )
    path, log = str(tmp_path / "plan"), str(tmp_path / "log")
    header = C.semantic_plan_written(jobs, path)
    assert header["coverage"] == {"jobs": 3, "rows": 7, "by_stratum": {"master:Item": 1, "master:Music": 1, "story:adv_a": 1}}
    part = C.semantic_slice(spark, path, str(tmp_path / "slice"), tables=("Music",), prefixes=("adv",))
    assert part["parent_sha256"] == header["jobs_sha256"] and part["coverage"]["parent_jobs"] == 3 and part["coverage"]["jobs"] == 2
    again, kept = readers.plan(spark, str(tmp_path / "slice"), C.PLAN)
    assert again == part and {r["job_id"] for r in kept.collect()} == {"j1", "j3"}
    for bad in ({}, {"tables": ("None",)}, {"mode": "odd"}):
        with pytest.raises(Violation):
            C.semantic_slice(spark, path, str(tmp_path / "other"), **bad)
    with pytest.raises(Violation):
        C.semantic_slice(spark, path, path, mode="all")

    plan = readers.plan(spark, path, C.PLAN)[1]
    C.semantic_extract(plan, log, lambda rows, turn: [{"source": "無", "category": "item", "suggested_translation": "x", "evidence": ["0"]}] if len(rows) == 1 and rows[0]["source"] == "本文" else [], "p", "m")
    made = C.semantic_repair(spark, path, log, str(tmp_path / "repair"), "p", "m", max_rows=2)
    assert made["coverage"]["jobs"] == 4 and made["coverage"]["rows"] == 6 and made["selection"]["repair_status"] == "empty"  # j1 in three, j3
    assert {r["repair_of"] for r in readers.plan(spark, str(tmp_path / "repair"), C.PLAN)[1].collect()} == {"j1", "j3"}
    assert C.semantic_repair(spark, path, log, str(tmp_path / "r2"), "p", "m", status="partial")["coverage"]["by_stratum"] == {"master:Item": 1}
    assert C.semantic_repair(spark, path, log, str(tmp_path / "r3"), "p", "other")["coverage"]["jobs"] == 0
    with pytest.raises(Violation):
        C.semantic_repair(spark, path, log, str(tmp_path / "r4"), "p", "m", max_rows=9)
    jobs.limit(1).write.mode("append").json(path)  # the header is of other jobs
    with pytest.raises(Violation):
        readers.plan(spark, path, C.PLAN)


def test_replies_are_parsed_strictly():
    whole = '{"translations": [{"id": "1", "translation": "x"}, {"id": "2", "source": "y"}]}'
    for text in (whole, f"```json\n{whole}\n```", f"Here it is: {whole} done"):
        assert model.reply(text) == {"1": "x", "2": "y"}
    double = whole.replace('"2"', '"1"')
    for text in (None, 5, "", "[]", "{", '{"translations": {}}', '{"translations": [{"id": 1, "translation": "x"}]}', '{"translations": ["x"]}', '{"translations": [{"id": "1"}]}', double):
        with pytest.raises(ValueError):
            model.reply(text)
    with pytest.raises(ValueError):
        model.reply(whole, "length")


def test_written_tables_and_documents_of_many_parts(spark, master, tmp_path):
    C.master_translate(spark, str(master / "orig"), str(master / "zh"), str(master / "log"), echo, write=True)
    assert json.loads((master / "zh/Item.json").read_text()) == {"i1": {"name": "蓝钥匙", "text": "译青い鍵で開く"}, "i2": {"name": "译赤い鍵"}}
    assert json.loads((master / "zh/Music.json").read_text())["m1"] == {"name": "译歌", "composer": "山田"}
    rows = spark.range(3000).select(F.concat(F.lit("T "), F.col("id") % 2).alias("tbl"), F.format_string("r%05d", 3000 - F.col("id")).alias("id"), F.lit("f").alias("field"), F.lit("x").alias("source"), F.col("id").alias("seq"))
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = sinks.record_documents(rows, str(tmp_path / "docs"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    for i in (0, 1):
        text = (tmp_path / f"docs/T {i}.json").read_bytes()
        assert hashlib.sha256(text).hexdigest() == made[f"T {i}"] and list(json.loads(text)) == [f"r{3000 - n:05d}" for n in range(i, 3000, 2)]


def test_scoped_glossaries_are_refused_and_policies_checked(spark, tmp_path):
    known = spark.createDataFrame([("a", "b", {"table": "x"})], "source string, target string, scope map<string,string>")
    reports = spark.createDataFrame([("a", "item", "x", ["1"])], "source string, category string, suggestion string, evidence array<string>")
    with pytest.raises(Violation):
        C.term_review([reports], spark.createDataFrame([], readers.ENTRIES), known)
    bad = write(tmp_path / "p.json", json.dumps({"schema_version": 1, "terms": [{"source": "a", "target": "b", "action": "retain", "scope": {}}]}))
    with pytest.raises(Violation, match="retain_target"):
        readers.policy(spark, bad)
