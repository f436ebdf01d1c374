import hashlib
import json

import pytest

from glossmill.operators.quality import Violation
from glossmill.sources import readers, sinks
from glossmill.streaming import logs


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_story(spark, tmp_path):
    rows = ["id,name,text,trans", "1:text:1,案内役,\"{user}、次へ\\n進もう\",", "2:title:1,,章,章节", "3:text:1,案内役,\"a\nb\",x", f"info,adv_a.txt,{'0' * 64},", "译者,me,,"]
    write(tmp_path / "d/adv_a.csv", "\n".join(rows), "utf-8-sig")
    write(tmp_path / "d/other.csv", "x\n1")
    all_rows = readers.dialogue(spark, str(tmp_path / "d"))
    assert readers.story_violations(all_rows).isEmpty()
    assert readers.story_footer(all_rows).first()["translator"] == "me"
    entries = readers.story_entries(spark, str(tmp_path / "d")).orderBy("seq").collect()
    assert [(e["script"], e["source"], e["translation"], len(e["neighbors"])) for e in entries] == [("adv_a.txt", "{user}、次へ\\n進もう", "", 1), ("adv_a.txt", "章", "章节", 2), ("adv_a.txt", "a\nb", "x", 1)]


def test_story_with_repeated_ids(spark, tmp_path):
    write(tmp_path / "adv_a.csv", "id,name,text,trans\n1:text:1,a,b,\n1:text:1,a,c,\nx,a,b,\n")
    assert {r["reason"] for r in readers.story_violations(readers.dialogue(spark, str(tmp_path))).collect()} == {"repeated_id", "field_id", "footer"}
    with pytest.raises(Violation):
        readers.story_entries(spark, str(tmp_path))


def test_records_keep_order_and_last_of_repeated_keys(spark, tmp_path):
    write(tmp_path / "s/Item.json", '{"i2": {"name": "青い鍵", "texts[0]": "x", "name": "赤い鍵"}, "i1": {"name": "あ"}}')
    write(tmp_path / "t/Item.json", json.dumps({"i2": {"name": "红钥匙"}}))
    source = readers.record_tables(spark, str(tmp_path / "s"))
    rows = readers.master_entries(source, readers.record_tables(spark, str(tmp_path / "t"))).orderBy("seq").collect()
    assert [(r["id"], r["field"], r["source"], r["translation"]) for r in rows] == [("i2", "name", "赤い鍵", "红钥匙"), ("i2", "texts[0]", "x", ""), ("i1", "name", "あ", "")]
    assert rows[0]["record_labels"] == {"name": "赤い鍵"}
    sinks.record_tables_json(source, str(tmp_path / "out"))
    back = spark.read.schema("id string, record map<string,string>, tbl string").json(str(tmp_path / "out"))
    assert {(r["tbl"], r["id"]) for r in back.collect()} == {("Item", "i1"), ("Item", "i2")}


def test_dictionaries(spark, tmp_path):
    assert readers.flat_glossary(spark, write(tmp_path / "g.json", '{"鍵": "钥匙"}')).first()["target"] == "钥匙"
    with pytest.raises(Violation):
        readers.flat_glossary(spark, write(tmp_path / "h.json", '{"鍵": ""}'))
    policy = {"schema_version": 1, "terms": [{"source": "鍵", "target": "钥匙", "category": "term", "action": "prefer", "scope": {"table": "It*"}}]}
    assert readers.policy(spark, write(tmp_path / "p.json", json.dumps(policy))).first()["scope"] == {"table": "It*"}
    with pytest.raises(Violation):
        readers.policy(spark, write(tmp_path / "q.json", '{"schema_version": 2, "terms": []}'))


def test_notices_and_interface(spark, tmp_path):
    page = f"/notice/{'a' * 64}/index.html"
    write(tmp_path / "n.json", json.dumps({"pages": {page: {"title": "題", "texts": ["開催中", "2030/1/2"]}}}))
    assert [(r["at"], r["source"]) for r in readers.notices(spark, str(tmp_path / "n.json")).orderBy("at").collect()] == [(-1, "題"), (0, "開催中"), (1, "2030/1/2")]
    write(tmp_path / "ui.json", json.dumps({"text": {"あ": "a"}, "i18n": {"k": "b"}, "i18n_by_source": {"k": {"い": "c"}}}))
    assert {tuple(r) for r in readers.interface(spark, str(tmp_path / "ui.json")).collect()} == {("text", "", "あ", "a"), ("i18n", "k", "", "b"), ("i18n_by_source", "k", "い", "c")}
    with pytest.raises(Violation):
        readers.variants(spark, write(tmp_path / "v.json", '{"k": ["a"]}'))


def test_captures(spark, tmp_path):
    line = json.dumps({"kind": "i18n", "key": "k", "source": "あ"})
    rows = readers.captured(spark, write(tmp_path / "c.jsonl", f"\x00\x00{line}\n{line}\n")).collect()
    assert sorted(r["recovered"] for r in rows) == [False, True]
    with pytest.raises(Violation):
        readers.captured(spark, write(tmp_path / "d.jsonl", "nope\n"))


def test_log_tail(spark, tmp_path):
    schema = "source string, translation string"
    good = '{"source":"a","translation":"b"}\n'
    assert readers.log(spark, write(tmp_path / "a.jsonl", good + good.strip()), schema).count() == 2
    assert readers.log(spark, write(tmp_path / "b.jsonl", good + '{"source":"a"'), schema).count() == 1
    with pytest.raises(Violation):
        readers.log(spark, write(tmp_path / "c.jsonl", '{"source":\n' + good), schema)


def test_manifest_and_reports(spark, tmp_path):
    write(tmp_path / "m/a.json", "{}")
    before = readers.manifest(spark, str(tmp_path / "m"))
    assert before.first()["sha256"] == hashlib.sha256(b"{}").hexdigest()
    held = before.collect()
    before = spark.createDataFrame(held, before.schema)
    readers.unchanged(before, readers.manifest(spark, str(tmp_path / "m")))
    path = write(tmp_path / "m/a.json", '{"a": 1}')
    with pytest.raises(Violation):
        readers.unchanged(before, readers.manifest(spark, str(tmp_path / "m")))
    with pytest.raises(Violation):
        sinks.document_json({}, path, "0" * 64)
    sinks.document_json({"b": 1}, path, hashlib.sha256(b'{"a": 1}').hexdigest())
    assert json.loads((tmp_path / "m/a.json").read_text()) == {"b": 1}


def test_streamed_log_equals_batch(spark, tmp_path):
    schema = "key string, seq long, t string"
    sinks.append_log(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema), str(tmp_path / "log"))
    sinks.append_log(spark.createDataFrame([("a", 2, "z")], schema), str(tmp_path / "log"))
    stream = logs.latest(logs.log_stream(spark, str(tmp_path / "log"), schema, 1), "key", "seq")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("latest_rows").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(120)
    assert {(r["key"], r["t"]) for r in spark.table("latest_rows").collect()} == {("a", "z"), ("b", "y")}


def test_line_numbers_of_a_file_of_several_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i * 7 % 90) for i in range(500)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_text("only")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = readers.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = {(r["path"].rsplit("/", 1)[1], r["line"]): r["value"] for r in found.collect()}
    finally:
        for key, value in zip(("maxPartitionBytes", "openCostInBytes"), held):
            spark.conf.set(f"spark.sql.files.{key}", value)
    assert got == {("a.txt", i + 1): x for i, x in enumerate(lines)} | {("b.txt", 1): "only"}


def test_captures_tell_the_line_that_is_wrong(spark, tmp_path):
    good = json.dumps({"kind": "text", "key": "", "source": "あ"})
    (tmp_path / "c.jsonl").write_text(f"{good}\n\n\x00{good}\n")
    assert [(r["at"], r["recovered"]) for r in readers.captured(spark, str(tmp_path / "c.jsonl")).orderBy("at").collect()] == [(1, False), (3, True)]
    (tmp_path / "c.jsonl").write_text(f"{good}\n{{}}\n")
    with pytest.raises(Violation, match="'line': 2"):
        readers.captured(spark, str(tmp_path / "c.jsonl"))


def test_records_that_hold_are_kept_beside_those_that_do_not(spark, tmp_path):
    (tmp_path / "A.json").write_text('{"r2": {"b": "x", "a": "y", "n": 5}, "r1": [1], "r0": {"z": null, "s": "t"}}')
    (tmp_path / "B.json").write_text('{"r": {"a": "b"}')
    (tmp_path / "C.json").write_text('["a"]')
    (tmp_path / "D.json").write_text('{"r": {"a": "b"}}')
    fields, rejected = readers.record_tables_leniently(spark, str(tmp_path))
    assert {(r["path"].rsplit("/", 1)[1], r["id"], r["field"], r["reason"]) for r in rejected.collect()} == {
        ("A.json", "r2", "n", "not_text"), ("A.json", "r1", None, "not_a_record"), ("A.json", "r0", "z", "not_text"), ("B.json", None, None, "malformed"), ("C.json", None, None, "not_a_table"),
    }
    assert [(r["tbl"], r["id"], r["field"], r["source"]) for r in fields.orderBy("tbl", "seq").collect()] == [("A", "r2", "b", "x"), ("A", "r2", "a", "y"), ("A", "r0", "s", "t"), ("D", "r", "a", "b")]


def test_prompts_are_chosen_by_kind_or_name(spark, tmp_path):
    for name, text in (("default", "翻译\n"), ("own", "x"), ("ui", " \n")):
        write(tmp_path / f"p/{name}.txt", text)
    folder = str(tmp_path / "p")
    assert readers.prompt(spark, folder, "story") == ("翻译\n", hashlib.sha256("翻译\n".encode()).hexdigest())
    assert readers.prompt(spark, folder, "legal", "own")[0] == "x"
    for kind, name in (("interface", None), ("legal", None), ("odd", None)):
        with pytest.raises(Violation):
            readers.prompt(spark, folder, kind, name)
