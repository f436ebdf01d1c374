import pytest
from pyspark.sql import functions as F

from glossmill.operators import planning
from glossmill.operators.quality import Violation

ENTRY = "kind string, tbl string, id string, script string, field string, source string, record_labels map<string,string>, seq long"


def entries(spark):
    rows = [
        ("master", "Item", "i1", None, "name", "青い鍵", {"name": "青い鍵"}, 0),
        ("master", "Item", "i2", None, "name", "青い鍵", {"name": "青い鍵"}, 1),
        ("master", "Item", "i1", None, "description", "扉を開く青い鍵です", {}, 2),
        ("master", "Item", "i3", None, "description", "短い", {}, 3),
        ("master", "Music", "m", None, "composer", "山田太郎の作曲した曲", {}, 4),
        ("master", "Emblem", "e", None, "name", "紋章", {}, 5),
        ("master", "Emblem", "e", None, "description", "とても長い紋章の説明文", {}, 6),
        ("master", "Rule", "r", None, "name", "規則", {}, 7),
        ("story", None, None, "adv_main_01.txt", "1:text:1", "進もう", None, 8),
        ("story", None, None, "adv_main_01.txt", "2:title:1", "章の題", None, 9),
        ("story", None, None, "adv_main_01.txt", "3:text:1", "作詞：山田", None, 10),
    ]
    return spark.createDataFrame(rows, ENTRY)


def test_eligibility(spark):
    got = {r["seq"]: r["ok"] for r in entries(spark).select("seq", planning.eligible().alias("ok")).collect()}
    assert [s for s, ok in got.items() if ok] == [0, 1, 2, 5, 6, 7, 8]


def test_profile_and_override(spark):
    rows = planning.selected(entries(spark))
    assert {r["seq"] for r in rows.where("included").collect()} == {0, 1, 2, 3, 4, 5, 8, 9, 10}
    counts = {r["stratum"]: (r["selected"], r["excluded"]) for r in planning.coverage(rows).collect()}
    assert counts["master:Emblem"] == (1, 1) and counts["story:adv_main"] == (3, 0)
    assert {r["seq"] for r in planning.selected(entries(spark), ["Rule"], ["adv_m"]).where("included").collect()} == {7, 8, 9, 10}


def test_jobs(spark):
    rows = planning.selected(entries(spark)).where(planning.eligible())
    heads, aliases = planning.planned(rows)
    assert [(r["id"], r["source"]) for r in aliases.collect()] == [("i2", "青い鍵")]
    plan = planning.jobs(heads).cache()
    assert sorted(len(r["rows"]) for r in plan.collect()) == [1, 1, 2]
    assert planning.jobs(heads).select("job_id").exceptAll(plan.select("job_id")).isEmpty()
    keys = {r["k"] for r in plan.select(planning.cache_key("p", "m").alias("k")).collect()}
    assert len(keys) == 3 and keys != {r["k"] for r in plan.select(planning.cache_key("p", "n").alias("k")).collect()}
    assert planning.sliced(plan, ["Item"]).count() == 1 and planning.sliced(plan, phase="narrative").count() == 1
    with pytest.raises(Violation):
        planning.sliced(plan, ["Nothing"])
    capped, _ = planning.planned(rows, per_stratum=1)
    assert capped.count() == 3


def test_repairs(spark):
    plan = spark.createDataFrame([("a", [("1", "x")]), ("b", [("2", "y")]), ("c", [("3", "z")])], "job_id string, rows array<struct<id:string,source:string>>")
    log = spark.createDataFrame([("a", "complete", 0, 1), ("b", "complete", 2, 1), ("b", "partial", 1, 2)], "job_id string, status string, n_terms int, seq long")
    assert {r["job_id"] for r in planning.to_repair(plan, log).collect()} == {"a", "b"}
    assert [r["id"] for r in planning.unverified(plan, log).collect()] == ["3"]


def test_categories(spark):
    rows = [("Music", "name", "m", "歌"), ("Music", "singer", "m", "星プロダクション"), ("Music", "singer", "m", "A×星プロダクション"), ("StoryPart", "name", "st-part-group-1", "x"), ("Music", "composer", "m", "x"), ("Item", "name", "i", "x")]
    got = spark.createDataFrame(rows, "tbl string, field string, id string, source string").select(planning.category().alias("c")).collect()
    assert [r["c"] for r in got] == ["song", "agency", None, "group", None, None]


def test_glossaries(spark):
    names = spark.createDataFrame([("トリエル", "x"), ("{user}さん", "y"), ("星プロ", "星プロ")], "source string, target string")
    got = {r["source"]: (r["category"], r["action"]) for r in planning.glossary_terms(names, spark.createDataFrame([("鍵", "钥匙")], "source string, target string")).collect()}
    assert got == {"トリエル": ("group", "prefer"), "星プロ": ("agency", "retain"), "鍵": ("term", "prefer")}


def test_kana(spark):
    key = "tbl string, id string, field string"
    issues = spark.createDataFrame([("Item", "1", "name"), ("Item", "2", "name"), ("ConditionDescription", "1", "text")], key)
    source = spark.createDataFrame([("Item", "1", "name", "鍵"), ("Item", "2", "name", "鍵")], key + ", source string")
    target = spark.createDataFrame([("Item", "1", "name", "キー"), ("Item", "2", "name", "キー")], key + ", source string")
    row = planning.kana_items(issues, source, target).first()
    assert row["current"] == "キー" and len(row["locations"]) == 2
    with pytest.raises(Violation):
        planning.kana_items(issues, source, target.withColumn("source", F.concat("source", "id")))
    with pytest.raises(Violation):
        planning.kana_items(issues, source, target, with_conditions=True)
