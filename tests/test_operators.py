import random

import pytest
from pyspark.sql import functions as F

from glossmill.operators import batching, documents, evidence, memory, model, quality, review, terms
from glossmill.operators.quality import Violation


def reasons(spark, pairs, rules):
    df = spark.createDataFrame(pairs, "s string, t string")
    return [r["r"] for r in df.select(quality.reason(rules).alias("r")).collect()]


def test_story_rules(spark):
    pairs = [("{user}、\\n", "{user},\\n"), ("あ", ""), ("あ", "a[b]"), ("{user}", "x"), ("あ\\n", "a")]
    assert reasons(spark, pairs, quality.story_line("s", "t")) == [None, "empty", "forbidden_character", "placeholders", "line_breaks"]


def test_record_rules(spark):
    pairs = [("{0}個<b>x</b>", "{0}<b>y</b>"), ("あ", "  "), ("%1$s", "s"), ("<日本>", "日本"), ("a\r\nb", "a\nb"), ("a", "a\\n")]
    assert reasons(spark, pairs, quality.record_line("s", "t")) == [None, "blank", "placeholders", "brackets", "line_breaks", "literal_breaks"]


def test_notice_and_legal_rules(spark):
    assert reasons(spark, [("1,000円と2", "1,000 2"), ("1と2", "2,1")], quality.notice_line("s", "t")) == [None, "numbers"]
    pairs = [("1. 総則", "1. 总则"), ("1. 総則", "2. 总则"), (" ", "x"), ("総則", "总⟦0⟧")]
    assert reasons(spark, pairs, quality.legal_line("s", "t")) == [None, "protected", "blank_changed", "protected"]


def test_greedy_batches_against_plain_python(spark):
    rng = random.Random(3)
    rows = [(f"g{rng.randint(0, 3)}", i, rng.choice([5, 700, 900, 1, 2000, 1600])) for i in range(400)]
    got = {r["i"]: r["batch"] for r in batching.greedy_batches(spark.createDataFrame(rows, "g string, i long, n long"), "g", "i", "n", 12, 1600).collect()}
    state: dict = {}
    for g, i, n in rows:
        batch, count, total = state.get(g, (0, 0, 0))
        if count and (count >= 12 or total + n > 1600):
            batch, count, total = batch + 1, 0, 0
        state[g] = (batch, count + 1, total + n)
        assert got[i] == batch


def test_breaker(spark):
    rows = [("r", i, i not in range(64)) for i in range(66)] + [("s", i, i == 63) for i in range(66)]
    out = batching.failure_runs(spark.createDataFrame(rows, "run string, seq long, ok boolean"), "run", "seq", F.col("ok"))
    by = {(r["run"], r["seq"]): (r["failures"], r["open"]) for r in out.collect()}
    assert by["r", 62] == (63, False) and by["r", 63] == (64, True) and by["r", 65] == (0, True)
    assert by["s", 62] == (63, False) and by["s", 63] == (0, False) and by["s", 65] == (2, False)


def test_first_and_last_wins(spark):
    log = spark.createDataFrame([("k", 1, "bad"), ("k", 2, "b"), ("k", 3, "c")], "key string, seq int, t string")
    assert memory.last_wins(log, ["key"], "seq").first()["t"] == "c"
    assert memory.first_wins(log, ["key"], "seq", F.col("t") != "bad").first()["t"] == "b"


def test_conflicting_glossaries(spark):
    a = spark.createDataFrame([("鍵", "钥匙")], "source string, target string")
    assert memory.merged_or_conflict(a, a, "source", "target").count() == 1
    with pytest.raises(Violation):
        memory.merged_or_conflict(a, spark.createDataFrame([("鍵", "锁")], "source string, target string"), "source", "target")


def test_scopes_and_specificity(spark):
    rows = spark.createDataFrame([(1, "Item", "name", "青い鍵"), (2, "Story", None, "青い鍵")], "i int, tbl string, field string, source string")
    given = [{"source": "青い鍵", "target": "蓝钥匙"}, {"source": "青い鍵", "target": "青钥", "scope": {"table": "It*", "field": "na?e"}}, {"source": "青い鍵", "target": "x", "scope": {"field": "*", "table": "St*"}}]
    context = {"table": F.col("tbl"), "field": F.col("field")}
    got = {r["i"]: r["target"] for r in terms.resolved(terms.active_terms(rows, given, context), ["i"]).collect()}
    assert got == {1: "青钥", 2: "蓝钥匙"}  # a missing context value fails a policy
    loose = {r["i"]: r["target"] for r in terms.resolved(terms.active_terms(rows, given, context, missing_fails=False), ["i"]).collect()}
    assert loose == {1: "青钥", 2: "x"}  # and counts as '' in an audit
    with pytest.raises(Exception, match="two targets"):
        terms.resolved(terms.active_terms(rows, [given[0], {"source": "青い鍵", "target": "別"}], context), ["i"]).collect()


def test_findings(spark):
    rows = [("Music", "composer", "山田", "Yamada"), ("Item", "name", "青い鍵", "锁"), ("Item", "name", "鍵の束", "钥匙串"), ("Item", "name", "鍵", "")]
    entries = spark.createDataFrame(rows, "tbl string, field string, source string, translation string")
    given = [{"source": "青い鍵", "target": "蓝钥匙"}, {"source": "鍵", "target": "钥匙"}]
    got = {(r["source"], r["type"], r["suggestion"]) for r in terms.findings(entries, given, {}, ["source"]).collect()}
    assert got == {("山田", "music_credit_changed", "山田"), ("青い鍵", "term_preference_mismatch", "蓝钥匙")}


def test_evidence(spark):
    kind = "job_id string, terms array<struct<source:string,category:string,suggested_translation:string,evidence:array<string>>>"
    good = ("青い鍵", "item", "蓝钥匙", ["r1"])
    given = [good, good, ("青い鍵", "thing", "", ["r1"]), ("青い鍵", "song", "", []), ("青い鍵", "song", "", ["r9"]), ("赤", "song", "", ["r1"]), ("青い鍵", "event", "", ["r1", "r1"]), ("{0}", "song", "", ["r1"]), ("作", "song", "", ["r2"])]
    rows = spark.createDataFrame([("j", "r1", "青い鍵だ", False), ("j", "r2", "作詞：山", True)], "job_id string, row_id string, source string, is_credit boolean")
    found = evidence.checked(evidence.candidates(spark.createDataFrame([("j", given)], kind)), rows)
    assert [r["reason"] for r in found.orderBy("at").collect()] == [None, "duplicate_candidate", "category", "missing_evidence", "unknown_row", "source_absent", "duplicate_evidence", "source_form", "credit_row"]
    beside = rows.groupBy("job_id").agg(F.collect_list(F.struct("row_id", "source")).alias("rows"))
    within = spark.createDataFrame([("j", given)], kind).join(beside, "job_id").select(F.explode(evidence.judged("terms", "rows")).alias("t")).select("t.candidate.*", "t.reason")
    assert [tuple(r) for r in within.collect()] == [tuple(r) for r in found.orderBy("at").select("source", "category", "suggested_translation", "evidence", "reason").collect()]
    odd = spark.createDataFrame([("k", None, []), ("l", [], None), ("m", [("鍵", "item", "", ["r"])], [("r", None)])], f"{kind}, rows array<struct<row_id:string,source:string>>")
    got = {r["job_id"]: r["t"] and [x["reason"] for x in r["t"]] for r in odd.select("job_id", evidence.judged("terms", "rows").alias("t")).collect()}
    assert got == {"k": None, "l": [], "m": ["unknown_row"]}


def test_decisions(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "2"), ("d", "1")], "review_id string, input_fingerprint string")
    old = [("a", "1", "accept", "x", "", "me"), ("b", "1", "pending", "", "", ""), ("c", "1", "accept", "x", "", ""), ("e", "1", "pending", "", "", "")]
    items, stale = review.merged_decisions(new, spark.createDataFrame(old, "review_id string, input_fingerprint string, decision string, selected_target string, notes string, reviewer string"))
    assert {(r["review_id"], r["input_fingerprint"], r["decision"]) for r in items.collect()} == {("a", "1", "accept"), ("b", "2", "pending"), ("c", "2", "pending"), ("d", "1", "pending")}
    assert {r["review_id"] for r in stale.collect()} == {"c", "e"}


def test_legal(spark):
    import hashlib

    text = "1. 総則\r\n\n"
    segments = [("l0", "1. 総則", "\r\n"), ("l1", "", "\n")]
    kind = "rule string, source string, source_sha256 string, segments array<struct<id:string,source:string,line_ending:string>>"
    rules = spark.createDataFrame([("1", text, hashlib.sha256(text.encode()).hexdigest(), segments), ("6", "残す", "0" * 64, [("l0", "残す", "")])], kind)
    assert [r["reason"] for r in quality.violations(rules, documents.legal_source_rules()).collect()] == ["hash"]
    parts = documents.legal_segments(rules)
    none = spark.createDataFrame([], "rule string, id string, target string")
    start = documents.legal_initialised(parts, none)
    assert [(r["id"], r["source"]) for r in documents.legal_pending(start).collect()] == [("1/l0", "1. 総則")]
    with pytest.raises(Violation):
        documents.legal_compiled(start)
    done = documents.legal_initialised(parts, spark.createDataFrame([("1", "l0", "1. 总则")], "rule string, id string, target string"))
    assert {r["rule"]: r["whole"] for r in documents.legal_compiled(done).collect()} == {"1": "1. 总则\r\n\n", "6": "残す"}
    with pytest.raises(Violation):
        documents.legal_initialised(parts, spark.createDataFrame([("6", "l0", "x")], "rule string, id string, target string"))


def test_notice_credits(spark):
    page = "/notice/x"
    sources = spark.createDataFrame([(page, "作詞：山田"), (page, "作曲：川"), (page, "作詞・編曲： 海 "), (page, "Music: x"), (page, "作曲/編曲：x"), (page, "作曲： "), (page, "本文")], "page string, source string")
    three = "page string, source string, translation string"
    initial = spark.createDataFrame([(page, "作詞：山田", "词：Yamada")], three)
    current = spark.createDataFrame([(page, "作曲：川", "作曲：川")], three)
    log = spark.createDataFrame([(page, "作曲：川", "作曲：川", "keep")], three + ", policy string")
    got = {r["source"]: (r["target"], r["action"], r["to_log"]) for r in documents.credit_actions(sources, initial, current, log, "keep").collect()}
    assert got == {
        "作詞：山田": ("词：Yamada", "preserved_conflict", False),
        "作曲：川": ("作曲：川", "already_correct", False),
        "作詞・編曲： 海 ": ("作词・编曲： 海 ", "filled", True),
    }
    report = documents.credit_report(documents.credit_actions(sources, initial, current, log, "keep")).first().asDict()
    assert report == {
        "matched_nodes": 3, "protected_initial_nodes": 1, "initial_policy_conflicts": 1, "restored_initial_nodes": 0, "changed_new_nodes": 0, "filled_new_nodes": 1,
        "already_correct_new_nodes": 1, "log_records_added": 1,
    }
    assert documents.snapshot_changes(initial, current).count() == 1
    back = spark.createDataFrame([(page, "作詞：山田", "词：山田")], three)
    assert documents.snapshot_changes(initial, back).count() == 1 and documents.snapshot_changes(initial, back, restore=True).isEmpty()
    restored = {r["source"]: r["target"] for r in documents.credit_actions(sources, initial, current, log, "keep", restore=True).collect()}
    assert restored["作詞：山田"] == "词：山田"


def test_model_retries_halves_and_splits():
    def stubborn(lines):
        if len(lines) > 1 or "\n" in lines[0]["source"]:
            raise ValueError
        return {lines[0]["id"]: lines[0]["source"].upper()}

    got = model.answered([{"id": "1", "source": "a\nb"}, {"id": "2", "source": "c"}], stubborn, lambda s, t: True)
    assert got == {"1": "A\nB", "2": "C"}
    assert model.answered([{"id": "1", "source": "a"}], lambda lines: {"2": "x"}, lambda s, t: True) == {}


def test_second_run_asks_nothing(spark):
    rows = spark.createDataFrame([("1", "あ", "b"), ("2", "い", "b")], "id string, source string, batch string")
    log = model.run_batches(rows, model.echo_service, lambda s, t: True)
    assert log.where("status = 'done'").count() == 2
    assert model.not_yet_done(rows, log, "id").isEmpty()


def test_more_terms_than_one_alternation_takes(spark):
    given = [{"source": s} for s in ("a", "ab", "abc", "b c", "x", "日", "日本", "a.b", "\\E")]
    texts = ["", "ab abc", "b c日本日", "a.b a\\Eb", "nothing", "xx", "日", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, source string")

    def found(most):
        return {(r["i"], r["term"]) for r in terms.mentions(rows, given, most=most, keys=["i"]).collect()}

    assert found(5) == found(100) and (1, "abc") in found(5) and (2, "日本") in found(5)


def test_scopes_found_by_their_beginnings_as_by_trying_all(spark):
    import random
    from fnmatch import fnmatchcase

    rng = random.Random(3)
    globs = ["*", "", "Item", "It*", "I?em", "[IJ]*", "Item[!0-9]*", "longer-than-sixteen-characters*", "long*", "a.b", "Ite", "*em"]
    given = [{"source": "鍵", "target": f"t{i}", "scope": {k: rng.choice(globs) for k in rng.sample(["table", "field", "script"], rng.randrange(4))}} for i in range(300)]
    given += [{"source": "key", "target": "Key"}, {"source": "ke", "target": "no"}]
    values = ["Item", "Items", "Item5", "Jtem", "", None, "longer-than-sixteen-characters and more", "a.b", "axb"]
    rows = [(i, rng.choice(["鍵 key", "鍵", "monkey", "key."]), rng.choice(values), rng.choice(values)) for i in range(60)]
    frame = spark.createDataFrame(rows, "i int, source string, tbl string, fld string")
    for missing_fails in (True, False):
        got = {(r["i"], r["term_seq"]) for r in terms.active_terms(frame, given, {"table": F.col("tbl"), "field": F.col("fld")}, missing_fails=missing_fails).collect()}

        def holds(t, row):
            own = {"table": row[2], "field": row[3]}
            told = {k: own.get(k) if missing_fails else own.get(k) or "" for k in t.get("scope", {})}
            return all(v is not None and fnmatchcase(v, t["scope"][k]) for k, v in told.items())

        stands = {"鍵": lambda s: "鍵" in s, "key": lambda s: s in ("鍵 key", "key."), "ke": lambda s: False}
        assert got == {(r[0], n) for r in rows for n, t in enumerate(given) if stands[t["source"]](r[1]) and holds(t, r)}


def test_plans_of_scoped_terms_have_one_size(spark):
    def size(n):
        given = [{"source": f"w{i}x", "target": "t", "scope": {"table": f"Table{i}*"}} for i in range(n)]
        rows = spark.createDataFrame([(1, "w1x w4999x", "Table4999b")], "i int, source string, tbl string")
        found = terms.active_terms(rows, given, {"table": F.col("tbl")})
        assert [r["term"] for r in found.collect()] == (["w4999x"] if n == 5000 else [])
        return len(found._jdf.queryExecution().optimizedPlan().treeString().splitlines())

    assert size(50) == size(5000)


def test_glossaries_of_any_size_are_looked_up_alike(spark, monkeypatch):
    glossary = {"a": "1", "ab": "2", "b c": "3", "日本": "4", "Key": "5", "zz": "6"}
    rows = spark.createDataFrame([(1, "ab cKey", None), (2, "", "b"), (3, "Key 日本", "ab"), (4, "none? q", None)], "i int, source string, speaker string")
    told = F.concat_ws(" ", "source", "speaker")
    policy = [{"source": s, "target": f"p{s}", "scope": {"table": "never"}} for s in glossary]

    def both():
        known = {r["i"]: dict(r["glossary"]) for r in model.relevant_glossary(rows, glossary, told, ["i"]).collect()}
        return known, sorted(tuple(r) for r in terms.preferences(rows, policy, glossary, {"table": F.lit("x")}, ["i"]).collect())

    few = both()
    monkeypatch.setattr(terms, "FEW_TERMS", 0)
    assert both() == few and few[0][1] == {"a": "1", "ab": "2", "b c": "3", "Key": "5"} and few[0][4] == {} and (3, "Key", "5", "prefer", "glossary") in few[1]
