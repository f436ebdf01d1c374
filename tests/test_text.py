"""Column functions on Japanese and Chinese texts, against plain Python where there is any."""

import fnmatch

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossmill.functions import patterns as P
from glossmill.functions import text as T


def one(spark, row: dict, column):
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("s", "want"),
    [("青い鍵", "青い鍵"), ("　青い鍵 ", "青い鍵"), ("", None), ("   ", None), ("{user}さん", None), ("2030/1/2 10:00", None), ("１２３", None), ("!!", None), ("あ" * 121, None), ("a\\nb", None)],
)
def test_candidate_text(spark, s, want):
    assert one(spark, {"s": s}, T.candidate_text("s")) == want


def test_candidate_text_with_literal_breaks(spark):
    assert one(spark, {"s": "青い\\n鍵"}, T.candidate_text("s", literal_breaks=True)) == "青い\\n鍵"


@pytest.mark.parametrize(
    ("glob", "text", "hit"), [("na*", "name", True), ("na?e", "name", True), ("[a-c]x", "bx", True), ("[!a-c]x", "bx", False), ("*", "a\nb", True), ("a.b", "axb", False), ("A*", "ab", False), ("[x", "[x", True)]
)
def test_globs(spark, glob, text, hit):
    assert one(spark, {"s": text}, F.col("s").rlike(P.glob_regex(glob))) is hit
    assert fnmatch.fnmatchcase(text, glob) is hit


@pytest.mark.parametrize(
    ("text", "term", "hit"), [("key card", "key", True), ("monkey", "key", False), ("鍵key鍵", "key", True), ("青い鍵だ", "青い鍵", True), ("key_1", "key", False), ("a.b+c", "b+", True), ("x\\nkey", "key", False)]
)
def test_whole_tokens(spark, text, term, hit):
    assert one(spark, {"s": text}, T.contains_token("s", term)) is hit


def test_literal_break_is_a_boundary(spark):
    assert one(spark, {"s": "x\\nkey"}, T.contains_token("s", "key", literal_break=True)) is True


def test_longer_terms_shadow_shorter_ones(spark):
    assert one(spark, {"s": "青い鍵と鍵"}, T.mentions("s", ["鍵", "青い鍵"])) == ["青い鍵", "鍵"]


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="a1 \n<>{}$^⟦\\鍵", max_size=12))
def test_masks_come_back(spark, s):
    masked = T.unmasked(T.masked(F.col("s"), "[0-9]+|[<>]", "⟪", "⟫"), F.col("s"), "[0-9]+|[<>]", "⟪", "⟫")
    assert one(spark, {"s": s}, masked) == s


def test_line_endings(spark):
    assert one(spark, {"s": "a\r\nb\nc", "t": "x\ny\nz"}, T.imposed_line_endings("s", "t")) == "x\r\ny\nz"
    assert one(spark, {"s": "a\r\nb", "t": "x\ny\nz"}, T.imposed_line_endings("s", "t")) == "x\ny\nz"


def test_story_normaliser(spark):
    assert one(spark, {"s": "a\\nb", "t": "x\ny[1]"}, T.story_normalised("s", "t")) == "x\\ny［1］"


def test_credits(spark):
    assert one(spark, {"s": "作詞・作曲：山田"}, T.credit_parts("s")).asDict() == {"label": "作词・作曲", "separator": "：", "names": "山田"}
    assert one(spark, {"s": "説明：山田"}, T.credit_parts("s")) is None


def test_ids_depend_on_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    a, b = (r["i"] for r in df.select(T.short_id("x", "y").alias("i")).collect())
    assert a != b and len(a) == 24


def test_markers_in_the_text_itself(spark):
    for text in ("⟦0⟧ and 5", "5 ⟦7⟧ 6", "⟦⟧ 1"):
        masked = one(spark, {"s": text}, T.masked("s", "[0-9]+"))
        assert one(spark, {"m": masked, "s": text}, T.unmasked("m", "s", "[0-9]+")) == text


def test_any_digit_counts(spark):
    assert one(spark, {"s": "{１}と{2:x}%３d"}, T.matches("s", P.RECORD_TOKEN)) == ["{１}", "{2:x}", "%３d"]


def test_paths_and_fences(spark):
    projects = ["a", "b"]
    for path, want in [("/home/x/b/src/f.csv", "b/src/f.csv"), ("C:\\Users\\x\\a\\f", "a/f"), ("/home/x/f.csv", "f.csv"), ("/data/a/f", "/data/a/f")]:
        assert one(spark, {"p": path}, T.portable_path("p", projects)) == want
    for answer, want in [(' {"a":1}\n', '{"a":1}'), ('```json\n{"a":1}\n``` ', '{"a":1}'), ("```json\n{", None), ("```{}```", None)]:
        assert one(spark, {"s": answer}, T.fenced_json("s")) == want


def test_interface_line_feeds(spark):
    for source, target, want in [("a\nb", "x\\ny", "x\ny"), ("a\\nb", "x\ny", "x\\ny"), ("a", "x\ny", "x\ny")]:
        assert one(spark, {"s": source, "t": target}, T.interface_normalised("s", "t")) == want
