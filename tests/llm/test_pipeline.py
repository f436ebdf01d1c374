"""The pipeline stage by stage, and empty tables for the operators over documents."""

import corpus_pipeline as pipeline
import pytest

from glossmill.llm import jaccard, licenses, substring, suffixtree


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    extra = spark.createDataFrame([(9_000_001, "123 !!", "en", "s", 6), (9_000_002, None, "en", "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    frames = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, frames[-1], data).write.parquet(f"{folder}/{name}")
        frames.append(spark.read.parquet(f"{folder}/{name}"))
    return frames


def test_stages(stages):
    assert 4 <= len(pipeline.STAGES) <= 5
    for frame in stages[1:-1]:
        assert frame.columns == list(pipeline.COLUMNS)
    counts = [f.count() for f in stages[:-1]]
    assert counts[1] == counts[0] - 2 and all(a >= b for a, b in zip(counts, counts[1:]))


def test_near_duplicates_by_brute_force(stages):
    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {r["doc_id"]: shingles(r["text"]) for r in stages[1].collect()}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert {r["doc_id"] for r in stages[2].select("doc_id").collect()} == {i for i, r in root.items() if i == r}


def test_passages_are_left_once(stages):
    seen: dict = {}
    for r in stages[3].orderBy("doc_id").collect():
        w = r["text"].split()
        for i in range(len(w) - 49):
            assert seen.setdefault(tuple(w[i : i + 50]), r["doc_id"]) == r["doc_id"]


def test_clean_documents_stay_as_they_are(stages):
    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    from glossmill.llm.surrogates import entities

    for r in stages[4].collect():
        if not entities(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]


def test_run(spark, data, stages):
    got = pipeline.run(spark, data)
    assert got.columns == stages[-1].columns
    assert got.agg({"length": "sum"}).first()[0] == stages[-1].agg({"length": "sum"}).first()[0]


def test_stages_on_odd_rows_and_columns(spark, data):
    """Null, empty and repeated rows, and columns that are named like what operators use inside."""
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60).selectExpr("doc_id", "text", "lang", "source", "n_chars")
    long = "the of and " * 30_000
    odd = [(None, None), (None, "no id at all"), (900_001, ""), (900_002, None), (900_003, "same words here"), (900_003, "same words here"), (900_004, long), (900_005, long)]
    rows = docs.unionByName(spark.createDataFrame([(i, t, None, "s", 0) for i, t in odd], docs.schema))
    for c in ("lang_pred", "Score", "kept_text", "n_removed", "at", "chunk", "places", "n_replaced", "component_id", "__n"):
        rows = rows.withColumn(c, pipeline.F.lit("x"))
    given = rows
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, rows, data)
        assert got.columns == given.columns and got.where("Score <> 'x' OR n_replaced <> 'x'").isEmpty()
        rows = spark.createDataFrame(got.collect(), got.schema)
        held = sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in rows.where("doc_id IS NULL OR doc_id > 900000").collect())
        if name == "language":  # no text, no language
            assert held == [(0, 12), (900_003, 15), (900_003, 15), (900_004, len(long)), (900_005, len(long))]
        else:
            assert held == [(0, 12), (900_003, 15), (900_003, 15), (900_004, len(long))]
    packed = pipeline.packing(spark, rows, data)
    assert packed.where("doc_id = 900003").count() == 2 and packed.where("doc_id IS NULL").count() == 1


def test_stages_on_no_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, data).isEmpty()


def test_run_on_an_empty_table(spark, data, tmp_path):
    spark.read.parquet(f"{data}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).isEmpty()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert substring.substring_dedup(empty).isEmpty()
    assert jaccard.similar_documents(empty).isEmpty()
    assert suffixtree.score_texts(empty, pipeline.F.lit(True)).isEmpty()
    assert licenses.scan(empty).isEmpty()
