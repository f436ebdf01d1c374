"""Operator 12 against its SQL, on the test data and on awkward rows."""

import duckdb
import pytest

from glossmill.llm import divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def by_sql(table):
    con = duckdb.connect()
    con.register("documents", table)
    return sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({divergence.ORACLE})").fetchall())


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


AWKWARD = [(i % 4, f"the-the cat{i}, dog. DOG é x {i} word{i % 3}", "en", f"s{i % 3}") for i in range(24)]
AWKWARD += [(1, None, "en", "s9"), (1, "", None, None), (None, "alpha " * 400, "de", "a"), (7, "only, two; words", "de", None), (7, "123 456 \t\x0b", "fr", "a"), (7, "", "fr", "b")]
AWKWARD += [(5, "same row repeated beta", "es", "q")] * 9 + [(5, "beta beta.", "es", "r")] * 2 + [(6, "Straße STRASSE 漢字 ÀÉ", "de", "z")] * 10


@pytest.mark.parametrize("held, slice_bytes, shard", [(700_000, 2 << 20, 20_000), (40, 64, 3)])
def test_awkward_rows_as_the_sql_says(spark, monkeypatch, held, slice_bytes, shard):
    monkeypatch.setattr(divergence, "_HELD", held)
    monkeypatch.setattr(divergence, "SLICE", slice_bytes)
    monkeypatch.setattr(divergence, "_SHARD", shard)
    monkeypatch.setattr(divergence, "_FEW", 10_000 if shard > 3 else 0)
    docs = spark.createDataFrame([(*r, 1, "units") for r in AWKWARD], "doc_id long, text string, lang string, source string, bucket int, units string")
    got = rows_of(divergence.audit(docs.repartition(3), bucket_bytes=100))
    assert got == by_sql(docs.toArrow())
    assert {r[2] for r in got} == {"pair", "term"}


def test_the_test_data_as_the_sql_says(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = rows_of(divergence.query(spark, data))
    assert got and got == by_sql(docs.toArrow())


def test_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0


def test_shares_are_exact_beyond_what_a_product_holds():
    import numpy as np

    counts, total, terms = np.array([0, 1, 10**13, 3 * 10**15]), 4 * 10**15, 12_345
    assert divergence._share(counts, total, terms).tolist() == [1 + 10**9 * (int(c) + 2) // (total + 2 * terms) for c in counts]
