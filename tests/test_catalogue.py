"""Every query of the library against its SQL, on the smallest driver tables."""

import duckdb
import pytest

from glossmill.plans import catalogue
from glossmill.session import TABLES


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(name, spark, data, duck):
    got = catalogue.queries()[name](spark, data).toPandas()
    want = duck.execute(catalogue.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = [f[columns].astype(str).sort_values(columns).reset_index(drop=True) for f in (got, want)]
    assert rows[0].equals(rows[1])


def test_containment_of_short_passages(spark, tmp_path):
    words = "the quick  brown fox\njumps over a lazy dog".split(" ")
    passages = [" ".join(words[at : at + n]) for n in range(1, 8) for at in (0, 1, 2)] + ["", " ", "he", "ck", "uick", "lazy do", "x brown f", "öß", " the", None]
    texts = ["the quick  brown fox\njumps over a lazy dog", "brown fox\njumps", "quick", "the", "", None, "a lazy dog höß", "unquick  brownish", "the quick brown fox", "over a lazy doghouse"]
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], r["item_id"]) for r in catalogue.containment_join(spark, str(tmp_path)).collect())
    c = duckdb.connect()
    for t in ("benchmark", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == sorted(c.execute(catalogue.oracle_sql()["containment_join"]).fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalogue.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
