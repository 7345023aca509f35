"""Every registered query of the library: runs on the small tables, and equals its SQL in DuckDB."""

from pathlib import Path

import duckdb
import pytest

from quirework import catalogue, catalogue_files, catalogue_parts, catalogue_plans  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(normal(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(([normal(r[c]) for c in cols] for r in df.collect()), key=str)
    if name in catalogue.ORACLE:
        rel = duck.sql(catalogue.ORACLE[name])
        assert sorted(rel.columns) == cols
        assert got == sorted(([normal(r[rel.columns.index(c)]) for c in cols] for r in rel.fetchall()), key=str)


def test_entry_module():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.QUERIES) <= set(entry.queries())


def test_notes_that_differ_after_their_beginning_are_not_repeated(spark, tmp_path):
    head = "One and the same opening of sixty characters, and then some more: "
    rows = [(1, head + "one"), (2, head + "two"), (3, head + "ONE!"), (4, "- " * 40 + head), (5, "* " * 40 + head)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["pages"] for r in catalogue.QUERIES["repeated_notes"](spark, str(tmp_path)).collect()) == [[1, 3], [4, 5]]


def test_text_measures_fold_the_whole_text(spark, tmp_path):
    head = "one and the same opening of forty characters: "
    rows = [(1, head + "STRASSE"), (2, head + "straße"), (3, head + "strasse!")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["folded_sha256"] for r in catalogue.QUERIES["text_measures"](spark, str(tmp_path)).collect()}
    assert got[1] == got[2] != got[3]
