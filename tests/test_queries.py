"""Every registered query of the engine against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from codexloom.plans import registry

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())


@pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")
def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() >= 20 and set(out.columns) >= {"book", "result", "score"}


@pytest.mark.parametrize("name", ["coverage", "coverage_checks"])
def test_books_with_names_of_any_length(spark, tmp_path, name):
    """Books with names of 6 to 9 characters: by one of them nothing can be divided."""
    rows = [(i, f"Some words of the document {i}. " * 9, "en", s) for s, first in (("src1", 0), ("src1", 20_000), ("src10", 20_000), ("src10", 200_000)) for i in range(first, first + 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql("SET error_on_division_by_zero = false")  # what can't be divided is null, and in neither's share
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    rel = con.sql(SQL[name])
    got = registry.queries()[name](spark, str(tmp_path)).select(*rel.columns).collect()
    assert sorted(repr(plain(tuple(r))) for r in got) == sorted(repr(plain(r)) for r in rel.fetchall()) and len({r["book"] for r in got}) == 4
