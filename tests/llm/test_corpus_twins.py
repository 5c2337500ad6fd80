"""Corpus queries against their SQL twins, on whole tables."""

import pytest

import __spark_entry__ as contract
from dayledger.llm.oracle import ORACLE

duckdb = pytest.importorskip("duckdb")
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("pages", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    frame = contract.queries()[name](spark, SMALL)
    result = connection.execute(contract.oracle_sql()[name])
    columns = sorted(c[0] for c in result.description)
    expected = [dict(zip([c[0] for c in result.description], row, strict=True)) for row in result.fetchall()]
    assert sorted(frame.columns) == columns
    as_text = lambda rows: sorted(str([row[c] for c in columns]) for row in rows)
    assert as_text(r.asDict() for r in frame.collect()) == as_text(expected) and expected


def test_all_queries_are_registered():
    names = [n for n in contract.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted({n.split("_")[0] for n in names}) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
