"""Every registered query against its SQL twin, on whole tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract
from dayledger.oracle import ORACLE
from dayledger.queries import REGISTRY

duckdb = pytest.importorskip("duckdb")
SMALL = "/root/testdata/sf0.001"

# Correct on these tables only if they find nothing.
EMPTY = {"dimension_conflicts", "reconciliation", "unique_creative_days"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    connection.execute(f"create view lineitem as select * from '{SMALL}/lineitem.parquet'")
    return connection


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, sql, name):
    frame = REGISTRY[name](spark, SMALL)
    result = sql.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    expected = in_name_order(columns, result.fetchall())
    found = in_name_order(frame.columns, frame.collect())
    assert found == expected
    assert bool(found[1]) == (name not in EMPTY)


def test_flagship_is_in_report_order(spark):
    rows = contract.entry(spark).collect()
    places = [(r.campaign_id, -r.ctr, r.creative_id) for r in rows]
    assert rows and places == sorted(places)


def test_the_contract_has_every_query_and_twin():
    assert REGISTRY.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
