"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from gaugeworks.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def comparable(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def ordered(rows):
    return sorted(([comparable(v) for v in row] for row in rows), key=lambda r: [str(v) for v in r])


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(registry.QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 11


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    found = entry_point.queries()[name](spark, SF)
    columns = sorted(found.columns)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    places = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(places) == columns
    want = ordered([row[places[c]] for c in columns] for row in cursor.fetchall())
    assert ordered([row[c] for c in columns] for row in found.collect()) == want
    assert want
