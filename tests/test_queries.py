"""Every registered query against its SQL, whole tables, exact values and types."""

import pytest

import __spark_entry__ as contract
from tallyloom.coverage import CASES
from tests.compare import same_rows

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
QUERIES = {name: q for name, q in contract.queries().items() if name in CASES}
ORACLES = {name: q for name, q in contract.oracle_sql().items() if name in CASES}


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    declared = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == declared
    assert same_rows(df, duck, ORACLES[name]) > 0


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "ship_order"
