"""Every registered query against its SQL formulation on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from covaria.plans.registered import registered
from oracles import oracle_sql

TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN",
}

QUERIES = dict(registered())
ORACLES = dict(oracle_sql())


@pytest.fixture(scope="session")
def database(sf_dir):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None:
        return ("none",)
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("number", value)
    if isinstance(value, int) and not isinstance(value, bool):
        return ("number", float(value))
    return ("other", str(value))


def _comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    ours = _comparable(df.columns, [tuple(r) for r in df.collect()])
    assert ours[1]
    if name not in ORACLES:
        return
    result = database.execute(ORACLES[name])
    theirs = _comparable([d[0] for d in result.description], result.fetchall())
    assert ours[0] == theirs[0]
    types = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    assert len(ours[1]) == len(theirs[1])
    for a, b in zip(ours[1], theirs[1]):
        assert a == b
