"""Every registered query of the survey part against its SQL twin, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from cohortforge.plans import registry, registry_features, registry_files, registry_media, registry_release  # noqa: F401

SF = "/root/testdata/sf0.001"


def plain(value):
    if value is None:
        return None
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, str):
        return value
    number = float(value)
    return None if math.isnan(number) else float(f"{number:.9g}")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, tables, name):
    df = registry.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((plain(tuple(r)) for r in df.select(*names).collect()), key=str)
    if name not in registry.ORACLE_SQL:
        assert got
        return
    result = tables.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    order = [columns.index(n) for n in names]
    expected = sorted((plain(tuple(r[i] for i in order)) for r in result.fetchall()), key=str)
    assert got == expected
