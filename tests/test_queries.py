"""Every registered report against its SQL twin on DuckDB."""

import datetime
import decimal

import duckdb
import pytest

from callweave import plans
from tests.conftest import SF

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}"
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_equals_sql(name, spark, duck, sf_dir):
    df = plans.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = duck.execute(plans.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE_SQL)


def test_registry_needs_no_session_and_survives_without_optional_part():
    import subprocess
    import sys

    code = "import sys; sys.modules['callweave.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'settlement_summary' in e.queries(); assert not any(n.startswith('op2_') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__import__("tests.conftest", fromlist=["ROOT"]).ROOT)
