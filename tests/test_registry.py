"""Every registered query against its SQL twin, on a driver table set."""

import math
from datetime import datetime

import duckdb
import pytest

from hearthline.plans import registry

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in names] for r in df.collect()), key=repr)
    cur = duck.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    want = sorted(([plain(r[cols.index(c)]) for c in names] for r in cur.fetchall()), key=repr)
    assert sorted(cols) == names
    assert len(got) == len(want) and got == want
    assert got


def test_plans_have_no_python_and_prune(spark):
    df = registry.queries()["pattern_query"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "Python" not in plan and "CartesianProduct" not in plan
    for name in ("ingest_store", "history_merge_dedup", "address_standardise", "page_links"):
        assert "Python" not in registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
