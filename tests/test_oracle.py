"""Every registered query against its DuckDB oracle (the driver's correctness gate).

Runs at sf0.001 by default (fast); ``EVENTIDE_ORACLE_SF=/root/testdata/sf0.01`` runs the
driver's scale.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from eventide.plans import catalog  # noqa: E402
from check_oracle import TABLES, digest, spark_type  # noqa: E402

SF = os.environ.get("EVENTIDE_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    assert stypes == otypes
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert df.columns == ["content_id", "score", "total_events", "unique_users",
                          "total_engagement_seconds"]
    scores = [r.score for r in rows]
    assert scores == sorted(scores, reverse=True) and scores[-1] > 0
