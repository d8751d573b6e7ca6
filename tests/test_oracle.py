"""Every registered query with an oracle, at sf0.001, against DuckDB."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from returnscope.plans import registry
from returnscope.sources.tables import DRIVER_TABLES, table_path

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(got, df.columns) == _rows(res.fetchall(), ocols)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "return_rate" in df.columns


def test_queries_without_oracle_run(spark):
    names = sorted(set(registry.QUERIES) - set(oracle_sql()))
    assert names == ["cluster_examples", "cluster_top_terms", "kmeans_assign", "kmeans_elbow", "silhouette"]
    assert queries()["kmeans_assign"](spark, SF).count() > 0


def test_fixture_figures(spark):
    """Figures measured independently with DuckDB (FIXTURES.md section 2)."""
    from pyspark.sql import functions as F

    r = queries()["rr_by_registration_cohort"](spark, SF).collect()[0]
    assert (r.pre_users, r.post_users) == (90, 60)
    dropoff = queries()["cart_dropoff"](spark, SF).agg(F.sum("users_dropoff")).collect()[0][0]
    assert dropoff == 18


def test_asof_fixture_figure(spark):
    """FIXTURES.md: at sf0.01 all paid orders (before copies and negative
    amounts) give 4,933 rows in the as-of join, 314 with a later refund event."""
    from pyspark.sql import functions as F

    from returnscope.operators.asof import asof_forward_min
    from returnscope.sources import driver

    sf = "/root/testdata/sf0.01"
    paid = driver.orders_raw(spark, sf, copies=False, negatives=False).where(F.col("status") == "Paid")
    refunds = driver.events_raw(spark, sf, copies=False).where(F.col("event_name") == "refund")
    first = asof_forward_min(
        paid.select("order_id", "user_id", "order_date"),
        refunds.select("user_id", F.col("event_date").alias("refund_ts")),
        "user_id",
        "order_date",
        "refund_ts",
        "refund_ts",
    )
    assert first.count() == 4933
    assert first.where(F.col("refund_ts").isNotNull()).count() == 314
