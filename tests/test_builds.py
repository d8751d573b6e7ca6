"""Builds as versions, ids that later builds keep, and marts refreshed for changed days."""

import datetime as dt
import os
import random

import pytest
from conftest import D, T, events_df, orders_df, rows, users_df, warehouse

from returnscope.operators import dims, facts, marts, refresh
from returnscope.plans import layers
from returnscope.plans.layers import Warehouse
from returnscope.sources import versions

USERS = [(1, D("2025-06-01"), "ios", "eu", "paid"), (2, D("2025-06-02"), "android", "us", "seo")]


def orders(*statuses):
    return [(f"o{i}", 1 + i % 2, T("2025-06-03 10:00:00"), 5, s) for i, s in enumerate(statuses)]


def test_ids_survive_the_next_build(spark):
    first = dims.dim_order_status(orders_df(spark, orders("paid", "refund", "zombie")))
    assert rows(first, "status_id", "status_name") == [(1, "paid"), (2, "refund"), (3, "zombie")]
    second = dims.dim_order_status(orders_df(spark, orders("approved", "paid", "refund", None, "lost", "paid")), first)
    assert rows(second, "status_id", "status_name") == [(1, "paid"), (2, "refund"), (3, "zombie"), (4, "approved"), (5, "lost"), (6, None)]
    again = dims.dim_order_status(orders_df(spark, orders("abc", None)), second)  # NULL is one value
    assert rows(again, "status_id", "status_name")[-2:] == [(6, None), (7, "abc")]
    assert rows(dims.dim_order_status(orders_df(spark, orders("b", "a")), first.limit(0)), "status_id") == [(1,), (2,)]


def test_stored_facts_keep_their_labels_after_the_next_build(spark, tmp_path):
    root = str(tmp_path / "layers")
    one = warehouse(spark, USERS, orders("paid", "refund"), [("e1", 1, T("2025-06-03 00:00:00"), "refund")])
    one.write_layers(root)
    old = spark.read.parquet(os.path.join(versions.current(spark, root), "fact/fact_orders"))
    before = rows(facts.label_orders(old, Warehouse.from_layers(spark, root).dim_order_status), "order_id", "st")
    two = warehouse(spark, USERS, orders("approved", "aaa", "refund"), [("e1", 1, T("2025-06-03 00:00:00"), "add_to_cart")])
    two.write_layers(root)
    after = rows(facts.label_orders(old, Warehouse.from_layers(spark, root).dim_order_status), "order_id", "st")
    assert before == after == [("o0", "paid"), ("o1", "refund")]
    names = rows(Warehouse.from_layers(spark, root).dim_event_name, "event_name_id", "event_name")
    assert names == [(1, "refund"), (2, "add_to_cart")]


def test_a_failed_build_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "layers")
    with pytest.raises(FileNotFoundError):
        Warehouse.from_layers(spark, root)
    warehouse(spark, USERS, orders("paid")).write_layers(root)
    write = layers.write_table

    def failing(df, path, by=None):
        if "fact_events" in path:
            raise RuntimeError("disk full")
        write(df, path, by)

    monkeypatch.setattr(layers, "write_table", failing)
    with pytest.raises(RuntimeError, match="disk full"):
        warehouse(spark, USERS[:1], orders("paid", "refund", "lost")).write_layers(root)
    stored = Warehouse.from_layers(spark, root)
    assert stored.users.count() == 2 and rows(stored.orders, "status") == [("paid",)]
    monkeypatch.undo()
    warehouse(spark, USERS[:1], orders("paid", "lost")).write_layers(root)
    assert stored.orders.count() == 1  # a reader of the build before goes on
    assert Warehouse.from_layers(spark, root).orders.count() == 2
    assert len(versions.finished(spark, root)) == 2 and len(os.listdir(os.path.join(root, "builds"))) == 2
    warehouse(spark, USERS, orders("paid", "lost", "lost")).write_layers(root)
    assert len(versions.finished(spark, root)) == 2


def test_a_table_may_be_replaced_by_its_own_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.read_current(spark, root) is None
    versions.replace_table(spark.range(5), root)
    versions.replace_table(versions.read_current(spark, root).where("id > 2"), root)
    assert rows(versions.read_current(spark, root)) == [(3,), (4,)]

    def broken():
        raise ValueError("half way")

    bad = spark.range(3).mapInPandas(lambda batches: broken(), "id long")
    with pytest.raises(Exception, match="half way"):
        versions.replace_table(bad, root)
    assert rows(versions.read_current(spark, root)) == [(3,), (4,)]


def labelled(spark, order_rows, event_rows):
    w = warehouse(spark, USERS + [(i, D("2025-06-01"), "ios", "eu", "paid") for i in range(3, 9)], order_rows, event_rows)
    return w.orders_labelled, w.events_labelled, w.users


def random_rows(r, n):
    day = lambda: dt.datetime(2025, 6, 1) + dt.timedelta(days=r.randint(0, 24), seconds=r.randint(0, 86399))
    some = [(f"o{i}", r.randint(1, 8), day(), 3, r.choice(["paid", "paid", "refund", "pending"])) for i in range(n)]
    seen = [(f"e{i}", r.randint(1, 8), day(), r.choice(["add_to_cart", "checkout_start", "payment_success", "refund", "login"])) for i in range(n)]
    return some, seen


@pytest.mark.parametrize("seed", [1])
def test_refreshed_marts_equal_a_full_rebuild(spark, tmp_path, seed):
    r = random.Random(seed)
    root = str(tmp_path / "marts")
    o, e = random_rows(r, 60)
    refresh.store_marts(root, *labelled(spark, o, e))
    for step in range(3):
        days = {dt.date(2025, 6, 1) + dt.timedelta(days=r.randint(0, 26)) for _ in range(2)}
        if step == 1:  # a user's first purchase moves away; another day loses everything
            days = {min(x[2].date() for x in o if x[4] == "paid"), o[-1][2].date()}
        o = [x for x in o if x[2].date() not in days or (step != 1 and r.random() < 0.5)]
        e = [x for x in e if x[2].date() not in days or (step != 1 and r.random() < 0.5)]
        if step != 1:
            new_o, new_e = random_rows(r, 40)
            o += [(f"n{step}{x[0]}", *x[1:]) for x in new_o if x[2].date() in days]
            e += [(f"n{step}{x[0]}", *x[1:]) for x in new_e if x[2].date() in days]
        now = labelled(spark, o, e)
        done = refresh.refresh_marts(root, sorted(days), *now)
        assert days <= set(done)
        full = marts.marts_kpi_daily(now[0], now[1])
        assert rows(refresh.read_mart(spark, root), *full.columns) == rows(full)
        segments = marts.marts_segments(now[0], now[2])
        assert rows(refresh.read_mart(spark, root, refresh.SEGMENTS), *segments.columns) == rows(segments)
        first = versions.read_current(spark, os.path.join(root, refresh.FIRST))
        assert rows(first, "user_id", "first_paid_date") == rows(marts.first_purchase(now[0]), "user_id", "first_paid_date")
        assert rows(refresh.read_mart(spark, root, refresh.DAYS), "user_id", "date") == rows(marts.paid_user_days(now[0]), "user_id", "date")


def test_an_interrupted_refresh_can_be_run_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "marts")
    paid = lambda i, u, d: (f"o{i}", u, T(f"2025-06-{d:02d} 12:00:00"), 3, "paid")
    refresh.store_marts(root, *labelled(spark, [paid(1, 1, 10), paid(2, 1, 17), paid(3, 2, 10)], []))
    now = labelled(spark, [paid(1, 1, 10), paid(2, 1, 17), paid(3, 2, 10), paid(4, 1, 3)], [])
    replace = versions.replace_table
    monkeypatch.setattr(versions, "replace_table", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        refresh.refresh_marts(root, [D("2025-06-03")], *now)
    monkeypatch.setattr(versions, "replace_table", replace)
    done = refresh.refresh_marts(root, [D("2025-06-03")], *now)
    assert done == [D("2025-06-03"), D("2025-06-10"), D("2025-06-17")]  # the first purchase moved from the 10th
    full = marts.marts_kpi_daily(now[0], now[1])
    assert rows(refresh.read_mart(spark, root), *full.columns) == rows(full)


def test_a_refresh_reads_the_changed_days_only(spark, tmp_path):
    o, e = random_rows(random.Random(3), 30)
    w = Warehouse(users_df(spark, USERS), orders_df(spark, o), events_df(spark, e))
    w.write_layers(str(tmp_path / "layers"))
    stored = Warehouse.from_layers(spark, str(tmp_path / "layers"))
    some = refresh._on(stored.fact_orders, "order_date", [D("2025-06-05"), D("2025-06-06"), D("2025-06-09")])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(" in plan.replace("IsNotNull(order_date), ", "")
