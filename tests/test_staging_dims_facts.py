"""Rows 1-10 and 36 on hand fixtures (FIXTURES.md section 3)."""

import datetime as dt

from conftest import D, M, T, rows, warehouse

from returnscope.operators import dense_ids, key_violations, unique_key_check

DUP_USERS = [
    (1, D("2024-01-05"), "IOS", "eu", "paid"),
    (1, D("2024-01-03"), "ios", "eu", "paid"),
    (2, D("2024-01-04"), "android", "us", "ORGANIC"),
    (2, D("2024-01-04"), "Android", "us", "organic"),
    (3, None, "Tablet", "asia", "seo"),
    (3, D("2024-01-06"), None, "asia", "seo"),
    (4, D("2024-01-01"), "Tablet", None, "email"),
]

DUP_ORDERS = [
    ("a", 1, T("2024-01-02 10:00:00"), 10.00, "Paid"),
    ("a", 1, T("2024-01-01 09:00:00"), 12.00, "PAID"),
    ("b", 1, T("2024-01-01 09:00:00"), -1.00, "paid"),
    ("c", 2, T("2024-01-01 09:00:00"), 0.00, "Refunded"),
    ("d", 2, T("2024-01-01 09:00:00"), None, "paid"),
    ("e", 3, T("2024-01-01 09:00:00"), 999999.99, None),
    ("f", 4, T("2024-01-01 08:00:00"), -5.00, "paid"),
    ("f", 4, T("2024-01-02 08:00:00"), 5.00, "pending"),
]

DUP_EVENTS = [
    ("e1", 1, T("2024-01-01 12:00:00"), "Add_To_Cart"),
    ("e1", 1, T("2024-01-01 11:00:00"), "add_to_cart"),
    ("e2", 2, T("2024-01-01 11:00:00"), None),
    ("e3", 2, T("2024-01-02 11:00:00"), "payment_success"),
]


def test_users_clean_dedup_and_canonical(spark):
    w = warehouse(spark, users=DUP_USERS)
    assert rows(w.users, "user_id", "reg_date", "device", "region", "channel") == [
        (1, D("2024-01-03"), "iOS", "EU", "Paid"),
        (2, D("2024-01-04"), "Android", "US", "Organic"),
        (3, D("2024-01-06"), None, "ASIA", "seo"),
        (4, D("2024-01-01"), "Tablet", None, "email"),
    ]


def test_orders_clean_filters_before_dedup(spark):
    w = warehouse(spark, orders=DUP_ORDERS)
    got = rows(w.orders, "order_id", "user_id", "order_date", "amount", "status")
    assert got == [
        ("a", 1, T("2024-01-01 09:00:00"), M(12.00), "paid"),
        ("c", 2, T("2024-01-01 09:00:00"), M(0.00), "refunded"),
        ("e", 3, T("2024-01-01 09:00:00"), M(999999.99), None),
        ("f", 4, T("2024-01-02 08:00:00"), M(5.00), "pending"),
    ]


def test_events_clean_keeps_earliest_lowercase(spark):
    w = warehouse(spark, events=DUP_EVENTS)
    assert rows(w.events, "event_id", "event_date", "event_name") == [
        ("e1", T("2024-01-01 11:00:00"), "add_to_cart"),
        ("e2", T("2024-01-01 11:00:00"), None),
        ("e3", T("2024-01-02 11:00:00"), "payment_success"),
    ]


def test_dims_and_facts(spark):
    w = warehouse(spark, users=DUP_USERS, orders=DUP_ORDERS, events=DUP_EVENTS)
    assert rows(w.dim_order_status, "status_id", "status_name") == [
        (1, "paid"),
        (2, "pending"),
        (3, "refunded"),
        (4, None),
    ]
    assert rows(w.dim_event_name, "event_name_id", "event_name") == [
        (1, "add_to_cart"),
        (2, "payment_success"),
        (3, None),
    ]
    # NULL status / NULL event name never match the dimension (inner join)
    assert rows(w.fact_orders, "order_id", "status_id") == [("a", 1), ("c", 3), ("f", 2)]
    assert rows(w.fact_events, "user_id", "event_name_id") == [(1, 1), (2, 2)]
    labelled = rows(w.orders_labelled, "order_id", "st", "status_group")
    assert labelled == [("a", "paid", "paid"), ("c", "refunded", "refund"), ("f", "pending", "other")]
    assert rows(w.dim_user, "user_id") == [(1,), (2,), (3,), (4,)]


def test_dense_ids_across_partitions(spark):
    df = spark.createDataFrame([(s,) for s in ["refunded", "paid", "pending", None, "paid", "b", "z"]], "status string")
    expected = [(1, "b"), (2, "paid"), (3, "pending"), (4, "refunded"), (5, "z"), (6, None)]
    assert rows(dense_ids(df, "status", "id", num_partitions=3), "id", "status") == expected
    assert rows(dense_ids(df, "status", "id"), "id", "status") == expected


def test_dim_date_calendar(spark):
    users = [(1, D("2024-12-30"), "ios", "eu", "paid")]
    events = [("x", 1, T("2025-01-05 10:00:00"), "view")]
    w = warehouse(spark, users=users, events=events)
    cal = {r["date_key"]: r for r in w.dim_date.collect()}
    assert sorted(cal) == [D("2024-12-30") + dt.timedelta(days=i) for i in range(7)]
    mon = cal[D("2024-12-30")]
    assert (mon.iso_dow, mon.week_of_year, mon.year, mon.quarter, mon.month_name, mon.is_weekend) == (
        1, 1, 2024, 4, "December ", False,
    )
    assert mon.week_start == D("2024-12-30") and mon.year_start == D("2024-01-01")
    sat = cal[D("2025-01-04")]
    assert (sat.iso_dow, sat.is_weekend, sat.week_of_year, sat.month_name) == (6, True, 1, "January  ")
    assert sat.week_start == D("2024-12-30") and sat.quarter_start == D("2025-01-01")
    assert cal[D("2025-01-05")].iso_dow == 7


def test_unique_key_check(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,), (3,), (3,)], "k int")
    assert rows(unique_key_check(df, ["k"]), "k", "n_rows") == [(1, 2), (3, 3), (None, 1)]
    kv = key_violations({"t": (df, ["k"])})
    assert rows(kv, "table_name", "key_value", "n_rows") == [("t", "1", 2), ("t", "3", 3), ("t", None, 1)]
