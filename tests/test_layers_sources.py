"""Sources and sinks: comments CSV, stored layers, materialised tables."""

import datetime as dt

from conftest import rows

from returnscope import config as C
from returnscope.operators import marts, text
from returnscope.plans.layers import LAYER_TABLES, Warehouse
from returnscope.sources import materialize, read_comments_csv

SF = "/root/testdata/sf0.001"


def test_read_comments_csv(spark, tmp_path):
    path = tmp_path / "comments.csv"
    path.write_text(
        'comment_id,comment_date,comment\n'
        '1,2025-06-15 10:00:00,"Checkout button, hidden"\n'
        '2,2025-06-16 00:00:00,"multi\nline, ""quoted"""\n'
        "3,2025-06-17 00:00:00,\n"
    )
    df = read_comments_csv(spark, str(path), multi_line=True)
    got = rows(df, "comment_id", "comment_date", "comment")
    assert got == [
        (1, dt.datetime(2025, 6, 15, 10), "Checkout button, hidden"),
        (2, dt.datetime(2025, 6, 16), 'multi\nline, "quoted"'),
        (3, dt.datetime(2025, 6, 17), None),
    ]
    assert [r.comment_id for r in text.comments_in_range(df).collect()] == [1, 2]


def test_read_comments_csv_of_two_columns(spark, tmp_path):
    path = tmp_path / "comments.csv"
    path.write_text("comment,comment_date\ngood button,2025-06-15 10:00:00\n")
    got = rows(read_comments_csv(spark, str(path)), "comment_id", "comment_date", "comment")
    assert got == [(None, dt.datetime(2025, 6, 15, 10), "good button")]


def test_no_checkpoint_folder_of_the_driver_on_a_cluster():
    import pytest

    from returnscope.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_checkpoint_folder_stays_the_same(spark):
    from returnscope.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_stored_layers_give_the_same_marts(spark, tmp_path):
    raw = Warehouse.from_driver(spark, SF, C.DRIVER_PARAMS)
    expected = rows(marts.marts_kpi_daily(raw.orders_labelled, raw.events_labelled))
    written = Warehouse.from_driver(spark, SF, C.DRIVER_PARAMS).write_layers(str(tmp_path / "layers"), with_marts=True)
    assert set(LAYER_TABLES.values()) | {"stg/comments", "marts/marts_kpi_daily", "marts/marts_segments"} == set(written)
    stored = Warehouse.from_layers(spark, str(tmp_path / "layers"), C.DRIVER_PARAMS)
    assert rows(marts.marts_kpi_daily(stored.orders_labelled, stored.events_labelled)) == expected
    assert rows(spark.read.parquet(written["marts/marts_kpi_daily"])) == expected


def test_stored_facts_are_pruned_by_name(spark, tmp_path):
    import contextlib
    import io
    import re

    from returnscope.plans.registry import RUNNERS

    Warehouse.from_driver(spark, SF, C.DRIVER_PARAMS).write_layers(str(tmp_path / "layers"))
    stored = Warehouse.from_layers(spark, str(tmp_path / "layers"), C.DRIVER_PARAMS)
    for name in ("cart_dropoff", "rr_by_registration_cohort"):
        text_of = io.StringIO()
        with contextlib.redirect_stdout(text_of):
            RUNNERS[name](stored).explain("formatted")
        assert re.search(r"PartitionFilters: .*event_name_id.*dynamicpruning", text_of.getvalue()), name


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    m = materialize(df, "twice")
    assert rows(m) == rows(df)
    assert m.inputFiles() and all(".parquet" in f for f in m.inputFiles())


def test_scale_conf_sizes_partitions_from_input():
    from returnscope.session import scale_conf

    small = scale_conf(10 << 20)
    assert small["spark.sql.shuffle.partitions"] == "8"
    big = scale_conf(100 << 40)
    assert big["spark.sql.shuffle.partitions"] == "409600"  # no cap
    mid = scale_conf(1 << 40)  # 1 TB / 256 MB
    assert mid["spark.sql.shuffle.partitions"] == "4096"
    assert mid["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_bad_csv_rows_are_set_aside(spark, tmp_path):
    import json

    import pytest

    path, rejects = tmp_path / "comments.csv", str(tmp_path / "rejected")
    path.write_text(
        " Comment_ID ,comment_date,comment\n"
        '1,2025-06-15 10:00:00,"fine, quoted"\n'
        "2,15/06/2025 10h,bad date\n"
        "3,2025-06-16\n"
        "4,2025-06-17 00:00:00,one,two,three\n"
        "five,2025-06-17 00:00:00,bad id\n"
        '6,2025-06-18 00:00:00,"a quoted\nbreak, ""twice"""\n'
        ",,\n"
        "8,2025-02-30 00:00:00,no such day\n"
        "9,2025-06-19,a day\n"
    )
    df = read_comments_csv(spark, str(path), multi_line=True, rejects_path=rejects)
    assert rows(df, "comment_id", "comment_date", "comment") == [
        (1, dt.datetime(2025, 6, 15, 10), "fine, quoted"),
        (6, dt.datetime(2025, 6, 18), 'a quoted\nbreak, "twice"'),
        (9, dt.datetime(2025, 6, 19), "a day"),
        (None, None, None),
    ]
    assert df.count() == 4 and df.select("comment_id").distinct().count() == 4  # whatever is selected
    aside = rows(spark.read.json(rejects), "reason", "record")
    assert [r for r, _ in aside] == ["date", "date", "id", "row", "row"]
    assert {json.loads(x)["comment"] for r, x in aside if r != "row"} == {"bad date", "no such day", "bad id"}
    assert [x for r, x in aside if r == "row"] == ["3,2025-06-16", "4,2025-06-17 00:00:00,one,two,three"]
    with pytest.raises(ValueError, match=r"5 rows .*'date': 2"):
        read_comments_csv(spark, str(path), multi_line=True, max_rejected=4)
    assert read_comments_csv(spark, str(path), multi_line=True, max_rejected=5).count() == 4


def test_csv_dates_of_a_stated_format(spark, tmp_path):
    path = tmp_path / "comments.csv"
    path.write_text("comment_date,comment\n15/06/2025,good\n2025-06-15,other format\n")
    df = read_comments_csv(spark, str(path), timestamp_format="dd/MM/yyyy")
    assert rows(df, "comment_date", "comment") == [(dt.datetime(2025, 6, 15), "good")]
