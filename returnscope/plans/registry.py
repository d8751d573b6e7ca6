"""Registered queries: one per operator, each (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` in full, maps them to the raw
schemas (``sources.driver``) and runs the library's operators with the driver
parameters (release 2024-01-16; FIXTURES.md).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators import analysis, dims, marts, quality, refresh, text
from ..operators.joins import dense_ids
from ..session import configure, ensure_checkpoint_dir
from ..sources import driver
from ..sources.files import materialize, split_comments_csv
from ..sources.tables import read_table
from .layers import Warehouse

P = C.DRIVER_PARAMS


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    configure(spark)
    return Warehouse.from_driver(spark, sf_dir, P)


def _comments(w: Warehouse) -> DataFrame:
    """All comments with a text: the date range is row 28's alone, as the driver tables have no comment dates."""
    return w.comments_raw.na.drop(subset=["comment"])


def _segment_ab(w: Warehouse) -> DataFrame:
    return analysis.rr_segment_ab(w.orders_labelled, w.users, P.release, P.ab_window_days)


def _clusters(w: Warehouse, texts: bool = False):
    # K-Means iterates over the features, and the reports join them back to
    # the comments: pin the per-row document keys and cut the lineage with
    # tables in the shared checkpoint folder.  The texts are written only
    # where a report shows them
    comments = text.joined(_comments(w), texts)
    n = comments.count()
    feats, vocab = text.tfidf_vectors(comments.drop("comment"), C.TFIDF_MAX_FEATURES, n_docs=n)
    return comments, feats, vocab, n


def _assigned(w: Warehouse):
    _, feats, _, _ = _clusters(w)
    return text.kmeans_assign(feats, C.KMEANS_K, C.KMEANS_SEED)


def _examples(w: Warehouse):
    comments, feats, _, _ = _clusters(w, texts=True)
    assigned = text.kmeans_assign(feats, C.KMEANS_K, C.KMEANS_SEED)
    return text.cluster_examples(assigned, C.EXAMPLES_PER_CLUSTER, texts=comments)


def _top_terms(w: Warehouse):
    _, feats, vocab, _ = _clusters(w)
    return text.centre_top_terms(text.kmeans_fit(feats, C.KMEANS_K, C.KMEANS_SEED), vocab, C.TOP_TERMS)


def _kmeans_checks(w: Warehouse):
    comments, feats, vocab, n = _clusters(w)
    weights = text.tfidf(comments, C.TFIDF_MAX_FEATURES, n_docs=n, keep_doc_key=True)
    checks = text.kmeans_checks(feats, materialize(weights, "kmeans-weights"), vocab, C.KMEANS_K_RANGE, C.KMEANS_SEED)
    below = F.lag("inertia").over(Window.orderBy("k"))  # one row per k
    return checks.select(
        "k",
        "comments",
        "misplaced",
        (F.col("inertia_gap") < 1e-9).alias("inertia_agrees"),
        F.coalesce(F.col("inertia") <= below, F.lit(True)).alias("inertia_falls"),
    )


def _by_source(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """Lemmatised comments, their clusters given: the sources, numbered in order of name.  Written without what
    no later step reads: the words before the lemma lookup and, unless ``texts``, the comments themselves."""
    configure(spark)
    comments = text.tokenised(driver.comments_by_source(spark, sf_dir).na.drop(subset=["comment"]))
    numbers = materialize(dense_ids(comments, "source", "cluster"), "sources")
    lemmas = text.lemmatised(comments.join(numbers, "source")).drop(text.WORDS, *([] if texts else ["comment"]))
    return materialize(lemmas, "lemmas-by-source")


def _silhouette_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats, _ = text.tfidf_vectors(_by_source(spark, sf_dir), C.TFIDF_MAX_FEATURES, keep=("cluster",))
    return text.silhouette_squared(feats).withColumn("silhouette", F.round("silhouette", 8))


def _silhouette_euclidean_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats, _ = text.tfidf_vectors(_by_source(spark, sf_dir, texts=False), C.TFIDF_MAX_FEATURES, keep=("cluster",))
    return text.silhouette(feats).withColumn("silhouette", F.round("silhouette", 8))


def _top_terms_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = _by_source(spark, sf_dir, texts=False)
    weights = text.tfidf(comments, C.TFIDF_MAX_FEATURES, keep_doc_key=True, keep=("cluster",))
    top = text.cluster_top_terms(weights, comments, C.TOP_TERMS)
    return top.withColumn("weight", F.round("weight", 10))


def _examples_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.cluster_examples(_by_source(spark, sf_dir), C.EXAMPLES_PER_CLUSTER)


def _clean_text_with_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row 29 with the words of the benchmark items as the lexicon."""
    lexicon = materialize(text.lexicon_of(read_table(spark, sf_dir, "benchmark", ["text"]), "text"), "lexicon")
    return text.clean_text(_comments(_wh(spark, sf_dir)), lexicon).select("comment_id", "clean_text")


def _event_names_next_build(w: Warehouse) -> DataFrame:
    """Row 7 at a second build: the stored dimension knows the funnel's events only, then all events come."""
    funnel = w.events.where(F.lower("event_name").isin(*C.FUNNEL_STEPS))
    stored = materialize(dims.dim_event_name(funnel), "dim-event-name")
    return dims.dim_event_name(w.events, stored)


def _kpi_refreshed(w: Warehouse) -> DataFrame:
    """Row 18 built on the rows up to the release and refreshed for the days from it on."""
    orders, events = (materialize(df, "facts") for df in (w.orders_labelled, w.events_labelled))
    spark = orders.sparkSession
    root = f"{ensure_checkpoint_dir(spark)}/tables/marts-{uuid.uuid4().hex[:12]}"
    early = F.lit(P.release).cast("timestamp_ntz")
    refresh.store_marts(root, orders.where(F.col("order_date") < early), events.where(F.col("event_date") < early), w.users)
    last = max(
        orders.agg(F.max(F.to_date("order_date")).alias("d")).first()["d"] or P.release,
        events.agg(F.max(F.to_date("event_date")).alias("d")).first()["d"] or P.release,
    )
    changed = [P.release + dt.timedelta(days=i) for i in range((last - P.release).days + 1)]
    refresh.refresh_marts(root, changed, orders, events, w.users)
    return refresh.read_mart(spark, root)


def _rolling_retention(w: Warehouse) -> DataFrame:
    """Row 23 over overlapping cohorts: the 14 days from every registration day on, and all users from the release on."""
    starts = w.users.where("reg_date IS NOT NULL").select(F.col("reg_date").cast("date").alias("start_date")).distinct()
    rolling = starts.select(F.col("start_date").cast("string").alias("cohort"), "start_date", F.date_add("start_date", 14).alias("end_date"))
    last = w.users.sparkSession.createDataFrame([("since release", P.release, None)], rolling.schema)
    cohorts = materialize(rolling.unionByName(last), "cohorts")
    return analysis.retention_by_cohort(w.users, w.events_labelled, cohorts, P.d7_window_days)


def _comments_csv(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Row 28 from a CSV file with bad rows: the comments, of which every 50th gets an unreadable date."""
    c = w.comments_raw.na.drop(subset=["comment"])
    date = F.when(F.col("comment_id") % 50 == 7, F.lit("not a date")).otherwise(F.date_format("comment_date", "yyyy-MM-dd HH:mm:ss"))
    path = f"{ensure_checkpoint_dir(c.sparkSession)}/tables/comments-csv-{uuid.uuid4().hex[:12]}"
    out = c.select("comment_id", date.alias("comment_date"), "comment")
    # quoted whole: texts keep their line breaks, quotes and edge blanks
    out.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return split_comments_csv(c.sparkSession, path, multi_line=True)


def _load_comments_csv(w: Warehouse) -> DataFrame:
    good, _ = _comments_csv(w)
    return text.comments_in_range(good, P.comment_range).select("comment_id", "comment_date", "comment")


def _rejected_comments(w: Warehouse) -> DataFrame:
    _, rejected = _comments_csv(w)
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _two_months(w: Warehouse) -> DataFrame:
    moved = Warehouse(w.users_raw, w.orders_raw, driver.over_two_months(w.events_raw), None, P)
    return analysis.funnel_month_change(moved.events_labelled, P.release, (P.release.replace(day=1) + dt.timedelta(days=31)))


def _wl(f):
    """Adapt a warehouse runner to the (spark, sf_dir) query signature."""
    return lambda spark, sf_dir: f(_wh(spark, sf_dir))


def _key_violations(w: Warehouse) -> DataFrame:
    return quality.key_violations(
        {
            "users_raw": (w.users_raw, ["user_id"]),
            "orders_raw": (w.orders_raw, ["order_id"]),
            "events_raw": (w.events_raw, ["event_id"]),
            "dim_date": (w.dim_date, ["date_key"]),
            "dim_order_status": (w.dim_order_status, ["status_id", "status_name"]),
            "dim_event_name": (w.dim_event_name, ["event_name_id", "event_name"]),
        }
    )


# name -> runner over a Warehouse (raw-backed or layer-backed)
RUNNERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # staging, dimensions, facts (rows 1-10)
    "stg_users_clean": lambda w: w.users,
    "stg_orders_clean": lambda w: w.orders,
    "stg_events_clean": lambda w: w.events,
    "dim_user": lambda w: w.dim_user,
    "dim_date": lambda w: w.dim_date,
    "dim_order_status": lambda w: w.dim_order_status,
    "dim_event_name": lambda w: w.dim_event_name,
    "dim_event_name_next_build": _event_names_next_build,
    "fact_orders": lambda w: w.fact_orders,
    "fact_events": lambda w: w.fact_events,
    "label_orders": lambda w: w.orders_labelled,
    "label_events": lambda w: w.events_labelled,
    # marts (rows 11-19)
    "daily_orders_refunds": lambda w: marts.daily_orders_refunds(w.orders_labelled),
    "step_daily": lambda w: marts.step_daily(w.events_labelled),
    "funnel_daily": lambda w: marts.funnel_daily(w.events_labelled),
    "conv_daily": lambda w: marts.conv_daily(w.events_labelled),
    "first_purchase": lambda w: marts.first_purchase(w.orders_labelled),
    "d7_purchase_retention": lambda w: marts.d7_purchase_retention(w.orders_labelled),
    "date_spine": lambda w: marts.date_spine(w.orders_labelled, w.events_labelled),
    "marts_kpi_daily": lambda w: marts.marts_kpi_daily(w.orders_labelled, w.events_labelled),
    "marts_kpi_daily_naive": lambda w: marts.marts_kpi_daily_stacked(w.orders_labelled, w.events_labelled),
    "marts_kpi_daily_refreshed": _kpi_refreshed,
    "marts_segments": lambda w: marts.marts_segments(w.orders_labelled, w.dim_user),
    # analyses (rows 20-27)
    "rr_before_after": lambda w: analysis.rr_before_after(w.orders_labelled, P.release, P.rr_range),
    "rr_segment_ab": _segment_ab,
    "checkout_funnel_before_after": lambda w: analysis.checkout_funnel_before_after(
        w.events_labelled, w.dim_user, P.release
    ),
    "d7_retention_cohorts": lambda w: analysis.d7_retention_cohorts(
        w.users, w.events_labelled, P.d7_cohorts, P.d7_window_days
    ),
    "d7_retention_rolling": _rolling_retention,
    "first_refunds": lambda w: analysis.first_refunds(
        w.orders_labelled, w.events_labelled, P.release, P.quick_refund_window_days
    ),
    "quick_refund_share": lambda w: analysis.quick_refund_share(
        w.orders_labelled, w.events_labelled, P.release, P.quick_refund_window_days, P.quick_refund_hours
    ),
    "rr_by_registration_cohort": lambda w: analysis.rr_by_registration_cohort(
        w.users, w.events_labelled, P.rr_cohort_pre, P.rr_cohort_post, P.rr_cohort_window_days
    ),
    "cart_dropoff": lambda w: analysis.cart_dropoff(w.events_labelled, w.dim_user, P.release),
    "rr_ztest": lambda w: analysis.rr_ztest(_segment_ab(w)).withColumn("p_value", F.round("p_value", 10)),
    # text (rows 28-35)
    "load_comments": lambda w: text.comments_in_range(w.comments_raw, P.comment_range),
    "load_comments_csv": _load_comments_csv,
    "load_comments_rejected": _rejected_comments,
    "clean_text": lambda w: text.clean_text(_comments(w)),
    # weights and p-values are compared to 10 decimals: last bits depend on summation order
    "tfidf": lambda w: text.tfidf(_comments(w), C.TFIDF_MAX_FEATURES).withColumn("weight", F.round("weight", 10)),
    "kmeans_elbow": lambda w: text.kmeans_elbow(_clusters(w)[1], C.KMEANS_K_RANGE, C.KMEANS_SEED),
    "kmeans_assign": lambda w: _assigned(w).select("comment_id", "cluster"),
    "silhouette": lambda w: text.silhouette(_assigned(w)),
    "cluster_top_terms": lambda w: _top_terms(w),
    "cluster_examples": _examples,
    "kmeans_checks": _kmeans_checks,
    # checks and dashboard tiles (rows 36-40)
    "key_violations": _key_violations,
    "kpi_totals": lambda w: quality.kpi_totals(w.orders_labelled, w.events_labelled, P.kpi_range),
    "rr_by_device": lambda w: analysis.rr_by_dimension(w.orders_labelled, w.users, "device", P.release),
    "rr_by_region": lambda w: analysis.rr_by_dimension(w.orders_labelled, w.users, "region", P.release),
    "rr_by_channel": lambda w: analysis.rr_by_dimension(w.orders_labelled, w.users, "channel", P.release),
    "funnel_by_month": lambda w: analysis.funnel_by_month(w.events_labelled),
    "funnel_month_change": _two_months,
    "top_rr_growth": lambda w: analysis.top_rr_growth(_segment_ab(w), P.top_n),
}

# Queries that need the raw tables (not available on a layer-backed warehouse).
RAW_ONLY = ("key_violations", "funnel_month_change")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _wl(f) for name, f in RUNNERS.items()}
QUERIES["clean_text_with_lexicon"] = _clean_text_with_lexicon
# rows 33-35 over a given grouping (the documents' source)
QUERIES["silhouette_by_source"] = _silhouette_by_source
QUERIES["silhouette_euclidean_by_source"] = _silhouette_euclidean_by_source
QUERIES["cluster_top_terms_by_source"] = _top_terms_by_source
QUERIES["cluster_examples_by_source"] = _examples_by_source


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
