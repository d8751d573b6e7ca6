"""Release analyses (rows 20-27).

Inputs: labelled orders (``status_group``, ``st``), labelled events (``ev``),
clean users.  Each analysis is a few conditional aggregations; segment or cohort
pivots are computed in the same pass as the counts (``sum(when(period = p))``),
which keeps the NULL-versus-0 behaviour of MAX(CASE ...) pivots: a period with
no rows gives NULL, a period with rows but no paid orders gives 0.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.labels import channel_group, date_lit, day_range, flag, period, ts_lit
from ..functions.stats import dbl, pct, two_proportion_ztest
from .asof import asof_forward_min
from .ranges import interval_join

SEGMENT = ("device", "region", "channel")
PERIODS = ("before", "after")


def _rate_pct(refunds: Column, orders: Column) -> Column:
    """ROUND(100 * refunds / orders, 2) when orders > 0, else NULL."""
    return F.when(orders > 0, pct(refunds, orders))


def rr_before_after(labelled_orders: DataFrame, release: dt.date = C.RELEASE_DATE, rng: tuple = C.RR_RANGE) -> DataFrame:
    """Row 20: one row with orders, refunds and return rate % before and after
    the release, and the relative change % of the (rounded) rates.

    The study range compares the order timestamp with two dates, so the last
    day only counts at midnight (as the original does)."""
    lo, hi = rng
    o = labelled_orders.where(
        (F.col("order_date") >= ts_lit(lo))
        & (F.col("order_date") <= ts_lit(hi))
        & F.col("status_group").isin("paid", "refund")
    ).select(
        period(F.to_date("order_date"), release).alias("period"),
        flag(F.col("status_group") == "paid").alias("is_order"),
        flag(F.col("status_group") == "refund").alias("is_refund"),
    )
    aggs = []
    for p in PERIODS:
        aggs += [
            F.sum(F.when(F.col("period") == p, F.col("is_order"))).alias(f"orders_{p}"),
            F.sum(F.when(F.col("period") == p, F.col("is_refund"))).alias(f"refunds_{p}"),
        ]
    a = o.agg(*aggs)
    rb = _rate_pct(F.col("refunds_before"), F.col("orders_before"))
    ra = _rate_pct(F.col("refunds_after"), F.col("orders_after"))
    return a.select(
        "orders_before",
        "refunds_before",
        rb.alias("return_rate_before"),
        "orders_after",
        "refunds_after",
        ra.alias("return_rate_after"),
        F.when(rb.isNull() | (rb == 0), F.lit(None).cast("double"))
        .otherwise(F.round((ra / rb - F.lit(1.0)) * F.lit(100.0), 2))
        .alias("return_rate_pct_change_after_vs_before"),
    )


def _segment_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    aggs = []
    for p in PERIODS:
        aggs += [
            F.sum(F.when(F.col("period") == p, F.col("is_order"))).cast("long").alias(f"orders_{p}"),
            F.sum(F.when(F.col("period") == p, F.col("is_refund"))).cast("long").alias(f"refunds_{p}"),
        ]
    return rows.groupBy(*keys).agg(*aggs)


def ab_rows(
    labelled_orders: DataFrame, users: DataFrame, release: dt.date = C.RELEASE_DATE, days: int = C.AB_WINDOW_DAYS
) -> DataFrame:
    """Per (user, period) of orders of known users within release +- days (by
    calendar day, inclusive): the number of order rows, paid orders and
    refund orders, with the user's segment.

    Orders are summed per (user, period) before the user join: the segment is
    a function of the user, so the sums per segment are unchanged, and the
    join meets at most two rows per user however many orders a user has."""
    d = F.to_date("order_date")
    o = labelled_orders.where(
        day_range("order_date", release - dt.timedelta(days=days), release + dt.timedelta(days=days))
    )
    per_user = o.groupBy("user_id", period(d, release).alias("period")).agg(
        F.sum(flag(F.col("status_group") == "paid")).alias("is_order"),
        F.sum(flag(F.col("status_group") == "refund")).alias("is_refund"),
    )
    return per_user.join(users.select("user_id", *SEGMENT), "user_id", "inner")


def _rates(df: DataFrame) -> list[Column]:
    ob, rb, oa, ra = (F.col(c) for c in ("orders_before", "refunds_before", "orders_after", "refunds_after"))
    return [
        _rate_pct(rb, ob).alias("return_rate_percent_before"),
        _rate_pct(ra, oa).alias("return_rate_percent_after"),
        F.when(
            (ob > 0) & (oa > 0),
            F.round(F.lit(100.0) * dbl(ra) / dbl(oa) - F.lit(100.0) * dbl(rb) / dbl(ob), 2),
        ).alias("delta_pp"),
    ]


def rr_segment_ab(
    labelled_orders: DataFrame, users: DataFrame, release: dt.date = C.RELEASE_DATE, days: int = C.AB_WINDOW_DAYS
) -> DataFrame:
    """Row 21: per device x region x channel, orders, refunds and return rate %
    before / after the release, the change in points, and the channel group.
    One row per channel (the channel group is a label of it)."""
    agg = _segment_counts(ab_rows(labelled_orders, users, release, days), list(SEGMENT))
    return agg.select(
        *SEGMENT,
        channel_group("channel").alias("channel_group"),
        "orders_before",
        "refunds_before",
        "orders_after",
        "refunds_after",
        *_rates(agg),
    )


def rr_by_dimension(
    labelled_orders: DataFrame,
    users: DataFrame,
    dim: str,
    release: dt.date = C.RELEASE_DATE,
    days: int = C.AB_WINDOW_DAYS,
) -> DataFrame:
    """Row 38: return rate % before / after and the change in points by one of
    device, region or channel (the dashboard's bar chart and table)."""
    agg = _segment_counts(ab_rows(labelled_orders, users, release, days), [dim])
    return agg.select(dim, "orders_before", "refunds_before", "orders_after", "refunds_after", *_rates(agg))


def top_rr_growth(segment_ab: DataFrame, n: int = 10) -> DataFrame:
    """Row 40: the n segments with the largest change in points (a top-k
    report; ties broken by segment)."""
    order = [F.col("delta_pp").desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in SEGMENT]
    return segment_ab.orderBy(*order).limit(n)


def rr_ztest(segment_ab: DataFrame, z_crit: float = C.Z_95) -> DataFrame:
    """Row 27: per segment, pooled two-proportion z statistic (before - after),
    two-sided p-value, change in points (after - before) and the unpooled 95%
    Wald interval in points.  NULL where a base is 0 / NULL or a variance is
    not positive."""
    t = two_proportion_ztest("refunds_before", "orders_before", "refunds_after", "orders_after", z_crit)
    return segment_ab.select(*SEGMENT, "channel_group", *[col.alias(name) for name, col in t.items()])


def _user_period_steps(labelled_events: DataFrame, users: DataFrame, release: dt.date, steps) -> DataFrame:
    """Step flags per (user, segment, period).  Flags are taken per (user,
    period) before the user join (the segment is a function of the user), so
    the join sees at most two rows per user."""
    cart, checkout, payment, refund = steps
    ev = F.col("ev")
    flags = (
        labelled_events.where(ev.isin(*steps))
        .groupBy("user_id", period("event_date", release).alias("period"))
        .agg(
            F.max(flag(ev == cart)).alias("s1_cart"),
            F.max(flag(ev == checkout)).alias("s2_checkout"),
            F.max(flag(ev == payment)).alias("s3_payment"),
            F.max(flag(ev == refund)).alias("s4_refund"),
        )
    )
    return flags.join(users.select("user_id", *SEGMENT), "user_id", "inner")


FUNNEL_METRICS = (
    ("conv_cart_to_checkout_pct", "s2_checkout", "s1_cart"),
    ("conv_checkout_to_payment_pct", "s3_payment", "s2_checkout"),
    ("refund_after_payment_pct", "s4_refund", "s3_payment"),
)


def checkout_funnel_before_after(
    labelled_events: DataFrame, users: DataFrame, release: dt.date = C.RELEASE_DATE, steps=C.FUNNEL_STEPS
) -> DataFrame:
    """Row 22: per segment and metric, the funnel conversion % before and after
    the release and the difference in points.  Flags are presence per
    user-period (not sequential), so a rate may exceed 100."""
    u = _user_period_steps(labelled_events, users, release, steps)

    def users_with(p, s):
        return F.count(F.when((F.col("period") == p) & (F.col(s) == 1), F.lit(1)))

    m = u.groupBy(*SEGMENT).agg(
        *[pct(users_with(p, num), users_with(p, den)).alias(f"{name}__{p}") for name, num, den in FUNNEL_METRICS for p in PERIODS]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.col(f"{name}__before").alias("before"),
                F.col(f"{name}__after").alias("after"),
            )
            for name, _, _ in FUNNEL_METRICS
        ]
    )
    long = m.select(*SEGMENT, F.inline(rows))
    return long.select(*SEGMENT, "metric", "before", "after", F.round(F.col("after") - F.col("before"), 2).alias("diff"))


def funnel_by_month(labelled_events: DataFrame, months: list[dt.date] | None = None, steps=C.FUNNEL_STEPS) -> DataFrame:
    """Row 39: the three funnel % per calendar month (the dashboard's month
    comparison), on distinct users with each step in the month."""
    cart, checkout, payment, refund = steps
    ev = F.col("ev")
    e = labelled_events.where(ev.isin(*steps))
    if months:
        starts = sorted({m.replace(day=1) for m in months})
        e = e.where(reduce(lambda a, b: a | b, [day_range("event_date", m, _month_end(m)) for m in starts]))
    e = e.withColumn("month", F.trunc(F.to_date("event_date"), "month"))
    u = e.groupBy("user_id", "month").agg(
        F.max(flag(ev == cart)).alias("s1_cart"),
        F.max(flag(ev == checkout)).alias("s2_checkout"),
        F.max(flag(ev == payment)).alias("s3_payment"),
        F.max(flag(ev == refund)).alias("s4_refund"),
    )
    return u.groupBy("month").agg(
        *[pct(F.sum(num), F.sum(den)).alias(name) for name, num, den in FUNNEL_METRICS]
    )


def funnel_month_change(
    labelled_events: DataFrame, before: dt.date, after: dt.date, steps=C.FUNNEL_STEPS
) -> DataFrame:
    """Row 39 as the dashboard shows it: per funnel %, its value in the month
    of ``before``, in the month of ``after``, and the difference in points.  A
    month without funnel events gives NULL."""
    months = {"before": before.replace(day=1), "after": after.replace(day=1)}
    by_month = funnel_by_month(labelled_events, list(months.values()), steps)
    names = [name for name, _, _ in FUNNEL_METRICS]
    one = by_month.agg(
        *[F.max(F.when(F.col("month") == F.lit(m), F.col(n))).alias(f"{n}__{side}") for n in names for side, m in months.items()]
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(f"{n}__before").alias("before"), F.col(f"{n}__after").alias("after")) for n in names]
    )
    return one.select(F.inline(rows)).withColumn("diff", F.round(F.col("after") - F.col("before"), 2))


def _month_end(m: dt.date) -> dt.date:
    nxt = m.replace(year=m.year + 1, month=1) if m.month == 12 else m.replace(month=m.month + 1)
    return nxt - dt.timedelta(days=1)


def _cohort_frame(spark, cohorts) -> DataFrame:
    rows = [(name, start, end) for name, start, end in cohorts]
    return spark.createDataFrame(rows, "cohort string, start_date date, end_date date")


def retention_by_cohort(
    users: DataFrame,
    labelled_events: DataFrame,
    cohorts: DataFrame,
    days: int = C.D7_WINDOW_DAYS,
    steps=C.FUNNEL_STEPS,
    mode: str = "within",
) -> DataFrame:
    """Row 23 for any number of cohorts, also overlapping ones: (cohort,
    new_users_count, retained_users_count, d7_retention) of the cohorts
    (cohort, start_date, end_date; NULL: open) with a user.

    Whether a user is retained does not depend on the cohort, so it is found
    once per user; users then meet their cohorts by buckets of days
    (``ranges.interval_join``).  Events are first reduced to distinct (user,
    day), which bounds a hot user to one row per day."""
    u = users.select("user_id", F.col("reg_date").cast("date").alias("reg_date")).where("reg_date IS NOT NULL")
    days_active = (
        labelled_events.where(F.col("ev").isin(*steps))
        .select(F.col("user_id").alias("_user"), F.to_date("event_date").alias("event_day"))
        .distinct()
    )
    at, reg = F.col("event_day"), F.col("reg_date")
    hit = (at == F.date_add(reg, days)) if mode == "exact_day" else (at >= reg) & (at < F.date_add(reg, days))
    joined = u.join(days_active, (F.col("user_id") == F.col("_user")) & hit, "left")
    per_user = joined.groupBy("user_id", "reg_date").agg(F.max(flag(at.isNotNull())).alias("retained"))
    members = interval_join(per_user, cohorts.select("cohort", "start_date", "end_date"), "reg_date", "start_date", "end_date")
    # distinct users of a cohort, like the retained ones
    per_member = members.groupBy("cohort", "user_id").agg(F.max("retained").alias("retained"))
    return (
        per_member.groupBy("cohort")
        .agg(
            F.count("user_id").alias("new_users_count"),
            F.sum(F.when(F.col("user_id").isNotNull(), F.col("retained")).otherwise(0)).alias("retained_users_count"),
        )
        .withColumn(
            "d7_retention",
            F.when(F.col("new_users_count") == 0, F.lit(0.0)).otherwise(pct("retained_users_count", "new_users_count")),
        )
    )


def d7_retention_cohorts(
    users: DataFrame,
    labelled_events: DataFrame,
    cohorts=C.D7_COHORTS,
    days: int = C.D7_WINDOW_DAYS,
    steps=C.FUNNEL_STEPS,
    mode: str = "within",
) -> DataFrame:
    """Row 23: per registration cohort, new users, users with any funnel event
    in [reg_date, reg_date + days), retention %; and the relative change of the
    first cohort against the second.  ``mode="exact_day"`` counts only events
    on the day reg_date + days (the wording of the original's description;
    its code, the default, counts the whole window)."""
    agg = retention_by_cohort(users, labelled_events, _cohort_frame(users.sparkSession, cohorts), days, steps, mode)
    names = [name for name, _, _ in cohorts]
    cols = []
    for name in names:
        for m in ("new_users_count", "retained_users_count", "d7_retention"):
            cols.append(F.max(F.when(F.col("cohort") == name, F.col(m))).alias(f"{name}_{m}"))
    wide = agg.agg(*cols)
    cur, base = (F.coalesce(F.col(f"{n}_d7_retention"), F.lit(0.0)) for n in names[:2])
    return wide.withColumn(
        "delta_d7_retention",
        F.round(F.lit(100.0) * (cur - base) / F.nullif(base, F.lit(0.0)), 2),
    )


def first_refunds(
    labelled_orders: DataFrame,
    labelled_events: DataFrame,
    release: dt.date = C.RELEASE_DATE,
    days: int = C.QUICK_REFUND_WINDOW_DAYS,
    paid=C.PAID_STATUSES,
    refund_events=C.REFUND_EVENT_NAMES,
) -> DataFrame:
    """Row 24, per order: paid orders in [release, release + days) with the
    first refund event of the same user at or after the order (forward as-of;
    refund events cut to the same window), NULL when there is none."""
    lo = ts_lit(release)
    hi = ts_lit(release + dt.timedelta(days=days))
    orders = labelled_orders.where(
        F.col("st").isin(*paid) & (F.col("order_date") >= lo) & (F.col("order_date") < hi)
    ).select("order_id", "user_id", "order_date")
    refunds = labelled_events.where(
        F.col("ev").isin(*refund_events) & (F.col("event_date") >= lo) & (F.col("event_date") < hi)
    ).select("user_id", F.col("event_date").alias("refund_ts"))
    return asof_forward_min(orders, refunds, "user_id", "order_date", "refund_ts", "refund_ts")


def quick_refund_share(
    labelled_orders: DataFrame,
    labelled_events: DataFrame,
    release: dt.date = C.RELEASE_DATE,
    days: int = C.QUICK_REFUND_WINDOW_DAYS,
    hours: int = C.QUICK_REFUND_HOURS,
    paid=C.PAID_STATUSES,
    refund_events=C.REFUND_EVENT_NAMES,
) -> DataFrame:
    """Row 24: refunded orders among the paid orders of [release, release +
    days), those refunded within ``hours``, and their share %.  One refund may
    serve several orders."""
    first = first_refunds(labelled_orders, labelled_events, release, days, paid, refund_events)
    return quick_refund_summary(first, hours)


def quick_refund_summary(first_refunds: DataFrame, hours: int = C.QUICK_REFUND_HOURS) -> DataFrame:
    refunded = F.col("refund_ts").isNotNull()
    quick = refunded & (F.col("refund_ts") <= F.col("order_date") + F.make_dt_interval(hours=F.lit(hours)))
    a = first_refunds.agg(
        F.count(F.when(refunded, F.lit(1))).alias("total_refunded_orders"),
        F.count(F.when(quick, F.lit(1))).alias("refunded_within_24h"),
    )
    return a.withColumn(
        "share_quick_refunds",
        F.round(
            F.when(
                F.col("total_refunded_orders") > 0,
                F.lit(100.0) * dbl("refunded_within_24h") / dbl("total_refunded_orders"),
            ).otherwise(F.lit(0.0)),
            2,
        ),
    )


def rr_by_registration_cohort(
    users: DataFrame,
    labelled_events: DataFrame,
    pre: tuple = C.RR_COHORT_PRE,
    post: tuple = C.RR_COHORT_POST,
    days: int = C.RR_COHORT_WINDOW_DAYS,
    refund_label: str = "refund",
) -> DataFrame:
    """Row 25: users of the pre and post registration cohorts, those with a
    refund event within ``days`` of registration, refund rate % and its relative
    change (NULL when the pre rate is 0).  Refund events are matched by label,
    never by a numeric id."""

    def within(c, rng):
        start, end = rng
        cond = c >= date_lit(start)
        return cond & (c < date_lit(end)) if end is not None else cond

    reg = F.col("reg_date").cast("date")
    cu = (
        users.select(
            "user_id",
            reg.alias("reg_date"),
            F.when(within(reg, pre), F.lit("pre")).when(within(reg, post), F.lit("post")).alias("cohort"),
        )
        .where(F.col("cohort").isNotNull())
        .distinct()
    )
    refund_days = (
        labelled_events.where(F.col("ev") == refund_label)
        .select("user_id", F.to_date("event_date").alias("event_day"))
        .distinct()
    )
    hit = cu.join(
        refund_days,
        (cu.user_id == refund_days.user_id)
        & (refund_days.event_day >= cu.reg_date)
        & (refund_days.event_day < F.date_add(cu.reg_date, days)),
        "left",
    ).select(cu.user_id, cu.reg_date, cu.cohort, refund_days.event_day.isNotNull().alias("hit"))
    per_user = hit.groupBy("user_id", "reg_date", "cohort").agg(F.max(flag(F.col("hit"))).alias("refunded"))
    cols = []
    for name in ("pre", "post"):
        in_c = F.col("cohort") == name
        cols += [
            F.count(F.when(in_c, F.lit(1))).alias(f"{name}_users"),
            F.count(F.when(in_c & (F.col("refunded") == 1), F.lit(1))).alias(f"{name}_refunded_users"),
        ]
    a = per_user.agg(*cols)

    def share(name):
        return F.coalesce(dbl(f"{name}_refunded_users") / F.nullif(dbl(f"{name}_users"), F.lit(0.0)), F.lit(0.0))

    return a.select(
        "pre_users",
        "pre_refunded_users",
        F.round(F.lit(100.0) * share("pre"), 2).alias("pre_rr"),
        "post_users",
        "post_refunded_users",
        F.round(F.lit(100.0) * share("post"), 2).alias("post_rr"),
        F.round(F.lit(100.0) * (share("post") / F.nullif(share("pre"), F.lit(0.0)) - F.lit(1.0)), 2).alias("delta_rr"),
    )


def cart_dropoff(
    labelled_events: DataFrame,
    users: DataFrame,
    release: dt.date = C.RELEASE_DATE,
    cart_step: str = "add_to_cart",
    pay_step: str = "payment_success",
    keep_zero: bool = False,
) -> DataFrame:
    """Row 26: per period x segment, users who added to cart, those without a
    payment in the same period and segment (anti join), and the rate %.
    Segments with no drop-off, and NULL segment keys, do not appear (inner
    equality join of the two counts) unless ``keep_zero``."""
    keys = ["period", *SEGMENT]
    # one scan: per (user, period) did they add to cart, did they pay; the user
    # join then meets at most one row per user and period
    per_user = (
        labelled_events.where(F.col("ev").isin(cart_step, pay_step))
        .groupBy("user_id", period("event_date", release).alias("period"))
        .agg(*(F.max((F.col("ev") == s).cast("int")).alias(n) for s, n in ((cart_step, "_cart"), (pay_step, "_paid"))))
        .where(F.col("_cart") == 1)
    )
    j = (
        per_user.join(users.select("user_id", *SEGMENT), "user_id", "inner")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("users_added_to_cart"), F.sum(1 - F.col("_paid")).alias("users_dropoff"))
    )
    if not keep_zero:
        j = j.where(F.col("users_dropoff") > 0).na.drop(subset=keys)
    return j.select(
        *keys,
        "users_dropoff",
        "users_added_to_cart",
        pct("users_dropoff", "users_added_to_cart").alias("dropoff_rate_from_cart"),
    )
