"""Web-session features joined to orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import clip_lower, cut_bins
from tallyloom.functions.time import date_parts, is_holiday, is_weekend, micros, seconds_of_day_gap
from tallyloom.operators.prep import fit_quantile_bins, quantile_bin
from tallyloom.operators.rows import combo_flag

SESSION = "sessionkey_id"
# Page types of the help section.
HELP_PAGES = [10, 11, 12, 13]


def web_session_stats(pages: DataFrame) -> DataFrame:
    """Dwell, pages, goods and prices per session; dwell floored at 0, missing statistics as 0."""
    dwell = clip_lower(F.col("pageview_duration_sec"), 0.0)

    def known(x: Column) -> Column:
        return F.coalesce(x, F.lit(0.0))

    return pages.groupBy(SESSION).agg(
        known(F.sum(dwell)).alias("duration"),
        F.count("pageview_number").alias("num_pages"),
        known(F.avg(dwell)).alias("page_time_avg"),
        known(F.stddev_samp(dwell)).alias("page_time_std"),
        F.count("good_id").alias("num_goods"),
        known(F.avg("price")).alias("avg_price"),
        known(F.stddev_samp("price")).alias("std_price"),
    )


def web_session_entropy(pages: DataFrame) -> DataFrame:
    """Natural-log entropy of a session's page types, from counts alone."""
    counts = pages.where(F.col("page_type").isNotNull()).groupBy(SESSION, "page_type").agg(F.count(F.lit(1)).alias("c"))
    total = F.sum("c")
    return counts.groupBy(SESSION).agg(
        (F.log(total) - F.sum(F.col("c") * F.log(F.col("c"))) / total).alias("session_page_entropy")
    )


def max_help_dwell(pages: DataFrame) -> DataFrame:
    """Longest stay on a help page, floored at 0; sessions without help pages are absent."""
    return (
        pages.where(F.col("page_type").isin(HELP_PAGES))
        .groupBy(SESSION)
        .agg(clip_lower(F.max("pageview_duration_sec"), 0.0).alias("max_help_dwell_sec"))
    )


def session_ends(pages: DataFrame) -> DataFrame:
    """Largest page number, page number of the last view, first and last instant."""
    place = F.struct("date_time", "event_id")
    return pages.groupBy(SESSION).agg(
        F.max("pageview_number").alias("max_pageview_number"),
        F.max_by("pageview_number", F.when(F.col("pageview_number").isNotNull(), place)).alias("last_pageview_number"),
        F.min("date_time").alias("start_time"),
        F.max("date_time").alias("end_time"),
    )


def pages_after_order(pages: DataFrame) -> DataFrame:
    gap = F.col("max_pageview_number") - F.col("last_pageview_number")
    return session_ends(pages).select(SESSION, clip_lower(gap, 0).alias("pages_after_order"))


def order_gap_minutes(created: Column, last: Column) -> Column:
    return (micros(created) - micros(last)) / 60_000_000


def order_session_gap(orders: DataFrame, pages: DataFrame) -> DataFrame:
    """Minutes from the session's last view to the order; null without a session."""
    joined = orders.join(session_ends(pages).select(SESSION, "end_time"), SESSION, "left")
    return joined.withColumn("order_vs_session_gap_min", order_gap_minutes(F.col("create_time"), F.col("end_time"))).drop("end_time")


def goods_stats(pages: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean price seen in the log per product, with the mean rating of its orders; missing as 0."""
    seen = pages.where(F.col("good_id").isNotNull()).groupBy("good_id").agg(F.avg("price").alias("good_avg_price"))
    rated = orders.groupBy("good_id").agg(
        F.avg("rating_value").alias("rating_value"), F.avg("rating_count").alias("rating_count")
    )
    return seen.join(rated, "good_id", "left").na.fill(0.0, ["good_avg_price", "rating_value", "rating_count"])


def multi_hot(pages: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Per session a 0/1 column for each value seen."""
    return pages.groupBy(SESSION).agg(
        *[F.coalesce(F.max((F.col(column) == v).cast("int")), F.lit(0)).alias(f"{column}_{v}") for v in values]
    )


def order_time_features(orders: DataFrame, pages: DataFrame) -> DataFrame:
    """Seconds from session start and to session end (whole days dropped), hour and weekend flag."""
    ends = session_ends(pages).select(SESSION, "start_time", "end_time")
    joined = orders.select("order_id", SESSION, "create_time").join(ends, SESSION, "left")
    made = F.col("create_time")
    return joined.select(
        "order_id",
        F.coalesce(seconds_of_day_gap(made, F.col("start_time")), F.lit(0)).alias("sec_before_order"),
        F.coalesce(seconds_of_day_gap(F.col("end_time"), made), F.lit(0)).alias("sec_after_order"),
        F.hour(made).alias("hour"),
        is_weekend(made).alias("is_weekend"),
    )


def fit_time_bins(times: DataFrame, bins: int = 6) -> dict[str, list[float]]:
    return {c: fit_quantile_bins(times, c, bins) for c in ("sec_before_order", "sec_after_order")}


def time_one_hot(times: DataFrame, edges: dict[str, list[float]], hours: Sequence[int]) -> DataFrame:
    """One-hot quantile bins of the two gaps, one-hot hour, weekend flag."""
    cols = []
    for c, inner in edges.items():
        bin_no = quantile_bin(F.col(c), inner)
        cols += [(bin_no == i).cast("int").alias(f"{c}_{i}") for i in range(1, len(inner) + 2)]
    cols += [(F.col("hour") == h).cast("int").alias(f"hour_{h}") for h in hours]
    return times.select("order_id", *cols, "is_weekend")


def enrich_orders(
    orders: DataFrame, pages: DataFrame, page_types: Sequence[int], edges: dict[str, list[float]], hours: Sequence[int]
) -> DataFrame:
    """Order rows with page flags, time features, session and product statistics; missing as 0."""
    out = (
        orders.select("order_id", SESSION, "good_id")
        .join(multi_hot(pages, "page_type", page_types), SESSION, "left")
        .join(time_one_hot(order_time_features(orders, pages), edges, hours), "order_id", "left")
        .join(web_session_stats(pages), SESSION, "left")
        .join(goods_stats(pages, orders), "good_id", "left")
    )
    return out.drop(SESSION, "good_id").na.fill(0)


# Interval edges and labels of the order features.
GAP_BINS = ([-1e6, 0, 5, 30, 60, 300, 1e6], ["<=0", "0-5", "5-30", "30-60", "60-300", "300+"])
PRICE_BINS = ([0, 500, 2000, 10000, 1e6], ["<500", "500-2k", "2k-10k", "10k+"])
QTY_BINS = ([0, 1, 3, 10, 100], ["1", "2-3", "4-10", "10+"])
PAGES_BINS = ([-1, 0, 5, 10, 30, 1000], ["0", "1-5", "6-10", "11-30", "30+"])
RATING_BINS = ([-1, 0, 5, 20, 1000], ["0", "1-5", "6-20", "20+"])
MISSING_GAP = 9999


def order_feature_table(orders: DataFrame, pages: DataFrame) -> DataFrame:
    """The 18 order features (with the order id), before imputation."""
    sessions = (
        session_ends(pages)
        .join(
            pages.groupBy(SESSION).agg(
                F.sum("pageview_duration_sec").alias("session_duration_sec"),
                F.count("page_type").alias("session_total_pages"),
                F.stddev_samp("pageview_duration_sec").alias("session_dwell_std"),
            ),
            SESSION,
        )
        .join(web_session_entropy(pages), SESSION, "left")
        .join(max_help_dwell(pages), SESSION, "left")
    )
    made = F.col("create_time")
    df = orders.join(sessions, SESSION, "left").withColumns(
        {
            "__after": clip_lower(F.col("max_pageview_number") - F.col("last_pageview_number"), 0),
            "__gap": F.coalesce(order_gap_minutes(made, F.col("end_time")), F.lit(float(MISSING_GAP))),
        }
    )
    gap = cut_bins(F.col("__gap"), *GAP_BINS)
    no_pages = cut_bins(F.col("__after"), *PAGES_BINS) == "0"
    return df.select(
        "order_id",
        *[c.alias(n) for n, c in date_parts(made, "order_").items()],
        is_holiday(made).alias("is_holiday"),
        "session_duration_sec",
        "session_total_pages",
        F.try_divide("session_duration_sec", "session_total_pages").alias("session_speed_sec_per_page"),
        *[combo_flag(F.col("utm_medium") == m, gap == "5-30").alias(f"combo_utm{m}_gap5_30") for m in (4, 5, 1)],
        combo_flag(F.col("root_id") == 1504, no_pages).alias("combo_root1504_no_after"),
        combo_flag(cut_bins(F.col("price"), *PRICE_BINS) == "10k+", cut_bins(F.col("goods_qty"), *QTY_BINS).isin("2-3", "10+")).alias("combo_price10k_bulk"),
        combo_flag(cut_bins(F.col("rating_count"), *RATING_BINS) == "0", no_pages).alias("combo_no_reviews_no_pages"),
        "session_page_entropy",
        "session_dwell_std",
        "max_help_dwell_sec",
    )
