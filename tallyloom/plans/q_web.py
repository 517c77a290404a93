"""Queries over web sessions and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import prep, web
from tallyloom.plans.registry import query

DWELL = "CASE WHEN pageview_duration_sec < 0 THEN 0.0 ELSE pageview_duration_sec END"
STATS = f"""stats AS (SELECT sessionkey_id, coalesce(sum({DWELL}), 0.0) AS duration, count(pageview_number) AS num_pages, coalesce(avg({DWELL}), 0.0) AS page_time_avg,
 coalesce(stddev_samp({DWELL}), 0.0) AS page_time_std, count(good_id) AS num_goods, coalesce(avg(price), 0.0) AS avg_price, coalesce(stddev_samp(price), 0.0) AS std_price
 FROM pageviews GROUP BY sessionkey_id)"""
STATS_DOUBLES = ["duration", "page_time_avg", "page_time_std", "avg_price", "std_price"]


@query("web_session_stats", f"WITH {STATS} SELECT * FROM stats", rounds=STATS_DOUBLES, uses="pageviews")
def _(t):
    return web.web_session_stats(t.pageviews)


ENTROPY = """ent AS (SELECT sessionkey_id, sum(-(c / n) * ln(c / n)) AS session_page_entropy FROM (SELECT sessionkey_id, page_type, count(*) AS c,
 sum(count(*)) OVER (PARTITION BY sessionkey_id) AS n FROM pageviews GROUP BY sessionkey_id, page_type) AS x GROUP BY sessionkey_id)"""


@query("web_session_entropy", f"WITH {ENTROPY} SELECT * FROM ent", rounds="session_page_entropy", uses="pageviews")
def _(t):
    return web.web_session_entropy(t.pageviews)


HELP = """help AS (SELECT sessionkey_id, CASE WHEN max(pageview_duration_sec) < 0 THEN 0.0 ELSE max(pageview_duration_sec) END AS max_help_dwell_sec
 FROM pageviews WHERE page_type IN (10, 11, 12, 13) GROUP BY sessionkey_id)"""


@query("max_help_dwell", f"WITH {HELP} SELECT * FROM help", rounds="max_help_dwell_sec", uses="pageviews")
def _(t):
    return web.max_help_dwell(t.pageviews)


ENDS = """ends AS (SELECT sessionkey_id, max(pageview_number) AS mx, arg_max(pageview_number, (date_time, event_id)) AS ls, min(date_time) AS st, max(date_time) AS en
 FROM pageviews GROUP BY sessionkey_id)"""


@query("pages_after_order", f"WITH {ENDS} SELECT sessionkey_id, CASE WHEN mx - ls < 0 THEN 0 ELSE mx - ls END AS pages_after_order FROM ends", uses="pageviews")
def _(t):
    return web.pages_after_order(t.pageviews)


@query("order_session_gap", f"WITH {ENDS} SELECT order_id, (epoch_us(create_time) - epoch_us(en)) / 60000000 AS gap FROM shop_orders LEFT JOIN ends USING (sessionkey_id)",
       rounds="gap", digits=9, uses="pageviews shop_orders")
def _(t):
    return web.order_session_gap(t.shop_orders, t.pageviews).select("order_id", F.col("order_vs_session_gap_min").alias("gap"))


@query("join_index_to_key", f"WITH {STATS} SELECT order_id, num_pages, num_goods FROM shop_orders LEFT JOIN stats USING (sessionkey_id)", uses="pageviews shop_orders")
def _(t):
    return t.shop_orders.join(web.web_session_stats(t.pageviews), "sessionkey_id", "left").select("order_id", "num_pages", "num_goods")


GOODS = """goods AS (SELECT good_id, coalesce(good_avg_price, 0.0) AS good_avg_price, coalesce(rating_value, 0.0) AS rating_value, coalesce(rating_count, 0.0) AS rating_count
 FROM (SELECT good_id, avg(price) AS good_avg_price FROM pageviews WHERE good_id IS NOT NULL GROUP BY good_id) AS p
 LEFT JOIN (SELECT good_id, avg(rating_value) AS rating_value, avg(rating_count) AS rating_count FROM shop_orders GROUP BY good_id) AS o USING (good_id))"""
GOODS_DOUBLES = ["good_avg_price", "rating_value", "rating_count"]


@query("goods_stats", f"WITH {GOODS} SELECT * FROM goods", rounds=GOODS_DOUBLES, uses="pageviews shop_orders")
def _(t):
    return web.goods_stats(t.pageviews, t.shop_orders)


TYPES = list(range(15))
HOT = "hot AS (SELECT sessionkey_id, " + ", ".join(f"max(CASE WHEN page_type = {v} THEN 1 ELSE 0 END) AS page_type_{v}" for v in TYPES) + " FROM pageviews GROUP BY sessionkey_id)"


@query("multi_hot_by_group", f"WITH {HOT} SELECT * FROM hot", uses="pageviews")
def _(t):
    return web.multi_hot(t.pageviews, "page_type", prep.categories(t.pageviews, "page_type"))


def wrap(a: str, b: str) -> str:
    return f"coalesce(((cast(floor((epoch_us({a}) - epoch_us({b})) / 1000000) AS bigint) % 86400) + 86400) % 86400, 0)"


TIMES = f"""times AS (SELECT order_id, {wrap('create_time', 'st')} AS sec_before_order, {wrap('en', 'create_time')} AS sec_after_order,
 cast(hour(create_time) AS int) AS hour, CASE WHEN isodow(create_time) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM shop_orders LEFT JOIN ends USING (sessionkey_id))"""


@query("order_time_features", f"WITH {ENDS}, {TIMES} SELECT * FROM times", uses="pageviews shop_orders")
def _(t):
    return web.order_time_features(t.shop_orders, t.pageviews)


EDGES = "edges AS (SELECT " + ", ".join(
    f"quantile_cont({c}, {i} / 6.0) AS {c}_e{i}" for c in ("sec_before_order", "sec_after_order") for i in range(1, 6)
) + " FROM times)"


def bin_sql(c: str) -> str:
    return "1" + "".join(f" + CASE WHEN {c} >= {c}_e{i} THEN 1 ELSE 0 END" for i in range(1, 6))


HOURS = list(range(24))
ONEHOT = "onehot AS (SELECT order_id, " + ", ".join(
    [f"CASE WHEN {bin_sql(c)} = {i} THEN 1 ELSE 0 END AS {c}_{i}" for c in ("sec_before_order", "sec_after_order") for i in range(1, 7)]
    + [f"CASE WHEN hour = {h} THEN 1 ELSE 0 END AS hour_{h}" for h in HOURS]
) + ", is_weekend FROM times, edges)"


@query("quantile_bins_onehot", f"WITH {ENDS}, {TIMES}, {EDGES}, {ONEHOT} SELECT * FROM onehot", uses="pageviews shop_orders")
def _(t):
    times = web.order_time_features(t.shop_orders, t.pageviews)
    return web.time_one_hot(times, web.fit_time_bins(times), prep.categories(times, "hour"))


@query("enrich_orders", f"""WITH {ENDS}, {TIMES}, {EDGES}, {ONEHOT}, {HOT}, {STATS}, {GOODS} SELECT o.order_id, {', '.join(f'coalesce(page_type_{v}, 0) AS page_type_{v}' for v in TYPES)},
 onehot.* EXCLUDE (order_id), {', '.join(f'coalesce({c}, 0) AS {c}' for c in ['duration', 'num_pages', 'page_time_avg', 'page_time_std', 'num_goods', 'avg_price', 'std_price'])},
 {', '.join(f'coalesce(goods.{c}, 0) AS {c}' for c in GOODS_DOUBLES)}
 FROM shop_orders o LEFT JOIN hot USING (sessionkey_id) LEFT JOIN onehot ON o.order_id = onehot.order_id LEFT JOIN stats USING (sessionkey_id) LEFT JOIN goods ON o.good_id = goods.good_id""",
       rounds=[*STATS_DOUBLES, *GOODS_DOUBLES], uses="pageviews shop_orders")
def _(t):
    orders, pages = t.shop_orders, t.pageviews
    times = web.order_time_features(orders, pages)
    return web.enrich_orders(orders, pages, prep.categories(pages, "page_type"), web.fit_time_bins(times), prep.categories(times, "hour"))


def cut_sql(x: str, bins) -> str:
    edges, labels = bins
    return "CASE " + " ".join(f"WHEN {x} > {a} AND {x} <= {b} THEN '{lab}'" for a, b, lab in zip(edges, edges[1:], labels)) + " END"


AFTER = "CASE WHEN mx - ls < 0 THEN 0 ELSE mx - ls END"
GAP = "coalesce((epoch_us(create_time) - epoch_us(en)) / 60000000, 9999.0)"


def flag(*conditions: str) -> str:
    return f"CASE WHEN {' AND '.join(conditions)} THEN 1 ELSE 0 END"


ORDER_DOUBLES = ["session_duration_sec", "session_speed_sec_per_page", "session_page_entropy", "session_dwell_std", "max_help_dwell_sec"]
ORDER_SQL = f"""WITH {ENDS}, {ENTROPY}, {HELP}, agg AS (SELECT sessionkey_id, sum(pageview_duration_sec) AS session_duration_sec, count(page_type) AS session_total_pages,
 stddev_samp(pageview_duration_sec) AS session_dwell_std FROM pageviews GROUP BY sessionkey_id)
 SELECT order_id, cast(hour(create_time) AS int) AS order_hour, cast(isodow(create_time) - 1 AS int) AS order_dow, cast(day(create_time) AS int) AS order_day,
 cast(month(create_time) AS int) AS order_month, cast(week(create_time) AS int) AS order_week,
 {flag("strftime(create_time, '%m-%d') IN ('01-01', '01-07', '05-01', '05-09', '06-12', '11-04')")} AS is_holiday,
 session_duration_sec, session_total_pages, session_duration_sec / session_total_pages AS session_speed_sec_per_page,
 {', '.join(f"{flag(f'utm_medium = {m}', cut_sql(GAP, web.GAP_BINS) + " = '5-30'")} AS combo_utm{m}_gap5_30" for m in (4, 5, 1))},
 {flag('root_id = 1504', cut_sql(AFTER, web.PAGES_BINS) + " = '0'")} AS combo_root1504_no_after,
 {flag(cut_sql('price', web.PRICE_BINS) + " = '10k+'", cut_sql('goods_qty', web.QTY_BINS) + " IN ('2-3', '10+')")} AS combo_price10k_bulk,
 {flag(cut_sql('rating_count', web.RATING_BINS) + " = '0'", cut_sql(AFTER, web.PAGES_BINS) + " = '0'")} AS combo_no_reviews_no_pages,
 session_page_entropy, session_dwell_std, max_help_dwell_sec
 FROM shop_orders LEFT JOIN ends USING (sessionkey_id) LEFT JOIN agg USING (sessionkey_id) LEFT JOIN ent USING (sessionkey_id) LEFT JOIN help USING (sessionkey_id)"""


@query("order_feature_table", ORDER_SQL, rounds=ORDER_DOUBLES, uses="pageviews shop_orders")
def _(t):
    return web.order_feature_table(t.shop_orders, t.pageviews)


@query("impute_mean_mode", f"""WITH f AS (SELECT order_id, session_duration_sec, session_dwell_std, CASE WHEN is_holiday = 1 THEN 'yes' WHEN order_dow < 3 THEN 'no' END AS holiday_text FROM ({ORDER_SQL}) AS o)
 SELECT order_id, coalesce(session_duration_sec, (SELECT avg(session_duration_sec) FROM f WHERE order_id % 10 < 7)) AS session_duration_sec,
 coalesce(session_dwell_std, (SELECT avg(session_dwell_std) FROM f WHERE order_id % 10 < 7)) AS session_dwell_std,
 coalesce(holiday_text, (SELECT holiday_text FROM f WHERE order_id % 10 < 7 AND holiday_text IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS holiday_text FROM f WHERE order_id % 10 >= 7""",
       rounds="session_duration_sec session_dwell_std", uses="pageviews shop_orders")
def _(t):
    text = F.when(F.col("is_holiday") == 1, "yes").when(F.col("order_dow") < 3, "no").alias("holiday_text")
    df = web.order_feature_table(t.shop_orders, t.pageviews).select("order_id", "session_duration_sec", "session_dwell_std", text)
    test = F.col("order_id") % 10 >= 7
    return prep.impute_mean_mode(df.where(~test), df.where(test), ["session_duration_sec", "session_dwell_std", "holiday_text"])
