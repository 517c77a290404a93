"""Queries over the click and search logs, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.operators import behaviour as b
from tallyloom.operators import user_table as ut
from tallyloom.operators.text_features import TextModel
from tallyloom.plans.registry import query

END = "2024-01-20"
TARGET = ("2024-01-21", "2024-01-30")
KEYWORDS = ["the", "ent", "que", "ein", "der", "sou"]


def days(column: str, back: int, end: str = END) -> str:
    return f"cast({column} AS date) BETWEEN DATE '{end}' - {back} AND DATE '{end}'"


def span(column: str, first: int, last: int) -> str:
    return f"cast({column} AS date) BETWEEN DATE '{END}' - {first} AND DATE '{END}' - {last}"


def upto(column: str) -> str:
    return f"cast({column} AS date) <= DATE '{END}'"


NORM = (
    "trim(regexp_replace(regexp_replace(replace(lower(search_query), 'ё', 'е'), "
    "'[^a-zа-я0-9\\s\\x{00A0}]+', ' ', 'g'), '[\\s\\x{00A0}]+', ' ', 'g'))"
)

TARGET_SQL = f"""SELECT user_id, max(CASE WHEN action_type = 'order' THEN 1 ELSE 0 END) AS target FROM actions
WHERE cast(ts AS date) BETWEEN DATE '{TARGET[0]}' AND DATE '{TARGET[1]}' GROUP BY user_id"""


@query("target_label", TARGET_SQL, uses="actions")
def _(t):
    return b.target_label(t.actions, *TARGET)


BASIC_COLUMNS = []
BASIC_DOUBLES = []
_basic_ctes, _basic_joins = [], []
for _a in b.BASIC_ACTIONS:
    cols = [f"num_products_{_a}", f"sum_discount_price_{_a}", f"max_discount_price_{_a}", f"days_since_last_{_a}", f"days_since_first_{_a}"]
    BASIC_COLUMNS += cols
    BASIC_DOUBLES += cols[1:3]
    _basic_ctes.append(f"""b_{_a} AS (SELECT user_id, cast(count(product_id) AS int) AS {cols[0]}, coalesce(sum(discount_price), 0.0) AS {cols[1]},
 max(discount_price) AS {cols[2]}, cast(date_diff('day', cast(max(ts) AS date), DATE '{END}') AS int) AS {cols[3]},
 cast(date_diff('day', cast(min(ts) AS date), DATE '{END}') AS int) AS {cols[4]}
 FROM actions LEFT JOIN products USING (product_id) WHERE action_type = '{_a}' AND {days('ts', 120)} GROUP BY user_id)""")
_first, *_rest = b.BASIC_ACTIONS
BASIC_SQL = f"SELECT user_id, {', '.join(BASIC_COLUMNS)} FROM b_{_first} " + " ".join(
    f"FULL JOIN b_{a} USING (user_id)" for a in _rest
)
BASIC_CTE = ", ".join(_basic_ctes)


@query("action_basic_features", f"WITH {BASIC_CTE} {BASIC_SQL}", rounds=BASIC_DOUBLES, uses="actions products")
def _(t):
    return b.action_basic_features(t.actions, t.products, END)


SEARCH_BASIC_SQL = f"""SELECT user_id, cast(count(search_query) AS int) AS num_search,
 cast(DATE '{END}' - cast(max(ts) AS date) AS int) AS days_since_last_search, cast(DATE '{END}' - cast(min(ts) AS date) AS int) AS days_since_first_search
 FROM searches WHERE {days('ts', 120)} GROUP BY user_id"""


@query("search_basic_features", SEARCH_BASIC_SQL, uses="searches")
def _(t):
    return b.search_basic_features(t.searches, END)


INTENT_CTE = f"""w7 AS (SELECT user_id, count(*) FILTER (WHERE action_type = 'to_cart') AS add_to_cart_count_7d,
 count(*) FILTER (WHERE action_type = 'click') AS product_clicks_7d FROM actions WHERE {days('ts', 7)} GROUP BY user_id),
w30 AS (SELECT user_id, count(*) FILTER (WHERE action_type = 'to_cart') AS add_to_cart_count_30d,
 count(*) FILTER (WHERE action_type = 'view') AS view_count_30d, count(*) FILTER (WHERE action_type = 'search') AS search_count_30d,
 count(*) FILTER (WHERE action_type = 'click') AS click_count_30d FROM actions WHERE {days('ts', 30)} GROUP BY user_id),
intent AS (SELECT *, (add_to_cart_count_30d + 1) / (click_count_30d + 1) AS cart_to_click_ratio FROM w7 FULL JOIN w30 USING (user_id))"""


@query("intent_counts", f"WITH {INTENT_CTE} SELECT * EXCLUDE (cart_to_click_ratio) FROM intent", uses="actions")
def _(t):
    return b.intent_counts(t.actions, END).drop("cart_to_click_ratio")


@query("cart_click_ratio", f"WITH {INTENT_CTE} SELECT user_id, cart_to_click_ratio FROM intent", rounds="cart_to_click_ratio", uses="actions")
def _(t):
    return b.intent_counts(t.actions, END).select("user_id", "cart_to_click_ratio")


def gap_cte(where: str = "true") -> str:
    return f"""gaps AS (SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) // 1000000 AS time_diff_sec
 FROM actions WHERE {where})"""


def session_cte(gap: int, where: str = "true") -> str:
    return gap_cte(where) + f""", sess AS (SELECT *, cast(sum(CASE WHEN time_diff_sec IS NULL OR time_diff_sec > {gap} THEN 1 ELSE 0 END)
 OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS bigint) AS session_id FROM gaps)"""


@query("time_since_prev", f"WITH {gap_cte()} SELECT event_id, user_id, time_diff_sec FROM gaps", uses="actions")
def _(t):
    return b.time_since_previous(t.actions).result().select("event_id", "user_id", "time_diff_sec")


@query("sessionize", f"WITH {session_cte(2400)} SELECT event_id, user_id, session_id FROM sess", uses="actions")
def _(t):
    return b.sessionize(t.actions).select("event_id", "user_id", "session_id")


@query("sessionize_6h", f"WITH {session_cte(21600)} SELECT event_id, user_id, session_id FROM sess", uses="actions")
def _(t):
    return b.sessionize(t.actions, 6 * 3600).select("event_id", "user_id", "session_id")


STATS_CTE = session_cte(2400, upto("ts")) + """, lens AS (SELECT user_id, session_id, count(*) AS n FROM sess GROUP BY ALL),
session_agg AS (SELECT user_id, avg(n) AS avg_actions_per_session, max(n) AS max_actions_per_session FROM lens GROUP BY user_id)"""


@query("session_stats", f"WITH {STATS_CTE} SELECT * FROM session_agg", rounds="avg_actions_per_session", uses="actions")
def _(t):
    return b.session_stats(t.actions, END)


@query("forward_fill", """SELECT event_id, user_id, last_value(widget_name_id IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
 ROWS UNBOUNDED PRECEDING) AS last_widget FROM actions""", uses="actions")
def _(t):
    ordered = b.Ordered.per_key(t.actions, ["user_id"], ["ts", "event_id"])
    return ordered.last_known(last_widget="widget_name_id").result().select("event_id", "user_id", "last_widget")


LAST_CTE = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM actions WHERE {upto('ts')}),
last3 AS (SELECT user_id, count(*) AS last_actions_count, coalesce(max(action_type) FILTER (WHERE rn = 1), 'NONE') AS last_action,
 coalesce(max(action_type) FILTER (WHERE rn = 2), 'NONE') AS last_2_action, coalesce(max(action_type) FILTER (WHERE rn = 3), 'NONE') AS last_3_action
 FROM ranked WHERE rn <= 3 GROUP BY user_id),
last_actions AS (SELECT *, last_3_action || '__' || last_2_action || '__' || last_action AS last_3_actions_str FROM last3)"""


@query("last_k_actions", f"WITH {LAST_CTE} SELECT * FROM last_actions", uses="actions")
def _(t):
    return b.last_k_actions(t.actions, END)


# --- search texts -------------------------------------------------------------------

QUERIES_CTE = f"""norm AS (SELECT user_id, ts, search_id, search_query, {NORM} AS q FROM searches),
queries AS (SELECT *, length(q) AS chars, len(string_split(q, ' ')) AS words,
 {', '.join(f"CASE WHEN contains(q, '{k}') THEN 1 ELSE 0 END AS product_{k}_flag" for k in KEYWORDS)} FROM norm)"""


@query("normalize_query", f"SELECT search_id, {NORM} AS q FROM searches", uses="searches")
def _(t):
    return t.searches.select("search_id", tx.normalize_query(F.col("search_query")).alias("q"))


@query("text_lengths", f"WITH {QUERIES_CTE} SELECT search_id, chars AS query_len_chars, words AS query_len_words FROM queries", uses="searches")
def _(t):
    return b.query_table(t.searches, []).select(
        "search_id", F.col("query_len_chars").cast("long").alias("query_len_chars"),
        F.col("query_len_words").cast("long").alias("query_len_words"),
    )


FLAGS = [f"product_{k}_flag" for k in KEYWORDS]


@query("keyword_flags", f"WITH {QUERIES_CTE} SELECT search_id, {', '.join(FLAGS)} FROM queries", uses="searches")
def _(t):
    return b.query_table(t.searches, KEYWORDS).select("search_id", *FLAGS)


TEXT_CTE = f"""q30 AS (SELECT user_id, count(*) AS search_count_30d, count(DISTINCT q) + max(CASE WHEN q IS NULL THEN 1 ELSE 0 END) AS unique_queries_30d,
 avg(chars) AS avg_query_len_chars_30d, median(chars) AS median_query_len_chars_30d, avg(words) AS avg_query_len_words_30d,
 max(words) AS max_query_len_words_30d FROM queries WHERE {days('ts', 30)} GROUP BY user_id),
q7 AS (SELECT user_id, count(*) AS search_count_7d, count(DISTINCT q) + max(CASE WHEN q IS NULL THEN 1 ELSE 0 END) AS unique_queries_7d
 FROM queries WHERE {days('ts', 7)} GROUP BY user_id)"""
TEXT_DOUBLES = ["avg_query_len_chars_30d", "median_query_len_chars_30d", "avg_query_len_words_30d"]


@query("query_text_features", f"WITH {QUERIES_CTE}, {TEXT_CTE} SELECT * FROM q30 FULL JOIN q7 USING (user_id)", rounds=TEXT_DOUBLES, uses="searches")
def _(t):
    return b.query_text_features(t.searches, END)


RECENCY_CTE = f"recency AS (SELECT user_id, cast(DATE '{END}' - max(cast(ts AS date)) AS int) AS days_since_last_search FROM searches WHERE {upto('ts')} GROUP BY user_id)"


@query("search_recency", f"WITH {RECENCY_CTE} SELECT * FROM recency", uses="searches")
def _(t):
    return b.search_recency(t.searches, END)


RATES_CTE = f"""rates AS (SELECT user_id, {', '.join(f'cast(sum({f}) AS bigint) AS {f}_count_30d, avg({f}) AS {f}_rate_30d' for f in FLAGS)}
 FROM queries WHERE {days('ts', 30)} GROUP BY user_id),
summary AS (SELECT user_id, cast(sum({' + '.join(FLAGS)}) AS bigint) AS product_keyword_hits_30d,
 count(*) FILTER (WHERE {' + '.join(FLAGS)} > 0) AS queries_with_product_keywords_30d FROM queries WHERE {days('ts', 30)} GROUP BY user_id)"""
RATES_DOUBLES = [f"{f}_rate_30d" for f in FLAGS]


@query("keyword_rates", f"WITH {QUERIES_CTE}, {RATES_CTE} SELECT * FROM rates", rounds=RATES_DOUBLES, uses="searches")
def _(t):
    return b.keyword_rates(t.searches, END, KEYWORDS)


@query("keyword_summary", f"WITH {QUERIES_CTE}, {RATES_CTE} SELECT * FROM summary", uses="searches")
def _(t):
    return b.keyword_summary(t.searches, END, KEYWORDS)


LASTQ_CTE = f"""newest AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, search_id DESC) AS rn FROM queries WHERE {upto('ts')}),
lastq AS (SELECT user_id, chars AS last_search_len_chars, words AS last_search_len_words,
 {', '.join(f'product_{k}_flag AS last_query_product_{k}' for k in KEYWORDS)} FROM newest WHERE rn = 1)"""


@query("last_query_features", f"WITH {QUERIES_CTE}, {LASTQ_CTE} SELECT * FROM lastq", uses="searches")
def _(t):
    return b.last_query_features(t.searches, END, KEYWORDS)


@query("concat_user_text", f"""WITH {QUERIES_CTE} SELECT user_id, cast(date_diff('day', DATE '1970-01-01', cast(ts AS date)) AS bigint) AS piece, 0::BIGINT AS part, string_agg(q, ' ' ORDER BY ts, search_id) AS queries_text
 FROM queries WHERE q IS NOT NULL AND {days('ts', 30)} GROUP BY ALL""", uses="searches")
def _(t):
    return b.concat_user_text(t.searches, END)


# --- prices -----------------------------------------------------------------------------

EVENTS_CTE = f"""pe AS (SELECT a.*, price, discount_price, category_id, category_name, brand,
 CASE WHEN discount_price IS NOT NULL AND discount_price > 0 THEN discount_price ELSE price END AS effective_price,
 CASE WHEN price IS NOT NULL AND price > 0 AND discount_price IS NOT NULL AND discount_price >= 0 AND discount_price <= price
  THEN (price - discount_price) / price ELSE 0.0 END AS discount_ratio,
 CASE WHEN price IS NOT NULL AND discount_price IS NOT NULL AND price > discount_price THEN 1 ELSE 0 END AS is_discounted
 FROM actions a LEFT JOIN products p ON a.product_id = p.product_id WHERE a.product_id IS NOT NULL AND {days('a.ts', 120)})"""


@query("effective_price", f"WITH {EVENTS_CTE} SELECT event_id, effective_price FROM pe", rounds="effective_price", uses="actions products")
def _(t):
    return b.product_events(t.actions, t.products, END).select("event_id", "effective_price")


@query("discount_ratio", f"WITH {EVENTS_CTE} SELECT event_id, discount_ratio FROM pe", rounds="discount_ratio", uses="actions products")
def _(t):
    return b.product_events(t.actions, t.products, END).select("event_id", "discount_ratio")


@query("is_discounted", f"WITH {EVENTS_CTE} SELECT event_id, is_discounted FROM pe", uses="actions products")
def _(t):
    return b.product_events(t.actions, t.products, END).select("event_id", "is_discounted")


PRICE_CTE = """price_block AS (SELECT user_id, avg(effective_price) AS avg_viewed_price, median(effective_price) AS median_viewed_price,
 max(effective_price) AS max_viewed_price, avg(discount_ratio) AS discount_ratio_mean, avg(is_discounted) AS fraction_discounted_products
 FROM pe WHERE action_type IN ('view', 'click', 'to_cart', 'order') GROUP BY user_id)"""
PRICE_DOUBLES = ["avg_viewed_price", "median_viewed_price", "max_viewed_price", "discount_ratio_mean", "fraction_discounted_products"]


@query("price_features", f"WITH {EVENTS_CTE}, {PRICE_CTE} SELECT * FROM price_block", rounds=PRICE_DOUBLES, uses="actions products")
def _(t):
    return b.price_features(t.actions, t.products, END)


CATEGORY_CTE = """cc AS (SELECT user_id, category_id, category_name, count(*) AS category_event_count FROM pe
 WHERE category_id IS NOT NULL AND action_type IN ('view', 'click', 'to_cart', 'favorite', 'order') GROUP BY ALL),
ct AS (SELECT user_id, cast(sum(category_event_count) AS bigint) AS total_category_events, max(category_event_count) AS favorite_category_count,
 count(*) AS unique_categories FROM cc GROUP BY user_id),
ctot AS (SELECT *, favorite_category_count / total_category_events AS favorite_category_share FROM ct),
centropy AS (SELECT user_id, sum(-(category_event_count / total_category_events) * ln(category_event_count / total_category_events)) AS category_entropy
 FROM cc JOIN ct USING (user_id) GROUP BY user_id),
ctop AS (SELECT category_id, category_name, cast(sum(category_event_count) AS bigint) AS global_category_count FROM cc GROUP BY ALL
 ORDER BY global_category_count DESC, category_id, category_name LIMIT 10)"""


@query("category_counts", f"WITH {EVENTS_CTE}, {CATEGORY_CTE} SELECT * FROM cc", uses="actions products")
def _(t):
    return b.category_counts(t.actions, t.products, END)


@query("category_totals", f"WITH {EVENTS_CTE}, {CATEGORY_CTE} SELECT * FROM ctot", rounds="favorite_category_share", uses="actions products")
def _(t):
    return b.category_totals(t.actions, t.products, END).drop("category_entropy")


@query("category_entropy", f"WITH {EVENTS_CTE}, {CATEGORY_CTE} SELECT * FROM centropy", rounds="category_entropy", uses="actions products")
def _(t):
    return b.category_totals(t.actions, t.products, END).select("user_id", "category_entropy")


@query("top_categories", f"WITH {EVENTS_CTE}, {CATEGORY_CTE} SELECT * FROM ctop", uses="actions products")
def _(t):
    counts = b.category_counts(t.actions, t.products, END)
    return b.top_groups(counts, ["category_id", "category_name"], "category_event_count", 10, "global_category_count")


@query("top_category_share_pivot", f"""WITH {EVENTS_CTE}, {CATEGORY_CTE} SELECT user_id, category_id,
 category_event_count / total_category_events AS share FROM cc JOIN ct USING (user_id) WHERE category_id IN (SELECT category_id FROM ctop)""",
       rounds="share", uses="actions products")
def _(t):
    """The pivoted shares, shown long so that the column set does not depend on the data."""
    counts = b.category_counts(t.actions, t.products, END)
    top = b.top_groups(counts, ["category_id", "category_name"], "category_event_count", 10, "n")
    ids = [r["category_id"] for r in top.collect()]
    wide = b.top_share_pivot(counts, "category_id", "category_event_count", ids, "s_")
    long = wide.unpivot(["user_id"], [f"s_{i}" for i in ids], "col", "share").where("share IS NOT NULL")
    return long.select("user_id", F.substring("col", 3, 30).cast("long").alias("category_id"), "share")


# --- trends ---------------------------------------------------------------------------------

_SPANS = {"last_7d": (6, 0), "prev_7d": (13, 7), "last_30d": (29, 0), "prev_30d": (59, 30)}
_trend = []
for _s, (_f, _l) in _SPANS.items():
    _counts = "".join(f", count(*) FILTER (WHERE action_type = '{k}') AS {stem}_{_s}" for stem, k in b.TREND_ACTIONS.items())
    _trend.append(f"""t_{_s} AS (SELECT user_id, count(*) AS actions_count_{_s}{_counts},
 count(DISTINCT product_id) + max(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END) AS unique_products_{_s}
 FROM actions WHERE {span('ts', _f, _l)} GROUP BY user_id)""")
TREND_CTE = ", ".join(_trend) + ", tw AS (SELECT * FROM t_last_7d FULL JOIN t_prev_7d USING (user_id) FULL JOIN t_last_30d USING (user_id) FULL JOIN t_prev_30d USING (user_id))"


def _dr(stem: str, out: str, s: str, ratio: bool = True) -> str:
    text = f"{stem}_last_{s} - {stem}_prev_{s} AS {out}_trend_delta_{s}"
    return text + (f", ({stem}_last_{s} + 1) / ({stem}_prev_{s} + 1) AS {out}_trend_ratio_{s}" if ratio else "")


TREND_CTE += f""", trend AS (SELECT *, {_dr('actions_count', 'actions', '7d')}, {_dr('click_count', 'click', '7d')}, {_dr('to_cart_count', 'to_cart', '7d')},
 {_dr('order_count', 'order', '30d')}, {_dr('unique_products', 'unique_products', '7d')} FROM tw)"""
TREND_DOUBLES = ["actions_trend_ratio_7d", "click_trend_ratio_7d", "to_cart_trend_ratio_7d", "order_trend_ratio_30d", "unique_products_trend_ratio_7d"]


@query("trend_windows", f"WITH {TREND_CTE} SELECT * FROM tw", uses="actions")
def _(t):
    return b.trend_windows(t.actions, END)


@query("trend_delta_ratio", f"WITH {TREND_CTE} SELECT user_id, COLUMNS('.*trend.*') FROM trend", rounds=TREND_DOUBLES, uses="actions")
def _(t):
    out = b.trend_delta_ratio(b.trend_windows(t.actions, END))
    return out.select("user_id", *[c for c in out.columns if "trend" in c])


_search_trend = []
for _s in ("last_7d", "prev_7d"):
    _search_trend.append(f"""s_{_s} AS (SELECT user_id, count(*) AS search_count_{_s}, count(DISTINCT search_query)
 + max(CASE WHEN search_query IS NULL THEN 1 ELSE 0 END) AS unique_searches_{_s} FROM searches WHERE {span('ts', *_SPANS[_s])} GROUP BY user_id)""")
SEARCH_TREND_CTE = ", ".join(_search_trend) + f""", search_trend AS (SELECT *, {_dr('search_count', 'search', '7d')},
 {_dr('unique_searches', 'unique_searches', '7d', False)} FROM s_last_7d FULL JOIN s_prev_7d USING (user_id))"""


@query("search_trend", f"WITH {SEARCH_TREND_CTE} SELECT * FROM search_trend", rounds="search_trend_ratio_7d", uses="searches")
def _(t):
    return b.search_trend(t.searches, END)


# --- conversion ---------------------------------------------------------------------------------

UNION_CTE = f"""line AS (SELECT user_id, ts, 0 AS kind_rank, search_id AS event_id, NULL AS action_kind FROM searches WHERE {days('ts', 30)}
 UNION ALL SELECT user_id, ts, 1, event_id, action_type FROM actions WHERE {days('ts', 30)} AND action_type IN ('click', 'to_cart', 'favorite', 'order'))"""
ASOF_CTE = UNION_CTE + """, after AS (SELECT a.user_id, a.event_id, a.ts, a.action_kind, s.ts AS last_search_ts,
 cast((epoch_us(a.ts) - epoch_us(s.ts)) // 1000000 AS bigint) AS secs_since_last_search
 FROM (SELECT * FROM line WHERE kind_rank = 1) a ASOF JOIN (SELECT user_id, ts FROM line WHERE kind_rank = 0) s
 ON a.user_id = s.user_id AND a.ts >= s.ts)"""


@query("union_events", f"WITH {UNION_CTE} SELECT user_id, kind_rank, event_id, action_kind FROM line", uses="searches actions")
def _(t):
    return b.union_events(t.searches, t.actions, END).drop("ts")


@query("asof_last_search", f"WITH {ASOF_CTE} SELECT user_id, event_id, action_kind, secs_since_last_search FROM after", uses="searches actions")
def _(t):
    return b.asof_last_search(t.searches, t.actions, END).drop("ts", "last_search_ts")


_conv = []
for _k, _n in (("click", "click"), ("to_cart", "cart")):
    _conv += [f"count(*) FILTER (WHERE action_kind = '{_k}' AND secs_since_last_search <= {m * 60}) AS search_to_{_n}_{m}m_count" for m in (5, 30, 60)]
    _conv.append(f"avg(secs_since_last_search) FILTER (WHERE action_kind = '{_k}') AS mean_secs_search_to_{_n}")
CONV_CTE = ASOF_CTE + f""", conv_agg AS (SELECT user_id, {', '.join(_conv)} FROM after GROUP BY user_id),
sc AS (SELECT user_id, count(*) AS search_events_30d FROM searches WHERE {days('ts', 30)} GROUP BY user_id),
conv AS (SELECT *, (search_to_click_30m_count + 1) / (search_events_30d + 1) AS search_to_click_30m_rate,
 (search_to_cart_30m_count + 1) / (search_events_30d + 1) AS search_to_cart_30m_rate FROM sc FULL JOIN conv_agg USING (user_id))"""
CONV_DOUBLES = ["mean_secs_search_to_click", "mean_secs_search_to_cart", "search_to_click_30m_rate", "search_to_cart_30m_rate"]


@query("search_conversion", f"WITH {CONV_CTE} SELECT * FROM conv", rounds=CONV_DOUBLES, uses="searches actions")
def _(t):
    return b.search_conversion(t.searches, t.actions, END)


# --- loyalty and widgets ------------------------------------------------------------------------------

_loyal, LOYAL_DOUBLES = [], []
for _key, _m in b.LOYALTY_NAMES.items():
    _loyal.append(f"""l_{_key} AS (SELECT user_id, count(*) AS {_m['unique']}, cast(sum(c) AS bigint) AS {_m['total']}, count(*) FILTER (WHERE c > 1) AS {_m['repeats']},
 max(c) AS {_m['favorite']}, count(*) FILTER (WHERE c > 1) / (count(*) + 1) AS {_m['rate']}, max(c) / sum(c) AS {_m['share']}
 FROM (SELECT user_id, {_key}, count(*) AS c FROM pe WHERE {_key} IS NOT NULL AND cast({_key} AS varchar) <> '' GROUP BY ALL) AS g GROUP BY user_id)""")
    LOYAL_DOUBLES += [_m["rate"], _m["share"]]
REPEAT_NAMES = [f"repeat_share_action_{k}" for k in b.PRODUCT_ACTIONS]
LOYAL_CTE = ", ".join(_loyal) + f""", per AS (SELECT user_id, action_type, (count(*) - count(DISTINCT product_id)) / (count(*) + 1) AS share FROM pe GROUP BY ALL),
repeats AS (SELECT user_id, {', '.join(f"max(share) FILTER (WHERE action_type = '{k}') AS repeat_share_action_{k}" for k in b.PRODUCT_ACTIONS)} FROM per GROUP BY user_id),
loyal AS (SELECT * FROM l_product_id FULL JOIN l_category_id USING (user_id) FULL JOIN l_brand USING (user_id) FULL JOIN repeats USING (user_id))"""


@query("loyalty", f"WITH {EVENTS_CTE}, {LOYAL_CTE} SELECT * EXCLUDE ({', '.join(REPEAT_NAMES)}) FROM loyal", rounds=LOYAL_DOUBLES, uses="actions products")
def _(t):
    return b.loyalty_features(t.actions, t.products, END).drop(*REPEAT_NAMES)


@query("repeat_share_pivot", f"WITH {EVENTS_CTE}, {LOYAL_CTE} SELECT * FROM repeats", rounds=REPEAT_NAMES, uses="actions products")
def _(t):
    return b.repeat_share_pivot(b.product_events(t.actions, t.products, END))


WIDGET_CTE = f"""w AS (SELECT * FROM actions WHERE {days('ts', 30)}),
wc AS (SELECT user_id, widget_name_id, count(*) AS widget_cnt FROM w WHERE widget_name_id IS NOT NULL GROUP BY ALL),
wbasic AS (SELECT user_id, count(*) AS widget_events_30d, count(DISTINCT widget_name_id) + max(CASE WHEN widget_name_id IS NULL THEN 1 ELSE 0 END) AS unique_widgets_30d,
 arg_max(widget_name_id, (ts, event_id)) FILTER (WHERE widget_name_id IS NOT NULL) AS last_widget_name_id FROM w GROUP BY user_id),
wfav AS (SELECT user_id, widget_name_id AS favorite_widget_name_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY widget_cnt DESC, widget_name_id) AS rn FROM wc) AS r WHERE rn = 1),
wt AS (SELECT user_id, cast(sum(widget_cnt) AS bigint) AS total_widget_cnt, max(widget_cnt) AS favorite_widget_cnt, max(widget_cnt) / sum(widget_cnt) AS favorite_widget_share FROM wc GROUP BY user_id),
went AS (SELECT user_id, sum(-(widget_cnt / total_widget_cnt) * ln(widget_cnt / total_widget_cnt)) AS widget_entropy FROM wc JOIN wt USING (user_id) GROUP BY user_id),
wtop AS (SELECT widget_name_id, sum(widget_cnt) AS n FROM wc GROUP BY ALL ORDER BY n DESC, widget_name_id LIMIT 20)"""


@query("widget_basic", f"WITH {WIDGET_CTE} SELECT * FROM wbasic LEFT JOIN wfav USING (user_id)", uses="actions")
def _(t):
    return b.widget_basic(t.actions, END)


@query("widget_share_entropy", f"WITH {WIDGET_CTE} SELECT * FROM wt JOIN went USING (user_id)", rounds="favorite_widget_share widget_entropy", uses="actions")
def _(t):
    return b.widget_share_entropy(t.actions, END)


@query("top_widget_share_pivot", f"""WITH {WIDGET_CTE} SELECT user_id, widget_name_id, widget_cnt / total_widget_cnt AS share FROM wc JOIN wt USING (user_id)
 WHERE widget_name_id IN (SELECT widget_name_id FROM wtop)""", rounds="share", uses="actions")
def _(t):
    counts = b.widget_counts(t.actions, END)
    ids = [r["widget_name_id"] for r in b.top_groups(counts, ["widget_name_id"], "widget_cnt", 20, "n").collect()]
    wide = b.top_share_pivot(counts, "widget_name_id", "widget_cnt", ids, "s_")
    long = wide.unpivot(["user_id"], [f"s_{i}" for i in ids], "col", "share").where("share IS NOT NULL")
    return long.select("user_id", F.substring("col", 3, 30).cast("long").alias("widget_name_id"), "share")


# --- the wide table -----------------------------------------------------------------------------------------

ALL_CTE = ", ".join(
    [BASIC_CTE, f"basic AS ({BASIC_SQL})", f"sbasic AS ({SEARCH_BASIC_SQL})", INTENT_CTE, STATS_CTE, LAST_CTE, QUERIES_CTE, TEXT_CTE,
     RECENCY_CTE, RATES_CTE, LASTQ_CTE, EVENTS_CTE, PRICE_CTE, CATEGORY_CTE, TREND_CTE, SEARCH_TREND_CTE, CONV_CTE, LOYAL_CTE, WIDGET_CTE,
     f"target AS ({TARGET_SQL})"]
)
DROP_SHARES = "top_category_share_|top_widget_share_"
ALL_DOUBLES = [*BASIC_DOUBLES, "cart_to_click_ratio", "avg_actions_per_session", *TEXT_DOUBLES, *RATES_DOUBLES, *PRICE_DOUBLES, "favorite_category_share",
               "category_entropy", *TREND_DOUBLES, "search_trend_ratio_7d", *CONV_DOUBLES, *LOYAL_DOUBLES, *REPEAT_NAMES, "favorite_widget_share", "widget_entropy"]
# Name collisions, in block order: intent and search both count searches over 30 days, and so on.
WIDE_SELECT = """SELECT target.user_id, target, basic.* EXCLUDE (user_id), sbasic.* EXCLUDE (user_id), intent.* EXCLUDE (user_id), session_agg.* EXCLUDE (user_id),
 coalesce(last_actions_count, NULL) AS last_actions_count, coalesce(last_action, 'NONE') AS last_action, coalesce(last_2_action, 'NONE') AS last_2_action,
 coalesce(last_3_action, 'NONE') AS last_3_action, coalesce(last_3_actions_str, 'NONE') AS last_3_actions_str,
 q30.search_count_30d AS search_count_30d_right, q30.* EXCLUDE (user_id, search_count_30d), q7.* EXCLUDE (user_id),
 recency.days_since_last_search AS days_since_last_search_right, rates.* EXCLUDE (user_id), summary.* EXCLUDE (user_id), lastq.* EXCLUDE (user_id),
 price_block.* EXCLUDE (user_id), ctot.* EXCLUDE (user_id), centropy.* EXCLUDE (user_id), trend.* EXCLUDE (user_id), search_trend.* EXCLUDE (user_id),
 conv.* EXCLUDE (user_id), loyal.* EXCLUDE (user_id), wbasic.* EXCLUDE (user_id), wfav.* EXCLUDE (user_id), wt.* EXCLUDE (user_id), went.* EXCLUDE (user_id)
 FROM target """ + " ".join(
    f"LEFT JOIN {n} ON target.user_id = {n}.user_id"
    for n in ["basic", "sbasic", "intent", "session_agg", "last_actions", "q30", "q7", "recency", "rates", "summary", "lastq", "price_block", "ctot",
              "centropy", "trend", "search_trend", "conv", "loyal", "wbasic", "wfav", "wt", "went"]
)


def _without_shares(df):
    return df.select(*[c for c in df.columns if not c.startswith(("top_category_share_", "top_widget_share_"))])


def wide_table(t):
    return ut.user_feature_table(t.actions, t.searches, t.products, END, target=TARGET, keywords=KEYWORDS)


@query("user_feature_table", f"WITH {ALL_CTE} {WIDE_SELECT}", rounds=ALL_DOUBLES, uses="actions searches products")
def _(t):
    """Top-k share columns are left out here (their names follow the data); their own queries check them."""
    return _without_shares(wide_table(t))


@query("assemble_blocks", f"""WITH target AS ({TARGET_SQL}), {INTENT_CTE}, {RECENCY_CTE}, sbasic AS ({SEARCH_BASIC_SQL}), {LAST_CTE}
 SELECT target.user_id, target, num_search, sbasic.days_since_last_search, days_since_first_search, recency.days_since_last_search AS days_since_last_search_right,
 intent.* EXCLUDE (user_id), coalesce(last_action, 'NONE') AS last_action
 FROM target LEFT JOIN sbasic ON target.user_id = sbasic.user_id LEFT JOIN recency ON target.user_id = recency.user_id
 LEFT JOIN intent ON target.user_id = intent.user_id LEFT JOIN last_actions ON target.user_id = last_actions.user_id""",
       rounds="cart_to_click_ratio", uses="actions searches")
def _(t):
    blocks = {
        "search_basic": b.search_basic_features(t.searches, END),
        "recency": b.search_recency(t.searches, END),
        "intent": b.intent_counts(t.actions, END),
        "last": b.last_k_actions(t.actions, END).select("user_id", "last_action"),
    }
    return b.assemble_blocks(b.target_label(t.actions, *TARGET), blocks, categorical=["last_action"])


@query("join_full_coalesce", f"WITH {INTENT_CTE}, {RECENCY_CTE} SELECT user_id, add_to_cart_count_7d, days_since_last_search FROM intent FULL JOIN recency USING (user_id)",
       uses="actions searches")
def _(t):
    out = b.join_blocks([b.intent_counts(t.actions, END), b.search_recency(t.searches, END)])
    return out.select("user_id", "add_to_cart_count_7d", "days_since_last_search")


@query("user_spine", "SELECT DISTINCT user_id FROM actions", uses="actions")
def _(t):
    return b.user_spine(users=t.actions.select("user_id").distinct())


SPLITS = {
    "train": ("2024-01-10", ("2024-01-11", "2024-01-15")),
    "val": ("2024-01-15", ("2024-01-16", "2024-01-20")),
    "test": ("2024-01-20", None),
}


def _split_sql() -> str:
    """The wide table's SQL at each feature date, with the split's own spine."""
    parts = []
    for name, (end, target) in SPLITS.items():
        spine = (
            f"SELECT user_id, max(CASE WHEN action_type = 'order' THEN 1 ELSE 0 END) AS target FROM actions WHERE cast(ts AS date) BETWEEN DATE '{target[0]}' AND DATE '{target[1]}' GROUP BY user_id"
            if target else "SELECT DISTINCT user_id, NULL::INTEGER AS target FROM actions"
        )
        blocks = ALL_CTE.replace(TARGET_SQL, "SELECT * FROM spine").replace(f"DATE '{END}'", f"DATE '{end}'")
        parts.append(f"SELECT *, '{name}' AS split FROM (WITH spine AS ({spine}), {blocks} {WIDE_SELECT})")
    return " UNION ALL ".join(parts)


@query("temporal_datasets", _split_sql(), rounds=ALL_DOUBLES, shift=0.0000000317, uses="actions searches products")
def _(t):
    users = t.actions.select("user_id").distinct()
    return _without_shares(ut.temporal_datasets(t.actions, t.searches, t.products, SPLITS, users=users, keywords=KEYWORDS))


@query("text_components")
def _(t):
    """Components of every split's texts under the vocabulary and vectors of the first; a test holds them against a dense SVD."""
    model = TextModel.fit(t.searches, SPLITS["train"][0])
    parts = [model.components(t.searches, end).withColumn("split", F.lit(name)) for name, (end, _) in SPLITS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
