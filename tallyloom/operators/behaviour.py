"""Per-user feature blocks over an event log.

Every block is one aggregation keyed by ``user_id`` with conditional aggregates,
so that the log is read once per block instead of once per action and window.

Expected inputs: ``actions(user_id, ts, event_id, action_type, product_id,
widget_name_id)``, ``searches(user_id, ts, search_id, search_query)`` and
``products(product_id, price, discount_price, category_id, category_name, brand, type)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.functions import text as tx
from tallyloom.functions.time import as_date, between_days, days_until, instant, lookback, whole_seconds
from tallyloom.operators.quantiles import exact_quantiles
from tallyloom.operators.slices import SLICE, Ordered, by_key

USER = "user_id"
# Action names and the column suffixes of the basic block.
BASIC_ACTIONS = ["click", "favorite", "order", "to_cart"]
PRODUCT_ACTIONS = ["view", "click", "to_cart", "favorite", "order"]
PRICE_ACTIONS = ["view", "click", "to_cart", "order"]
CONVERSION_ACTIONS = ["click", "to_cart", "favorite", "order"]
SESSION_GAP_SECONDS = 40 * 60
# Product words looked for in queries.
PRODUCT_KEYWORDS = [
    "молоко", "сыр", "творог", "йогурт", "кефир", "батон", "хлеб", "яйца",
    "курица", "банан", "яблок", "кофе", "чай", "шоколад", "вода", "колбас",
]


def until(ts: Column, end: str | date) -> Column:
    return ts < instant(as_date(end) + timedelta(days=1))


def target_label(actions: DataFrame, start: str, end: str, positive: str = "order") -> DataFrame:
    """1 for users with a ``positive`` action in the window, 0 for other active users."""
    return (
        actions.where(between_days(F.col("ts"), start, end))
        .groupBy(USER)
        .agg(F.max(F.when(F.col("action_type") == positive, 1).otherwise(0)).alias("target"))
    )


def action_basic_features(
    actions: DataFrame, products: DataFrame, end: str, anchor: str | None = None, days: int = 120
) -> DataFrame:
    """Count, price sum and maximum, and recency per action, in one pass.

    A user without a given action gets nulls for it, as a left join would give.
    """
    anchor = anchor or end
    log = actions.where(lookback(F.col("ts"), end, days) & F.col("action_type").isin(BASIC_ACTIONS)).join(
        products.select("product_id", "discount_price"), "product_id", "left"
    )
    aggs, out = [], []
    for a in BASIC_ACTIONS:
        is_a = F.col("action_type") == a
        aggs += [
            F.count(F.when(is_a, 1)).alias(f"__rows_{a}"),
            F.count(F.when(is_a, F.col("product_id"))).alias(f"__n_{a}"),
            F.sum(F.when(is_a, F.col("discount_price"))).alias(f"__sum_{a}"),
            F.max(F.when(is_a, F.col("discount_price"))).alias(f"max_discount_price_{a}"),
            F.max(F.when(is_a, F.col("ts"))).alias(f"__last_{a}"),
            F.min(F.when(is_a, F.col("ts"))).alias(f"__first_{a}"),
        ]
        seen = F.col(f"__rows_{a}") > 0
        out += [
            F.when(seen, F.col(f"__n_{a}")).cast("int").alias(f"num_products_{a}"),
            F.when(seen, F.coalesce(f"__sum_{a}", F.lit(0.0))).alias(f"sum_discount_price_{a}"),
            F.col(f"max_discount_price_{a}"),
            days_until(anchor, F.col(f"__last_{a}")).alias(f"days_since_last_{a}"),
            days_until(anchor, F.col(f"__first_{a}")).alias(f"days_since_first_{a}"),
        ]
    return log.groupBy(USER).agg(*aggs).select(USER, *out)


def search_basic_features(searches: DataFrame, end: str, anchor: str | None = None, days: int = 120) -> DataFrame:
    anchor = anchor or end
    return (
        searches.where(lookback(F.col("ts"), end, days))
        .groupBy(USER)
        .agg(
            F.count("search_query").cast("int").alias("num_search"),
            days_until(anchor, F.max("ts")).alias("days_since_last_search"),
            days_until(anchor, F.min("ts")).alias("days_since_first_search"),
        )
    )


def intent_counts(actions: DataFrame, end: str) -> DataFrame:
    """Cart and click counts of the last week and month; null where the user has no row in the window."""
    recent = lookback(F.col("ts"), end, 7)

    def number(kind: str, window: Column | None = None) -> Column:
        hit = F.col("action_type") == kind
        return F.count_if(hit & window if window is not None else hit)

    has_week = F.count_if(recent) > 0
    out = (
        actions.where(lookback(F.col("ts"), end, 30))
        .groupBy(USER)
        .agg(
            F.when(has_week, number("to_cart", recent)).alias("add_to_cart_count_7d"),
            F.when(has_week, number("click", recent)).alias("product_clicks_7d"),
            number("to_cart").alias("add_to_cart_count_30d"),
            number("view").alias("view_count_30d"),
            number("search").alias("search_count_30d"),
            number("click").alias("click_count_30d"),
        )
    )
    return out.withColumn("cart_to_click_ratio", cart_click_ratio())


def cart_click_ratio(cart: str = "add_to_cart_count_30d", click: str = "click_count_30d") -> Column:
    return (F.col(cart) + 1) / (F.col(click) + 1)


def time_since_previous(log: DataFrame, limit: int | None = None) -> Ordered:
    """Adds ``time_diff_sec``: whole seconds since the user's previous event."""
    ordered = Ordered.per_key(log, [USER], ["ts", "event_id"], **({"limit": limit} if limit else {}))
    out = ordered.previous(__prev_ts="ts")
    return Ordered(
        out.df.withColumn("time_diff_sec", whole_seconds(F.col("ts"), F.col("__prev_ts"))).drop("__prev_ts"),
        out.keys,
        out.order,
    )


def sessionize(log: DataFrame, gap: int = SESSION_GAP_SECONDS, limit: int | None = None) -> DataFrame:
    """Adds ``time_diff_sec`` and a per-user running ``session_id``."""
    stepped = time_since_previous(log, limit)
    fresh = F.coalesce(F.col("time_diff_sec") > gap, F.lit(True)).cast("long")
    return stepped.running_sum(session_id=fresh).result()


def session_stats(actions: DataFrame, end: str, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    log = actions.where(until(F.col("ts"), end)).select(USER, "ts", "event_id")
    return (
        sessionize(log, gap)
        .groupBy(USER, "session_id")
        .agg(F.count(F.lit(1)).alias("session_len"))
        .groupBy(USER)
        .agg(
            F.avg("session_len").alias("avg_actions_per_session"),
            F.max("session_len").alias("max_actions_per_session"),
        )
    )


def last_k_actions(actions: DataFrame, end: str) -> DataFrame:
    """The last three actions; the row_number filter is cut down before the shuffle."""
    newest = W.partitionBy(USER).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    recent = (
        actions.where(until(F.col("ts"), end))
        .select(USER, "ts", "event_id", "action_type", F.row_number().over(newest).alias("__rn"))
        .where(F.col("__rn") <= 3)
    )

    def nth(n: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("__rn") == n, F.col("action_type"))), F.lit("NONE"))

    return (
        recent.groupBy(USER)
        .agg(
            F.count(F.lit(1)).alias("last_actions_count"),
            nth(1).alias("last_action"),
            nth(2).alias("last_2_action"),
            nth(3).alias("last_3_action"),
        )
        .withColumn("last_3_actions_str", F.concat_ws("__", "last_3_action", "last_2_action", "last_action"))
    )


def intent_features(actions: DataFrame, end: str) -> DataFrame:
    return join_blocks([intent_counts(actions, end), session_stats(actions, end), last_k_actions(actions, end)])


def join_blocks(blocks: Sequence[DataFrame]) -> DataFrame:
    """Full outer joins on the user with one merged key column."""
    out = blocks[0]
    for block in blocks[1:]:
        out = out.join(block, [USER], "full")
    return out


# --- search texts -----------------------------------------------------------


def keyword_name(keyword: str) -> str:
    return "_".join("".join(c if c.isalnum() else " " for c in keyword.lower()).split())


def query_table(searches: DataFrame, keywords: Sequence[str] = PRODUCT_KEYWORDS) -> DataFrame:
    """One row per query with its normalised text, lengths and keyword flags."""
    out = searches.withColumn("search_query_norm", tx.normalize_query(F.col("search_query")))
    norm = F.col("search_query_norm")
    return out.select(
        "*",
        F.length(norm).alias("query_len_chars"),
        F.when(norm.isNotNull(), tx.word_count(norm)).alias("query_len_words"),
        *[tx.keyword_flag(norm, k).alias(f"product_{keyword_name(k)}_flag") for k in keywords],
    )


def query_rollup(searches: DataFrame, end: str) -> DataFrame:
    """One row per (user, normalised query) of the whole history.

    Holds the number of uses in the last 30 and 7 days and the place of the last
    use.  Every search statistic follows from it, so texts are normalised and
    shuffled once.
    """
    ts = F.col("ts")
    return (
        searches.where(until(ts, end))
        .select(USER, "ts", "search_id", tx.normalize_query(F.col("search_query")).alias("q"))
        .groupBy(USER, "q")
        .agg(
            F.count_if(lookback(ts, end, 30)).alias("n30"),
            F.count_if(lookback(ts, end, 7)).alias("n7"),
            F.max(F.struct("ts", "search_id")).alias("last"),
        )
        .select("*", F.length("q").alias("chars"), F.when(F.col("q").isNotNull(), tx.word_count(F.col("q"))).alias("words"))
    )


def _weighted_mean(value: Column, weight: Column) -> Column:
    known = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(value * weight).cast("double"), F.sum(known).cast("double"))


def _flags(keywords: Sequence[str]) -> dict[str, Column]:
    return {f"product_{keyword_name(k)}_flag": tx.keyword_flag(F.col("q"), k) for k in keywords}


def search_statistics(rollup: DataFrame, end: str, keywords: Sequence[str] = PRODUCT_KEYWORDS) -> DataFrame:
    """All per-user search columns that do not need a median, in one aggregate."""
    flags = _flags(keywords)
    table = rollup.select(USER, "n30", "n7", "last", "chars", "words", *[c.alias(n) for n, c in flags.items()])
    n30, n7 = F.col("n30"), F.col("n7")
    month = F.sum(n30) > 0
    hits = F.lit(0)
    for n in flags:
        hits = hits + F.col(n)
    aggs = {
        "search_count_30d": F.when(month, F.sum(n30)),
        "unique_queries_30d": F.when(month, F.count_if(n30 > 0)),
        "avg_query_len_chars_30d": _weighted_mean(F.col("chars"), n30),
        "avg_query_len_words_30d": _weighted_mean(F.col("words"), n30),
        "max_query_len_words_30d": F.max(F.when(n30 > 0, F.col("words"))),
        "days_since_last_search": days_until(end, F.max("last.ts")),
    }
    for n in flags:
        aggs[f"{n}_count_30d"] = F.when(month, F.sum(F.col(n) * n30))
        aggs[f"{n}_rate_30d"] = F.when(month, F.sum(F.col(n) * n30) / F.sum(n30))
    aggs["product_keyword_hits_30d"] = F.when(month, F.sum(hits * n30))
    aggs["queries_with_product_keywords_30d"] = F.when(month, F.sum(F.when(hits > 0, n30).otherwise(0)))
    aggs["__newest"] = F.max_by(F.struct("chars", "words", *flags), F.col("last"))
    aggs["search_count_7d"] = F.when(F.sum(n7) > 0, F.sum(n7))
    aggs["unique_queries_7d"] = F.when(F.sum(n7) > 0, F.count_if(n7 > 0))
    out = table.groupBy(USER).agg(*[c.alias(n) for n, c in aggs.items()])
    newest = {
        "last_search_len_chars": F.col("__newest.chars"),
        "last_search_len_words": F.col("__newest.words"),
        **{f"last_query_{n.removesuffix('_flag')}": F.col(f"__newest.{n}") for n in flags},
    }
    return out.withColumns(newest).drop("__newest")


def _active_month(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    return stats.where(F.col("search_count_30d") > 0).select(USER, *columns)


TEXT_COLUMNS = ["search_count_30d", "unique_queries_30d", "avg_query_len_chars_30d", "avg_query_len_words_30d", "max_query_len_words_30d"]


def query_length_median(rollup: DataFrame) -> DataFrame:
    used = rollup.where(F.col("n30") > 0)
    return exact_quantiles(used, [USER], "chars", {"median_query_len_chars_30d": 0.5}, weight="n30")


def query_text_features(searches: DataFrame, end: str) -> DataFrame:
    rollup = query_rollup(searches, end)
    stats = search_statistics(rollup, end, [])
    recent = ["search_count_7d", "unique_queries_7d"]
    return join_blocks([_active_month(stats, [*TEXT_COLUMNS, *recent]), query_length_median(rollup)])


def search_recency(searches: DataFrame, end: str) -> DataFrame:
    return (
        searches.where(until(F.col("ts"), end))
        .groupBy(USER)
        .agg(days_until(end, F.max("ts")).alias("days_since_last_search"))
    )


def keyword_rates(searches: DataFrame, end: str, keywords: Sequence[str] = PRODUCT_KEYWORDS) -> DataFrame:
    names = [f"{n}_{kind}_30d" for n in _flags(keywords) for kind in ("count", "rate")]
    return _active_month(search_statistics(query_rollup(searches, end), end, keywords), names)


def keyword_summary(searches: DataFrame, end: str, keywords: Sequence[str] = PRODUCT_KEYWORDS) -> DataFrame:
    stats = search_statistics(query_rollup(searches, end), end, keywords)
    return _active_month(stats, ["product_keyword_hits_30d", "queries_with_product_keywords_30d"])


def last_query_features(searches: DataFrame, end: str, keywords: Sequence[str] = PRODUCT_KEYWORDS) -> DataFrame:
    stats = search_statistics(query_rollup(searches, end), end, keywords)
    return stats.select(USER, *[c for c in stats.columns if c.startswith("last_")])


def concat_user_text(
    searches: DataFrame, end: str, days: int = 30, piece_seconds: int = 86_400, piece_rows: int = 10_000
) -> DataFrame:
    """A user's queries in time order, joined by blanks, in bounded pieces.

    Pieces of one user joined by a blank in (piece, part) order give the full
    text.  A span with more than ``piece_rows`` queries is cut into parts, so no
    task ever holds more of one user than that.
    """
    norm = tx.normalize_query(F.col("search_query"))
    span = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / piece_seconds)
    log = searches.where(lookback(F.col("ts"), end, days) & F.col("search_query").isNotNull())
    log = log.select(USER, "ts", "search_id", "search_query", span.alias("piece"))
    cut = by_key(log, [USER, "piece"], ["ts", "search_id"], piece_rows)
    queries = cut.select(USER, "piece", F.col(SLICE).alias("part"), "ts", "search_id", norm.alias("q"))
    ordered = F.array_sort(F.collect_list(F.struct("ts", "search_id", "q")))
    return queries.groupBy(USER, "piece", "part").agg(
        F.concat_ws(" ", F.transform(ordered, lambda r: r["q"])).alias("queries_text")
    )


def search_features(searches: DataFrame, end: str, keywords: Sequence[str] = PRODUCT_KEYWORDS) -> DataFrame:
    rollup = query_rollup(searches, end)
    return join_blocks([search_statistics(rollup, end, keywords), query_length_median(rollup)])


# --- prices and categories ---------------------------------------------------


def effective_price() -> Column:
    return F.when(F.col("discount_price") > 0, F.col("discount_price")).otherwise(F.col("price"))


def discount_ratio() -> Column:
    price, low = F.col("price"), F.col("discount_price")
    fits = (price > 0) & (low >= 0) & (low <= price)
    return F.when(fits, (price - low) / price).otherwise(0.0)


def is_discounted() -> Column:
    return F.when(F.col("price") > F.col("discount_price"), 1).otherwise(0)


def product_events(actions: DataFrame, products: DataFrame, end: str, days: int = 120) -> DataFrame:
    """Events of the window that name a product, with the product's attributes."""
    log = actions.where(lookback(F.col("ts"), end, days) & F.col("product_id").isNotNull())
    return log.join(products, "product_id", "left").select(
        "*",
        effective_price().alias("effective_price"),
        discount_ratio().alias("discount_ratio"),
        is_discounted().alias("is_discounted"),
    )


def price_features(actions: DataFrame, products: DataFrame, end: str) -> DataFrame:
    priced = product_events(actions, products, end).where(F.col("action_type").isin(PRICE_ACTIONS))
    stats = priced.groupBy(USER).agg(
        F.avg("effective_price").alias("avg_viewed_price"),
        F.max("effective_price").alias("max_viewed_price"),
        F.avg("discount_ratio").alias("discount_ratio_mean"),
        F.avg("is_discounted").alias("fraction_discounted_products"),
    )
    middle = exact_quantiles(priced, [USER], "effective_price", {"median_viewed_price": 0.5})
    return join_blocks([stats, middle])


def category_counts(actions: DataFrame, products: DataFrame, end: str) -> DataFrame:
    return (
        product_events(actions, products, end)
        .where(F.col("action_type").isin(PRODUCT_ACTIONS) & F.col("category_id").isNotNull())
        .groupBy(USER, "category_id", "category_name")
        .agg(F.count(F.lit(1)).alias("category_event_count"))
    )


def entropy(count: str, total: str) -> Column:
    """Natural-log entropy of counts as an aggregate over (count, total) rows."""
    share = F.col(count) / F.col(total)
    return F.sum(F.when(share > 0, -share * F.log(share)).otherwise(0.0))


def totals_and_entropy(
    counts: DataFrame, count: str, total: str, favorite: str, share: str, entropy_name: str, unique: str | None = None
) -> DataFrame:
    """Per-user total, largest count, its share, number of groups, and entropy.

    Entropy comes from sums alone, H = ln(T) - sum(c ln c) / T, so no join of the
    totals back to the counts is needed.
    """
    c = F.col(count)
    aggs = [F.sum(c).alias(total), F.max(c).alias(favorite)]
    if unique:
        aggs.append(F.count(F.lit(1)).alias(unique))
    out = counts.groupBy(USER).agg(*aggs, F.sum(c * F.log(c)).alias("__clogc"))
    return out.withColumns(
        {
            share: F.col(favorite) / F.col(total),
            entropy_name: F.log(F.col(total)) - F.col("__clogc") / F.col(total),
        }
    ).drop("__clogc")


def category_totals(actions: DataFrame, products: DataFrame, end: str) -> DataFrame:
    return totals_and_entropy(
        category_counts(actions, products, end),
        "category_event_count",
        "total_category_events",
        "favorite_category_count",
        "favorite_category_share",
        "category_entropy",
        unique="unique_categories",
    )


def top_groups(counts: DataFrame, by: list[str], count: str, k: int, out: str) -> DataFrame:
    """The ``k`` most frequent groups; ties go to the smaller key."""
    return (
        counts.groupBy(*by)
        .agg(F.sum(count).alias(out))
        .orderBy(F.col(out).desc(), *[F.col(b).asc() for b in by])
        .limit(k)
    )


def top_share_pivot(
    counts: DataFrame, key: str, count: str, top: Sequence, prefix: str
) -> DataFrame:
    """Per-user share of each value in ``top``; absent is null.  One aggregate, no join."""
    total = F.sum(count)
    return (
        counts.groupBy(USER)
        .agg(
            F.max(F.col(key).isin(list(top))).alias("__any"),
            *[(F.sum(F.when(F.col(key) == v, F.col(count))) / total).alias(f"{prefix}{v}") for v in top],
        )
        .where("__any")
        .drop("__any")
    )


def category_features(actions: DataFrame, products: DataFrame, end: str, k: int = 10) -> DataFrame:
    counts = category_counts(actions, products, end)
    top = top_groups(counts, ["category_id", "category_name"], "category_event_count", k, "n")
    ids = [r["category_id"] for r in top.collect()]  # at most k rows: they name the output columns
    return join_blocks(
        [
            price_features(actions, products, end),
            category_totals(actions, products, end),
            top_share_pivot(counts, "category_id", "category_event_count", ids, "top_category_share_"),
        ]
    )


# --- trends -------------------------------------------------------------------


def trend_spans(end: str) -> dict[str, tuple[date, date]]:
    """First and last day of each trend window (exactly 7 or 30 days long)."""
    last = as_date(end)

    def back(n: int) -> date:
        return last - timedelta(days=n)

    return {
        "last_7d": (back(6), last),
        "prev_7d": (back(13), back(7)),
        "last_30d": (back(29), last),
        "prev_30d": (back(59), back(30)),
    }


# Action counted under each column stem.
TREND_ACTIONS = {"click_count": "click", "to_cart_count": "to_cart", "favorite_count": "favorite", "order_count": "order"}


def _by_window(log: DataFrame, value: str, spans: dict[str, tuple[date, date]], rows: str, distinct: str, kinds: dict[str, str]) -> DataFrame:
    """Per user and window: rows, rows of each kind of action, different values (a missing one counts as a value).

    One row per user and value first, with a bit for each window the value falls in, so distinct
    counts need no copy of the rows; all null where the user has no row in the window.
    """
    inside = {s: between_days(F.col("ts"), *days) for s, days in spans.items()}
    bits = F.lit(0)
    for i, within in enumerate(inside.values()):
        bits = bits + F.when(within, 1 << i).otherwise(0)
    sums = {f"{rows}_{s}": F.count_if(within) for s, within in inside.items()}
    sums |= {f"{stem}_{s}": F.count_if(within & (F.col("action_type") == kind)) for s, within in inside.items() for stem, kind in kinds.items()}
    each = log.groupBy(USER, value).agg(F.bit_or(bits).alias("__bits"), *[c.alias(n) for n, c in sums.items()])
    out = []
    for i, s in enumerate(spans):
        some = F.sum(f"{rows}_{s}") > 0
        out += [F.when(some, F.sum(f"{n}_{s}")).alias(f"{n}_{s}") for n in (rows, *kinds)]
        out.append(F.when(some, F.count_if(F.col("__bits").bitwiseAND(1 << i) > 0)).alias(f"{distinct}_{s}"))
    return each.groupBy(USER).agg(*out)


def trend_windows(actions: DataFrame, end: str) -> DataFrame:
    """Counts per window in one pass; all null where the user has no row in the window."""
    log = actions.where(lookback(F.col("ts"), end, 60))
    return _by_window(log, "product_id", trend_spans(end), "actions_count", "unique_products", TREND_ACTIONS)


def _delta(stem: str, out: str, span: str, ratio: bool = True) -> dict[str, Column]:
    now, before = F.col(f"{stem}_last_{span}"), F.col(f"{stem}_prev_{span}")
    cols = {f"{out}_trend_delta_{span}": now - before}
    if ratio:
        cols[f"{out}_trend_ratio_{span}"] = (now + 1) / (before + 1)
    return cols


def trend_delta_ratio(windows: DataFrame) -> DataFrame:
    return windows.withColumns(
        {
            **_delta("actions_count", "actions", "7d"),
            **_delta("click_count", "click", "7d"),
            **_delta("to_cart_count", "to_cart", "7d"),
            **_delta("order_count", "order", "30d"),
            **_delta("unique_products", "unique_products", "7d"),
        }
    )


def search_trend(searches: DataFrame, end: str) -> DataFrame:
    spans = {s: trend_spans(end)[s] for s in ("last_7d", "prev_7d")}
    log = searches.where(between_days(F.col("ts"), spans["prev_7d"][0], spans["last_7d"][1]))
    return _by_window(log, "search_query", spans, "search_count", "unique_searches", {}).withColumns(
        {
            **_delta("search_count", "search", "7d"),
            **_delta("unique_searches", "unique_searches", "7d", ratio=False),
        }
    )


def trend_features(actions: DataFrame, searches: DataFrame, end: str) -> DataFrame:
    return join_blocks([trend_delta_ratio(trend_windows(actions, end)), search_trend(searches, end)])


# --- search to action ------------------------------------------------------------


def union_events(searches: DataFrame, actions: DataFrame, end: str, days: int = 30) -> DataFrame:
    """Searches and actions of the window in one time line; a search sorts before an action at the same instant."""
    looked = searches.where(lookback(F.col("ts"), end, days)).select(
        USER, "ts", F.lit(0).alias("kind_rank"), F.col("search_id").alias("event_id"),
        F.lit(None).cast("string").alias("action_kind"),
    )
    acted = actions.where(
        lookback(F.col("ts"), end, days) & F.col("action_type").isin(CONVERSION_ACTIONS)
    ).select(USER, "ts", F.lit(1).alias("kind_rank"), "event_id", F.col("action_type").alias("action_kind"))
    return looked.unionByName(acted)


def asof_last_search(searches: DataFrame, actions: DataFrame, end: str, days: int = 30, limit: int | None = None) -> DataFrame:
    """For each action the user's last search at or before it, and the seconds since."""
    line = union_events(searches, actions, end, days).withColumn(
        "search_ts", F.when(F.col("kind_rank") == 0, F.col("ts"))
    )
    ordered = Ordered.per_key(line, [USER], ["ts", "kind_rank", "event_id"], **({"limit": limit} if limit else {}))
    return (
        ordered.last_known(last_search_ts="search_ts")
        .result()
        .where((F.col("kind_rank") == 1) & F.col("last_search_ts").isNotNull())
        .select(
            USER, "event_id", "ts", "action_kind", "last_search_ts",
            whole_seconds(F.col("ts"), F.col("last_search_ts")).alias("secs_since_last_search"),
        )
    )


def search_conversion(searches: DataFrame, actions: DataFrame, end: str, days: int = 30) -> DataFrame:
    after = asof_last_search(searches, actions, end, days)
    secs = F.col("secs_since_last_search")
    aggs = []
    for kind, label in (("click", "click"), ("to_cart", "cart")):
        for minutes in (5, 30, 60):
            aggs.append(
                F.count_if((F.col("action_kind") == kind) & (secs <= minutes * 60)).alias(
                    f"search_to_{label}_{minutes}m_count"
                )
            )
    for kind, label in (("click", "click"), ("to_cart", "cart")):
        aggs.append(F.avg(F.when(F.col("action_kind") == kind, secs)).alias(f"mean_secs_search_to_{label}"))
    counts = (
        searches.where(lookback(F.col("ts"), end, days)).groupBy(USER).agg(F.count(F.lit(1)).alias("search_events_30d"))
    )
    joined = join_blocks([counts, after.groupBy(USER).agg(*aggs)])
    return joined.withColumns(
        {
            f"search_to_{label}_30m_rate": (F.col(f"search_to_{label}_30m_count") + 1) / (F.col("search_events_30d") + 1)
            for label in ("click", "cart")
        }
    )


# --- loyalty and widgets -------------------------------------------------------------


def loyalty(events: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """Repeat statistics of one attribute.

    ``names`` gives the output columns: unique, total, repeats, favorite, rate, share.
    """
    counts = events.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).groupBy(USER, key).agg(
        F.count(F.lit(1)).alias("__c")
    )
    return loyalty_of(counts, "__c", names)


def loyalty_of(counts: DataFrame, count: str, names: dict[str, str], more: Sequence[Column] = ()) -> DataFrame:
    """Repeat statistics from one row per user and value; ``more`` aggregates come along."""
    return (
        counts.groupBy(USER)
        .agg(
            F.count(F.lit(1)).alias(names["unique"]),
            F.sum(count).alias(names["total"]),
            F.count_if(F.col(count) > 1).alias(names["repeats"]),
            F.max(count).alias(names["favorite"]),
            *more,
        )
        .withColumns(
            {
                names["rate"]: F.col(names["repeats"]) / (F.col(names["unique"]) + 1),
                names["share"]: F.col(names["favorite"]) / F.col(names["total"]),
            }
        )
    )


# Output names of the three loyalty groups.
LOYALTY_NAMES = {
    "product_id": dict(unique="unique_products_120d", total="total_product_events_120d", repeats="repeat_products_120d",
                       favorite="favorite_product_cnt", rate="repeat_product_rate", share="favorite_product_share"),
    "category_id": dict(unique="unique_categories_120d", total="total_category_events_120d", repeats="repeat_categories_120d",
                        favorite="favorite_category_cnt_120d", rate="repeat_category_rate", share="favorite_category_share_120d"),
    "brand": dict(unique="unique_brands_120d", total="total_brand_events_120d", repeats="repeat_brands_120d",
                  favorite="favorite_brand_cnt", rate="repeat_brand_rate", share="favorite_brand_share"),
}


def repeat_share_pivot(events: DataFrame, kinds: Sequence[str] = PRODUCT_ACTIONS) -> DataFrame:
    """(events - distinct products) / (events + 1) per action, one column per action."""
    per = events.groupBy(USER, "action_type").agg(
        ((F.count(F.lit(1)) - F.count_distinct("product_id")) / (F.count(F.lit(1)) + 1)).alias("__share")
    )
    return per.groupBy(USER).agg(
        *[F.max(F.when(F.col("action_type") == k, F.col("__share"))).alias(f"repeat_share_action_{k}") for k in kinds]
    )


def loyalty_features(actions: DataFrame, products: DataFrame, end: str) -> DataFrame:
    log = actions.where(lookback(F.col("ts"), end, 120) & F.col("product_id").isNotNull())
    events = log.join(products.select("product_id", "brand", "category_id"), "product_id", "left").select(
        USER, "product_id", "brand", "category_id", "action_type"
    )
    blocks = [loyalty(events, key, names) for key, names in LOYALTY_NAMES.items()]
    return join_blocks([*blocks, repeat_share_pivot(log)])


def widget_counts(actions: DataFrame, end: str) -> DataFrame:
    return (
        actions.where(lookback(F.col("ts"), end, 30) & F.col("widget_name_id").isNotNull())
        .groupBy(USER, "widget_name_id")
        .agg(F.count(F.lit(1)).alias("widget_cnt"))
    )


def widget_basic(actions: DataFrame, end: str) -> DataFrame:
    """Events, distinct widgets, most used (smallest on ties) and last widget."""
    log = actions.where(lookback(F.col("ts"), end, 30))
    place = F.when(F.col("widget_name_id").isNotNull(), F.struct("ts", "event_id"))
    per = log.groupBy(USER, "widget_name_id").agg(
        F.count(F.lit(1)).alias("__c"), F.max(place).alias("__place")
    )
    return widget_basic_of(per, "__c")


def widget_basic_of(per: DataFrame, count: str) -> DataFrame:
    """The same from one row per user and widget with its ``count`` and last ``__place``."""
    known = F.col("widget_name_id").isNotNull()
    return per.groupBy(USER).agg(
        F.sum(count).alias("widget_events_30d"),
        F.count(F.lit(1)).alias("unique_widgets_30d"),
        F.max_by("widget_name_id", F.when(known, F.struct(count, -F.col("widget_name_id")))).alias("favorite_widget_name_id"),
        F.max_by("widget_name_id", "__place").alias("last_widget_name_id"),
    )


def widget_share_entropy(actions: DataFrame, end: str) -> DataFrame:
    return totals_and_entropy(
        widget_counts(actions, end), "widget_cnt", "total_widget_cnt", "favorite_widget_cnt",
        "favorite_widget_share", "widget_entropy",
    )


def widget_features(actions: DataFrame, end: str, k: int = 20) -> DataFrame:
    counts = widget_counts(actions, end)
    top = top_groups(counts, ["widget_name_id"], "widget_cnt", k, "n")
    ids = [r["widget_name_id"] for r in top.collect()]  # at most k rows: they name the output columns
    return join_blocks(
        [
            widget_basic(actions, end),
            widget_share_entropy(actions, end),
            top_share_pivot(counts, "widget_name_id", "widget_cnt", ids, "top_widget_share_"),
        ]
    )


# --- assembly -----------------------------------------------------------------------------


def user_spine(labels: DataFrame | None = None, users: DataFrame | None = None) -> DataFrame:
    if labels is not None:
        return labels
    if users is not None:
        return users
    raise ValueError("either a label table or a user list is needed")


def assemble_blocks(
    spine: DataFrame, blocks: dict[str, DataFrame], suffix: str = "_right", categorical: Sequence[str] = ()
) -> DataFrame:
    """Left-join blocks on the user, fill texts by kind and sort the columns.

    A column name already taken gets ``suffix`` (again and again while taken).
    """
    out, taken = spine, set(spine.columns)
    for block in blocks.values():
        names = []
        for c in block.columns:
            new = c
            while c != USER and new in taken:
                new += suffix
            names.append(new)
        block = block.toDF(*names)
        taken.update(names)
        out = out.join(block, [USER], "left")
    return sort_columns(fill_by_type(out, categorical))


def fill_by_type(df: DataFrame, categorical: Sequence[str] = ()) -> DataFrame:
    """Text nulls become empty, categorical nulls "NONE"; numbers stay null."""
    chosen = [c for c in categorical if c in df.columns]
    texts = [n for n, t in df.dtypes if t == "string" and n not in chosen]
    return df.na.fill("NONE", chosen).na.fill("", texts) if chosen else df.na.fill("", texts)


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


CATEGORICAL = ["last_action", "last_2_action", "last_3_action", "last_3_actions_str"]
