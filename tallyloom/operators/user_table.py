"""The wide table of users, from one rollup of each log.

Every counting block of the table needs the log only through (user, action, product,
widget): a count per window, the first and last instant, the last place in the log.
So the log is folded once to such rows, products are joined once to the folded rows,
and the blocks are aggregates over them, grouped by user, product, category, brand
or widget.  The fold is keyed by four columns and combined before its shuffle, so a
user with a third of all rows meets no single task.  Work that needs the order of
events (sessions, last actions, searches before actions) reads the log itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.time import between_days, days_until, lookback
from tallyloom.operators import behaviour as b
from tallyloom.operators.quantiles import exact_quantiles
from tallyloom.operators.text_features import TextModel
from tallyloom.session import cut_lineage

USER = b.USER
#: Days of history of the rollup: the longest window of a block.
HISTORY = 120


def action_rollup(actions: DataFrame, products: DataFrame, end: str) -> DataFrame:
    """One row per (user, action, product, widget) of the last ``HISTORY`` days with the product's attributes.

    ``n`` counts rows, ``n7`` and ``n30`` those of the last week and month, ``n_<window>`` those of the trend windows;
    a missing product or widget is a value of its own.
    """
    ts = F.col("ts")
    windows = {"n7": lookback(ts, end, 7), "n30": lookback(ts, end, 30)}
    windows |= {f"n_{s}": between_days(ts, *span) for s, span in b.trend_spans(end).items()}
    rows = (
        actions.where(lookback(ts, end, HISTORY))
        .groupBy(USER, "action_type", "product_id", "widget_name_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(w).alias(name) for name, w in windows.items()],
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.max(F.when(windows["n30"], F.struct("ts", "event_id"))).alias("place"),
        )
    )
    columns = ["product_id", "price", "discount_price", "category_id", "category_name", "brand"]
    return rows.join(products.select(*columns), "product_id", "left").select(
        "*", b.effective_price().alias("effective_price"), b.discount_ratio().alias("discount_ratio"), b.is_discounted().alias("is_discounted")
    )


def _number(name: str, where: Column) -> Column:
    return F.sum(F.when(where, F.col(name)).otherwise(0))


def _mean(value: str, where: Column) -> Column:
    known = where & F.col(value).isNotNull()
    return F.try_divide(F.sum(F.when(known, F.col(value) * F.col("n"))).cast("double"), _number("n", known).cast("double"))


def by_user(rollup: DataFrame, end: str) -> dict[str, DataFrame]:
    """Basic, intent and price columns of one aggregate, apart by block."""
    kind = F.col("action_type")
    priced = F.col("product_id").isNotNull() & kind.isin(b.PRICE_ACTIONS)
    aggs: dict[str, Column] = {"__basic": _number("n", kind.isin(b.BASIC_ACTIONS)), "__month": F.sum("n30"), "__week": F.sum("n7"), "__priced": _number("n", priced)}
    basic: dict[str, Column] = {}
    for a in b.BASIC_ACTIONS:
        is_a = kind == a
        aggs |= {
            f"__rows_{a}": _number("n", is_a),
            f"__n_{a}": _number("n", is_a & F.col("product_id").isNotNull()),
            f"__sum_{a}": F.sum(F.when(is_a, F.col("discount_price") * F.col("n"))),
            f"__max_{a}": F.max(F.when(is_a, F.col("discount_price"))),
            f"__last_{a}": F.max(F.when(is_a, F.col("last_ts"))),
            f"__first_{a}": F.min(F.when(is_a, F.col("first_ts"))),
        }
        seen = F.col(f"__rows_{a}") > 0
        basic |= {
            f"num_products_{a}": F.when(seen, F.col(f"__n_{a}")).cast("int"),
            f"sum_discount_price_{a}": F.when(seen, F.coalesce(f"__sum_{a}", F.lit(0.0))),
            f"max_discount_price_{a}": F.col(f"__max_{a}"),
            f"days_since_last_{a}": days_until(end, F.col(f"__last_{a}")),
            f"days_since_first_{a}": days_until(end, F.col(f"__first_{a}")),
        }
    for a, window in (("to_cart", "n7"), ("click", "n7"), ("to_cart", "n30"), ("view", "n30"), ("search", "n30"), ("click", "n30")):
        aggs[f"__{window}_{a}"] = _number(window, kind == a)
    week, month = F.col("__week") > 0, F.col("__month") > 0
    intent = {
        "add_to_cart_count_7d": F.when(week, F.col("__n7_to_cart")),
        "product_clicks_7d": F.when(week, F.col("__n7_click")),
        "add_to_cart_count_30d": F.when(month, F.col("__n30_to_cart")),
        "view_count_30d": F.when(month, F.col("__n30_view")),
        "search_count_30d": F.when(month, F.col("__n30_search")),
        "click_count_30d": F.when(month, F.col("__n30_click")),
        "cart_to_click_ratio": F.when(month, b.cart_click_ratio("__n30_to_cart", "__n30_click")),
    }
    price = {
        "avg_viewed_price": _mean("effective_price", priced),
        "max_viewed_price": F.max(F.when(priced, F.col("effective_price"))),
        "discount_ratio_mean": _mean("discount_ratio", priced),
        "fraction_discounted_products": _mean("is_discounted", priced),
    }
    users = rollup.groupBy(USER).agg(*[c.alias(n) for n, c in (aggs | price).items()])
    users = users.select(USER, *[c.alias(n) for n, c in (basic | intent).items()], *price)
    return {"basic": users.select(USER, *basic), "intent": users.select(USER, *intent), "price": users.select(USER, *price)}


def by_product(rollup: DataFrame, kinds: Sequence[str] = b.PRODUCT_ACTIONS) -> dict[str, DataFrame]:
    """Trend windows and product loyalty from one row per user and product."""
    kind = F.col("action_type")
    spans = list(b.trend_spans("2000-01-01"))
    sums = {"__n": F.sum("n")} | {f"__of_{a}": _number("n", kind == a) for a in kinds}
    for s in spans:
        sums[f"actions_count_{s}"] = F.sum(f"n_{s}")
        sums |= {f"{stem}_{s}": _number(f"n_{s}", kind == a) for stem, a in b.TREND_ACTIONS.items()}
    each = rollup.groupBy(USER, "product_id").agg(*[c.alias(n) for n, c in sums.items()])
    names, named = b.LOYALTY_NAMES["product_id"], F.col("product_id").isNotNull()
    trend: list[Column] = []
    for s in spans:
        some = F.sum(f"actions_count_{s}") > 0
        trend += [F.when(some, F.sum(f"{n}_{s}")).alias(f"{n}_{s}") for n in ("actions_count", *b.TREND_ACTIONS)]
        trend.append(F.when(some, F.count_if(F.col(f"actions_count_{s}") > 0)).alias(f"unique_products_{s}"))
    windows = each.groupBy(USER).agg(*trend)
    repeats = []
    for a in kinds:
        rows = F.sum(f"__of_{a}")
        repeats.append(F.when(rows > 0, (rows - F.count_if(F.col(f"__of_{a}") > 0)) / (rows + 1)).alias(f"repeat_share_action_{a}"))
    loyal = b.loyalty_of(each.where(named), "__n", names, repeats)
    return {"trend": b.trend_delta_ratio(windows), "loyalty": loyal}


def by_category(rollup: DataFrame, top: Sequence) -> dict[str, DataFrame]:
    used = F.col("product_id").isNotNull() & F.col("category_id").isNotNull()
    acted = F.col("action_type").isin(b.PRODUCT_ACTIONS)
    each = rollup.where(used).groupBy(USER, "category_id", "category_name").agg(F.sum("n").alias("__n"), _number("n", acted).alias("category_event_count"))
    counts = each.where("category_event_count > 0")
    totals = b.totals_and_entropy(
        counts, "category_event_count", "total_category_events", "favorite_category_count", "favorite_category_share", "category_entropy", unique="unique_categories"
    )
    shares = b.top_share_pivot(counts, "category_id", "category_event_count", top, "top_category_share_")
    per_id = each.groupBy(USER, "category_id").agg(F.sum("__n").alias("__n"))
    return {"price": b.join_blocks([totals, shares]), "loyalty": b.loyalty_of(per_id, "__n", b.LOYALTY_NAMES["category_id"])}


def by_brand(rollup: DataFrame) -> DataFrame:
    branded = rollup.where(F.col("product_id").isNotNull() & (F.col("brand") != ""))
    return b.loyalty_of(branded.groupBy(USER, "brand").agg(F.sum("n").alias("__n")), "__n", b.LOYALTY_NAMES["brand"])


def by_widget(rollup: DataFrame, top: Sequence) -> DataFrame:
    known = F.col("widget_name_id").isNotNull()
    each = rollup.where("n30 > 0").groupBy(USER, "widget_name_id").agg(F.sum("n30").alias("widget_cnt"), F.max(F.when(known, F.col("place"))).alias("__place"))
    basic = b.widget_basic_of(each, "widget_cnt")
    counts = each.where(known)
    entropy = b.totals_and_entropy(counts, "widget_cnt", "total_widget_cnt", "favorite_widget_cnt", "favorite_widget_share", "widget_entropy")
    return b.join_blocks([basic, entropy, b.top_share_pivot(counts, "widget_name_id", "widget_cnt", top, "top_widget_share_")])


def _ids(counts: DataFrame, by: list[str], count: str, k: int) -> list:
    """The ``k`` most frequent groups; their ids name the output columns."""
    return [r[0] for r in b.top_groups(counts, by, count, k, "__uses").collect()]


def action_blocks(rollup: DataFrame, actions: DataFrame, end: str, categories: int = 10, widgets: int = 20) -> dict[str, DataFrame]:
    """All blocks of the action log that need no order of events but the last ones; the rollup is fixed first."""
    rollup = cut_lineage(rollup)
    users, products = by_user(rollup, end), by_product(rollup)
    acted = F.col("product_id").isNotNull() & F.col("action_type").isin(b.PRODUCT_ACTIONS) & F.col("category_id").isNotNull()
    top = _ids(rollup.where(acted), ["category_id", "category_name"], "n", categories)
    category = by_category(rollup, top)
    priced = rollup.where(F.col("product_id").isNotNull() & F.col("action_type").isin(b.PRICE_ACTIONS))
    middle = exact_quantiles(priced, [USER], "effective_price", {"median_viewed_price": 0.5}, weight="n")
    used = rollup.where("widget_name_id IS NOT NULL AND n30 > 0")
    return {
        "basic": users["basic"],
        "intent": b.join_blocks([users["intent"], b.session_stats(actions, end), b.last_k_actions(actions, end)]),
        "price": b.join_blocks([users["price"], middle, category["price"]]),
        "trend": products["trend"],
        "loyalty": b.join_blocks([products["loyalty"], category["loyalty"], by_brand(rollup)]),
        "widget": by_widget(rollup, _ids(used, ["widget_name_id"], "n30", widgets)),
    }


def user_feature_table(
    actions: DataFrame,
    searches: DataFrame,
    products: DataFrame,
    feature_end: str,
    target: tuple[str, str] | None = None,
    users: DataFrame | None = None,
    keywords: Sequence[str] = b.PRODUCT_KEYWORDS,
    include: Sequence[str] = ("intent", "search", "price", "trend", "conversion", "loyalty", "widget"),
    extra_blocks: dict[str, DataFrame] | None = None,
    text_model: TextModel | None = None,
) -> DataFrame:
    """One wide row per labelled (or given) user.

    With a ``text_model`` the search block has the components of the users' texts; terms, weights and vectors are
    those of the period it learnt from.
    """
    spine = b.user_spine(b.target_label(actions, *target) if target else None, users)
    made = action_blocks(action_rollup(actions, products, feature_end), actions, feature_end)
    rollup = cut_lineage(b.query_rollup(searches, feature_end)) if "search" in include else None

    def search() -> DataFrame:
        parts = [b.search_statistics(rollup, feature_end, keywords), b.query_length_median(rollup)]
        return b.join_blocks(parts + ([text_model.components(searches, feature_end)] if text_model else []))

    build = {
        "search": search,
        "trend": lambda: b.join_blocks([made["trend"], b.search_trend(searches, feature_end)]),
        "conversion": lambda: b.search_conversion(searches, actions, feature_end),
    }
    blocks = {
        "basic": made["basic"],
        "search_basic": b.search_basic_features(searches, feature_end),
        **{name: build[name]() if name in build else made[name] for name in include},
        **(extra_blocks or {}),
    }
    return b.assemble_blocks(spine, blocks, categorical=b.CATEGORICAL)


def temporal_datasets(
    actions: DataFrame, searches: DataFrame, products: DataFrame, splits: dict[str, tuple[str, tuple[str, str] | None]],
    users: DataFrame | None = None, **options,
) -> DataFrame:
    """The same table for several (feature date, label window) pairs, stacked with a ``split`` column.

    A split without a label window is built for ``users`` and has a null target. A ``text_model`` among the options
    serves all splits; fit it on the period of the first.
    """
    out = None
    for name, (end, target) in splits.items():
        part = user_feature_table(
            actions, searches, products, end, target, None if target else users, **options
        ).withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
