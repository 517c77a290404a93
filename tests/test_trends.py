"""Trend windows count different values without copying the log."""

from __future__ import annotations

from tallyloom.operators import behaviour


def test_distinct_values_by_bits(spark):
    rows = [
        (1, "2024-01-30 10:00:00", 5, "click"), (1, "2024-01-29 10:00:00", 5, "order"), (1, "2024-01-30 11:00:00", None, "click"),
        (1, "2024-01-20 09:00:00", 5, "click"), (1, "2024-01-20 09:00:00", 6, None), (2, "2023-12-15 00:00:00", None, "favorite"), (3, "2023-01-01 00:00:00", 1, "click"),
    ]
    actions = spark.createDataFrame(rows, "user_id long, ts string, product_id long, action_type string").selectExpr(
        "user_id", "cast(ts AS timestamp_ntz) AS ts", "product_id", "action_type"
    )
    out = behaviour.trend_windows(actions, "2024-01-31")
    got = {r["user_id"]: r.asDict() for r in out.collect()}
    assert set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one["actions_count_last_7d"], one["unique_products_last_7d"], one["click_count_last_7d"], one["order_count_last_7d"]) == (3, 2, 2, 1)
    assert (one["actions_count_prev_7d"], one["unique_products_prev_7d"]) == (2, 2)
    assert (one["actions_count_last_30d"], one["unique_products_last_30d"], one["unique_products_prev_30d"]) == (5, 3, None)
    assert two["actions_count_last_7d"] is None and (two["unique_products_prev_30d"], two["favorite_count_prev_30d"]) == (1, 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
