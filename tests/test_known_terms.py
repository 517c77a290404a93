"""Word counts of a fitted model."""

from __future__ import annotations

from tallyloom.operators import text_features


def test_only_known_terms_are_counted(spark):
    rows = [(1, i, f"2024-01-0{1 + i % 5} 10:00:00", text) for i, text in enumerate(["red shoes", "blue shoes", "red shoes red", None, "shoes"])]
    searches = spark.createDataFrame(rows, "user_id long, search_id long, ts string, search_query string").selectExpr(
        "user_id", "search_id", "cast(ts AS timestamp_ntz) AS ts", "search_query"
    )
    known = spark.createDataFrame([("shoes",), ("red shoes",), ("shoes blue",)], "term string")
    whole, _ = text_features.user_word_counts(searches, "2024-01-10", 30)
    few, _ = text_features.user_word_counts(searches, "2024-01-10", 30, known=known)
    want = {(r["term"], r["tf"]) for r in whole.collect() if r["term"] in ("shoes", "red shoes", "shoes blue")}
    assert {(r["term"], r["tf"]) for r in few.collect()} == want and len(want) == 3
