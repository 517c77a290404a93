"""The wide table from rollups against the blocks built one by one, and the text model against a dense SVD."""

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import behaviour as b
from tallyloom.operators import user_table as ut
from tallyloom.operators.text_features import TextModel, word_tfidf
from tallyloom.plans.registry import Tables

END, TARGET = "2024-01-20", ("2024-01-21", "2024-01-30")
FOLDER = "/root/testdata/sf0.001"


def rows(df):
    frame = df.toPandas()
    return frame.sort_values("user_id").reset_index(drop=True)[sorted(frame.columns)]


def same(left, right):
    left, right = rows(left), rows(right)
    assert list(left.columns) == list(right.columns) and len(left) == len(right)
    for c in left.columns:
        pairs = zip(left[c].tolist(), right[c].tolist(), strict=True)
        for x, y in pairs:
            if isinstance(x, str) or isinstance(y, str) or x is None or y is None:
                assert x == y or (x != x or x is None) and (y != y or y is None), c
            else:
                assert x == y or np.isclose(x, y, rtol=1e-12, atol=1e-12) or (x != x and y != y), (c, x, y)


def test_rollup_blocks_equal_blocks_of_the_log(spark):
    t = Tables(spark, FOLDER)
    apart = {
        "basic": b.action_basic_features(t.actions, t.products, END),
        "search_basic": b.search_basic_features(t.searches, END),
        "intent": b.intent_features(t.actions, END),
        "search": b.search_features(t.searches, END, ["the", "ein"]),
        "price": b.category_features(t.actions, t.products, END),
        "trend": b.trend_features(t.actions, t.searches, END),
        "conversion": b.search_conversion(t.searches, t.actions, END),
        "loyalty": b.loyalty_features(t.actions, t.products, END),
        "widget": b.widget_features(t.actions, END),
    }
    spine = b.target_label(t.actions, *TARGET)
    wide = ut.user_feature_table(t.actions, t.searches, t.products, END, target=TARGET, keywords=["the", "ein"])
    assert any(c.startswith("top_category_share_") for c in wide.columns)
    assert any(c.startswith("top_widget_share_") for c in wide.columns)
    same(wide, b.assemble_blocks(spine, apart, categorical=b.CATEGORICAL))


def test_a_hot_user_and_an_empty_log(spark):
    t = Tables(spark, FOLDER)
    hot = t.actions.withColumn("user_id", F.when(F.col("event_id") % 3 > 0, F.lit(7)).otherwise(F.col("user_id")).cast(t.actions.schema["user_id"].dataType))
    wide = ut.user_feature_table(hot, t.searches, t.products, END, users=hot.select("user_id").distinct(), include=("trend", "loyalty"))
    apart = {
        "basic": b.action_basic_features(hot, t.products, END), "search_basic": b.search_basic_features(t.searches, END),
        "trend": b.trend_features(hot, t.searches, END), "loyalty": b.loyalty_features(hot, t.products, END),
    }
    same(wide, b.assemble_blocks(hot.select("user_id").distinct(), apart))
    none = t.actions.limit(0)
    users = t.actions.select("user_id").distinct()
    empty = ut.user_feature_table(none, t.searches, t.products, END, users=users, include=("intent", "price", "widget"))
    assert empty.count() == users.count() and empty.where("num_products_click IS NOT NULL").count() == 0


def test_few_scans(spark):
    t = Tables(spark, FOLDER)
    wide = ut.user_feature_table(t.actions, t.searches, t.products, END, target=TARGET, keywords=["the"])
    wide.collect()
    plan = wide._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") <= 11


def test_text_model_against_a_dense_svd(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.01")
    first, later = "2024-01-10", "2024-01-20"
    model = TextModel.fit(t.searches, first, components=4, max_features=300)
    long = word_tfidf(t.searches, first, max_features=300).toPandas()
    dense = long.pivot(index="user_id", columns="term", values="weight").fillna(0.0)
    _, values, right = np.linalg.svd(dense.to_numpy(), full_matrices=False)
    assert list(dense.columns) == [r.term for r in model.table.orderBy("term").collect()]
    got = model.components(t.searches, first).toPandas().set_index("user_id").loc[dense.index].to_numpy()
    expected = dense.to_numpy() @ right[:1].T
    # The first component is the best separated: equal up to its sign; the rest span as much of the table.
    assert np.abs(np.abs(got[:, :1]) - np.abs(expected)).max() < 1e-4
    assert np.square(got).sum() > 0.995 * np.square(values[:4]).sum()

    model.write(str(tmp_path / "model"))
    again = TextModel.read(spark, str(tmp_path / "model"))
    same(model.components(t.searches, later), again.components(t.searches, later))

    terms = {r.term: (r.idf, np.array(r.vector)) for r in model.table.collect()}
    from tallyloom.operators.text_features import user_word_counts

    counts = user_word_counts(t.searches, later)[0].toPandas()
    user = counts["user_id"].iloc[0]
    known = [(1 + np.log(tf)) * terms[term][0] * np.array([1.0, *terms[term][1]]) for term, tf in counts[counts.user_id == user][["term", "tf"]].itertuples(index=False) if term in terms]
    w = np.array(known)
    plain = w[:, 1:].sum(axis=0) / np.sqrt(np.square(w[:, 0]).sum())
    row = model.components(t.searches, later).where(F.col("user_id") == int(user)).toPandas().drop(columns="user_id").to_numpy()[0]
    assert np.allclose(row, plain)
