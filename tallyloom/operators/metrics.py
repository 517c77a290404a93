"""Evaluation of scores and labels from cumulative counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.functions.numeric import sigmoid
from tallyloom.operators.quantiles import cumulative_counts
from tallyloom.operators.slices import Ordered, by_range


def validate_binary_target(df: DataFrame, label: str) -> DataFrame:
    """The frame itself; raises unless the labels are exactly 0 and 1."""
    y = F.col(label)
    seen = df.agg(F.max((y == 0).cast("int")), F.max((y == 1).cast("int")),
                  F.count_if(y.isNull() | ~y.isin(0, 1))).first()
    if (seen[0], seen[1], seen[2]) != (1, 1, 0):
        raise ValueError(f"{label} must contain exactly the labels 0 and 1")
    return df


def margin_to_probability(margin: Column) -> Column:
    return sigmoid(margin)


def confusion_counts(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((label == 1) & (predicted == 1)),
        "fp": F.count_if((label == 0) & (predicted == 1)),
        "fn": F.count_if((label == 1) & (predicted == 0)),
        "tn": F.count_if((label == 0) & (predicted == 0)),
    }


def _share(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def metric_columns() -> dict[str, Column]:
    """Metrics from tp, fp, fn, tn; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    recall, specificity = _share(tp, tp + fn), _share(tn, tn + fp)
    return {
        "accuracy": _share(tp + tn, tp + fp + fn + tn),
        "balanced_accuracy": (recall + specificity) / 2,
        "f1": _share(2 * tp, 2 * tp + fp + fn),
        "precision": _share(tp, tp + fp),
        "recall": recall,
        "mcc": _share(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))),
    }


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    hit = (F.col(score) >= threshold).cast("int")
    counts = df.agg(*[c.alias(n) for n, c in confusion_counts(F.col(label), hit).items()])
    return counts.select(*[c.alias(n) for n, c in metric_columns().items()])


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    cells = df.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("__n"))
    return cells.select(label, predicted, (F.col("__n") / F.sum("__n").over(W.partitionBy())).alias("share"))


def score_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score: positives and negatives at it and up to it."""
    by_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(score)
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return Ordered(by_range(by_score, score), [], [F.col(score)]).running_sum(pos_upto="pos", neg_upto="neg").result()


def _totals(df: DataFrame, label: str, score: str) -> tuple[int, int]:
    row = df.where(F.col(score).isNotNull()).agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    if not row[0] or not row[1]:
        raise ValueError("both classes are needed")
    return row[0], row[1]


def roc_auc(df: DataFrame, label: str, score: str, name: str = "roc_auc") -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half."""
    pos, neg = _totals(df, label, score)
    below = F.col("neg_upto") - F.col("neg")
    won = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2))
    return score_steps(df, label, score).agg((won / (float(pos) * float(neg))).alias(name))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate of the rule score >= threshold."""
    pos, neg = _totals(df, label, score)
    return score_steps(df, label, score).select(
        F.col(score).alias("threshold"),
        ((F.lit(neg) - F.col("neg_upto") + F.col("neg")) / neg).alias("fpr"),
        ((F.lit(pos) - F.col("pos_upto") + F.col("pos")) / pos).alias("tpr"),
    )


def average_precision(df: DataFrame, label: str, score: str, name: str = "average_precision") -> DataFrame:
    pos, neg = _totals(df, label, score)
    above_pos = F.lit(pos) - F.col("pos_upto") + F.col("pos")
    above_neg = F.lit(neg) - F.col("neg_upto") + F.col("neg")
    return score_steps(df, label, score).agg(
        F.sum(F.col("pos") / pos * (above_pos / (above_pos + above_neg))).alias(name)
    )


def _cross_entropy(label: str, probability: str) -> Column:
    eps = 2.220446049250313e-16
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    return -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))


def log_loss(df: DataFrame, label: str, probability: str, name: str = "log_loss") -> DataFrame:
    return df.agg(F.avg(_cross_entropy(label, probability)).alias(name))


def probability_report(df: DataFrame, label: str, probability: str) -> tuple[float, float, float]:
    """(ROC AUC, average precision, log loss) of predicted probabilities from one set of cumulative counts."""
    totals = df.agg(
        F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0), F.avg(_cross_entropy(label, probability))
    ).first()
    pos, neg, loss = totals
    if not pos or not neg:
        raise ValueError("both classes are needed")
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_upto") - F.col("neg") / 2))
    above_pos = F.lit(pos) - F.col("pos_upto") + F.col("pos")
    above_neg = F.lit(neg) - F.col("neg_upto") + F.col("neg")
    precision = F.sum(F.col("pos") / pos * (above_pos / (above_pos + above_neg)))
    row = score_steps(df, label, probability).agg(won / (float(pos) * float(neg)), precision).first()
    return row[0], row[1], loss


def regression_error(df: DataFrame, label: str, predicted: str) -> DataFrame:
    mse = F.avg((F.col(label) - F.col(predicted)) * (F.col(label) - F.col(predicted)))
    return df.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"))


def threshold_grid(df: DataFrame, score: str, most: int = 400) -> DataFrame:
    """All distinct scores, or ``most`` evenly spaced quantiles when there are more."""
    scores = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).select(score)
    distinct = scores.distinct()
    if distinct.limit(most + 1).count() <= most:
        return distinct.select(F.col(score).cast("double").alias("threshold"))
    steps = most - 1
    ranked = cumulative_counts(scores, [], score)
    last_place = F.col("__total") - 1
    first, after = F.col("__upto") - F.col("__n"), F.col("__upto")
    # Quantile i sits at i * last_place / steps; its lower and upper neighbours are whole places.
    ceil_div = lambda a, b: F.floor((a + b - 1) / b)
    low_from, low_to = ceil_div(first * steps, last_place), ceil_div(after * steps, last_place) - 1
    up_from = F.floor((first - 1) * steps / last_place) + 1
    up_to = F.floor((after - 1) * steps / last_place)

    def covered(start: Column, stop: Column, name: str) -> DataFrame:
        start, stop = F.greatest(start, F.lit(0)), F.least(stop, F.lit(steps))
        hit = ranked.where(start <= stop)
        return hit.select(F.explode(F.sequence(start, stop)).alias("i"), F.col(score).cast("double").alias(name), last_place.alias(f"n_{name}"))

    both = covered(low_from, low_to, "lo").join(covered(up_from, up_to, "hi").drop("n_hi"), "i")
    place = F.col("i") * F.col("n_lo") / steps
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (place - F.floor(place))
    return both.select(value.alias("threshold")).distinct()


def _interval(number: Column, points: list[float], at_or_below: bool) -> Column:
    """How many points are <= (or <) the number, by bisection."""

    def descend(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        left = number < points[mid] if at_or_below else number <= points[mid]
        return F.when(left, descend(lo, mid)).otherwise(descend(mid + 1, hi))

    return descend(0, len(points))


def threshold_curve(
    df: DataFrame, label: str, score: str, metric: str = "f1", positive_if_ge: bool = True, most: int = 400
) -> DataFrame:
    """(threshold, value): one pass over the scores against at most ``most`` thresholds."""
    metrics = metric_columns()
    if metric not in metrics:
        raise ValueError(f"{metric} has no value per threshold; choose one of {sorted(metrics)}")
    points = sorted(r[0] for r in threshold_grid(df, score, most).collect())  # at most ``most`` numbers
    cell = _interval(F.col(score).cast("double"), points, at_or_below=positive_if_ge)
    cells = df.where(F.col(score).isNotNull()).groupBy(cell.alias("cell")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    spark = df.sparkSession
    grid = spark.createDataFrame(list(enumerate(points)), "cell int, threshold double")
    # A short table from here on: one row per threshold (and one cell below the first).
    edge = spark.createDataFrame([(len(points), None)], "cell int, threshold double")
    line = grid.unionByName(edge).join(cells, "cell", "left").na.fill(0, ["pos", "neg"])
    upto = W.orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy()
    low_pos, low_neg = F.sum("pos").over(upto), F.sum("neg").over(upto)
    all_pos, all_neg = F.sum("pos").over(whole), F.sum("neg").over(whole)
    if positive_if_ge:  # cells 0..i hold scores below threshold i
        counts = {"tp": all_pos - low_pos, "fp": all_neg - low_neg, "fn": low_pos, "tn": low_neg}
    else:  # cells 0..i hold scores at or below threshold i
        counts = {"tp": low_pos, "fp": low_neg, "fn": all_pos - low_pos, "tn": all_neg - low_neg}
    return (
        line.select("threshold", *[c.alias(n) for n, c in counts.items()])
        .where(F.col("threshold").isNotNull())
        .select("threshold", metrics[metric].alias("value"))
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """Largest metric value and the lowest threshold reaching it."""
    return curve.agg(
        F.max_by("threshold", F.struct(F.col("value"), -F.col("threshold"))).alias("best_threshold"),
        F.max("value").alias("best_value"),
    )
