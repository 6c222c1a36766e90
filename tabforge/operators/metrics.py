"""Exact metrics over a prediction table.

Threshold-free metrics first shrink the table to one row per distinct score, with
map-side combining, then run a bucketed running total; no window ever spans all
rows. ``by`` columns (run, fold, class) are carried through every metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabforge.functions.moments import correlation
from tabforge.operators.prefix import running_totals


def _zero_div(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def _cells(df: DataFrame, label: str, pred: str, by: Sequence[str]) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1, sensitivity, specificity; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return _cells(df, label, pred, by).select(
        *by,
        "tn",
        "fp",
        "fn",
        "tp",
        _zero_div(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        _zero_div(tp, tp + fp).alias("precision"),
        _zero_div(tp, tp + fn).alias("recall"),
        _zero_div(tp * 2, tp * 2 + fp + fn).alias("f1_score"),
        _zero_div(tp, tp + fn).alias("sensitivity"),
        _zero_div(tn, tn + fp).alias("specificity"),
    )


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision, recall, F1, support, with macro and weighted averages."""
    cells = confusion(df, label, pred)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    actual = cells.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    guessed = cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("guesses"))
    rows = (
        actual.join(guessed, "class", "full")
        .na.fill(0, ["support", "hits", "guesses"])
        .select(
            F.col("class").cast("string").alias("class"),
            _zero_div(F.col("hits"), F.col("guesses")).alias("precision"),
            _zero_div(F.col("hits"), F.col("support")).alias("recall"),
            _zero_div(F.col("hits") * 2, F.col("guesses") + F.col("support")).alias("f1_score"),
            F.col("support").cast("long").alias("support"),
        )
    )
    measures = ("precision", "recall", "f1_score")
    macro = rows.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = rows.agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    tagged = [part.select(F.lit(t).alias("class"), *measures, "support") for t, part in (("macro avg", macro), ("weighted avg", weighted))]
    return rows.unionByName(tagged[0]).unionByName(tagged[1])


def score_counts(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under ROC; a tied pair counts one half. NULL where one class is absent."""
    run = running_totals(score_counts(df, label, score, by), "score", ["neg"], by)
    pairs = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return run.groupBy(*by).agg(
        F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )


def curve_points(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One row per threshold: tp, fp at or above it, with ROC and PR coordinates."""
    by = list(by)
    counts = score_counts(df, label, score, by)
    run = running_totals(counts, "score", ["pos", "neg"], by, descending=True)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    if by:
        both = run.join(F.broadcast(totals), by)
        p, n = F.col("_p"), F.col("_n")
    else:
        both = run
        t = totals.select(F.struct("*").alias("t")).scalar()
        p, n = t["_p"], t["_n"]
    tp, fp = F.col("pos_to"), F.col("neg_to")
    return both.select(
        *by,
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        F.try_divide(tp.cast("double"), p).alias("tpr"),
        F.try_divide(fp.cast("double"), n).alias("fpr"),
        _zero_div(tp, tp + fp).alias("precision"),
        F.try_divide(tp.cast("double"), p).alias("recall"),
    )


def auc_one_vs_rest(df: DataFrame, label: str, class_scores: dict) -> DataFrame:
    """Support-weighted one-vs-rest AUC from one score column per class."""
    arms = F.array(
        *[
            F.struct(
                F.lit(str(c)).alias("class"),
                (F.col(label) == F.lit(c)).cast("int").alias("y"),
                F.col(col).cast("double").alias("s"),
            )
            for c, col in class_scores.items()
        ]
    )
    # Shrinks to one row per (class, score) in the map-side combine of score_counts.
    long = df.select(F.explode(arms).alias("a")).select("a.*")
    per_class = roc_auc(long, "y", "s", by=["class"])
    return per_class.agg(
        (F.sum(F.col("auc") * F.col("n_pos")) / F.sum(F.when(F.col("auc").isNotNull(), F.col("n_pos")))).alias("auc_weighted"),
        F.avg("auc").alias("auc_macro"),
    )


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """R2, MSE, RMSE, MAE, explained variance and bias in one pass.

    Central sums come from the variance aggregates, which are stable where
    raw sums of squares would cancel.
    """
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    e = y - p
    mse = F.avg(e * e)
    var_y = F.var_pop(y)
    return df.groupBy(*by).agg(
        F.count(e).alias("n"),
        (F.lit(1.0) - F.try_divide(mse, var_y)).alias("r2_score"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.var_pop(e), var_y)).alias("explained_variance"),
        F.avg(-e).alias("bias"),
    )


def residual_summary(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    return df.agg(
        F.avg(y - p).alias("residual_mean"),
        F.stddev_pop(y - p).alias("residual_std"),
        correlation(y, p).alias("corr_actual_predicted"),
    )


def multi_target_metrics(df: DataFrame, targets: dict[str, tuple[str, str]], baseline: dict[str, float] | None = None) -> DataFrame:
    """Metrics per target plus their average row.

    ``targets``: name -> (label column, prediction column). ``baseline``: earlier R2
    per target, giving the improvement in percent.
    """
    arms = F.array(
        *[
            F.struct(F.lit(t).alias("target"), F.col(a).cast("double").alias("y"), F.col(b).cast("double").alias("p"))
            for t, (a, b) in targets.items()
        ]
    )
    long = df.select(F.explode(arms).alias("a")).select("a.*")
    per = regression_metrics(long, "y", "p", by=["target"]).select("target", "r2_score", "mse", "mae", "explained_variance")
    mean = per.agg(*[F.avg(c).alias(c) for c in per.columns[1:]]).select(F.lit("average").alias("target"), "*")
    out = per.unionByName(mean)
    if baseline:
        ref = F.create_map(*[F.lit(v) for kv in baseline.items() for v in kv])
        out = (
            out.withColumn("_b", F.try_element_at(ref, F.col("target")))
            .withColumn("improvement_pct", (F.col("r2_score") - F.col("_b")) / F.col("_b") * 100.0)
            .drop("_b")
        )
    return out


def confidence(probabilities: Column) -> Column:
    """Largest class probability."""
    return F.array_max(probabilities)
