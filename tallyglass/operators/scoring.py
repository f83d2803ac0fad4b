"""Quality of scored rows: confusion counts, ratios, area under ROC, class-weighted F1, limits.

Every function takes long predictions (group columns, label, prediction, score, optional weight)
and needs one aggregation over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.numeric import ratio_or
from tallyglass.operators.ranks import running_sums


def _weight(weight: str | Column | None) -> Column:
    return F.lit(1.0) if weight is None else (F.col(weight) if isinstance(weight, str) else weight).cast("double")


def confusion_columns(
    label: str = "label", prediction: str = "prediction", weight: str | Column | None = None
) -> dict[str, Column]:
    """The four cells as aggregate columns; counts without a weight, sums of weights with one."""
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    out = {}
    for name, (actual, predicted) in cells.items():
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        out[name] = F.count_if(hit) if weight is None else F.sum(F.when(hit, _weight(weight)).otherwise(0.0))
    return out


def confusion(df: DataFrame, by: list[str], weight: str | None = None, **names: str) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in confusion_columns(weight=weight, **names).items()])


def precision() -> Column:
    return ratio_or(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return ratio_or(F.col("tp"), F.col("tp") + F.col("fn"))


def f_beta(beta: float = 1.0) -> Column:
    """F-beta of the positive class over tp, fp, fn; 0 when nothing is right."""
    b2 = F.lit(beta * beta)
    return ratio_or((1 + b2) * F.col("tp"), (1 + b2) * F.col("tp") + b2 * F.col("fn") + F.col("fp"))


def accuracy() -> Column:
    return ratio_or(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"), None)


def support_weighted_f1() -> Column:
    """F1 of both classes, averaged by class support (binary case, over tp, fp, fn, tn)."""
    positive, negative = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    f_pos = ratio_or(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    f_neg = ratio_or(2 * F.col("tn"), 2 * F.col("tn") + F.col("fp") + F.col("fn"))
    return ratio_or(positive * f_pos + negative * f_neg, positive + negative, None)


def class_f1(
    df: DataFrame, by: list[str], label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Support-weighted F1 and accuracy for any number of classes."""
    pairs = df.groupBy(*by, F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).agg(
        F.sum(_weight(weight)).alias("w")
    )
    hit = F.when(F.col("y") == F.col("p"), F.col("w")).otherwise(0.0)
    zero = F.lit(0.0)
    roles = F.array(
        F.struct(F.col("y").alias("class"), hit.alias("tp"), F.col("w").alias("actual"), zero.alias("predicted")),
        F.struct(F.col("p").alias("class"), zero.alias("tp"), zero.alias("actual"), F.col("w").alias("predicted")),
    )
    classes = (
        pairs.select(*by, F.explode(roles).alias("r"))
        .groupBy(*by, "r.class")
        .agg(*[F.sum(f"r.{c}").alias(c) for c in ("tp", "actual", "predicted")])
    )
    f1 = ratio_or(2 * F.col("tp"), F.col("actual") + F.col("predicted"))
    return classes.groupBy(*by).agg(
        ratio_or(F.sum("tp"), F.sum("actual"), None).alias("accuracy"),
        ratio_or(F.sum(f1 * F.col("actual")), F.sum("actual"), None).alias("f1_weighted"),
    )


def score_cells(
    df: DataFrame, by: list[str], weight: str | Column | None = None, score: str = "score", bins: int | None = None
) -> DataFrame:
    """One row per distinct score with the four confusion weights (pre-aggregated map-side).

    ``bins`` rounds scores in [0, 1] down to that many steps: an approximate area from small cells.
    """
    cells = confusion_columns(weight=_weight(weight))
    value = F.col(score) if bins is None else F.floor(F.col(score) * bins) / F.lit(float(bins))
    return df.groupBy(*by, value.alias(score)).agg(*[c.alias(n) for n, c in cells.items()])


def area_and_counts(cells: DataFrame, by: list[str], score: str = "score") -> DataFrame:
    """Area under ROC (trapezoids over distinct scores) and total confusion weights per group."""
    sides = cells.withColumns({"pos": F.col("tp") + F.col("fn"), "neg": F.col("fp") + F.col("tn")})
    ranked = running_sums(sides, by, score, {"neg_below": "neg"}, label="scores")
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return ranked.groupBy(*by).agg(
        ratio_or(wins, F.sum("pos") * F.sum("neg"), None).alias("auc"),
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")],
    )


def area_under_roc(df: DataFrame, by: list[str], weight: str | None = None, score: str = "score") -> DataFrame:
    return area_and_counts(score_cells(df, by, weight, score), by, score).select(*by, "auc")


def evaluate(df: DataFrame, by: list[str], weight: str | None = None, bins: int | None = None) -> DataFrame:
    """All metrics of each group in one row, from one pass over the predictions."""
    table = area_and_counts(score_cells(df, by, weight, bins=bins), by)
    return table.select(
        *by,
        "auc",
        accuracy().alias("accuracy"),
        precision().alias("precision"),
        recall().alias("recall"),
        f_beta().alias("f1"),
        support_weighted_f1().alias("f1_weighted"),
        "tp",
        "fp",
        "fn",
        "tn",
    )


# Business targets for type-I error share, monthly loss and fraud share.
MAX_FALSE_POSITIVE_RATE = 0.05
MAX_MONTHLY_LOSS = 500_000.0
EXPECTED_FRAUD_SHARE = 0.02


def business_limits(df: DataFrame, by: list[str], time: str = "ts", amount: str = "amount") -> DataFrame:
    """Per month: false-positive rate, amount lost to missed fraud, fraud share, and the two checks."""
    missed = (F.col("label") == 1) & (F.col("prediction") == 0)
    monthly = df.groupBy(*by, F.date_format(time, "yyyy-MM").alias("month")).agg(
        *[c.alias(n) for n, c in confusion_columns().items()],
        F.sum(F.when(missed, F.col(amount)).otherwise(0.0)).alias("loss"),
    )
    rate = ratio_or(F.col("fp"), F.col("fp") + F.col("tn"))
    share = ratio_or(F.col("tp") + F.col("fn"), F.col("tp") + F.col("fn") + F.col("fp") + F.col("tn"))
    return monthly.select(
        *by,
        "month",
        rate.alias("false_positive_rate"),
        "loss",
        share.alias("fraud_share"),
        (rate <= MAX_FALSE_POSITIVE_RATE).cast("int").alias("type_one_ok"),
        (F.col("loss") <= MAX_MONTHLY_LOSS).cast("int").alias("loss_ok"),
        (share <= EXPECTED_FRAUD_SHARE).cast("int").alias("fraud_share_ok"),
    )
