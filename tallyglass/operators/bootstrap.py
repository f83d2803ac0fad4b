"""Model comparison by a bootstrap that runs as one job for all models, replicates and metrics.

Sampling with replacement at a fraction is a Poisson count per row. The counts come from a digest of
key and replicate, so a retried task draws the same numbers. One digest serves eight replicates;
rows with count zero leave before the shuffle; the rest is pre-aggregated to distinct scores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.numeric import percent_change
from tallyglass.operators import scoring
from tallyglass.operators.sampling import poisson_count, poisson_steps

# 32-bit words in one SHA-256 digest.
WORDS = 8

# A metric is a Column over auc, tp, fp, fn, tn (weighted sums of one replicate).
METRICS: dict[str, Callable[[], Column]] = {
    "auc": lambda: F.col("auc"),
    "accuracy": scoring.accuracy,
    "f1": scoring.support_weighted_f1,
}


def replicate_counts(
    df: DataFrame, key: str, replicates: int, fraction: float, salt: str | Column = ""
) -> DataFrame:
    """``df`` with ``replicate`` and ``copies`` (> 0): each row once per replicate that drew it."""
    prefix = F.lit(salt) if isinstance(salt, str) else salt
    last_block = (replicates - 1) // WORDS
    text = F.concat(prefix, F.col(key).cast("string"), F.lit("-"), F.col("_block").cast("string"))
    words = F.array(*[F.substring("_digest", 8 * i + 1, 8) for i in range(WORDS)])
    drawn = (
        df.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(last_block))))
        .withColumn("_digest", F.sha2(text, 256))
        .select(*df.columns, "_block", F.posexplode(words).alias("_i", "_word"))
    )
    # The first step is what a row must reach to be drawn at all.
    drawn = drawn.filter(F.col("_word") >= F.lit(poisson_steps(fraction)[0]))
    counted = drawn.select(
        *df.columns,
        (F.col("_block") * WORDS + F.col("_i")).alias("replicate"),
        poisson_count(F.col("_word"), fraction).alias("copies"),
    )
    return counted.filter(f"copies > 0 and replicate < {replicates}")


def bootstrap_metrics(
    predictions: DataFrame,
    replicates: int = 1000,
    fraction: float = 0.1,
    metrics: dict[str, Callable[[], Column]] | None = None,
    weight: str | None = "weight",
    paired: bool = False,
    bins: int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """(model, metric, replicate, value). ``paired`` draws the same rows for every model."""
    metrics = metrics or METRICS
    narrow = predictions.select("model", "key", "label", "score", "prediction", *([weight] if weight else []))
    if spread:
        narrow = narrow.repartition(spread, "key")
    salt = F.lit("") if paired else F.concat(F.col("model"), F.lit("-"))
    drawn = replicate_counts(narrow, "key", replicates, fraction, salt)
    copies = F.col("copies") * (F.col(weight) if weight else F.lit(1.0))
    cells = scoring.score_cells(drawn, ["model", "replicate"], copies, bins=bins)
    table = scoring.area_and_counts(cells, ["model", "replicate"])
    wide = table.select("model", "replicate", *[build().alias(name) for name, build in metrics.items()])
    return wide.unpivot(["model", "replicate"], list(metrics), "metric", "value")


def intervals(values: DataFrame, ci: float = 95.0) -> DataFrame:
    """Percentile interval per model and metric, linear interpolation; one row per replicate feeds it."""
    tail = (100.0 - ci) / 200.0
    bounds = F.percentile("value", F.array(F.lit(tail), F.lit(1 - tail)))
    table = values.groupBy("model", "metric").agg(bounds.alias("b"), F.count("value").alias("replicates"))
    return table.select(
        "model", "metric", F.col("b")[0].alias("low"), F.col("b")[1].alias("high"), "replicates"
    )


def point_estimates(
    predictions: DataFrame,
    metrics: dict[str, Callable[[], Column]] | None = None,
    weight: str | None = "weight",
    bins: int | None = None,
) -> DataFrame:
    metrics = metrics or METRICS
    table = scoring.area_and_counts(scoring.score_cells(predictions, ["model"], weight, bins=bins), ["model"])
    wide = table.select("model", *[build().alias(name) for name, build in metrics.items()])
    return wide.unpivot(["model"], list(metrics), "metric", "point")


def bootstrap_ci(
    predictions: DataFrame,
    replicates: int = 1000,
    ci: float = 95.0,
    fraction: float = 0.1,
    metrics: dict[str, Callable[[], Column]] | None = None,
    weight: str | None = "weight",
    paired: bool = False,
    bins: int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """(model, metric, low, high, point) for every model in ``predictions``.

    ``bins`` trades the exact area for one over that many score steps, with much smaller cells.
    ``spread`` shuffles the narrow rows to that many tasks before the fan-out over replicates, which
    pays when the input has few or uneven splits.
    """
    values = bootstrap_metrics(predictions, replicates, fraction, metrics, weight, paired, bins, spread)
    drawn = intervals(values, ci)
    return drawn.join(point_estimates(predictions, metrics, weight, bins), ["model", "metric"])


def compare(table: DataFrame, baseline: str = "baseline", candidate: str = "candidate") -> DataFrame:
    """Disjoint intervals decide: improved is true, false, or null when they overlap."""
    sides = [
        table.filter(F.col("model") == name).select(
            "metric", *[F.col(c).alias(f"{side}_{c}") for c in ("point", "low", "high")]
        )
        for name, side in ((baseline, "base"), (candidate, "cand"))
    ]
    better = F.when(F.col("base_high") < F.col("cand_low"), True).when(
        F.col("cand_high") < F.col("base_low"), False
    )
    change = percent_change(F.col("cand_point"), F.col("base_point"))
    return sides[0].join(sides[1], "metric").withColumns({"improved": better, "change_percent": change})


def verdict(comparison: DataFrame) -> DataFrame:
    """Tally over the metrics and the decision: deploy, keep or inconclusive."""
    tally = comparison.agg(
        F.count_if(F.col("improved")).alias("improvements"),
        F.count_if(~F.col("improved")).alias("deteriorations"),
        F.count_if(F.col("improved").isNull()).alias("inconclusive"),
    )
    decision = (
        F.when(F.col("improvements") > F.col("deteriorations"), "deploy")
        .when(F.col("deteriorations") > F.col("improvements"), "keep")
        .otherwise("inconclusive")
    )
    return tally.withColumn("decision", decision)
