"""Model decisions as queries over small append-only tables (one row per run, version or alias change).

``runs``: run_id, run_name, kind, key, value, ts. ``versions``: model, version, run_id, description, ts.
``aliases``: model, version, alias, source (``alias`` or ``tag``), ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.numeric import percent_change

# Legacy stages and their aliases; any other stage is lower-cased.
STAGE_ALIASES = {"Production": "champion", "Staging": "challenger", "Archived": "archived"}


def stage_alias(stage: Column) -> Column:
    pairs = [F.lit(x) for item in STAGE_ALIASES.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), stage), F.lower(stage))


def run_metrics(runs: DataFrame, names: list[str]) -> DataFrame:
    """Latest value of each named metric per run, one column each."""
    metrics = runs.filter((F.col("kind") == "metric") & F.col("key").isin(names))
    return metrics.groupBy("run_id").pivot("key", names).agg(F.max_by("value", "ts").cast("double"))


def number_versions(runs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Give each run of a model the next version number in time order, after the existing ones."""
    order = Window.partitionBy("model").orderBy("ts", "run_id")
    fresh = runs.withColumn("version", F.row_number().over(order))
    if existing is None:
        return fresh
    last = existing.groupBy("model").agg(F.max("version").alias("_last"))
    joined = fresh.join(last, "model", "left")
    return joined.withColumn("version", F.col("version") + F.coalesce("_last", F.lit(0))).drop("_last")


def promotion_history(versions: DataFrame, metric: str = "auc") -> DataFrame:
    """Alias of each version when it was registered.

    The first version of a model, or one strictly better than every earlier one, becomes champion;
    any other version challenger. A metric that is NaN counts as missing and beats nothing. ``improvement`` is the percent gain over the champion before it.
    """
    earlier = (
        Window.partitionBy("model").orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    )
    known = F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))
    versions = versions.withColumn(metric, known)
    order = Window.partitionBy("model").orderBy("version")
    better = F.col(metric) > F.coalesce(F.col("best_before"), F.lit(float("-inf")))
    promoted = (F.row_number().over(order) == 1) | F.coalesce(better, F.lit(False))
    return (
        versions.withColumn("best_before", F.max(metric).over(earlier))
        .withColumn("alias", F.when(promoted, "champion").otherwise("challenger"))
        .withColumn("improvement", F.when(promoted, percent_change(F.col(metric), F.col("best_before"))))
    )


def current_aliases(aliases: DataFrame) -> DataFrame:
    """The version each (model, alias) points to now: the latest change wins, then the higher version."""
    newest = aliases.groupBy("model", "alias").agg(F.max(F.struct("ts", "version")).alias("r"))
    return newest.select("model", "alias", F.col("r.version").alias("version"), F.col("r.ts").alias("ts"))


def resolve(aliases: DataFrame, alias: str = "champion") -> DataFrame:
    """Version per model behind ``alias``; a tag counts only when there is no true alias."""
    by_source = (
        aliases.filter(F.col("alias") == alias)
        .groupBy("model", "source")
        .agg(F.max(F.struct("ts", "version")).alias("r"))
    )
    rank = (F.col("source") == "alias").cast("int")
    chosen = by_source.groupBy("model").agg(F.max_by(F.struct("r.version", "source"), rank).alias("c"))
    return chosen.select("model", F.col("c.version").alias("version"), F.col("c.source").alias("source"))


def champion_metrics(aliases: DataFrame, versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Run id and headline metrics of each model's champion."""
    champions = resolve(aliases).join(versions.select("model", "version", "run_id"), ["model", "version"])
    return champions.join(run_metrics(runs, ["auc", "accuracy", "f1"]), "run_id", "left")


def objective(table: DataFrame) -> DataFrame:
    """Trial loss: 1 - (0.7 auc + 0.3 precision), the precision part only above 0.8 recall."""
    # The weights and the recall floor.
    bonus = F.when(F.col("recall") > 0.8, 0.3 * F.col("precision")).otherwise(0.0)
    score = 0.7 * F.col("auc") + bonus
    return table.withColumn("loss", F.coalesce(1 - score, F.lit(1.0)))


def leaderboard(trials: DataFrame) -> DataFrame:
    """All trials with their rank, best area first; trials without a result come last.

    One row per trial reaches the ranking window.
    """
    return trials.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("auc"), "trial_id")))


def best_trial(trials: DataFrame) -> DataFrame:
    """The row with the smallest loss; ties go to the smaller trial id."""
    row = F.struct(*trials.columns)
    best = trials.agg(F.min_by(row, F.struct("loss", "trial_id")).alias("r"))
    return best.select("r.*")


def quality_alerts(metrics: DataFrame, metric: str = "auc", drop: float = 0.02) -> DataFrame:
    """Versions whose metric fell by more than ``drop`` against the version before, and the roll-back target.

    The target is the latest earlier version that was not itself a fall.
    """
    order = Window.partitionBy("model").orderBy("version")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fell = F.coalesce(F.col(metric) < F.col("previous") - F.lit(drop), F.lit(False))
    return (
        metrics.withColumn("previous", F.lag(metric).over(order))
        .withColumn("alert", fell.cast("int"))
        .withColumn("valid", F.when(F.col("alert") == 0, F.col("version")))
        .withColumn("roll_back_to", F.when(F.col("alert") == 1, F.last("valid", ignorenulls=True).over(before)))
        .drop("valid")
    )
