"""The model job: train, search, compare with the champion by bootstrap, promote."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.operators import bootstrap, cleaning, sampling, scoring, training
from tallyglass.schema import LABEL, MODEL_FEATURES
from tallyglass.sources.modelstore import ModelStore
from tallyglass.workspace import materialize

ROWS_PER_TASK = 20_000
METRIC_NAMES = ["auc", "accuracy", "precision", "recall", "f1", "f1_weighted"]


def spread(stored: DataFrame, key: str) -> DataFrame:
    """Stored rows in as many files as their number asks for, dealt and ordered by key; few rows stay as they are.

    A forest reads its rows once per level and tree group, so two tasks for half a million rows leave a cluster idle.
    Row order decides a forest's draws; here it follows the key, not the order in which a shuffle arrives.
    """
    tasks = min(stored.count() // ROWS_PER_TASK, 4 * stored.sparkSession.sparkContext.defaultParallelism)
    if tasks <= stored.rdd.getNumPartitions():
        return stored
    return materialize(stored.repartition(tasks, key).sortWithinPartitions(key), "model-rows")


def prepare(rows: DataFrame, key: str = "transaction_id", weighting: str = "balanced") -> tuple[DataFrame, DataFrame]:
    """Weighted train and test rows, 80 to 20 by key hash, stored once for all following fits.

    What makes ``rows`` runs once, for their columns here, and apart from the join of the weights: in one
    generated method with it, it can outgrow what the JVM compiles.
    """
    narrow = rows.select(key, *MODEL_FEATURES, LABEL).persist()
    if weighting == "balanced":
        weighted = sampling.with_balanced_weight(narrow)
    else:
        weighted = narrow.withColumn("weight", sampling.constant_class_weight())
    stored = materialize(weighted.select(key, *MODEL_FEATURES, LABEL, "weight"), "model-rows")
    narrow.unpersist()
    return sampling.hash_split(spread(stored, key), key)


def missing_values(rows: DataFrame) -> DataFrame:
    """Columns with nulls, from one pass."""
    return cleaning.null_counts(rows).filter("null_count > 0")


def _metrics(table: DataFrame) -> dict[str, float]:
    row = table.select(*METRIC_NAMES).first()
    return {name: row[name] for name in METRIC_NAMES if row[name] is not None}


def train(
    rows: DataFrame, store: ModelStore, run_name: str, model: str, model_type: str = "rf",
    grid: dict[str, list] | None = None, key: str = "transaction_id", parallelism: int = 4,
) -> tuple[int, str]:
    """Grid search, evaluation on held-out rows, run log, registration and first promotion."""
    train_rows, test_rows = prepare(rows, key)
    pipeline = training.build_pipeline(MODEL_FEATURES, model_type, "weight")
    search_grid = grid if grid is not None else (training.GRID if model_type == "rf" else {"regParam": [0.0, 0.1]})
    fitted = training.cross_validate(train_rows, pipeline, key, search_grid, weight="weight", parallelism=parallelism)
    best = fitted.bestModel
    metrics = _metrics(training.evaluate_model(best, test_rows, model, key))
    run_id = f"{run_name}-{dt.datetime.now():%Y%m%d%H%M%S%f}"
    chosen = {p.name: v for p, v in best.stages[-1].extractParamMap().items() if p.name in search_grid}
    store.log_run(run_id, run_name, metrics=metrics, params={f"best_{k}": v for k, v in chosen.items()})
    return store.promote(model, run_id, metrics.get("auc", float("nan")), best)


def challenge(
    rows: DataFrame, store: ModelStore, run_name: str, model: str, trials: list[dict] | None = None,
    replicates: int = 100, fraction: float = 0.1, key: str = "transaction_id", parallelism: int = 4,
) -> str | None:
    """Search a candidate and test it against the champion; None without a champion, else the decision."""
    champion = store.load(model)
    if champion is None:
        return None
    train_rows, test_rows = prepare(rows, key)
    table = training.search(train_rows, test_rows, MODEL_FEATURES, key, "weight", trials, parallelism)
    candidate, params = training.refit_best(train_rows, table, MODEL_FEATURES, "weight")
    scored = training.score(champion, test_rows, "baseline", key, "weight").unionByName(
        training.score(candidate, test_rows, "candidate", key, "weight")
    )
    predictions = materialize(scored, "ab-predictions")
    intervals = bootstrap.bootstrap_ci(predictions, replicates, 95.0, fraction)
    outcome = bootstrap.verdict(bootstrap.compare(intervals)).first().asDict()
    held_out = predictions.filter(F.col("model") == "candidate")
    metrics = _metrics(scoring.evaluate(held_out, ["model"], "weight"))
    run_id = f"{run_name}-{dt.datetime.now():%Y%m%d%H%M%S%f}"
    tally = {k: outcome[k] for k in ("improvements", "deteriorations", "inconclusive")}
    store.log_run(run_id, run_name, metrics={**metrics, **tally}, params=params, texts={"decision": outcome["decision"]})
    if outcome["decision"] == "deploy":
        store.promote(model, run_id, metrics["auc"], candidate)
    return outcome["decision"]
