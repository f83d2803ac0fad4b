"""Fraud classifiers on Spark ML: pipeline, grid search with cross validation, random search, evaluation."""

from __future__ import annotations

import random
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.operators import forest, registry, scoring
from tallyglass.operators.sampling import hash_fold
from tallyglass.schema import LABEL, TARGET_COLUMNS

# Grid, folds, seed, and the search space (low, high, step; step None is continuous).
GRID = {"numTrees": [10, 20], "maxDepth": [5, 10]}
FOLDS = 3
SEED = 42
SEARCH_SPACE = {
    "numTrees": (50, 200, 10),
    "maxDepth": (5, 15, 1),
    "maxBins": (20, 50, 5),
    "minInstancesPerNode": (1, 10, 1),
    "subsamplingRate": (0.6, 1.0, None),
    "featureSubsetStrategy": ["auto", "sqrt", "log2"],
    "impurity": ["gini", "entropy"],
}
TRIALS = 15


class Fits:
    """Models of a grid by place, each fitted in the thread that asks for it; ``end`` is called after the last."""

    def __init__(self, fit: Callable, n: int, end: Callable):
        self.fit, self.end, self.places, self.open, self.lock = fit, end, iter(range(n)), n, threading.Lock()

    def __iter__(self):
        return self

    def __next__(self):
        place = next(self.places)
        try:
            return place, self.fit(place)
        finally:
            with self.lock:
                self.open -= 1
                if not self.open:
                    self.end()


class SharedSteps(Pipeline):
    """A pipeline of which all but the last stage are fitted, and their rows kept, once for a grid of the last stage's parameters."""

    def fitMultiple(self, dataset, paramMaps):  # noqa: N802, N803 - Spark's names
        *steps, last = self.getStages()
        if any(not last.hasParam(p.name) or last.getParam(p.name) != p for point in paramMaps for p in point):
            return super().fitMultiple(dataset, paramMaps)
        ready = Pipeline(stages=steps).fit(dataset)
        rows = ready.transform(dataset).select(*{last.getOrDefault(p) for p in ("featuresCol", "labelCol", "weightCol") if last.isDefined(p)}).persist()
        return Fits(lambda i: PipelineModel([*ready.stages, last.fit(rows, paramMaps[i])]), len(paramMaps), rows.unpersist)


def build_pipeline(
    features: list[str], model_type: str = "rf", weight: str | None = None, label: str = LABEL, **params
) -> Pipeline:
    """Assemble, standardise, classify. Labels and weights must not be features."""
    leaking = set(features) & {*TARGET_COLUMNS, label, weight}
    if leaking:
        raise ValueError(f"label-derived columns among the features: {sorted(leaking)}")
    assembler = VectorAssembler(inputCols=features, outputCol="features_raw")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    shared = {"labelCol": label, "featuresCol": "features", **({"weightCol": weight} if weight else {})}
    if model_type == "rf":
        classifier = RandomForestClassifier(**shared, **{"seed": SEED, "numTrees": 10, "maxDepth": 5, **params})
    elif model_type == "lr":
        classifier = LogisticRegression(**shared, **params)
    else:
        raise ValueError("model_type must be rf or lr")
    return SharedSteps(stages=[assembler, scaler, classifier])


def parameter_grid(pipeline: Pipeline, grid: dict[str, list] | None = None) -> list[dict]:
    classifier = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in (grid or GRID).items():
        builder = builder.addGrid(classifier.getParam(name), values)
    return builder.build()


def cross_validate(
    df: DataFrame,
    pipeline: Pipeline,
    key: str,
    grid: dict[str, list] | None = None,
    folds: int = FOLDS,
    weight: str | None = None,
    label: str = LABEL,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Grid search by area under ROC. Folds follow a key hash, so they survive re-partitioning."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", **({"weightCol": weight} if weight else {})
    )
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=parameter_grid(pipeline, grid),
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    return validator.fit(df.withColumn("fold", hash_fold(key, folds)))


def grid_results(spark: SparkSession, fitted: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its parameters and mean area under ROC."""
    rows = [
        (i, {p.name: str(v) for p, v in point.items()}, float(metric))
        for i, (point, metric) in enumerate(zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics))
    ]
    return spark.createDataFrame(rows, "trial_id int, params map<string,string>, auc double")


def score(model: PipelineModel, df: DataFrame, name: str, key: str, weight: str | None = None, label: str = LABEL) -> DataFrame:
    """Long predictions (model, key, label, weight, score, prediction) for the metric operators."""
    scored = model.transform(df)
    probability = vector_to_array("probability")[1]
    return scored.select(
        F.lit(name).alias("model"),
        F.col(key).alias("key"),
        F.col(label).alias("label"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
        probability.alias("score"),
        "prediction",
    )


def evaluate_model(
    model: PipelineModel, test: DataFrame, name: str, key: str, weight: str | None = None, label: str = LABEL
) -> DataFrame:
    return scoring.evaluate(score(model, test, name, key, weight, label), ["model"], weight and "weight")


def draw_trials(n: int = TRIALS, seed: int = SEED, space: dict | None = None) -> list[dict]:
    """Seeded random points of the search space."""
    source = random.Random(seed)
    points = []
    for _ in range(n):
        point = {}
        for name, choice in (space or SEARCH_SPACE).items():
            if isinstance(choice, list):
                point[name] = source.choice(choice)
            elif choice[2] is None:
                point[name] = source.uniform(choice[0], choice[1])
            else:
                point[name] = source.randrange(choice[0], choice[1] + 1, choice[2])
        points.append(point)
    return points


def search(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    key: str,
    weight: str | None = None,
    trials: list[dict] | None = None,
    parallelism: int = 4,
    label: str = LABEL,
) -> DataFrame:
    """Trials table (trial_id, params, auc, precision, recall, f1, status, loss).

    Each trial is a set of Spark jobs submitted from a driver thread; the data never leaves the
    executors. Rows are assembled and scaled once, as that is the same for all trials. Many rows are counted once in the
    cells that forests tell apart, and trials grow and judge their trees from these. A failed trial keeps its row, with status and the worst loss.
    """
    spark = train.sparkSession
    points = trials if trials is not None else draw_trials()

    kept, cells, held_out, broken = [], None, None, None
    try:
        ready = Pipeline(stages=build_pipeline(features, "rf", weight, label).getStages()[:-1]).fit(train)
        used = ["features", label, *([weight] if weight else [])]
        kept = [ready.transform(df).select(*{*columns, *used}).persist() for df, columns in ((train, []), (test, [key]))]
        bins = {b for point in points if isinstance(b := point.get("maxBins", 32), int) and b > 1}  # 32 is Spark's
        cells, held_out = forest.train_and_test_cells(*kept, label, weight, sorted(bins), len(features), SEED) or (None, None)
    except Exception as error:  # noqa: BLE001 - every trial fails by it, below
        broken = error

    def run(item: tuple[int, dict]) -> tuple:
        number, point = item
        text = {k: str(v) for k, v in point.items()}
        try:
            if broken:
                raise broken
            classifier = build_pipeline(features, "rf", weight, label, **point).getStages()[-1]
            unseen, by = kept[1], weight
            if forest.served(classifier, cells):
                model = forest.fit(classifier, spark, cells)
                if held_out:
                    by = weight or "weight"
                    unseen = forest.as_rows(held_out[classifier.getMaxBins()], spark, key, label, by)
            else:
                model = classifier.fit(kept[0])
            row = evaluate_model(model, unseen, "trial", key, by, label).first()
            return number, text, row["auc"], row["precision"], row["recall"], row["f1"], "ok"
        except Exception as error:  # noqa: BLE001 - one bad trial must not end the search
            return number, text, None, None, None, None, f"failed: {type(error).__name__}: {str(error)[:500]}"

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(run, enumerate(points)))
    for df in kept:
        df.unpersist()
    schema = (
        "trial_id int, params map<string,string>, auc double, precision double, recall double, f1 double, status string"
    )
    return registry.objective(spark.createDataFrame(rows, schema))


def typed_params(text: dict[str, str]) -> dict:
    """Parameters of a stored trial with their Python types."""
    numeric = {k: (float(v) if SEARCH_SPACE[k][2] is None else int(v)) for k, v in text.items() if isinstance(SEARCH_SPACE[k], tuple)}
    return {**text, **numeric}


def refit_best(
    train: DataFrame, trials: DataFrame, features: list[str], weight: str | None = None, label: str = LABEL
) -> tuple[PipelineModel, dict]:
    """Fit the best trial's parameters on all training rows. An error if no trial succeeded."""
    if trials.filter("status = 'ok'").isEmpty():
        raise ValueError("no trial succeeded: " + str([r.status for r in trials.select("status").limit(3).collect()]))
    params = typed_params(registry.best_trial(trials).first()["params"])
    return build_pipeline(features, "rf", weight, label, **params).fit(train), params
