import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.operators import bootstrap, sampling, scoring


@pytest.fixture(scope="module")
def preds(spark, sf_dir):
    return adapters.predictions(spark, sf_dir).cache()


@pytest.mark.parametrize("weight", [None, "weight"])
def test_area_equals_the_exact_evaluator(preds, weight):
    got = {r.model: r.auc for r in scoring.area_under_roc(preds, ["model"], weight).collect()}
    for model in ("baseline", "candidate"):
        rows = preds.filter(F.col("model") == model).withColumn("label", F.col("label").cast("double"))
        extra = {"weightCol": weight} if weight else {}
        exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0, **extra).evaluate(rows)
        assert got[model] == pytest.approx(exact, abs=1e-12)


def test_multiclass_equals_the_evaluator(spark):
    rng = random.Random(3)
    rows = [(1, float(rng.randrange(3)), float(rng.randrange(3)), float(rng.randrange(1, 4))) for _ in range(200)]
    df = spark.createDataFrame(rows, "g int, label double, prediction double, w double")
    row = scoring.class_f1(df, ["g"], weight="w").first()
    for name, value in (("accuracy", row.accuracy), ("f1", row.f1_weighted)):
        exact = MulticlassClassificationEvaluator(metricName=name, weightCol="w").evaluate(df)
        assert value == pytest.approx(exact, abs=1e-12)


def test_binary_and_multiclass_f1_agree(preds):
    one = {r.model: r.f1_weighted for r in scoring.evaluate(preds, ["model"], "weight").collect()}
    two = {r.model: r.f1_weighted for r in scoring.class_f1(preds, ["model"], weight="weight").collect()}
    assert one == pytest.approx(two)


def test_empty_denominators(spark):
    rows = spark.createDataFrame([(1, 0, 0.1, 0.0), (1, 0, 0.2, 0.0)], "g int, label int, score double, prediction double")
    row = scoring.evaluate(rows, ["g"]).first()
    assert (row.precision, row.recall, row.f1, row.accuracy, row.auc) == (0.0, 0.0, 0.0, 1.0, None)


def test_class_weights(spark):
    rows = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "tx_fraud int")
    weights = {r.tx_fraud: r.weight for r in sampling.class_weights(rows).collect()}
    assert weights == {1: 2.0, 0: pytest.approx(4 / 6)}
    assert sampling.with_balanced_weight(rows).filter("tx_fraud is null").first().weight == 1.0
    single = spark.createDataFrame([(0,), (0,)], "tx_fraud int")
    assert [r.weight for r in sampling.class_weights(single).collect()] == [1.0]


def test_splits_and_samples(spark):
    rows = spark.range(1000).withColumn("g", F.col("id") % 2)
    train, test = sampling.hash_split(rows, "id")
    assert train.count() + test.count() == 1000 and 700 < train.count() < 900
    many = spark.range(20_000)
    for share in (0.95, 0.75, 0.04):
        assert abs(sampling.hash_split(many, "id", share)[0].count() / 20_000 - share) < 0.01
    again = sampling.hash_split(rows.repartition(7), "id")[0]
    assert train.exceptAll(again).count() == 0
    assert sampling.hash_sample(rows, "id", 10).count() == 10 and sampling.hash_sample(rows, "id", 5000).count() == 1000
    per_group = sampling.hash_sample(rows, "id", 3, by=["g"]).groupBy("g").count().collect()
    assert [r["count"] for r in per_group] == [3, 3]
    parts = sampling.random_split(rows)
    assert parts[0].count() + parts[1].count() == 1000
    assert 50 < sampling.sample_with_replacement(rows, 0.1, 1).count() < 150


def test_poisson_draws():
    steps = sampling.poisson_cdf(1.0)
    assert steps[0] == pytest.approx(0.36787944) and steps == sorted(steps) and 1 - steps[-1] <= 2**-34
    words = sampling.poisson_steps(1.0)
    assert words == sorted(words) and all(len(w) == 8 for w in words)


def test_replicates_are_repeatable_and_unbiased(spark):
    rows = spark.range(3000).withColumnRenamed("id", "key")
    drawn = bootstrap.replicate_counts(rows, "key", 6, 0.5)
    again = bootstrap.replicate_counts(rows.repartition(5), "key", 6, 0.5)
    assert drawn.exceptAll(again).count() == 0 and again.exceptAll(drawn).count() == 0
    totals = [r.n for r in drawn.groupBy("replicate").agg(F.sum("copies").alias("n")).collect()]
    assert len(totals) == 6 and all(1300 < t < 1700 for t in totals)


def test_interval_widens_with_a_smaller_fraction(preds):
    width = {}
    for fraction in (0.05, 0.8):
        table = bootstrap.bootstrap_ci(preds, 24, 95.0, fraction)
        row = table.filter("model = 'candidate' and metric = 'accuracy'").first()
        width[fraction] = row.high - row.low
        assert row.low <= row.point <= row.high
    assert width[0.05] > width[0.8]


def test_own_metric(preds):
    table = bootstrap.bootstrap_ci(preds, 8, 90.0, 0.5, metrics={"f2": lambda: scoring.f_beta(2.0)})
    assert {r.metric for r in table.collect()} == {"f2"}


@pytest.mark.parametrize(
    "base, cand, improved, decision",
    [((0.1, 0.2), (0.3, 0.4), True, "deploy"), ((0.3, 0.4), (0.1, 0.2), False, "keep"), ((0.1, 0.3), (0.2, 0.4), None, "inconclusive")],
)
def test_comparison(spark, base, cand, improved, decision):
    rows = [(m, "auc", sum(b) / 2, *b) for m, b in (("baseline", base), ("candidate", cand))]
    table = bootstrap.compare(spark.createDataFrame(rows, "model string, metric string, point double, low double, high double"))
    assert table.first().improved is improved
    assert bootstrap.verdict(table).first().decision == decision


def test_bootstrap_rows_are_aggregated_before_the_shuffle(preds):
    drawn = bootstrap.replicate_counts(preds.select("model", "key", "label", "score", "prediction"), "key", 8, 0.1)
    plan = scoring.score_cells(drawn, ["model", "replicate"], "copies")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan and "Python" not in plan


def test_limits(spark):
    rows = [("m", "2024-01-05 00:00:00", 1, 0.0, 600000.0), ("m", "2024-01-06 00:00:00", 0, 1.0, 5.0), ("m", "2024-02-01 00:00:00", 0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "model string, ts string, label int, prediction double, amount double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    table = {r.month: r for r in scoring.business_limits(df, ["model"]).collect()}
    assert (table["2024-01"].loss_ok, table["2024-01"].type_one_ok, table["2024-02"].loss_ok) == (0, 0, 1)
