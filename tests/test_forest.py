import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallyglass.operators import forest, training
from tallyglass.plans import modelling
from tallyglass.schema import MODEL_FEATURES


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.range(0, 24000, 1, 3).selectExpr(
        "id as k",
        "case when id % 3 = 0 then 0 else round(exp((id * 7919 % 1000) / 250.0), 2) end as x",
        "cast(id * 31 % 101 as double) as z",
        "cast((id * 7919 % 1000 > 700 and id % 5 < 3) or id % 31 = 0 as int) as tx_fraud",
        "case when id % 7 = 0 then 3.5d else 1.0d end as weight",
    )
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(table).persist()


@pytest.fixture(autouse=True)
def few_rows_suffice(monkeypatch):
    monkeypatch.setattr(forest, "ROWS_BY_CELL", 100)


@pytest.mark.parametrize("bins, depth, impurity, least", [(32, 5, "gini", 1), (20, 12, "entropy", 4), (45, 8, "gini", 10)])
def test_a_tree_has_the_nodes_of_sparks_tree(spark, rows, tmp_path, bins, depth, impurity, least):
    classifier = RandomForestClassifier(
        labelCol="tx_fraud", weightCol="weight", numTrees=2, seed=training.SEED, bootstrap=False,
        maxBins=bins, maxDepth=depth, impurity=impurity, minInstancesPerNode=least,
    )
    classifier.fit(rows).save(str(tmp_path / "model"))
    want = [r.nodeData.asDict(True) for r in spark.read.parquet(str(tmp_path / "model" / "data")).filter("treeID = 0").orderBy("nodeData.id").collect()]
    cells = forest.train_and_test_cells(rows, rows, "tx_fraud", "weight", [bins], 2, training.SEED)[0][bins]
    settings = {"impurity": impurity, "features": 2, "depth": depth, "min_gain": 0.0, "min_rows": least, "min_weight": 0.0}
    got = forest.grow(cells, cells.rows, settings, np.random.default_rng(0))
    assert cells.rows.sum() == 24000 and len(got) == len(want) > 5
    for a, b in zip(got, want):
        for name in ("id", "prediction", "rawCount", "leftChild", "rightChild"):
            assert a[name] == b[name]
        for name in ("impurity", "impurityStats", "gain"):
            assert a[name] == pytest.approx(b[name], abs=1e-9)
        assert a["split"]["featureIndex"] == b["split"]["featureIndex"]
        assert a["split"]["leftCategoriesOrThreshold"] == pytest.approx(b["split"]["leftCategoriesOrThreshold"])


def test_many_rows_are_read_once_for_all_trials(rows, monkeypatch):
    points = [{"numTrees": 20, "maxDepth": 6, "subsamplingRate": 0.7}, {"numTrees": 0}, {"numTrees": 15, "maxBins": 20, "impurity": "entropy"}, {"numTrees": 3, "subsamplingRate": 7.0}]
    args = (rows.drop("features"), rows.drop("features"), ["x", "z"], "k", "weight", points)
    monkeypatch.setattr(forest, "ROWS_BY_CELL", 10**9)
    by_rows = {r.trial_id: r for r in training.search(*args).collect()}
    monkeypatch.setattr(forest, "ROWS_BY_CELL", 100)
    fits, real = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: fits.append(self.getNumTrees()) or real(self, df))
    by_cells = {r.trial_id: r for r in training.search(*args).collect()}
    assert fits == [] or fits == [0]  # only the trial that no forest can serve
    for i in (0, 2):
        for name in ("auc", "precision", "recall", "f1"):
            assert by_cells[i][name] == pytest.approx(by_rows[i][name], abs=0.05)
    assert by_rows[0].status == by_cells[0].status == by_rows[2].status == by_cells[2].status == "ok"
    assert all(t[i].status.startswith("failed") and t[i].loss == 1.0 for t in (by_rows, by_cells) for i in (1, 3))


def test_cells_judge_a_forest_as_rows_do(spark, rows):
    classifier = RandomForestClassifier(labelCol="tx_fraud", weightCol="weight", numTrees=25, maxDepth=7, seed=training.SEED, subsamplingRate=0.8)
    train, held_out = rows.filter("k % 5 > 0"), rows.filter("k % 5 = 0")
    cells, unseen = forest.train_and_test_cells(train, held_out, "tx_fraud", "weight", [32], 2, training.SEED)
    model = forest.fit(classifier, spark, cells)
    assert model.getNumTrees == 25 and model.numClasses == 2 and model.numFeatures == 2 and model.getMaxDepth() == 7
    assert model.totalNumNodes == forest.fit(classifier, spark, cells).totalNumNodes
    want = training.evaluate_model(model, held_out, "m", "k", "weight").first().asDict()
    got = training.evaluate_model(model, forest.as_rows(unseen[32], spark, "k", "tx_fraud", "weight"), "m", "k", "weight").first().asDict()
    assert want.pop("model") == got.pop("model") and got == pytest.approx(want)
    assert {r.label for r in model.transform(held_out).select(F.col("prediction").alias("label")).distinct().collect()} == {0.0, 1.0}


def test_draws_are_poisson_counts_of_all_rows(rows):
    cells = forest.train_and_test_cells(rows, rows, "tx_fraud", None, [20], 2, training.SEED)[0][20]
    assert cells.rows.sum() == 24000 and cells.label @ cells.rows == rows.agg(F.sum("tx_fraud")).first()[0]
    settings = {"impurity": "gini", "features": 2, "depth": 2, "min_gain": 0.0, "min_rows": 1, "min_weight": 0.0}
    roots = [forest.grow(cells, (s := np.random.default_rng([1, t])).poisson(0.7 * cells.rows), settings, s)[0]["rawCount"] for t in range(200)]
    assert np.mean(roots) == pytest.approx(0.7 * 24000, rel=0.005) and np.var(roots) == pytest.approx(0.7 * 24000, rel=0.4)


def test_spark_fits_what_cells_do_not_serve(rows, monkeypatch):
    counted = lambda df, other=rows, bins=(32,), d=2: forest.train_and_test_cells(df, other, "tx_fraud", "weight", [*bins], d, training.SEED)
    assert counted(rows.withColumn("tx_fraud", F.col("k") % 3)) is None
    assert counted(rows.withColumn("tx_fraud", F.when(F.col("k") > 0, F.col("tx_fraud")))) is None
    assert counted(rows.withColumn("tx_fraud", F.lit(1))) is None
    assert counted(rows.withColumn("weight", F.col("k") + 1.0)) is None
    assert counted(rows.limit(50)) is None
    cells, held_out = counted(rows, rows.withColumn("weight", F.lit(None).cast("double")), (20, 400))
    assert list(cells) == [20] and held_out is None  # 400 * 400 * 4 cells would be too many
    serves = lambda **settings: forest.served(RandomForestClassifier(**{"maxBins": 20, **settings}), cells)
    assert serves() and serves(featureSubsetStrategy="log2") and not serves(maxBins=21) and not serves(numTrees=1)
    assert not serves(bootstrap=False) and not serves(featureSubsetStrategy="0.5") and not forest.served(RandomForestClassifier(), None)


def test_rows_are_made_once_for_the_models(spark):
    seen = spark.sparkContext.accumulator(0)

    def label(i):
        seen.add(1)
        return int(i % 7 == 0)

    made = spark.range(0, 700, 1, 2).select("id", F.udf(label, "int")("id").alias("tx_fraud"))
    table = made.selectExpr("id as transaction_id", "tx_fraud", *[f"cast(id as double) as {c}" for c in MODEL_FEATURES])
    train, test = modelling.prepare(table)
    assert train.count() + test.count() == 700 and seen.value == 700
    assert sorted(r.weight for r in train.union(test).select("weight").distinct().collect()) == pytest.approx([700 / 1200, 3.5])
