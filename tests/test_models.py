import datetime as dt

import pytest
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.operators import cleaning, registry, scaling, scoring, training
from tallyglass.plans import daily, modelling
from tallyglass.schema import MODEL_FEATURES
from tallyglass.sources import sinks, storage, transactions
from tallyglass.sources.modelstore import ModelStore
from tallyglass.workspace import checked_broadcast, scratch_root

SMALL = [{"numTrees": 4, "maxDepth": 3}, {"numTrees": 0}, {"numTrees": 6, "maxDepth": 4}]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return cleaning.clean(adapters.transactions(spark, sf_dir)).cache()


@pytest.fixture
def store(spark, tmp_path):
    return ModelStore(spark, str(tmp_path / "store"))


def test_labels_never_become_features():
    with pytest.raises(ValueError):
        training.build_pipeline(["tx_amount", "weight"], weight="weight")
    with pytest.raises(ValueError):
        training.build_pipeline(["tx_fraud_scenario"])
    with pytest.raises(ValueError):
        training.build_pipeline(["tx_amount"], model_type="svm")


def test_grid_and_space():
    assert len(training.parameter_grid(training.build_pipeline(["tx_amount"]))) == 4
    points = training.draw_trials()
    assert points == training.draw_trials() and len(points) == 15
    for p in points:
        assert 50 <= p["numTrees"] <= 200 and p["numTrees"] % 10 == 0 and 0.6 <= p["subsamplingRate"] <= 1.0
        assert training.typed_params({k: str(v) for k, v in p.items()}) == p


def test_cross_validation_is_deterministic(spark, rows):
    train, _ = modelling.prepare(rows)
    grid = {"numTrees": [3, 5], "maxDepth": [2]}
    results = []
    for frame in (train, train.repartition(6)):
        fitted = training.cross_validate(frame, training.build_pipeline(["tx_amount"], weight="weight"), "transaction_id", grid, weight="weight")
        results.append([r.auc for r in training.grid_results(spark, fitted).orderBy("trial_id").collect()])
    assert len(results[0]) == 2 and results[0] == pytest.approx(results[1], abs=0.05) and min(results[0]) > 0.5


def test_search_keeps_failed_trials(rows):
    train, test = modelling.prepare(rows)
    table = training.search(train, test, ["tx_amount"], "transaction_id", "weight", SMALL).cache()
    status = {r.trial_id: (r.status, r.loss) for r in table.collect()}
    assert status[1][0].startswith("failed") and status[1][1] == 1.0 and status[0][0] == "ok"
    assert [r.trial_id for r in registry.leaderboard(table).collect()] == sorted([0, 2], key=lambda i: -table.filter(f"trial_id = {i}").first().auc) + [1]
    model, params = training.refit_best(train, table, ["tx_amount"], "weight")
    assert params in (SMALL[0], SMALL[2]) and model.stages[-1].getNumTrees == params["numTrees"]


def test_model_lifecycle(rows, store):
    assert modelling.challenge(rows, store, "ab", "fraud", SMALL) is None  # no champion yet
    grid = {"numTrees": [3], "maxDepth": [2]}
    assert modelling.train(rows, store, "first", "fraud", grid=grid) == (1, "champion")
    champion = store.champion_metrics("fraud")
    assert champion["version"] == 1 and champion["auc"] > 0.5
    assert store.promote("fraud", "worse", champion["auc"]) == (2, "challenger")
    assert store.lookup("fraud") == 1 and store.lookup("fraud", "challenger") == 2
    assert modelling.challenge(rows, store, "ab", "fraud", [SMALL[2]], 12, 0.5) in ("deploy", "keep", "inconclusive")
    logged = {(r.kind, r.key) for r in store.runs().collect()}
    assert ("metric", "auc") in logged and ("param", "best_numTrees") in logged and ("text", "decision") in logged
    assert modelling.train(rows, store, "linear", "fraud_lr", "lr")[1] == "champion"


def test_aliases_and_stages(store):
    t = dt.datetime(2024, 1, 1)
    first, second = (store.register("m", f"r{i}", ts=t) for i in (1, 2))
    assert (first, second, store.register("other", "r3")) == (1, 2, 1)
    assert store.lookup("m") is None and store.load("m") is None and store.champion_metrics("m") is None
    store.set_alias("m", 2, "champion", source="tag", ts=t)
    assert store.lookup("m") == 2
    store.set_alias("m", 1, "champion", ts=t)  # a true alias comes before a tag
    assert store.lookup("m") == 1
    store.transition_stage("m", 2, "Production", "moved")
    store.transition_stage("m", 1, "Archived")
    store.transition_stage("m", 1, "Shadow")
    now = {r.alias: r.version for r in registry.current_aliases(store.aliases()).collect()}
    assert now == {"champion": 2, "archived": 1, "shadow": 1} and store.lookup("m") == 2


def test_promotion_and_alerts(spark):
    aucs = [0.70, 0.75, 0.75, 0.60, 0.62, 0.80]
    table = spark.createDataFrame([("m", i + 1, a) for i, a in enumerate(aucs)], "model string, version int, auc double")
    history = registry.promotion_history(table).orderBy("version").collect()
    assert [r.alias for r in history] == ["champion", "champion", "challenger", "challenger", "challenger", "champion"]
    assert history[1].improvement == pytest.approx(100 * 0.05 / 0.70)
    odd = [None, float("nan"), 0.6, float("nan"), 0.6]
    table2 = spark.createDataFrame([("m", i + 1, a) for i, a in enumerate(odd)], "model string, version int, auc double")
    history = registry.promotion_history(table2).orderBy("version").collect()
    assert [r.alias for r in history] == ["champion", "challenger", "champion", "challenger", "challenger"]
    alerts = registry.quality_alerts(table).orderBy("version").collect()
    assert [(r.alert, r.roll_back_to) for r in alerts] == [(0, None)] * 3 + [(1, 3)] + [(0, None)] * 2


def test_objective(spark):
    table = spark.createDataFrame([(1, 0.9, 0.5, 0.9), (2, 0.9, 0.5, 0.8), (3, None, None, None)], "trial_id int, auc double, precision double, recall double")
    assert [r.loss for r in registry.objective(table).orderBy("trial_id").collect()] == pytest.approx([0.22, 0.37, 1.0])


def test_version_numbers_continue(spark):
    runs = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "z", 1)], "model string, run_id string, ts int")
    known = spark.createDataFrame([("a", 4)], "model string, version int")
    assert {r.run_id: r.version for r in registry.number_versions(runs, known).collect()} == {"y": 5, "x": 6, "z": 1}


@pytest.mark.parametrize("method", scaling.SCALERS)
def test_grouped_scaling_equals_the_fitted_pipeline(spark, rows, method, tmp_path):
    dated = cleaning.with_day(rows)
    first, second = (r.date for r in cleaning.days(dated).limit(2).collect())
    model = scaling.fit_scaler(dated.filter(F.col("date") == F.lit(first)), ["tx_amount"], method)
    sinks.save_pipeline(model, str(tmp_path / "scaler"))
    sinks.save_pipeline(model, str(tmp_path / "scaler"))  # overwrite
    loaded = sinks.load_pipeline(str(tmp_path / "scaler"))
    fitted = loaded.transform(dated.filter(F.col("date") == F.lit(second)))
    want = {r.transaction_id: r.scaled_features[0] for r in fitted.collect()}
    grouped = scaling.scale_by_previous_day(dated, ["tx_amount"], method=method).filter(F.col("date") == F.lit(second))
    got = {r.transaction_id: r.tx_amount_scaled for r in grouped.collect()}
    assert got.keys() == want.keys()
    if method != "robust":  # quantile interpolation differs between the two
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_constant_column_scales_to_the_middle(spark):
    df = spark.sql("select date'2024-01-01' as date, 5 as c union all select date'2024-01-02', 7")
    assert scaling.scale_by_previous_day(df, ["c"]).first().c_scaled == 0.5
    with pytest.raises(ValueError):
        scaling.scale_by_previous_day(df, ["c"], method="absent")


def test_daily_plan(spark, sf_dir, tmp_path):
    report = daily.analyse(adapters.transactions(spark, sf_dir), with_change_points=True, remove_outliers=True)
    daily.write_report(report, str(tmp_path))
    daily.write_report(report, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "cleaned")).count() == report.cleaned.count()
    profile = spark.read.json(str(tmp_path / "profile"))
    assert profile.filter("date = '2024-01-05' and column = 'tx_amount'").count() == 1
    assert spark.read.json(str(tmp_path / "correlation")).select("col_a").distinct().count() == 8
    assert spark.read.parquet(str(tmp_path / "tests")).filter("test = 'mann_whitney' and feature = 'tx_amount'").count() == 29


def test_write_modes(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    sinks.write_new(one, str(tmp_path / "a"))
    with pytest.raises(Exception):
        sinks.write_new(two, str(tmp_path / "a"))
    sinks.write_if_absent(two, str(tmp_path / "a"))
    assert transactions.read_parquet(spark, str(tmp_path / "a")).count() == 1


def test_day_overwrite_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.sql("select date'2024-01-01' as date, 1 as v union all select date'2024-01-02', 2")
    sinks.overwrite_days(both, path)
    sinks.overwrite_days(both.filter("v = 2").withColumn("v", F.lit(9)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def test_pandas_both_ways(spark, rows):
    frame = transactions.to_pandas(rows.limit(5), 5)
    with pytest.raises(ValueError, match="more than 5"):
        transactions.to_pandas(rows, 5)
    assert len(frame) == 5 and str(frame["tx_datetime"].dtype).startswith("datetime64")
    assert transactions.from_pandas(spark, frame).count() == 5
    with pytest.raises(ValueError):
        transactions.to_pandas(rows, 0)
    texts = spark.createDataFrame([("2024-01-01 10:00:00",), ("broken",)], "tx_datetime string")
    parsed = sorted(transactions.parse_time(texts).collect(), key=lambda r: r.tx_datetime is None)
    assert parsed[0].tx_datetime == dt.datetime(2024, 1, 1, 10) and parsed[1].tx_datetime is None


def test_views(spark, rows):
    transactions.register_view(rows, "tx_view")
    assert transactions.view(spark, "tx_view").count() == rows.count()
    assert transactions.drop_view(spark, "tx_view") and not transactions.drop_view(spark, "tx_view")


def test_object_store_settings():
    conf = storage.object_store_conf("https://store.example", "k", "s")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "https://store.example"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not any("key" in name for name in storage.object_store_conf("https://store.example"))


def test_scratch_and_checked_broadcast(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    small, large = spark.range(3), spark.range(300)
    assert "ResolvedHint" in checked_broadcast(small, "x", 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in checked_broadcast(large, "x", 10)._jdf.queryExecution().analyzed().toString()


def test_missing_value_report(spark, sf_dir):
    raw = adapters.transactions(spark, sf_dir)
    assert {r.column for r in modelling.missing_values(raw).collect()} == set(raw.columns)
    assert scoring.EXPECTED_FRAUD_SHARE == 0.02


def test_rows_of_a_few_files_are_spread(spark, monkeypatch):
    monkeypatch.setattr(modelling, "ROWS_PER_TASK", 50)
    rows = spark.range(0, 1000, 1, 1).selectExpr("id as transaction_id", "id % 7 = 0 as hit", *[f"cast(id as double) as {c}" for c in MODEL_FEATURES])
    rows = rows.withColumn("tx_fraud", F.col("hit").cast("int"))
    train, test = modelling.prepare(rows)
    assert train.rdd.getNumPartitions() > 2
    assert train.count() + test.count() == 1000 and train.select("transaction_id").union(test.select("transaction_id")).distinct().count() == 1000


def test_scaling_is_fitted_once_for_all_points(spark, monkeypatch):
    fitted, real = [], StandardScaler._fit
    monkeypatch.setattr(StandardScaler, "_fit", lambda self, df: fitted.append(1) or real(self, df))
    rows = spark.range(0, 300, 1, 2).selectExpr("id", "cast(id % 50 as double) as x", "cast(id % 50 > 35 as int) as tx_fraud", "1.0d as weight")
    pipeline = training.build_pipeline(["x"], "rf", "weight")
    model = training.cross_validate(rows, pipeline, "id", {"numTrees": [2, 3], "maxDepth": [1, 2]}, weight="weight")
    assert len(model.avgMetrics) == 4 and min(model.avgMetrics) > 0.9 and len(model.bestModel.stages) == 3
    assert len(fitted) == 4  # three folds and the last fit
    fitted.clear()
    table = training.search(rows, rows, ["x"], "id", "weight", [{"numTrees": 2}, {"numTrees": 3}])
    assert [r.status for r in table.collect()] == ["ok", "ok"] and len(fitted) == 1
