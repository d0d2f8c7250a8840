"""Registered model queries do the whole job of their operators."""

import pytest

from creditmill import schema as S
from creditmill.catalog import learned
from creditmill.operators import explain, models

SMALL = {"LogisticRegression": {"maxIter": 5}, "DecisionTree": {"maxDepth": 2}, "RandomForest": {"numTrees": 2, "maxDepth": 2},
         "GradientBoosting": {"maxIter": 2, "maxDepth": 2}, "WeightedBoosting": {"maxIter": 2, "maxDepth": 2}}


@pytest.mark.parametrize("name", ["train_all_undersampled", "log_run"])
def test_every_model_is_fitted(spark, sf_dir, monkeypatch, name):
    for model, few in SMALL.items():
        monkeypatch.setitem(models.SPECS, model, {**models.SPECS[model], **few})
    assert {r["model"] for r in learned.QUERIES[name](spark, sf_dir).collect()} == set(models.SPECS)


def test_as_many_model_features_as_by_default(spark, sf_dir):
    names = [r["feature"] for r in learned.QUERIES["select_features_of_model"](spark, sf_dir).collect()]
    assert len(set(names)) == len(names) == explain.TOP_FEATURES == 30 and set(names) < set(S.MODEL_FEATURES)


def test_tuning_searches_the_full_ranges(spark, sf_dir, monkeypatch):
    asked, draw = [], models.draw_params

    def small(n_trials, seed, ranges):
        asked.append(ranges)
        return [{**t, "maxDepth": 2, "stepSize": 0.3} for t in draw(n_trials, seed, ranges)]

    monkeypatch.setattr(models, "draw_params", small)
    monkeypatch.setattr(models, "rungs", lambda n, most: [(n, 2)] if most == 600 else 1 / 0)
    assert learned.QUERIES["tune_gbt"](spark, sf_dir).count() == 1
    assert asked == [models.TUNE_RANGES]


def test_tuning_draws_as_often_as_by_default(spark, sf_dir, monkeypatch):
    import inspect

    class Stop(Exception):
        pass

    def look(n_trials, *_):
        raise Stop(n_trials)

    monkeypatch.setattr(models, "draw_params", look)
    with pytest.raises(Stop) as told:
        learned.QUERIES["tune_gbt"](spark, sf_dir)
    assert told.value.args[0] == inspect.signature(models.tune_gbt).parameters["n_trials"].default == 50


def test_mutual_information_of_every_model_feature(spark, sf_dir):
    names = [r["feature"] for r in learned.QUERIES["mutual_information_of_model"](spark, sf_dir).collect()]
    assert sorted(names) == sorted(S.MODEL_FEATURES)


def test_score_stream_has_files_for_all_cores_in_each_batch(spark, sf_dir, monkeypatch):
    """Four batches as before, none of them one file that one core must read."""
    from pyspark.sql import functions as F

    from creditmill.streaming import applications as stream

    class Stop(Exception):
        pass

    def look(spark, path, files_per_batch=None):
        files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
        raise Stop(files, files_per_batch)

    monkeypatch.setattr(learned, "served_model", lambda s, d: (None, None))
    monkeypatch.setattr(stream, "read_applications", look)
    with pytest.raises(Stop) as told:
        learned.score_stream(spark, sf_dir)
    files, at_once = told.value.args
    assert at_once == spark.sparkContext.defaultParallelism and files == 4 * at_once


def test_shapley_values_shuffle_one_row_a_loan(spark):
    from pyspark.sql import functions as F

    from creditmill.operators import explain, models

    rows = spark.createDataFrame([(i, float(i % 5), float(i % 3), int(i % 5 > 2)) for i in range(40)],
                                 "loan_id long, a double, b double, is_default int")
    model = models.train("DecisionTree", rows, ["a", "b"])
    phi = explain.shapley_values(model, rows, ["a", "b"], permutations=4, background_rows=10)
    plan = phi._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(loan_id" in plan and "feature_no" not in plan
    told = phi.groupBy("loan_id").agg(F.count("*").alias("n"), F.sum("phi").alias("phi")).collect()
    assert len(told) == 40 and all(r["n"] == 2 for r in told)
    assert {(r["loan_id"], r["feature"]): r["value"] for r in phi.collect()}[7, "a"] == 2.0


def test_mutual_information_counts_cells_without_a_row_a_value(spark):
    """NaN, unknown values, unknown classes and constant columns are counted as by the definition."""
    import math

    from creditmill.operators import explain, ranks

    rows = [(i, None if i % 7 == 0 else float(i % 11), float("nan") if i % 13 == 0 else 1.0, None if i == 5 else i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "loan_id long, a double, b double, is_default int")
    calls = []
    real, ranks.long_values = ranks.long_values, lambda *a: calls.append(a) or real(*a)
    try:
        found = {r["feature"]: r["score"] for r in explain.mutual_information(df, ["a", "b"], bins=4).collect()}
    finally:
        ranks.long_values = real
    assert all(list(c[1]) == ["b"] for c in calls)  # NaN alone sends a column to the full count
    for place, name in ((1, "a"), (2, "b")):
        v = [0.0 if r[place] is None else r[place] for r in rows]
        order = sorted(v, key=lambda z: (z != z, z))
        def quantile(p):
            at = (len(order) - 1) * p
            low, high = order[math.floor(at)], order[math.ceil(at)]
            return low + (high - low) * (at - math.floor(at))
        edges = [quantile(i / 4) for i in range(1, 4)]
        bins = [sum(z != z or z > e for e in edges) for z in v]
        cells, n = {}, len(rows)
        for b, r in zip(bins, rows):
            cells[b, r[3]] = cells.get((b, r[3]), 0) + 1
        def total(i, x):
            return sum(c for key, c in cells.items() if key[i] == x)
        expected = sum(c / n * math.log(c * n / (total(0, b) * total(1, y))) for (b, y), c in cells.items())
        assert found[name] == pytest.approx(expected, abs=1e-12)


def test_explanations_take_more_tasks_the_more_attributions_there_are(spark, monkeypatch):
    phi = spark.range(300).selectExpr("id % 100 AS loan_id", "concat('f', id) AS feature", "id * 1.5 AS value", "id - 150.0D AS phi")
    scored = spark.range(100).selectExpr("id AS loan_id", "id / 100 AS predicted_pd")
    before = explain.business_explanation(phi, scored)
    monkeypatch.setattr(explain, "PHI_A_TASK", 20)
    after = explain.business_explanation(phi, scored)
    assert "15), REPARTITION_BY_NUM" in after._jdf.queryExecution().executedPlan().toString()
    assert sorted(before.collect()) == sorted(after.collect()) and before.count() == 100
