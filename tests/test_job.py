"""The one job: gate, resumption after a stop at any stage, and what is served meanwhile."""

import pytest
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.operators import models
from creditmill.operators.validation import ValidationFailed
from creditmill.plans import job
from creditmill.plans.ledger import Ledger
from creditmill.session import scratch_path
from creditmill.sources import files
from creditmill.sources.loans_view import raw_loans
from creditmill.sources.registry import Card, Registry, StaleBest
from creditmill.sources.store import Store

SMALL = job.Settings(names=("DecisionTree", "NaiveBayes"), params={"DecisionTree": {"maxDepth": 3}}, tune_from_rows=0, trials=1,
                     tune_ranges={"maxIter": (2, 3), "maxDepth": (2, 2)}, folds=2, explained_rows=5)


class Stopped(Exception):
    pass


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    path = scratch_path(spark, "csv")
    raw_loans(spark, sf_dir).select(*S.RAW_FILE.names).write.csv(path, header=True)
    return path


@pytest.fixture(scope="module")
def whole(spark, source):
    root = scratch_path(spark, "job")
    return root, job.run(spark, source, root, SMALL)


def test_store_texts_are_whole(spark):
    store = Store(spark, scratch_path(spark, "store"))
    assert store.get("a/b") is None and store.names("a") == []
    store.put("a/b", "é")
    with pytest.raises(FileExistsError):
        store.put("a/b", "other")
    assert store.get("a/b") == "é" and store.names("a") == ["b"]


def test_ledger_runs_a_stage_once(spark):
    root, calls = scratch_path(spark, "ledger"), []

    def work(path):
        calls.append(path)
        if len(calls) == 1:
            raise Stopped
        return {"n": 1}

    with pytest.raises(Stopped):
        Ledger(spark, root).stage("a", work, [1])
    first, again = Ledger(spark, root), Ledger(spark, root)
    a = first.stage("a", work, [1])
    assert again.stage("a", work, [1]) == a and len(calls) == 2 and (first.ran, again.reused) == (["a"], ["a"])
    assert again.stage("a", work, [2]).key != a.key and again.stage("b", work, [1], [a]).key != again.stage("b", work, [1]).key


def test_registry(spark, whole):
    _, done = whole
    registry, model = Registry(spark, scratch_path(spark, "registry")), None
    with pytest.raises(LookupError):
        registry.load()
    model = Registry(spark, f"{whole[0]}/registry").load(done.stages["leaderboard"].note["version"])[0]
    for v in ("one", "two"):
        registry.register(model, Card(v, "DecisionTree"))
    with pytest.raises(LookupError):
        registry.promote("three")
    registry.promote("one")
    registry.promote("one")
    with pytest.raises(StaleBest):
        registry.promote("two", instead_of="two")
    assert registry.current().version == "one"
    registry.promote("two", instead_of="one")
    assert registry.history() == ["one", "two"] and registry.load()[1].version == "two"
    assert {(r.version, r.promoted, r.in_force) for r in registry.versions().collect()} == {("one", 1, False), ("two", 2, True)}


def test_a_version_without_card_is_written_again(spark, whole, monkeypatch):
    registry = Registry(spark, scratch_path(spark, "registry"))
    model = Registry(spark, f"{whole[0]}/registry").load(whole[1].stages["leaderboard"].note["version"])[0]

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(registry.store, "put", stop)
        with pytest.raises(Stopped):
            registry.register(model, Card("one", "DecisionTree"))
    assert registry.card("one") is None and registry.versions().count() == 0
    registry.register(model, Card("one", "DecisionTree"))
    assert registry.card("one").name == "DecisionTree"


def test_the_whole_job(spark, whole):
    root, done = whole
    assert done.served.calibrated and done.served.version.endswith("-calibrated") and done.reused == []
    assert {"ingest", "validate", "warehouse", "features", "frames", "fit-DecisionTree", "fit-NaiveBayes", "leaderboard", "tune", "calibrate",
            "evaluate", "explain", "score", "drift"} <= set(done.ran)
    told = files.read_predictions(spark, f"{root}/predictions")
    assert told.count() == done.stages["frames"].note["test"] and {r[0] for r in told.select("model_version").distinct().collect()} == {
        done.served.version}
    runs = files.read_runs(spark, f"{root}/runs")
    assert {r["model"] for r in runs.collect()} == {"DecisionTree", "NaiveBayes", job.TUNED}
    # the tuned model replaced the best only if it won on held-out training rows
    tune = done.stages["tune"].note
    history = Registry(spark, f"{root}/registry").history()
    assert (len(history) == 3) == (tune["tuned"] > tune["best_before"]) and history[-1] == done.served.version
    assert done.served.parent == history[-2] == tune["version"]
    warehouse = spark.read.parquet(done.stages["warehouse"].path)
    assert set(warehouse.columns) <= set(S.WAREHOUSE) and warehouse.count() == done.stages["ingest"].note["rows"]
    decisions = spark.read.parquet(f"{done.stages['explain'].path}/decisions")
    assert decisions.count() == SMALL.explained_rows


def test_a_second_run_takes_everything_over(spark, source, whole):
    root, done = whole
    before = files.read_predictions(spark, f"{root}/predictions").count(), files.read_runs(spark, f"{root}/runs").count()
    again = job.run(spark, source, root, SMALL)
    assert again.ran == [] and sorted(again.reused) == sorted(done.ran) and again.served == done.served
    assert before == (files.read_predictions(spark, f"{root}/predictions").count(), files.read_runs(spark, f"{root}/runs").count())


def numbers(spark, root):
    return {r["loan_id"]: round(r["probability_of_default"], 9) for r in files.read_predictions(spark, f"{root}/predictions").collect()}


def test_stopped_between_all_steps_and_resumed(spark, source, whole, monkeypatch):
    """The job is stopped once in each model step, after its work and before its entry; the outcome is the same."""
    root = scratch_path(spark, "stopped")
    seen = []
    steps = ["fit", "leaderboard", "tune", "calibrate", "score"]

    def stopping(name, work):
        def step(self, *args):
            out = work(self, *args)
            if name not in seen:
                seen.append(name)
                raise Stopped(name)
            return out
        return step

    for name in steps:
        monkeypatch.setattr(job.Job, name, stopping(name, getattr(job.Job, name)))
    registry, in_force = Registry(spark, f"{root}/registry"), []
    for name in steps:
        with pytest.raises(Stopped, match=name):
            job.run(spark, source, root, SMALL)
        if (now := registry.current()) is not None:
            in_force.append(now)
            assert registry.load()[1] == now  # what is in force is whole
    done = job.run(spark, source, root, SMALL)
    assert "ingest" in done.reused and "calibrate" in done.reused and "score" in done.ran
    assert [c.calibrated for c in in_force] == [False, False, True, True]
    assert done.served.name == whole[1].served.name and numbers(spark, root) == numbers(spark, whole[0])
    assert files.read_runs(spark, f"{root}/runs").count() == files.read_runs(spark, f"{whole[0]}/runs").count()
    assert len(set(registry.history())) == len(registry.history())


def test_the_gate_stops_the_job(spark, source):
    root, empty = scratch_path(spark, "gate"), scratch_path(spark, "csv")
    spark.read.csv(source, header=True, schema=S.RAW_FILE).limit(0).coalesce(1).write.csv(empty, header=True)
    with pytest.raises(ValidationFailed, match="rows"):
        job.run(spark, empty, root, SMALL)
    assert [n.split("-")[0] for n in Store(spark, root).names("ledger")] == ["ingest"]
    with pytest.raises(ValidationFailed):  # and again: a failed gate is not an entry
        job.run(spark, empty, root, SMALL)


def test_other_settings_redo_what_they_concern(spark, source, whole):
    root, done = whole
    cheap = job.Settings(**{**SMALL.__dict__, "tune_from_rows": 10**9, "names": ("NaiveBayes",)})
    other = job.run(spark, source, root, cheap)
    assert {"ingest", "features", "frames"} <= set(other.reused) and {"fit-NaiveBayes", "tune", "score"} <= set(other.ran)
    assert other.run != done.run and other.stages["tune"].note["tuned"] is None
    rows = spark.read.parquet(f"{root}/predictions")
    assert rows.groupBy("run").agg(F.count("*").alias("n")).select("n").distinct().count() == 1 and rows.select("run").distinct().count() == 2


def test_a_retried_append_leaves_the_row_count(spark):
    path = scratch_path(spark, "predictions")
    scored = spark.range(10).select(F.col("id").alias(S.KEY), F.lit(0.1).alias("predicted_pd"), F.lit(5.0).alias("expected_loss"),
                                    F.lit(700).alias("credit_score"), F.when(F.col("id") < 5, "Low Risk").otherwise("High Risk").alias("risk_tier"))
    for _ in range(2):
        files.append_predictions(scored, path, "v", run="a")
    files.append_predictions(scored.filter("loan_id < 3"), path, "v", run="b")
    files.append_predictions(scored.filter("loan_id < 3"), path, "v", run="a")  # its other tier goes as well
    assert files.read_predictions(spark, path).count() == 6


def test_held_out_auc_is_that_of_tuning(spark):
    df = spark.range(800).select(F.col("id").alias(S.KEY), (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("x"))
    df = df.withColumn(S.TARGET, (F.col("x") + F.pmod(F.xxhash64(S.KEY, F.lit(3)), F.lit(50)) / 100 > 0.75).cast("int"))
    model, params, auc = models.tune_gbt(df, ["x"], n_trials=1, ranges={"maxIter": (2, 4), "maxDepth": (2, 2)})
    assert models.held_out_auc("WeightedBoosting", df, ["x"], **params) == pytest.approx(auc) and model.stages[-1].getNumTrees == params["maxIter"]
