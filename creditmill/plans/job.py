"""From a loan file to a promoted, calibrated model, scored loans and a drift report: one job that can be stopped and resumed.

Stages: ingest, validate (the gate), warehouse, features, frames, a fit per model, leaderboard, tune, calibrate, and side by
side evaluate, explain, score and drift. Each is in the ledger, models are in the registry, and tables that grow from run to
run hold one folder a run, so a resumed job redoes no finished stage and leaves no row twice.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.operators import cleaning, drift, explain, features, metrics, models, sampling, scoring, validation
from creditmill.plans import training
from creditmill.plans.ledger import Entry, Ledger
from creditmill.sources import files
from creditmill.sources.registry import Card, Registry
from creditmill.sources.store import file_marks

TUNED = "WeightedBoosting_tuned"


@dataclass(frozen=True)
class Settings:
    """What a run depends on besides its input."""

    names: Sequence[str] = tuple(models.SPECS)
    params: Mapping[str, Mapping] = field(default_factory=dict)
    sampling_method: str = "none"
    fit_on: str = "train"
    tune_from_rows: int = 80_000  # training rows from which tuning is worth its time
    trials: int = 40
    tune_ranges: Mapping = field(default_factory=dict)
    folds: int = 5
    drift_rows: int = 5000
    explained_rows: int = 1000
    seed: int = S.SEED


@dataclass(frozen=True)
class Outcome:
    run: str
    served: Card
    ran: list[str]
    reused: list[str]
    stages: Mapping[str, Entry]


class Job:
    """One run over one loan file. `root` holds stages, ledger, registry, predictions, run log and drift reports."""

    def __init__(self, spark: SparkSession, csv_path: str, root: str, settings: Settings = Settings(), nrows: int | None = None):
        self.spark, self.csv_path, self.root, self.settings, self.nrows = spark, csv_path, root.rstrip("/"), settings, nrows
        self.ledger, self.registry = Ledger(spark, root), Registry(spark, f"{self.root}/registry")

    # --- data ---

    def ingest(self, path: str) -> dict:
        raw = files.read_loans_csv(self.spark, self.csv_path, nrows=self.nrows).withColumn(S.KEY, F.col("id"))
        clean = raw.transform(cleaning.clean).transform(cleaning.drop_leaky_columns)
        clean.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return {"rows": self.spark.read.parquet(path).count()}

    def validate(self, path: str, loans: DataFrame) -> dict:
        """The gate: a failed check ends the job here, and the report of what failed is kept."""
        validation.validation_report(loans).coalesce(1).write.mode("overwrite").parquet(path)
        validation.require_valid(loans)
        return {"passed": True}

    def frames(self, path: str, loans: DataFrame) -> dict:
        train, test, used = training.model_frames(loans, self.settings.fit_on, self.settings.seed)
        for name, part in (("train", train), ("test", test)):
            part.write.mode("overwrite").parquet(f"{path}/{name}")
        return {"features": used, **{n: self.spark.read.parquet(f"{path}/{n}").count() for n in ("train", "test")}}

    # --- models ---

    @cached_property
    def _training_rows(self) -> DataFrame:
        s = self.settings
        return models.training_rows(self.train, self.used, s.sampling_method, S.TARGET, s.seed)[0]

    def version(self, name: str) -> str:
        return f"{self.run_key}-{name}"

    def fit(self, name: str) -> dict:
        model = models.train(name, self._training_rows, self.used, seed=self.settings.seed, **self.settings.params.get(name, {}))
        card = Card(self.version(name), name, run=self.run_key, params=dict(self.settings.params.get(name, {})), features=self.used)
        return {"version": self.registry.register(model, card).version}

    def leaderboard(self, path: str, fits: Mapping[str, Entry]) -> dict:
        """Metrics of all models on the test rows; the best is promoted if nothing of this run is in force yet."""
        fitted = {n: self.registry.load(e.note["version"])[0] for n, e in fits.items()}
        board = models.leaderboard(self.spark, fitted, self.test, self.used)
        board.coalesce(1).write.mode("overwrite").parquet(path)
        models.log_board(self.spark, f"{self.root}/runs", board, self.settings.sampling_method, len(self.used), self.sizes,
                         f"{self.run_key}-train", self.settings.params)
        best = metrics.select_best_model(board).first()["model"]
        return {"best": best, "version": self.registry.promote(fits[best].note["version"]).version}

    def tune(self, board: Entry) -> dict:
        """The tuned booster takes the best model's place only if it beats it on held-out training rows."""
        s, before = self.settings, self.registry.card(board.note["version"])
        if self.sizes[0] < s.tune_from_rows:
            return {"version": before.version, "tuned": None}
        model, params, auc = models.tune_gbt(self.train, self.used, s.trials, s.seed, ranges=s.tune_ranges or None)
        old = models.held_out_auc(before.name, self.train, self.used, seed=s.seed, **before.params)
        card = self.registry.register(model, Card(self.version(TUNED), "WeightedBoosting", run=self.run_key, parent=before.version,
                                                  metrics={"validation_auc": auc}, params=params, features=self.used))
        told = metrics.all_metrics(models.predict_pd(model, self.test).withColumn("model", F.lit(TUNED)))
        models.log_board(self.spark, f"{self.root}/runs", told, "none", len(self.used), self.sizes, f"{self.run_key}-tune", {TUNED: params})
        wins = auc > old
        if wins:
            self.registry.promote(card.version)
        return {"version": card.version if wins else before.version, "tuned": auc, "best_before": old}

    def calibrate(self, tuned: Entry) -> dict:
        """The best model, calibrated, is what is served; it comes last, so nothing replaces it uncalibrated."""
        s, best = self.settings, self.registry.card(tuned.note["version"])
        version = f"{best.version}-calibrated"
        if self.registry.card(version) is None:
            model = models.calibrate_isotonic(best.name, self.train, self.used, folds=s.folds, seed=s.seed, **best.params)
            raw = self.registry.load(best.version)[0]
            both = models.predict_pd(model, models.predict_pd(raw, self.test, "raw_pd"))
            told = {r["model"]: r for r in metrics.calibration_check(both).collect()}
            found = {f"{k}_{m}": float(r[k]) for m, r in told.items() for k in ("mean_pd", "roc_auc")}
            self.registry.register(model, Card(version, best.name, True, self.run_key, best.version,
                                               {**found, "base_rate": float(told["raw"]["base_rate"])}, best.params, self.used))
        return {"version": self.registry.promote(version).version}

    # --- what the served model says ---

    def scored(self, served: Entry) -> DataFrame:
        return models.predict_pd(self.registry.load(served.note["version"])[0], self.test)

    def evaluate(self, path: str, served: Entry) -> dict:
        scored = self.scored(served).select(S.KEY, S.TARGET, scoring.PD, F.lit(served.note["version"]).alias("model"))
        told = metrics.all_metrics(scored)
        told.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")
        metrics.confusion_matrix(scored).coalesce(1).write.mode("overwrite").parquet(f"{path}/confusion")
        for name, curve in (("roc", metrics.roc_curve), ("precision_recall", metrics.pr_curve), ("gain", metrics.gain_lift)):
            curve(scored).write.mode("overwrite").parquet(f"{path}/{name}")
        r = told.first()
        return {k: float(r[k]) for k in ("roc_auc", "f1_score", "pr_auc") if r[k] is not None}

    def explain(self, path: str, served: Entry) -> dict:
        """Attributions of the model that is served, and its decisions with reasons, for a seeded sample of test rows."""
        rows = sampling.fixed_sample(self.test, self.settings.explained_rows, self.settings.seed)
        model = self.registry.load(served.note["version"])[0]
        explain.shapley_values(model, rows, self.used, background=self.train).write.mode("overwrite").parquet(f"{path}/phi")
        phi = self.spark.read.parquet(f"{path}/phi")
        explain.attribution_summary(phi).coalesce(1).write.mode("overwrite").parquet(f"{path}/summary")
        told = explain.business_explanation(phi, models.predict_pd(model, rows).select(S.KEY, scoring.PD))
        told.withColumn("model_version", F.lit(served.note["version"])).write.mode("overwrite").parquet(f"{path}/decisions")
        return {}

    def score(self, served: Entry) -> dict:
        scored = self.scored(served).transform(scoring.score_portfolio)
        files.append_predictions(scored, f"{self.root}/predictions", served.note["version"], run=self.run_key)
        return {}

    def drift(self, path: str) -> dict:
        """Training rows against test rows, samples of a bounded size as in monitoring."""
        s = self.settings
        old, new = (sampling.fixed_sample(d, s.drift_rows, s.seed) for d in (self.train, self.test))
        told = drift.column_drift(old, new)
        told.coalesce(1).write.mode("overwrite").parquet(path)
        r = drift.dataset_drift(self.spark.read.parquet(path)).first()
        return {"drifted": bool(r["dataset_drifted"]), "share": float(r["drifted_share"])}

    # --- the whole ---

    def run(self) -> Outcome:
        s, stage = self.settings, self.ledger.stage
        done: dict[str, Entry] = {}
        ingested = done["ingest"] = stage("ingest", self.ingest, [file_marks(self.spark, self.csv_path), self.nrows])
        loans = self.ledger.read(ingested)
        gate = done["validate"] = stage("validate", lambda p: self.validate(p, loans), [], [ingested])
        done["warehouse"] = stage("warehouse", lambda p: files.warehouse_projection(loans).write.mode("overwrite").parquet(p), [], [gate])
        made = done["features"] = stage(
            "features", lambda p: loans.transform(features.feature_pipeline).write.mode("overwrite").parquet(p), [], [gate])
        cut = done["frames"] = stage("frames", lambda p: self.frames(p, self.ledger.read(made)), [s.fit_on, s.seed], [made])
        self.train, self.test = self.ledger.read(cut, "train"), self.ledger.read(cut, "test")
        self.used, self.sizes = cut.note["features"], (cut.note["train"], cut.note["test"])
        # models of the same rows and settings are the same, so a version carries what its run depends on
        self.run_key = stage("run", lambda p: None, [s.__dict__], [cut]).key

        def fit(name: str) -> Entry:
            return stage(f"fit-{name}", lambda p: self.fit(name), [], [done["run"]])

        done["run"] = Entry("run", self.run_key, "", {})
        if any(self.registry.card(self.version(n)) is None for n in s.names):
            self._training_rows  # once, before the threads need it
        order = sorted(s.names, key=lambda n: -list(models.SPECS).index(n))
        fits = {e.stage.removeprefix("fit-"): e for e in models.at_once(fit, order, len(order))}
        done |= {e.stage: e for e in fits.values()}
        if "_training_rows" in self.__dict__:
            self._training_rows.unpersist()
        board = done["leaderboard"] = stage("leaderboard", lambda p: self.leaderboard(p, fits), [], [fits[n] for n in s.names])
        tuned = done["tune"] = stage("tune", lambda p: self.tune(board), [], [board])
        served = done["calibrate"] = stage("calibrate", lambda p: self.calibrate(tuned), [], [tuned])
        last = {"evaluate": lambda p: self.evaluate(p, served), "explain": lambda p: self.explain(p, served),
                "score": lambda p: self.score(served), "drift": self.drift}
        done |= {e.stage: e for e in models.at_once(lambda n: stage(n, last[n], [], [served]), last, len(last))}
        return Outcome(self.run_key, self.registry.current(), self.ledger.ran, self.ledger.reused, done)


def run(spark: SparkSession, csv_path: str, root: str, settings: Settings = Settings(), nrows: int | None = None) -> Outcome:
    """Run the job, or what is left of it. Raises ValidationFailed at the gate; no stage after it has run then."""
    return Job(spark, csv_path, root, settings, nrows).run()
