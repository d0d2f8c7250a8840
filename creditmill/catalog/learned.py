"""Trained models, calibration, batch and stream scoring, attributions, at the operators' own settings.

`credit_pipeline` runs the one job from loan file to drift report with three of the six models, because its fits come on top of
each other (see README for the times), and `train_smote` and `train_adasyn` fit the same three.
`select_features` returns ten raw columns, as its SQL says; `select_features_of_model` takes the defaults.
"""

from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.catalog.base import applications_of, feature_loans, oracle, rounded, stored_loans
from creditmill.operators import explain, metrics, models
from creditmill.plans import job, prediction, training
from creditmill.session import scratch_path, settle
from creditmill.sources import files
from creditmill.sources.loans_view import clean_loans, raw_loans
from creditmill.sources.registry import Card, Registry
from creditmill.streaming import applications as stream

JOB_MODELS = ("LogisticRegression", "DecisionTree", "NaiveBayes")
# A plain linear scorecard over raw inputs, for attributions that have a closed form.
SCORECARD = {"int_rate": 0.02, "dti": 0.004, "annual_inc": -0.0000015, "loan_amnt": 0.000004, "revol_util": 0.0008,
             "revol_bal": 0.000002, "installment": 0.00003, "total_acc": -0.003, "open_acc": -0.006,
             "delinq_2yrs": 0.03, "inq_last_6mths": 0.015, "pub_rec": 0.08, "grade_numeric": 0.025,
             "emp_length_years": -0.004}


def frames(spark, sf_dir, features=tuple(S.MODEL_FEATURES)):
    return training.model_frames(feature_loans(spark, sf_dir), features=features)


def _train(name):
    """Test-set metrics of one model."""
    def run(spark, sf_dir):
        train, test, used = frames(spark, sf_dir)
        model = models.train(name, train, used)
        scored = models.predict_pd(model, test).withColumn("model", F.lit(name))
        return rounded(metrics.all_metrics(scored))
    return run


def train_all(spark, sf_dir):
    train, test, used = frames(spark, sf_dir)
    return models.train_all(train, test, used)[0]


def train_all_undersampled(spark, sf_dir):
    train, test, used = frames(spark, sf_dir)
    return models.train_all(train, test, used, sampling_method="undersample")[0]


def _train_resampled(method):
    """Leaderboard of the quick models, trained on rows that an oversampler has balanced."""
    def run(spark, sf_dir):
        train, test, used = frames(spark, sf_dir)
        return models.train_all(train, test, used, names=JOB_MODELS, sampling_method=method)[0]
    return run


def log_run(spark, sf_dir):
    path = scratch_path(spark, "runs")
    train, test, used = frames(spark, sf_dir)
    models.train_all(train, test, used, runs_path=path)
    return (files.read_runs(spark, path).drop("logged_at")
            .select("model", "sampling_method", "n_features", "train_size", "test_size",
                    F.col("metrics")["roc_auc"].alias("roc_auc"), F.col("metrics")["f1_score"].alias("f1_score")))


def save_model(spark, sf_dir):
    """Predictions of a model that was saved and loaded again."""
    train, test, used = frames(spark, sf_dir)
    path = scratch_path(spark, "model")
    models.save_model(models.train("DecisionTree", train, used), path)
    return models.predict_pd(models.load_model(path), test).select(S.KEY, S.TARGET, "predicted_pd")


def predict_pd(spark, sf_dir):
    train, test, used = frames(spark, sf_dir)
    model = models.train("LogisticRegression", train, used)
    return models.predict_pd(model, test).select(S.KEY, S.TARGET, "predicted_pd")


def tune_gbt(spark, sf_dir):
    train, test, used = frames(spark, sf_dir)
    model, params, auc = models.tune_gbt(train, used)
    scored = models.predict_pd(model, test)
    return metrics.roc_auc(scored).select(
        F.lit(auc).alias("validation_auc"), F.col("roc_auc").alias("test_auc"),
        F.lit(params["maxIter"]).alias("rounds"), F.lit(params["maxDepth"]).alias("depth"))


def calibrate_isotonic(spark, sf_dir):
    train, test, used = frames(spark, sf_dir)
    raw = models.train("DecisionTree", train, used)
    calibrated = models.calibrate_isotonic("DecisionTree", train, used)
    path = scratch_path(spark, "calibrated")
    models.save_model(calibrated, path)
    both = models.predict_pd(models.load_model(path, calibrated=True), models.predict_pd(raw, test, "raw_pd"))
    return rounded(metrics.calibration_check(both))


def served_model(spark, sf_dir):
    """(model, card) of a calibrated model as the registry serves it."""
    train, _, used = frames(spark, sf_dir)
    registry = Registry(spark, scratch_path(spark, "registry"))
    card = Card("1-LogisticRegression-calibrated", "LogisticRegression", True, "1", features=used)
    registry.register(models.calibrate_isotonic(card.name, train, used), card)
    registry.promote(card.version)
    return registry.load()


def _flat(responses):
    return responses.withColumns({c: F.array_join(c, "; ") for c in ("top_risk_factors", "protective_factors")})


def predict_batch(spark, sf_dir):
    model, card = served_model(spark, sf_dir)
    return _flat(prediction.predict_batch(model, applications_of(spark, sf_dir), card.features, card.version)[0])


def score_stream(spark, sf_dir):
    model, card = served_model(spark, sf_dir)
    source, out = scratch_path(spark, "applications"), scratch_path(spark, "stream")
    cores = spark.sparkContext.defaultParallelism
    applications_of(spark, sf_dir).repartition(4 * cores).write.parquet(source)
    # four batches, each with a file for every core
    query = stream.score_stream(model, stream.read_applications(spark, source, cores), out,
                                scratch_path(spark, "stream-state"), card.features, card.version)
    query.awaitTermination()
    return _flat(stream.read_scored(spark, out).drop("batch"))


def credit_pipeline(spark, sf_dir):
    """Predictions of the calibrated model that one run of the whole job promotes, with the run's metrics beside them."""
    source, root = scratch_path(spark, "csv"), scratch_path(spark, "job")
    raw_loans(spark, sf_dir).select(*S.RAW_FILE.names).write.csv(source, header=True)
    done = job.run(spark, source, root, job.Settings(names=JOB_MODELS))
    told = done.stages["evaluate"].note
    return files.read_predictions(spark, f"{root}/predictions").select(
        S.KEY, F.lit(done.served.name).alias("model"), "probability_of_default", "risk_tier", "expected_loss", "risk_score",
        F.lit(told["roc_auc"]).alias("test_auc"), F.lit(done.stages["drift"].note["drifted"]).alias("drifted"))


def mutual_information(spark, sf_dir):
    return rounded(explain.mutual_information(stored_loans(spark, sf_dir, S.TARGET, *S.NUMERICAL), S.NUMERICAL))


def select_features(spark, sf_dir):
    return rounded(explain.select_features(stored_loans(spark, sf_dir, S.TARGET, *S.NUMERICAL), S.NUMERICAL, top_n=10))


def _model_features(spark, sf_dir):
    return settle(feature_loans(spark, sf_dir).select(S.TARGET, *S.MODEL_FEATURES))


def mutual_information_of_model(spark, sf_dir):
    return rounded(explain.mutual_information(_model_features(spark, sf_dir), S.MODEL_FEATURES))


def select_features_of_model(spark, sf_dir):
    """As many as the operator selects by default, of the model features."""
    return rounded(explain.select_features(_model_features(spark, sf_dir), S.MODEL_FEATURES))


def permutation_importance(spark, sf_dir):
    train, _, used = frames(spark, sf_dir)
    return explain.permutation_importance(train, used)


def _phi(spark, sf_dir):
    return explain.linear_attributions(feature_loans(spark, sf_dir), SCORECARD)


def shapley_values(spark, sf_dir):
    train, test, used = frames(spark, sf_dir)
    model = models.train("DecisionTree", train, used)
    return explain.shapley_values(model, train.unionByName(test), used)


def local_surrogate(spark, sf_dir):
    train, test, used = frames(spark, sf_dir)
    model = models.train("LogisticRegression", train, used)
    return explain.local_surrogate(model, train.unionByName(test), used)


def business_explanation(spark, sf_dir):
    scored = clean_loans(spark, sf_dir).select(S.KEY, F.col("fixture_pd").alias("predicted_pd"))
    told = explain.business_explanation(_phi(spark, sf_dir), scored)
    return told.withColumns({c: F.array_join(c, "; ") for c in ("top_risk_factors", "top_positive_factors")})


QUERIES = {
    "train_logistic": _train("LogisticRegression"), "train_decision_tree": _train("DecisionTree"),
    "train_gaussian_nb": _train("NaiveBayes"), "train_random_forest": _train("RandomForest"),
    "train_gbt": _train("GradientBoosting"), "train_weighted_gbt": _train("WeightedBoosting"),
    "train_all": train_all, "train_all_undersampled": train_all_undersampled,
    "train_smote": _train_resampled("smote"), "train_adasyn": _train_resampled("adasyn"), "log_run": log_run,
    "save_model": save_model, "predict_pd": predict_pd, "tune_gbt": tune_gbt,
    "calibrate_isotonic": calibrate_isotonic, "credit_pipeline": credit_pipeline, "predict_batch": predict_batch, "score_stream": score_stream,
    "mutual_information": mutual_information, "select_features": select_features,
    "mutual_information_of_model": mutual_information_of_model, "select_features_of_model": select_features_of_model,
    "permutation_importance": permutation_importance,
    "linear_attributions": lambda s, d: rounded(_phi(s, d)),
    "shapley_values": shapley_values,
    "attribution_summary": lambda s, d: rounded(explain.attribution_summary(_phi(s, d))),
    "attribution_dependence": lambda s, d: rounded(explain.attribution_dependence(_phi(s, d), "dti")),
    "local_surrogate": local_surrogate, "business_explanation": business_explanation,
}

_edges = ", ".join(f"QUANTILE_CONT(v,{i / explain.BINS}) AS e{i}" for i in range(1, explain.BINS))
_bin = "+".join(f"(CASE WHEN v>e{i} THEN 1 ELSE 0 END)" for i in range(1, explain.BINS))
_mi_long = " UNION ALL ".join(
    f"SELECT is_default AS y, '{c}' AS feature, COALESCE({c},0) AS v FROM clean" for c in S.NUMERICAL)
_mi = f"""long AS ({_mi_long}), edges AS (SELECT feature, {_edges} FROM long GROUP BY feature),
cells AS (SELECT l.feature, {_bin} AS bin, y, COUNT(*) AS n FROM long l JOIN edges e ON l.feature=e.feature GROUP BY 1,2,3),
mi AS (SELECT feature, SUM(g) AS score FROM (SELECT feature, n/SUM(n) OVER f*LN(n*SUM(n) OVER f/(SUM(n) OVER
  (PARTITION BY feature, bin)*SUM(n) OVER (PARTITION BY feature, y))) AS g FROM cells WINDOW f AS (PARTITION BY feature))
  GROUP BY feature)"""
_phi_sql = "means AS (SELECT " + ", ".join(f"AVG({c}) AS {c}" for c in SCORECARD) + " FROM feats), phi AS (" + " UNION ALL ".join(
    f"SELECT loan_id, '{c}' AS feature, COALESCE(f.{c},m.{c}) AS value, {w:.9f}E0*(COALESCE(f.{c},m.{c})-m.{c}) AS phi "
    f"FROM feats f, means m" for c, w in SCORECARD.items()) + ")"
_names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.DESCRIPTIONS.items())
_text = f"""(CASE feature {_names} WHEN 'emp_length_years' THEN 'Emp Length Years' END)
  ||' (value: '||PRINTF('%.2f',value)||')'"""
_told = f"""ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY loan_id ORDER BY ABS(phi) DESC, feature) AS place FROM phi),
named AS (SELECT *, {_text} AS t, ROW_NUMBER() OVER (PARTITION BY loan_id, phi>0 ORDER BY place) AS i FROM ranked
  WHERE place<=10),
sides AS (SELECT loan_id, COALESCE(STRING_AGG(CASE WHEN phi>0 AND i<=5 THEN t END,'; ' ORDER BY place),'') AS up,
  COALESCE(STRING_AGG(CASE WHEN phi<=0 AND i<=5 THEN t END,'; ' ORDER BY place),'') AS down FROM named GROUP BY loan_id)"""
ORACLES = {
    "mutual_information": oracle("SELECT feature, ROUND(score,6) AS score FROM mi", "clean", extra=_mi),
    "select_features": oracle("SELECT feature, ROUND(score,6) AS score FROM mi ORDER BY mi.score DESC, feature LIMIT 10",
                              "clean", extra=_mi),
    "linear_attributions": oracle(
        "SELECT loan_id, feature, ROUND(value,6) AS value, ROUND(phi,6) AS phi FROM phi", "feats", extra=_phi_sql),
    "attribution_summary": oracle(
        """SELECT feature, ROUND(AVG(ABS(phi)),6) AS mean_abs_phi FROM phi GROUP BY feature
           ORDER BY AVG(ABS(phi)) DESC, feature LIMIT 20""", "feats", extra=_phi_sql),
    "attribution_dependence": oracle(
        "SELECT loan_id, ROUND(value,6) AS value, ROUND(phi,6) AS phi FROM phi WHERE feature='dti'", "feats",
        extra=_phi_sql),
    "business_explanation": oracle(
        """SELECT c.loan_id, CAST(PRINTF('%.2f',fixture_pd*100) AS DOUBLE) AS probability_of_default,
           CASE WHEN fixture_pd>=0.5 THEN 'HIGH RISK — Recommend Denial'
           WHEN fixture_pd>=0.25 THEN 'ELEVATED RISK — Recommend Review'
           WHEN fixture_pd>=0.10 THEN 'MODERATE RISK — Conditional Approval'
           ELSE 'LOW RISK — Recommend Approval' END AS decision, up AS top_risk_factors, down AS top_positive_factors
           FROM clean c JOIN sides s ON c.loan_id=s.loan_id""", "feats", extra=_phi_sql + ", " + _told),
}
