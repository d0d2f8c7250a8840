import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmill.functions import scoring as fn
from creditmill.functions.columns import fixed_text, round_exact
from creditmill.operators import applications, drift, metrics, scoring, validation

APP = {"annual_income": 64000.0, "loan_amount": 11000.0, "dti": 21.0, "int_rate": 14.0, "installment": 380.0,
       "emp_length_years": 3.0, "revol_util": 55.0, "revol_bal": 8000.0, "open_acc": 7.0, "total_acc": 18.0,
       "delinq_2yrs": 0.0, "inq_last_6mths": 2.0, "pub_rec": 0.0, "grade_numeric": 3.0, "sub_grade_numeric": 16.0}


def app(spark, **changes):
    row = {**APP, **changes}
    return spark.createDataFrame([(1, *row.values())], "loan_id long, " + ", ".join(f"{c} double" for c in row))


@pytest.mark.parametrize("p,score,tier", [(0.0, 850, "Low Risk"), (0.157, 740, "Low Risk"), (0.158, 739, "Medium Risk"),
                                          (0.257, 670, "Medium Risk"), (0.2586, 668, "High Risk"), (0.9, 300, "High Risk"),
                                          (1.0, 300, "High Risk"), (None, None, None)])
def test_score_and_tier(spark, p, score, tier):
    df = spark.createDataFrame([(p,)], "predicted_pd double")
    r = df.select(fn.pd_to_credit_score("predicted_pd").alias("s")).withColumn("t", fn.assign_risk_tier("s")).first()
    assert (r["s"], r["t"]) == (score, tier)


def test_decisions_by_pd(spark):
    df = spark.createDataFrame([(0.5,), (0.25,), (0.1,), (0.09,)], "p double")
    got = [r["d"].split(" — ")[0] for r in df.select(fn.decision_by_pd("p").alias("d")).collect()]
    assert got == ["HIGH RISK", "ELEVATED RISK", "MODERATE RISK", "LOW RISK"]


def test_fixed_text_equals_exact_rounding(spark):
    values = [0.5, 1.5, 2.5, 83.5, 12.25, 12.35, 21.45, 1.005, 2.675, 4098.735, 5039.685, 100.0, 0.0, 17.05]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2):
        rows = df.select("x", fixed_text("x", digits).alias("t"), round_exact("x", digits).alias("r")).collect()
        assert [r["t"] for r in rows] == [f"{v:.{digits}f}" for v in values]
        assert [r["r"] for r in rows] == [round(v, digits) for v in values]


def test_portfolio_without_pd_column_is_unchanged(spark):
    df = spark.createDataFrame([(1, 2.0)], "loan_id long, loan_amnt double")
    assert scoring.score_portfolio(df).columns == df.columns


def test_reasons_at_thresholds(spark):
    risky = app(spark, dti=28.0, int_rate=18.0, revol_util=70.0, delinq_2yrs=1.0, emp_length_years=1.0, pub_rec=2.0,
                inq_last_6mths=4.0, grade_numeric=4.9, loan_amount=60000.0)
    r = scoring.risk_factors(risky).first()
    assert r["top_risk_factors"] == [
        "Loan grade E (deep subprime) — significantly increases risk",
        "High loan-to-income ratio (94%) — loan is large relative to income",
        "High DTI (28%) — heavy existing debt burden", "High interest rate (18.0%) — priced for risk",
        "High revolving utilization (70%) — near credit limits"]
    assert r["protective_factors"] == []
    good = app(spark, dti=12.0, int_rate=8.0, revol_util=25.0, grade_numeric=1.0, loan_amount=100.0)
    assert len(scoring.risk_factors(good).first()["protective_factors"]) == 5
    board = scoring.risk_factors(app(spark, dti=25.0, int_rate=16.0, revol_util=65.0, grade_numeric=2.0), dashboard=True).first()
    assert board["top_risk_factors"] == ["Loan grade C — moderate risk tier", "High DTI (25%)",
                                         "High interest rate (16.0%)", "High revolving utilization (65%)"]


def test_applications_default_and_quarantine(spark):
    bare = spark.createDataFrame([(1, 50000.0, 5000.0, 10.0, 9.0, 100.0)],
                                 "loan_id long, annual_income double, loan_amount double, dti double, int_rate double, "
                                 "installment double")
    ok, bad = applications.validate_applications(bare)
    assert ok.first()["open_acc"] == 5.0 and ok.first()["grade_numeric"] == 2.0 and bad.count() == 0
    for field, value in (("annual_income", 0.0), ("dti", 100.5), ("int_rate", -1.0), ("emp_length_years", 16.0),
                         ("grade_numeric", 7.0), ("sub_grade_numeric", 35.0), ("loan_amount", None),
                         ("pub_rec", float("nan"))):
        ok, bad = applications.validate_applications(app(spark, **{field: value}))
        assert ok.count() == 0 and bad.first()["broken"] == [field]
    for field, value in (("dti", 0.0), ("dti", 100.0), ("int_rate", 40.0), ("revol_util", 150.0)):
        assert applications.validate_applications(app(spark, **{field: value}))[0].count() == 1


def test_grades_are_rederived(spark):
    r = applications.application_to_loan(app(spark, grade_numeric=2.7, sub_grade_numeric=33.0)).first()
    assert (r["grade"], r["sub_grade"], r["term_months"], r["funded_amnt"]) == ("C", "C4", 36.0, 11000.0)


def test_rank_metrics_with_ties(spark):
    rng = np.random.default_rng(0)
    y, p = rng.integers(0, 2, 400), rng.integers(0, 25, 400) / 25
    df = spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))],
                               "loan_id long, is_default int, predicted_pd double")
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert metrics.roc_auc(df).first()["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))
    area, seen = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        recall, precision = y[p >= t].sum() / y.sum(), y[p >= t].mean()
        area, seen = area + (recall - seen) * precision, recall
    assert metrics.average_precision(df).first()["pr_auc"] == pytest.approx(area)
    last = metrics.gain_lift(df).orderBy(F.desc("pct_population")).first()
    assert (last["pct_population"], last["pct_defaults"], last["lift"], last["decile"]) == (100.0, 100.0, 1.0, 10)


def test_undefined_metrics(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (2, 0, 0.2)], "loan_id long, is_default int, predicted_pd double")
    r = metrics.threshold_metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1_score"]) == (1.0, 0.0, 0.0, 0.0)
    assert metrics.roc_auc(df).first()["roc_auc"] is None
    assert {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()} == {
        (0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}


def test_best_model_rule(spark):
    # the rule trades a sliver of AUC for F1
    board = spark.createDataFrame([("a", .7510, .4310), ("b", .7505, .2200), ("c", .7470, .4300), ("d", .7460, .4309), ("e", .7458, .9)],
                                  "model string, roc_auc double, f1_score double")
    assert metrics.select_best_model(board).first()["model"] == "a"
    assert metrics.select_best_model(board, slack=0.006).first()["model"] == "e"


def test_validation_levels(spark):
    rows = [(float(i % 3), None if i % 2 else 1.0, int(i == 0)) for i in range(30)]
    df = spark.createDataFrame(rows, "loan_amnt double, dti double, is_default int")
    found = {(r["level"], r["check"]): r["value"] for r in validation.validation_report(df).collect()}
    assert found["WARN", "numerical_missing"] == 13.0 and found["INFO", "categorical_present"] == 0.0
    assert found["WARN", "severe_imbalance"] == pytest.approx(1 / 30)
    assert found["WARN", "duplicate_rows"] == 30 - df.distinct().count()
    assert ("WARN", "high_null_columns") not in found  # exactly half is not above half
    assert found["PASS", "verdict"] == 0.0
    one_class = validation.check_class_balance(df.filter("is_default = 0")).collect()
    assert [(r["check"], r["value"]) for r in one_class] == [("minority_share", 1.0)]


def test_empty_or_unlabelled_frames_fail(spark):
    empty = spark.createDataFrame([], "loan_amnt double, is_default int")
    rows = {(r["level"], r["check"]) for r in validation.validation_report(empty).collect()}
    assert {("FAIL", "rows"), ("FAIL", "verdict")} <= rows and not any(c == "minority_share" for _, c in rows)
    with pytest.raises(validation.ValidationFailed, match="rows"):
        validation.require_valid(empty)
    with pytest.raises(validation.ValidationFailed, match="target_present"):
        validation.require_valid(spark.createDataFrame([(1.0,)], "loan_amnt double"))


def test_drift_distance_and_test_choice(spark):
    rng = np.random.default_rng(2)
    ref, cur = rng.normal(0, 1, 1500), rng.normal(0.5, 1, 700)
    def frame(x):
        return spark.createDataFrame([(float(v), float(round(abs(v))  > 1)) for v in x], "dti double, pub_rec double")
    rows = {r["column"]: r for r in drift.column_drift(frame(ref), frame(cur), ["dti", "pub_rec"]).collect()}
    grid = np.sort(np.concatenate([ref, cur]))
    gap = np.abs(np.searchsorted(np.sort(ref), grid, "right") / 1500 - np.searchsorted(np.sort(cur), grid, "right") / 700)
    assert rows["dti"]["ks"] == pytest.approx(gap.max())
    assert rows["dti"]["statistic"] == pytest.approx((gap[:-1] * np.diff(grid)).sum() / ref.std())
    assert rows["dti"]["test"] == "wasserstein" and rows["dti"]["drifted"]
    assert rows["pub_rec"]["test"] == "jensen_shannon"
    small = drift.column_drift(frame(ref[:300]), frame(ref[300:600]), ["dti"]).first()
    assert small["test"] == "kolmogorov_smirnov" and not small["drifted"]
    verdict = drift.dataset_drift(drift.column_drift(frame(ref), frame(cur), ["dti", "pub_rec"])).first()
    assert verdict["n_columns"] == 2 and verdict["dataset_drifted"]
