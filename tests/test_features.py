import pytest
from pyspark.sql import functions as F

from creditmill.operators import cleaning, features

COLUMNS = ("loan_id", "loan_amnt", "funded_amnt", "annual_inc", "dti", "installment", "int_rate", "revol_util", "revol_bal",
           "open_acc", "total_acc", "delinq_2yrs", "pub_rec", "tot_cur_bal", "total_rev_hi_lim", "emp_length_years",
           "term_months", "total_pymnt", "total_rec_prncp", "last_pymnt_amnt", "is_default")
ROWS = [(41, 18000, 18000, 72000, 20.0, 600, 12.5, 60.0, 9000, 9, 26, 0, 0, 120000, 30000, 4, 36, 9000, 6000, 600, 0),
        (42, 9600, 9500, 41000, 33.0, 240, 21.0, 97.0, 7400, 5, 31, 3, 2, 8200, 7600, 0, 60, 1300, 700, 240, 1),
        (43, 32000, 32000, 210000, 4.5, 1000, 6.1, 8.0, 1500, 15, 22, 1, 0, 460000, 65000, 9, 36, 32500, 32000, 950, 0),
        (44, 2500, 2500, 28500, 12.0, 85, 16.2, 0.0, 0, 2, 3, 0, 0, 900, 1200, 2, 36, 400, 250, 85, 1)]


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame(ROWS, list(COLUMNS))


def test_values_by_hand(loans):
    r = loans.transform(features.feature_pipeline).filter("loan_id = 41").first()
    strength = 0.35 * 0.4 + 0.25 * 9 / 27 + 0.2 + 0.2
    expected = {
        "loan_income_ratio": 18000 / 72001, "installment_income_ratio": 600 / 6001, "monthly_payment_ratio": 600 / 501,
        "interest_payment_ratio": 2250 / 72001, "credit_utilization_overall": 120000 / 30001,
        "payment_completion_ratio": 9000 / 18001, "principal_payment_ratio": 6000 / 9001, "last_payment_ratio": 600 / 601,
        "credit_strength_score": strength, "income_x_credit_strength": 72000 * strength,
        "financial_health_score": 0.3 * 0.8 + 0.25 * 0.4 + 0.2 + 0.15 * (1 - 18000 / 72001) + 0.1 * 9 / 27}
    assert {c: r[c] for c in expected} == pytest.approx(expected)
    assert (r["income_bracket"], r["loan_amount_bracket"], r["int_rate_bracket"]) == ("50-75K", "15-25K", "Medium")


def test_scores_within_unit_interval(loans):
    out = loans.transform(features.feature_pipeline)
    for c in ("financial_health_score", "credit_strength_score", "repayment_capacity_score"):
        assert out.filter((F.col(c) < 0) | (F.col(c) > 1) | F.col(c).isNull()).count() == 0


def test_absent_columns_fall_back(loans):
    out = loans.drop("emp_length_years", "term_months").transform(features.feature_pipeline)
    r = out.filter("loan_id = 42").first()
    assert r["inquiry_frequency"] == 0.0 and r["employment_stability"] == 0.5
    assert r["monthly_payment_ratio"] == pytest.approx(240 / (9600 / 36 + 1))
    assert "grade_numeric" not in out.columns
    bare = features.behavioral_features(loans.drop("total_pymnt", "last_pymnt_amnt"))
    assert not {"payment_completion_ratio", "principal_payment_ratio", "last_payment_ratio"} & set(bare.columns)


def test_zero_denominator_and_nulls(spark, loans):
    odd = loans.withColumn("annual_inc", F.when(F.col("loan_id") == 41, F.lit(-1)))
    rows = {r["loan_id"]: r for r in odd.transform(features.feature_pipeline).collect()}
    assert rows[41]["loan_income_ratio"] is None and rows[41]["revol_bal_x_income"] is None
    assert rows[42]["loan_income_ratio"] is None and rows[42]["financial_health_score"] is None
    assert rows[42]["income_bracket"] is None


@pytest.mark.parametrize("income,label", [(0, None), (30000, "<30K"), (30000.01, "30-50K"), (150000, "100-150K"),
                                          (1e9, "150K+"), (-5, None)])
def test_brackets_are_right_closed(spark, income, label):
    df = spark.createDataFrame([(float(income), 5000.0, 7.0)], ["annual_inc", "loan_amnt", "int_rate"])
    r = features.brackets(df).first()
    assert (r["income_bracket"], r["loan_amount_bracket"], r["int_rate_bracket"]) == (label, "<5K", "Low")


def test_clean_texts(spark):
    rows = [("13.56%", "< 1 year", " 36 months"), (" 7%%", "10+ years", "60 months "), ("n/a", "11 years", None),
            (None, None, "x")]
    df = spark.createDataFrame(rows, "int_rate string, emp_length string, term string")
    out = df.transform(cleaning.clean_percentages).transform(cleaning.clean_emp_length).transform(cleaning.clean_term)
    got = [(r["int_rate"], r["emp_length_years"], r["term_months"]) for r in out.collect()]
    assert got == [(13.56, 0.0, 36.0), (7.0, 10.0, 60.0), (None, None, None), (None, None, None)]
    numeric = spark.createDataFrame([(1.5, 36.0)], ["int_rate", "term"])
    assert cleaning.clean_term(cleaning.clean_percentages(numeric)).columns == ["int_rate", "term"]


def test_status_filter_drops_null_and_others(spark):
    df = spark.createDataFrame([(1, "Fully Paid"), (2, "Charged Off"), (3, "Current"), (4, None)],
                               "loan_id int, loan_status string")
    out = cleaning.binary_target(cleaning.filter_loan_status(df))
    assert {(r["loan_id"], r["is_default"]) for r in out.collect()} == {(1, 0), (2, 1)}


def test_null_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, inf), (2, -inf), (3, float("nan")), (4, 2.0), (5, None)], "k int, x double")
    assert [r["x"] for r in cleaning.null_infinities(df).orderBy("k").collect()] == [None, None, None, 2.0, None]
