"""Derived borrower features: each step only adds columns, so Catalyst folds them into one projection."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions.columns import bracket, clamp, position_in, ratio

DEFAULT_TERM = 36


def _good(name: str):
    """A share to be high: clipped to [0, 1]."""
    return clamp(name, 0, 1)


def _bad(name: str):
    """A share to be low: one minus its clipped value."""
    return F.lit(1.0) - clamp(name, 0, 1)


def _weighted(*terms):
    total = None
    for weight, term in terms:
        part = F.lit(weight) * term
        total = part if total is None else total + part
    return total


def financial_ratios(df: DataFrame) -> DataFrame:
    c = F.col
    income = c("annual_inc") + 1
    term = c("term_months") if "term_months" in df.columns else F.lit(float(DEFAULT_TERM))
    return df.withColumns({
        "loan_income_ratio": ratio("loan_amnt", income),
        "debt_income_ratio": c("dti") / 100,
        "installment_income_ratio": ratio("installment", c("annual_inc") / 12 + 1),
        "revolving_utilization_ratio": clamp("revol_util", 0, 150) / 100,
        "monthly_payment_ratio": ratio("installment", ratio("loan_amnt", term) + 1),
        "funded_ratio": ratio("funded_amnt", c("loan_amnt") + 1),
        "interest_payment_ratio": ratio(c("int_rate") / 100 * c("loan_amnt"), income),
    })


def credit_features(df: DataFrame) -> DataFrame:
    c = F.col
    have = set(df.columns)
    lines = c("total_acc") + 1
    new = {
        "total_credit_lines_ratio": ratio("open_acc", lines),
        "delinquency_rate": ratio("delinq_2yrs", lines),
        "inquiry_frequency": c("inq_last_6mths") / 6 if "inq_last_6mths" in have else F.lit(0.0),
        "public_record_ratio": ratio("pub_rec", lines),
        "revolving_balance_per_account": ratio("revol_bal", c("open_acc") + 1),
    }
    if {"tot_cur_bal", "total_rev_hi_lim"} <= have:
        new["credit_utilization_overall"] = ratio("tot_cur_bal", c("total_rev_hi_lim") + 1)
    return df.withColumns(new)


def risk_scores(df: DataFrame) -> DataFrame:
    # Weights of the three composite scores and the neutral utilization.
    spare_limit = (_bad("revolving_utilization_ratio") if "revolving_utilization_ratio" in df.columns
                   else F.lit(1.0) - F.lit(0.5))
    return df.withColumns({
        "financial_health_score": _weighted(
            (0.3, _bad("debt_income_ratio")), (0.25, _bad("revolving_utilization_ratio")),
            (0.2, _bad("delinquency_rate")), (0.15, _bad("loan_income_ratio")),
            (0.1, _good("total_credit_lines_ratio"))),
        "credit_strength_score": _weighted(
            (0.35, spare_limit), (0.25, _good("total_credit_lines_ratio")),
            (0.2, _bad("delinquency_rate")), (0.2, _bad("public_record_ratio"))),
        "repayment_capacity_score": _weighted(
            (0.4, _bad("installment_income_ratio")), (0.3, _bad("debt_income_ratio")),
            (0.3, _bad("loan_income_ratio"))),
    })


def behavioral_features(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    tenure = (F.coalesce("emp_length_years", F.lit(0.0)) / 10 if "emp_length_years" in have else F.lit(0.5))
    new = {"employment_stability": tenure}
    for name, top, bottom in (("payment_completion_ratio", "total_pymnt", "funded_amnt"),
                              ("principal_payment_ratio", "total_rec_prncp", "total_pymnt"),
                              ("last_payment_ratio", "last_pymnt_amnt", "installment")):
        if {top, bottom} <= have:
            new[name] = ratio(top, F.col(bottom) + 1)
    return df.withColumns(new)


def interaction_features(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "income_x_credit_strength": c("annual_inc") * c("credit_strength_score"),
        "dti_x_loan_amount": c("dti") * c("loan_amnt"),
        "revol_bal_x_income": ratio("revol_bal", c("annual_inc") + 1),
        "int_rate_x_loan": c("int_rate") * c("loan_amnt"),
        "installment_x_dti": c("installment") * c("dti"),
        "income_x_employment": c("annual_inc") * c("employment_stability"),
    })


def brackets(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "income_bracket": bracket("annual_inc", *S.INCOME_BRACKETS),
        "loan_amount_bracket": bracket("loan_amnt", *S.LOAN_BRACKETS),
        "int_rate_bracket": bracket("int_rate", *S.RATE_BRACKETS),
    })


def grade_numeric(df: DataFrame) -> DataFrame:
    codes = {"grade_numeric": ("grade", S.GRADES), "sub_grade_numeric": ("sub_grade", S.SUB_GRADES)}
    new = {out: position_in(src, names) for out, (src, names) in codes.items() if src in df.columns}
    return df.withColumns(new) if new else df


def feature_pipeline(df: DataFrame) -> DataFrame:
    for step in (financial_ratios, credit_features, risk_scores, behavioral_features,
                 interaction_features, brackets, grade_numeric):
        df = df.transform(step)
    return df
