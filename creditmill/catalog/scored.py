"""Scores, decisions, rule-based reasons and applications."""

from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.catalog.base import APP_DEFAULTS, applications_of, oracle, r6, rounded, scored_loans
from creditmill.functions import scoring as fn
from creditmill.functions.columns import round_exact
from creditmill.operators import applications, scoring
from creditmill.sources.loans_view import clean_loans


def _columns(*names):
    return lambda spark, sf_dir: rounded(scored_loans(spark, sf_dir).select(S.KEY, "predicted_pd", *names))


def decision_by_tier(spark, sf_dir):
    return scored_loans(spark, sf_dir).select(S.KEY, "risk_tier", fn.decision_by_tier("risk_tier").alias("decision"))


def decision_by_pd(spark, sf_dir):
    return rounded(scored_loans(spark, sf_dir).select(
        S.KEY, "predicted_pd", fn.decision_by_pd("predicted_pd").alias("decision")))


def expected_loss_text(spark, sf_dir):
    text = fn.expected_loss_text("predicted_pd", "loan_amnt", round_exact("expected_loss", 2))
    return scored_loans(spark, sf_dir).select(S.KEY, text.alias("formula"))


def risk_profile(spark, sf_dir):
    return rounded(scoring.risk_profile(
        clean_loans(spark, sf_dir).withColumn("predicted_pd", F.col("fixture_pd"))))


def checked_applications(spark, sf_dir):
    checked = applications.check_applications(applications_of(spark, sf_dir))
    return checked.select(S.KEY, *APP_DEFAULTS, F.array_join("broken", ",").alias("broken"))


def application_to_loan(spark, sf_dir):
    valid, _ = applications.validate_applications(applications_of(spark, sf_dir))
    return rounded(applications.application_to_loan(valid))


def _factors(dashboard):
    def run(spark, sf_dir):
        valid, _ = applications.validate_applications(applications_of(spark, sf_dir))
        found = scoring.risk_factors(valid, dashboard)
        return found.select(S.KEY, F.array_join("top_risk_factors", "; ").alias("top_risk_factors"),
                            F.array_join("protective_factors", "; ").alias("protective_factors"))
    return run


QUERIES = {
    "pd_to_credit_score": _columns("credit_score"),
    "assign_risk_tier": _columns("credit_score", "risk_tier"),
    "expected_loss": _columns("loan_amnt", "expected_loss"),
    "risk_profile": risk_profile,
    "score_portfolio": _columns("loan_amnt", "credit_score", "risk_tier", "expected_loss"),
    "decision_by_tier": decision_by_tier, "decision_by_pd": decision_by_pd,
    "expected_loss_text": expected_loss_text,
    "validate_applications": checked_applications, "application_to_loan": application_to_loan,
    "risk_factors": _factors(False), "risk_factors_dashboard": _factors(True),
}

_pd = "ROUND(predicted_pd,6) AS predicted_pd"
_loss = "ROUND(expected_loss,6) AS expected_loss"
_thousands = "FORMAT('{{:,}}',CAST(ROUND_EVEN({},0) AS BIGINT))".format
_exact = "CAST(PRINTF('%.2f',{}) AS DOUBLE)".format
_same = [c for c in APP_DEFAULTS if c not in ("annual_income", "loan_amount", "grade_numeric", "sub_grade_numeric")]


def _reasons(topics, side):
    """Topic by topic the text of the first true rule, if it is on this side; five at most."""
    cells = []
    for topic in topics:
        arms = " ".join(f"WHEN {cond} THEN {text if s == side else 'NULL'}" for cond, s, text in topic)
        cells.append(f"CASE {arms} END")
    return f"ARRAY_TO_STRING(LIST_SLICE(LIST_FILTER([{', '.join(cells)}], lambda x: x IS NOT NULL),1,5),'; ')"


def _fmt(template, expr, spec="%.0f"):
    before, after = template.split("{}")
    value = f"PRINTF('{spec}',{expr})" if spec else f"CAST({expr} AS VARCHAR)"
    return f"('{before}'||{value}||'{after}')"


_lti = "(loan_amount/GREATEST(annual_income,1))"
R, P = "risk", "protective"


def _int(c):
    return f"CAST(TRUNC({c}) AS INT)"


def _grade(names):
    return "(CASE " + _int("grade_numeric") + " " + " ".join(
        f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END)"


_long = _grade(["A (prime)", "B (near-prime)", "C (mid-tier)", "D (subprime)", "E (deep subprime)", "F (high risk)",
                "G (highest risk)"])
_short = _grade(list("ABCDEFG"))
_API = [
    [("grade_numeric>=4", R, f"'Loan grade '||{_long}||' — significantly increases risk'"),
     ("grade_numeric>=2", R, f"'Loan grade '||{_long}||' — moderate risk tier'"),
     ("TRUE", P, f"'Loan grade '||{_long}||' — lower risk tier'")],
    [(f"{_lti}<0.15", P, _fmt("Strong income-to-loan ratio ({}%) — loan is small relative to income", f"{_lti}*100")),
     (f"{_lti}>0.5", R, _fmt("High loan-to-income ratio ({}%) — loan is large relative to income", f"{_lti}*100"))],
    [("dti<=12", P, _fmt("Low DTI ({}%) — healthy debt load", "dti")),
     ("dti>=28", R, _fmt("High DTI ({}%) — heavy existing debt burden", "dti")),
     ("dti>=20", R, _fmt("Moderate DTI ({}%) — manageable but elevated", "dti"))],
    [("int_rate<=8", P, _fmt("Low interest rate ({}%) — favorable pricing", "int_rate", "%.1f")),
     ("int_rate>=18", R, _fmt("High interest rate ({}%) — priced for risk", "int_rate", "%.1f")),
     ("int_rate>=13", R, _fmt("Above-average interest rate ({}%)", "int_rate", "%.1f"))],
    [("revol_util<=25", P, _fmt("Low revolving utilization ({}%) — healthy credit usage", "revol_util")),
     ("revol_util>=70", R, _fmt("High revolving utilization ({}%) — near credit limits", "revol_util")),
     ("revol_util>=45", R, _fmt("Moderate revolving utilization ({}%)", "revol_util"))],
    [("delinq_2yrs=0", P, "'No delinquencies in past 2 years — clean payment history'"),
     ("delinq_2yrs>=2", R, _fmt("{} delinquencies in past 2 years — payment issues", _int("delinq_2yrs"), "")),
     ("TRUE", R, _fmt("{} delinquency in past 2 years", _int("delinq_2yrs"), ""))],
    [("emp_length_years>=7", P, _fmt("Stable employment ({} years)", _int("emp_length_years"), "")),
     ("emp_length_years<=1", R, _fmt("Short employment history ({} year)", _int("emp_length_years"), ""))],
    [("pub_rec>0", R, _fmt("{} public record(s) — bankruptcies or liens", _int("pub_rec"), ""))],
    [("inq_last_6mths>=4", R, _fmt("{} credit inquiries in 6 months — active credit seeking",
                                   _int("inq_last_6mths"), ""))],
]
_DASHBOARD = [
    [("grade_numeric>=4", R, f"'Loan grade '||{_short}||' — high risk tier'"),
     ("grade_numeric>=2", R, f"'Loan grade '||{_short}||' — moderate risk tier'"),
     ("TRUE", P, f"'Loan grade '||{_short}||' — lower risk tier'")],
    [(f"{_lti}<0.15", P, _fmt("Strong income-to-loan ratio ({}%)", f"{_lti}*100")),
     (f"{_lti}>0.5", R, _fmt("High loan-to-income ratio ({}%)", f"{_lti}*100"))],
    [("dti<=12", P, _fmt("Low DTI ({}%)", "dti")), ("dti>=25", R, _fmt("High DTI ({}%)", "dti"))],
    [("int_rate<=8", P, _fmt("Low interest rate ({}%)", "int_rate", "%.1f")),
     ("int_rate>=16", R, _fmt("High interest rate ({}%)", "int_rate", "%.1f"))],
    [("revol_util<=30", P, _fmt("Low revolving utilization ({}%)", "revol_util")),
     ("revol_util>=65", R, _fmt("High revolving utilization ({}%)", "revol_util"))],
    [("delinq_2yrs=0", P, "'No delinquencies — clean payment history'"),
     ("TRUE", R, _fmt("{} delinquencies in past 2 years", _int("delinq_2yrs"), ""))],
    [("emp_length_years>=7", P, _fmt("Stable employment ({} years)", _int("emp_length_years"), "")),
     ("emp_length_years<=1", R, _fmt("Short employment history ({} year)", _int("emp_length_years"), ""))],
    [("pub_rec>0", R, _fmt("{} public record(s)", _int("pub_rec"), ""))],
]


def _factors_sql(topics):
    return oracle(f"""SELECT loan_id, {_reasons(topics, R)} AS top_risk_factors,
        {_reasons(topics, P)} AS protective_factors FROM valid""", "valid")


_letter = "SUBSTRING('ABCDEFG',CAST(TRUNC(LEAST(GREATEST(grade_numeric,0),6)) AS INT)+1,1)"
ORACLES = {
    "pd_to_credit_score": oracle(f"SELECT loan_id, {_pd}, credit_score FROM scored", "scored"),
    "assign_risk_tier": oracle(f"SELECT loan_id, {_pd}, credit_score, risk_tier FROM scored", "scored"),
    "expected_loss": oracle(f"SELECT loan_id, {_pd}, loan_amnt, {_loss} FROM scored", "scored"),
    "risk_profile": oracle(
        f"""SELECT loan_id, {_exact('predicted_pd*100')} AS probability_of_default, credit_score, risk_tier,
            {_exact('expected_loss')} AS expected_loss, loan_amnt AS loan_amount, annual_inc AS annual_income, dti,
            int_rate AS interest_rate, CASE WHEN annual_inc IS NOT NULL
            THEN {_exact('loan_amnt/GREATEST(annual_inc,1)*100')} END AS loan_to_income FROM scored""", "scored"),
    "score_portfolio": oracle(f"SELECT loan_id, {_pd}, loan_amnt, credit_score, risk_tier, {_loss} FROM scored",
                              "scored"),
    "decision_by_tier": oracle(
        """SELECT loan_id, risk_tier, CASE risk_tier
           WHEN 'High Risk' THEN 'HIGH RISK (Subprime) — Recommend Denial or High-Rate Pricing'
           WHEN 'Medium Risk' THEN 'MEDIUM RISK (Near-Prime) — Standard Approval with Review'
           ELSE 'LOW RISK (Prime) — Recommend Approval at Best Rates' END AS decision FROM scored""", "scored"),
    "decision_by_pd": oracle(
        f"""SELECT loan_id, {_pd}, CASE WHEN predicted_pd>=0.5 THEN 'HIGH RISK — Recommend Denial'
            WHEN predicted_pd>=0.25 THEN 'ELEVATED RISK — Recommend Review'
            WHEN predicted_pd>=0.10 THEN 'MODERATE RISK — Conditional Approval'
            ELSE 'LOW RISK — Recommend Approval' END AS decision FROM scored""", "scored"),
    "expected_loss_text": oracle(
        f"""SELECT loan_id, 'PD('||PRINTF('%.2f',predicted_pd*100)||'%) x EAD($'||{_thousands('loan_amnt')}
            ||') x LGD(45%) = $'||{_thousands(_exact('expected_loss'))} AS formula FROM scored""", "scored"),
    "validate_applications": oracle(
        f"SELECT loan_id, {', '.join(APP_DEFAULTS)}, ARRAY_TO_STRING(broken,',') AS broken FROM checked", "checked"),
    "application_to_loan": oracle(
        f"""SELECT loan_id, annual_income AS annual_inc, loan_amount AS loan_amnt, loan_amount AS funded_amnt,
            {r6(*_same)}, 36.0E0 AS term_months, {_letter} AS grade,
            {_letter}||CAST(CAST(TRUNC(sub_grade_numeric%5) AS INT)+1 AS VARCHAR) AS sub_grade FROM valid""", "valid"),
    "risk_factors": _factors_sql(_API),
    "risk_factors_dashboard": _factors_sql(_DASHBOARD),
}
