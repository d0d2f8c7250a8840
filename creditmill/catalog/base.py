"""Shared SQL and frames of the registered queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as S
from creditmill.operators import applications, features
from creditmill.session import settle
from creditmill.sources.loans_view import LOANS_SQL, TABLES, clean_loans

TEXT_DATE = "CAST(CAST(issue_d AS DATE) AS VARCHAR) AS issue_d"

# Columns of the cleaned view by type, in order.
TEXTS = S.CATEGORICAL
NUMBERS = S.NUMERICAL + ["emp_length_years", "term_months"]

_years = " ".join(f"WHEN '{t}' THEN {float(y)}E0" for t, y in S.EMP_YEARS.items())
CLEAN_BODY = f"""
SELECT * REPLACE (CAST(RTRIM(int_rate,'%') AS DOUBLE) AS int_rate, CAST(RTRIM(revol_util,'%') AS DOUBLE) AS revol_util),
  id AS loan_id, CASE WHEN loan_status='Charged Off' THEN 1 ELSE 0 END AS is_default,
  CASE emp_length {_years} END AS emp_length_years,
  CAST(SPLIT_PART(TRIM(term),' ',1) AS DOUBLE) AS term_months
FROM loans WHERE loan_status IN ('Fully Paid','Charged Off')"""


def _clip(x, lo, hi):
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE LEAST(GREATEST({x},{lo}E0),{hi}E0) END)"


def _ratio(a, b):
    return f"(({a})/NULLIF({b},0))"


def sql_bracket(c, edges, labels):
    arms = " ".join(f"WHEN {c} <= {e} THEN '{n}'" for e, n in zip(edges[1:], labels))
    return f"CASE WHEN {c} <= {edges[0]} THEN NULL {arms} WHEN {c} > {edges[-1]} THEN '{labels[-1]}' END"


def sql_position(c, names):
    return "CASE " + c + " " + " ".join(f"WHEN '{n}' THEN {i}.0E0" for i, n in enumerate(names)) + " END"


def _bad(x):
    return f"(1-{_clip(x, 0, 1)})"


FEATURE_SQL = {
    "ratios": {
        "loan_income_ratio": _ratio("loan_amnt", "annual_inc+1"),
        "debt_income_ratio": "dti/100",
        "installment_income_ratio": _ratio("installment", "annual_inc/12+1"),
        "revolving_utilization_ratio": _clip("revol_util", 0, 150) + "/100",
        "monthly_payment_ratio": _ratio("installment", "loan_amnt/term_months+1"),
        "funded_ratio": _ratio("funded_amnt", "loan_amnt+1"),
        "interest_payment_ratio": _ratio("int_rate/100*loan_amnt", "annual_inc+1"),
    },
    "credit": {
        "total_credit_lines_ratio": _ratio("open_acc", "total_acc+1"),
        "delinquency_rate": _ratio("delinq_2yrs", "total_acc+1"),
        "inquiry_frequency": "inq_last_6mths/6",
        "public_record_ratio": _ratio("pub_rec", "total_acc+1"),
        "revolving_balance_per_account": _ratio("revol_bal", "open_acc+1"),
        "credit_utilization_overall": _ratio("tot_cur_bal", "total_rev_hi_lim+1"),
    },
    "scores": {
        "financial_health_score":
            f"0.3E0*{_bad('debt_income_ratio')}+0.25E0*{_bad('revolving_utilization_ratio')}"
            f"+0.2E0*{_bad('delinquency_rate')}+0.15E0*{_bad('loan_income_ratio')}"
            f"+0.1E0*{_clip('total_credit_lines_ratio', 0, 1)}",
        "credit_strength_score":
            f"0.35E0*{_bad('revolving_utilization_ratio')}+0.25E0*{_clip('total_credit_lines_ratio', 0, 1)}"
            f"+0.2E0*{_bad('delinquency_rate')}+0.2E0*{_bad('public_record_ratio')}",
        "repayment_capacity_score":
            f"0.4E0*{_bad('installment_income_ratio')}+0.3E0*{_bad('debt_income_ratio')}"
            f"+0.3E0*{_bad('loan_income_ratio')}",
    },
    "behavior": {"employment_stability": "COALESCE(emp_length_years,0)/10"},
    "interactions": {
        "income_x_credit_strength": "annual_inc*credit_strength_score",
        "dti_x_loan_amount": "dti*loan_amnt",
        "revol_bal_x_income": _ratio("revol_bal", "annual_inc+1"),
        "int_rate_x_loan": "int_rate*loan_amnt",
        "installment_x_dti": "installment*dti",
        "income_x_employment": "annual_inc*employment_stability",
    },
    "brackets": {
        "income_bracket": sql_bracket("annual_inc", *S.INCOME_BRACKETS),
        "loan_amount_bracket": sql_bracket("loan_amnt", *S.LOAN_BRACKETS),
        "int_rate_bracket": sql_bracket("int_rate", *S.RATE_BRACKETS),
    },
    "grades": {"grade_numeric": sql_position("grade", S.GRADES),
               "sub_grade_numeric": sql_position("sub_grade", S.SUB_GRADES)},
}


def _feature_ctes():
    out, source = [], "clean"
    for step, columns in FEATURE_SQL.items():
        new = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
        out.append(f"f_{step} AS (SELECT *, {new} FROM {source})")
        source = f"f_{step}"
    return ", ".join(out) + f", feats AS (SELECT * FROM {source})"


SCORED_BODY = """
SELECT *, CASE WHEN credit_score >= 740 THEN 'Low Risk' WHEN credit_score >= 670 THEN 'Medium Risk' ELSE 'High Risk' END
  AS risk_tier, predicted_pd*loan_amnt*0.45E0 AS expected_loss
FROM (SELECT *, fixture_pd AS predicted_pd,
  CAST(TRUNC(LEAST(GREATEST(850.0E0-fixture_pd*700.0E0,300.0E0),850.0E0)) AS INT) AS credit_score FROM clean)"""

_app_same = ["dti", "int_rate", "installment", "emp_length_years", "revol_util", "revol_bal", "open_acc", "total_acc",
             "delinq_2yrs", "inq_last_6mths", "pub_rec", "grade_numeric", "sub_grade_numeric"]
# Applications: cleaned loans under application names; every 50th has a DTI below its range.
APPS_BODY = f"""
SELECT loan_id, annual_inc AS annual_income, loan_amnt AS loan_amount,
  CASE WHEN loan_id%50=0 THEN -1.0E0 ELSE dti END AS dti, {", ".join(_app_same[1:])} FROM feats"""
APP_DEFAULTS = {name: default for name, *_, default in applications.FIELDS}
FILLED_BODY = "SELECT loan_id, " + ", ".join(
    name if d is None else f"COALESCE({name},{float(d)}E0) AS {name}" for name, d in APP_DEFAULTS.items()) + " FROM apps"


def _sql_broken():
    marks = []
    for name, low, open_low, high, _ in applications.FIELDS:
        bad = f"{name} IS NULL OR {name} {'<=' if open_low else '<'} {low}" + (f" OR {name} > {high}" if high else "")
        marks.append(f"CASE WHEN {bad} THEN '{name}' END")
    return "LIST_FILTER([" + ", ".join(marks) + "], lambda x: x IS NOT NULL)"


_loans = LOANS_SQL.format(**{t: t for t in TABLES})
CTES = {
    "loans": f"loans AS ({_loans})",
    "clean": f"clean AS ({CLEAN_BODY})",
    "feats": _feature_ctes(),
    "scored": f"scored AS ({SCORED_BODY})",
    "apps": f"apps AS ({APPS_BODY})",
    "filled": f"filled AS ({FILLED_BODY})",
    "checked": f"checked AS (SELECT *, {_sql_broken()} AS broken FROM filled)",
    "valid": "valid AS (SELECT * FROM checked WHERE LEN(broken)=0)",
}
NEEDS = {"loans": [], "clean": ["loans"], "feats": ["clean"], "scored": ["clean"], "apps": ["feats"],
         "filled": ["apps"], "checked": ["filled"], "valid": ["checked"]}


def oracle(body: str, *sources: str, extra: str = "") -> str:
    """`body` after the CTEs it reads, each with what it needs."""
    order: list[str] = []

    def add(name):
        for need in NEEDS[name]:
            add(need)
        if name not in order:
            order.append(name)
    for name in sources:
        add(name)
    parts = [CTES[n] for n in order] + ([extra] if extra else [])
    return "WITH " + ", ".join(parts) + " " + body


def r6(*columns: str) -> str:
    return ", ".join(f"ROUND({c},6) AS {c}" for c in columns)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double, so that both engines print the same digits."""
    new = {f.name: F.round(F.col(f"`{f.name}`"), places) for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(new) if new else df


def stored_loans(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned loans (or some columns) written out once, for operators that read their input repeatedly."""
    loans = clean_loans(spark, sf_dir)
    return settle(loans.select(*columns) if columns else loans)


def model_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored loans without identifiers, date and fixture PD: what preprocessing sees."""
    return stored_loans(spark, sf_dir, S.KEY, *TEXTS, *NUMBERS, S.STATUS, S.TARGET)


def feature_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_loans(spark, sf_dir).transform(features.feature_pipeline)


def applications_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = applications.loans_as_applications(feature_loans(spark, sf_dir))
    broken = F.when(F.col("loan_id") % 50 == 0, F.lit(-1.0)).otherwise(F.col("dti"))
    return apps.withColumn("dti", broken)


def scored_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditmill.operators.scoring import score_portfolio
    return clean_loans(spark, sf_dir).withColumn("predicted_pd", F.col("fixture_pd")).transform(score_portfolio)
