"""Column lists, table contracts and scoring constants shared by every operator."""

from pyspark.sql import types as T

TARGET = "is_default"
STATUS = "loan_status"
KEY = "loan_id"

# Statuses kept for modelling and the one that counts as a default.
KEPT_STATUSES = ["Fully Paid", "Charged Off"]
DEFAULT_STATUS = "Charged Off"

# Credit score range, slope, tier floors and loss-given-default.
SCORE_MIN, SCORE_MAX, SCORE_SLOPE = 300, 850, 700
TIER_FLOORS = [("Low Risk", 740), ("Medium Risk", 670)]
LOWEST_TIER = "High Risk"
LGD = 0.45
REALIZED_LGD = 0.60

SEED = 42
TEST_SHARE = 0.2
MODEL_VERSION = "2.0.0-calibrated"

# The numerical and categorical inputs of a loan.
NUMERICAL = [
    "loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc",
    "dti", "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec",
    "revol_bal", "revol_util", "total_acc", "tot_cur_bal", "total_rev_hi_lim",
]
CATEGORICAL = [
    "term", "grade", "sub_grade", "emp_length", "home_ownership",
    "verification_status", "purpose", "addr_state", "application_type",
]

# The model vector, in the order training and serving share.
MODEL_FEATURES = [
    "annual_inc", "loan_amnt", "funded_amnt", "dti", "int_rate", "installment",
    "emp_length_years", "revol_util", "revol_bal", "open_acc", "total_acc",
    "delinq_2yrs", "inq_last_6mths", "pub_rec", "grade_numeric", "sub_grade_numeric",
    "loan_income_ratio", "debt_income_ratio", "installment_income_ratio",
    "revolving_utilization_ratio", "interest_payment_ratio",
    "total_credit_lines_ratio", "delinquency_rate", "inquiry_frequency",
    "public_record_ratio", "revolving_balance_per_account",
    "employment_stability", "financial_health_score", "credit_strength_score",
    "repayment_capacity_score",
    "income_x_credit_strength", "dti_x_loan_amount", "revol_bal_x_income",
    "int_rate_x_loan", "installment_x_dti", "income_x_employment",
]

# Identifiers, free text, dates and columns known only after the outcome.
LEAKY = [
    "id", "member_id", "url", "desc", "title", "zip_code",
    "emp_title", "issue_d", "earliest_cr_line", "last_pymnt_d",
    "next_pymnt_d", "last_credit_pull_d", "policy_code",
    "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "total_rec_late_fee", "last_pymnt_amnt", "collection_recovery_fee",
    "recoveries", "out_prncp", "out_prncp_inv",
]

# Employment length texts and their years.
EMP_YEARS = {"< 1 year": 0, "1 year": 1, **{f"{n} years": n for n in range(2, 10)}, "10+ years": 10}

GRADES = "ABCDEFG"
SUB_GRADES = [f"{g}{n}" for g in GRADES for n in range(1, 6)]

# Right-closed bracket edges and labels.
INCOME_BRACKETS = ([0, 30000, 50000, 75000, 100000, 150000],
                   ["<30K", "30-50K", "50-75K", "75-100K", "100-150K", "150K+"])
LOAN_BRACKETS = ([0, 5000, 10000, 15000, 25000],
                 ["<5K", "5-10K", "10-15K", "15-25K", "25K+"])
RATE_BRACKETS = ([0, 7, 10, 13, 17],
                 ["Low", "Medium-Low", "Medium", "Medium-High", "High"])
RATE_BRACKETS_PCT = ([0, 7, 10, 13, 17],
                     ["<7%", "7-10%", "10-13%", "13-17%", "17%+"])
DTI_BRACKETS = ([0, 10, 15, 20, 25, 30],
                ["<10", "10-15", "15-20", "20-25", "25-30", "30+"])

# Feature names as a borrower reads them.
DESCRIPTIONS = {
    "int_rate": "Interest Rate",
    "dti": "Debt-to-Income Ratio",
    "annual_inc": "Annual Income",
    "loan_amnt": "Loan Amount",
    "revol_util": "Revolving Credit Utilization",
    "revol_bal": "Revolving Balance",
    "installment": "Monthly Installment",
    "total_acc": "Total Credit Accounts",
    "open_acc": "Open Credit Accounts",
    "delinq_2yrs": "Delinquencies (2 years)",
    "inq_last_6mths": "Recent Credit Inquiries",
    "pub_rec": "Public Records",
    "grade_numeric": "Loan Grade",
    "sub_grade_numeric": "Loan Sub-Grade",
    "loan_income_ratio": "Loan-to-Income Ratio",
    "debt_income_ratio": "Debt-to-Income Ratio",
    "financial_health_score": "Financial Health Score",
    "credit_strength_score": "Credit Strength Score",
    "repayment_capacity_score": "Repayment Capacity",
    "employment_stability": "Employment Stability",
}

WAREHOUSE_TEXT = ["term", "grade", "sub_grade", "emp_length", "home_ownership",
                  "verification_status", "loan_status", "purpose", "addr_state", "application_type"]
# The warehouse columns in load order.
WAREHOUSE = [
    "loan_amnt", "funded_amnt", "term", "int_rate", "installment",
    "grade", "sub_grade", "emp_length", "home_ownership", "annual_inc",
    "verification_status", "loan_status", "purpose", "addr_state",
    "dti", "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec",
    "revol_bal", "revol_util", "total_acc", "application_type",
    "tot_cur_bal", "total_rev_hi_lim", "is_default",
]


def _field(name: str) -> T.StructField:
    if name in WAREHOUSE_TEXT:
        return T.StructField(name, T.StringType())
    return T.StructField(name, T.IntegerType() if name == TARGET else T.DoubleType())


RAW_LOANS = T.StructType(
    [T.StructField("id", T.LongType())] + [_field(c) for c in WAREHOUSE]
    + [T.StructField("created_at", T.TimestampType())]
)
FEATURE_STORE = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("loan_id", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in (
        "debt_income_ratio", "loan_income_ratio", "revolving_utilization_ratio",
        "monthly_payment_ratio", "credit_history_length", "delinquency_rate",
        "inquiry_frequency", "financial_health_score", "credit_strength_score",
        "repayment_capacity_score")]
    + [T.StructField("created_at", T.TimestampType())]
)
PREDICTIONS = T.StructType([
    T.StructField("loan_id", T.LongType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("probability_of_default", T.DoubleType()),
    T.StructField("risk_tier", T.StringType()),
    T.StructField("expected_loss", T.DoubleType()),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("predicted_at", T.TimestampType()),
])
CONTRACTS = {"raw_loans": RAW_LOANS, "feature_store": FEATURE_STORE, "predictions": PREDICTIONS}

# A raw loan file as it arrives: percent strings and padded terms are still text.
RAW_FILE = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("member_id", T.LongType()),
     T.StructField("issue_d", T.TimestampNTZType())]
    + [T.StructField(c, T.StringType() if c in ("int_rate", "revol_util") else _field(c).dataType)
       for c in WAREHOUSE if c != TARGET]
)
