"""Sources, sinks, cleaning and derived features."""

from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.catalog.base import FEATURE_SQL, NUMBERS, TEXT_DATE, TEXTS, feature_loans, model_loans, oracle, r6
from creditmill.catalog.base import rounded, scored_loans
from creditmill.operators import cleaning, features, preprocess
from creditmill.plans import pipeline
from creditmill.session import scratch_path
from creditmill.sources import files
from creditmill.sources.loans_view import clean_loans, keyed_loans, raw_loans

RAW = [c for c in S.RAW_FILE.names if c != "issue_d"]
STORED = ["debt_income_ratio", "loan_income_ratio", "revolving_utilization_ratio", "monthly_payment_ratio",
          "delinquency_rate", "inquiry_frequency", "financial_health_score", "credit_strength_score",
          "repayment_capacity_score"]
BRACKETS = list(FEATURE_SQL["brackets"])


def _text_date(df):
    return df.withColumn("issue_d", F.col("issue_d").cast("date").cast("string"))


def read_loans_csv(spark, sf_dir):
    path = scratch_path(spark, "raw_csv")
    raw_loans(spark, sf_dir).select(*S.RAW_FILE.names).write.csv(path, header=True, ignoreLeadingWhiteSpace=False)
    return _text_date(files.read_loans_csv(spark, path))


def write_clean(spark, sf_dir):
    root = scratch_path(spark, "processed")
    files.write_clean(cleaning.drop_leaky_columns(clean_loans(spark, sf_dir)), root)
    return rounded(files.read_clean(spark, root).select(S.KEY, *TEXTS, *NUMBERS, S.STATUS, S.TARGET))


def run_ingestion(spark, sf_dir):
    source, root = scratch_path(spark, "raw_csv"), scratch_path(spark, "processed")
    raw_loans(spark, sf_dir).select(*S.RAW_FILE.names).write.csv(source, header=True, ignoreLeadingWhiteSpace=False)
    done = pipeline.ingest(spark, source, root)
    return rounded(done.select(S.KEY, *TEXTS, *NUMBERS, S.STATUS, S.TARGET))


def save_features(spark, sf_dir):
    root = scratch_path(spark, "features")
    files.save_features(feature_loans(spark, sf_dir).select(S.KEY, "grade", *S.MODEL_FEATURES), root,
                        partition_by=["grade"])
    return rounded(files.load_features(spark, root).select(S.KEY, "grade", *S.MODEL_FEATURES))


def feature_set_metadata(spark, sf_dir):
    root = scratch_path(spark, "features")
    loans = feature_loans(spark, sf_dir)
    files.save_features(loans.select(S.KEY, *S.MODEL_FEATURES), root)
    files.save_features(loans.select(S.KEY, *STORED), root, "stored_ratios")
    found = files.feature_set_metadata(spark, root, [files.FEATURES_NAME, "stored_ratios"])
    return found.withColumn("columns", F.array_join("columns", ","))


def warehouse_projection(spark, sf_dir):
    return rounded(files.warehouse_projection(clean_loans(spark, sf_dir)))


def load_warehouse(spark, sf_dir):
    """The warehouse table, replaced by one half of the loans and then appended the other, read back by SQL."""
    loans, name = clean_loans(spark, sf_dir), "creditmill_warehouse"
    path = scratch_path(spark, "warehouse")
    files.load_warehouse(loans.filter(F.col(S.KEY) % 2 == 0), name, dependents=(), path=path)
    files.load_warehouse(loans.filter(F.col(S.KEY) % 2 == 1), name, mode="append", path=path)
    return rounded(files.run_sql(spark, "SELECT * FROM {t}", t=spark.read.parquet(path)))


def run_sql(spark, sf_dir):
    text = """SELECT grade, purpose, COUNT(*) AS n, ROUND(AVG(loan_amnt),2) AS avg_loan FROM {loans}
              WHERE annual_inc >= :income GROUP BY grade, purpose"""
    return files.run_sql(spark, text, {"income": 50000}, loans=clean_loans(spark, sf_dir))


def table_contracts(spark, sf_dir):
    root = scratch_path(spark, "tables")
    prefix = "t" + root.rsplit("-", 1)[1] + "_"
    names = files.create_tables(spark, root, prefix)
    loans = feature_loans(spark, sf_dir)
    stored = loans.select(F.col(S.KEY).alias("id"), S.KEY, *STORED)
    files.conform(stored, S.FEATURE_STORE).write.insertInto(names["feature_store"])
    files.conform(loans, S.RAW_LOANS).write.insertInto(names["raw_loans"])
    back = spark.table(names["feature_store"]).drop("created_at", "id")
    held = spark.table(names["raw_loans"]).select(F.col("id").alias(S.KEY), "grade", S.TARGET)
    return rounded(held.join(back, S.KEY))


def append_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    files.append_predictions(scored_loans(spark, sf_dir), path)
    return rounded(files.read_predictions(spark, path).drop("predicted_at"))


def join_features_to_loans(spark, sf_dir):
    loans = clean_loans(spark, sf_dir).select(S.KEY, "grade", "loan_amnt", S.TARGET)
    stored = feature_loans(spark, sf_dir).filter("annual_inc IS NOT NULL").select(S.KEY, "grade", *STORED)
    return rounded(files.join_features_to_loans(loans, stored))


def filter_loan_status(spark, sf_dir):
    return cleaning.filter_loan_status(keyed_loans(spark, sf_dir)).select(S.KEY, S.STATUS, "loan_amnt")


def binary_target(spark, sf_dir):
    return cleaning.binary_target(keyed_loans(spark, sf_dir)).select(S.KEY, S.STATUS, S.TARGET)


def drop_leaky_columns(spark, sf_dir):
    return cleaning.drop_leaky_columns(keyed_loans(spark, sf_dir))


def clean_percentages(spark, sf_dir):
    return cleaning.clean_percentages(keyed_loans(spark, sf_dir)).select(S.KEY, "int_rate", "revol_util")


def clean_emp_length(spark, sf_dir):
    return cleaning.clean_emp_length(keyed_loans(spark, sf_dir)).select(S.KEY, "emp_length", "emp_length_years")


def clean_term(spark, sf_dir):
    return cleaning.clean_term(keyed_loans(spark, sf_dir)).select(S.KEY, "term", "term_months")


def drop_high_null_columns(spark, sf_dir):
    return rounded(preprocess.drop_high_null_columns(model_loans(spark, sf_dir)))


def null_infinities(spark, sf_dir):
    """Two ratios with zero denominators, kept as infinities on the way in."""
    loans = clean_loans(spark, sf_dir)
    bare = F.when(F.col("delinq_2yrs") == 0, F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("loan_amnt"), F.col("delinq_2yrs")))
    frame = loans.select(S.KEY, bare.alias("amount_per_delinquency"), (-bare).alias("negated"))
    return rounded(cleaning.null_infinities(frame))


def select_model_features(spark, sf_dir):
    return rounded(cleaning.select_model_features(feature_loans(spark, sf_dir)))


def align_to_model(spark, sf_dir):
    """Unengineered loans asked for the whole model vector: engineered inputs come out as 0."""
    loans = clean_loans(spark, sf_dir)
    return rounded(cleaning.align_to_model(loans, S.MODEL_FEATURES, fill_nulls=True))


def _step(step, columns, before=()):
    def run(spark, sf_dir):
        loans = clean_loans(spark, sf_dir)
        for earlier in before:
            loans = earlier(loans)
        return rounded(step(loans).select(S.KEY, *columns))
    return run


_ratios, _credit = features.financial_ratios, features.credit_features
_base = (_ratios, _credit)
QUERIES = {
    "read_loans_csv": read_loans_csv, "write_clean": write_clean, "run_ingestion": run_ingestion,
    "save_features": save_features, "feature_set_metadata": feature_set_metadata,
    "warehouse_projection": warehouse_projection, "load_warehouse": load_warehouse, "run_sql": run_sql, "table_contracts": table_contracts,
    "append_predictions": append_predictions, "join_features_to_loans": join_features_to_loans,
    "filter_loan_status": filter_loan_status, "binary_target": binary_target,
    "drop_leaky_columns": drop_leaky_columns, "clean_percentages": clean_percentages,
    "clean_emp_length": clean_emp_length, "clean_term": clean_term,
    "drop_high_null_columns": drop_high_null_columns, "null_infinities": null_infinities,
    "select_model_features": select_model_features, "align_to_model": align_to_model,
    "financial_ratios": _step(_ratios, FEATURE_SQL["ratios"]),
    "credit_features": _step(_credit, FEATURE_SQL["credit"]),
    "risk_scores": _step(features.risk_scores, FEATURE_SQL["scores"], _base),
    "behavioral_features": _step(features.behavioral_features, FEATURE_SQL["behavior"]),
    "interaction_features": _step(features.interaction_features, FEATURE_SQL["interactions"],
                                  (*_base, features.risk_scores, features.behavioral_features)),
    "brackets": _step(features.brackets, FEATURE_SQL["brackets"]),
    "grade_numeric": _step(features.grade_numeric, FEATURE_SQL["grades"]),
    "feature_pipeline": lambda spark, sf_dir: rounded(feature_loans(spark, sf_dir).select(
        S.KEY, *[c for step in FEATURE_SQL.values() for c in step])),
}


def _features_sql(step):
    names = FEATURE_SQL[step]
    body = ", ".join(names) if step == "brackets" else r6(*names)
    return oracle(f"SELECT loan_id, {body} FROM feats", "feats")


_cleaned = f"SELECT loan_id, {', '.join(TEXTS)}, {r6(*NUMBERS)}, loan_status, is_default FROM clean"
_kept = [c for c in NUMBERS if c != "total_rev_hi_lim"]
_raw_kept = [c for c in RAW if c not in S.LEAKY]
_engineered = [c for c in S.MODEL_FEATURES if c not in NUMBERS]
ORACLES = {
    "read_loans_csv": oracle(f"SELECT {TEXT_DATE}, {', '.join(RAW)} FROM loans", "loans"),
    "write_clean": oracle(_cleaned, "clean"),
    "run_ingestion": oracle(_cleaned, "clean"),
    "save_features": oracle(f"SELECT loan_id, grade, {r6(*S.MODEL_FEATURES)} FROM feats", "feats"),
    "warehouse_projection": oracle(
        "SELECT " + ", ".join(c if c in S.WAREHOUSE_TEXT or c == S.TARGET else r6(c) for c in S.WAREHOUSE)
        + " FROM clean", "clean"),
    "load_warehouse": oracle(
        "SELECT " + ", ".join(c if c in S.WAREHOUSE_TEXT or c == S.TARGET else r6(c) for c in S.WAREHOUSE)
        + " FROM clean", "clean"),
    "run_sql": oracle("""SELECT grade, purpose, COUNT(*) AS n, ROUND(AVG(loan_amnt),2) AS avg_loan FROM clean
                         WHERE annual_inc >= 50000 GROUP BY grade, purpose""", "clean"),
    "table_contracts": oracle(
        f"SELECT loan_id, grade, is_default, CAST(NULL AS DOUBLE) AS credit_history_length, {r6(*STORED)} FROM feats",
        "feats"),
    "append_predictions": oracle(
        f"""SELECT loan_id, '{S.MODEL_VERSION}' AS model_version, ROUND(predicted_pd,6) AS probability_of_default,
            risk_tier, ROUND(expected_loss,6) AS expected_loss, credit_score AS risk_score FROM scored""", "scored"),
    "join_features_to_loans": oracle(
        f"""SELECT c.loan_id, c.grade, c.loan_amnt, c.is_default, {r6(*STORED)} FROM
            (SELECT loan_id, grade, loan_amnt, is_default FROM clean) c LEFT JOIN
            (SELECT loan_id, {', '.join(STORED)} FROM feats WHERE annual_inc IS NOT NULL) f ON c.loan_id=f.loan_id""",
        "feats"),
    "filter_loan_status": oracle("""SELECT id AS loan_id, loan_status, loan_amnt FROM loans
                                    WHERE loan_status IN ('Fully Paid','Charged Off')""", "loans"),
    "binary_target": oracle("""SELECT id AS loan_id, loan_status,
        CASE WHEN loan_status='Charged Off' THEN 1 ELSE 0 END AS is_default FROM loans""", "loans"),
    "drop_leaky_columns": oracle(f"SELECT id AS loan_id, {', '.join(_raw_kept)}, fixture_pd FROM loans", "loans"),
    "clean_percentages": oracle("""SELECT id AS loan_id, CAST(RTRIM(int_rate,'%') AS DOUBLE) AS int_rate,
        CAST(RTRIM(revol_util,'%') AS DOUBLE) AS revol_util FROM loans""", "loans"),
    "clean_emp_length": oracle("""SELECT id AS loan_id, emp_length, CASE WHEN emp_length='< 1 year' THEN 0.0E0
        WHEN emp_length='10+ years' THEN 10.0E0 ELSE CAST(SPLIT_PART(emp_length,' ',1) AS DOUBLE) END
        AS emp_length_years FROM loans""", "loans"),
    "clean_term": oracle("""SELECT id AS loan_id, term, CAST(SPLIT_PART(TRIM(term),' ',1) AS DOUBLE) AS term_months
        FROM loans""", "loans"),
    "drop_high_null_columns": oracle(
        f"SELECT loan_id, {', '.join(TEXTS)}, {r6(*_kept)}, loan_status, is_default FROM clean", "clean"),
    "null_infinities": oracle("""SELECT loan_id, ROUND(loan_amnt/NULLIF(delinq_2yrs,0),6) AS amount_per_delinquency,
        ROUND(-(loan_amnt/NULLIF(delinq_2yrs,0)),6) AS negated FROM clean""", "clean"),
    "select_model_features": oracle(f"SELECT loan_id, {r6(*S.MODEL_FEATURES)} FROM feats", "feats"),
    "align_to_model": oracle(
        "SELECT loan_id, " + ", ".join(
            f"ROUND(COALESCE({c},0),6) AS {c}" if c in NUMBERS else f"0.0E0 AS {c}" for c in S.MODEL_FEATURES)
        + " FROM clean", "clean"),
    "financial_ratios": _features_sql("ratios"), "credit_features": _features_sql("credit"),
    "risk_scores": _features_sql("scores"), "behavioral_features": _features_sql("behavior"),
    "interaction_features": _features_sql("interactions"), "brackets": _features_sql("brackets"),
    "grade_numeric": _features_sql("grades"),
    "feature_pipeline": oracle(
        "SELECT loan_id, " + ", ".join(c if c in BRACKETS else r6(c) for step in FEATURE_SQL.values() for c in step)
        + " FROM feats", "feats"),
}
