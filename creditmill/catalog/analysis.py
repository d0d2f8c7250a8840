"""Portfolio questions, dashboard and exploratory aggregates, validation, metrics and drift."""

from itertools import combinations

from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.catalog.base import TEXTS, model_loans, oracle, r6, rounded, scored_loans, sql_bracket
from creditmill.operators import drift, eda, metrics, portfolio, scoring, validation
from creditmill.session import scratch_path
from creditmill.sources.loans_view import clean_loans, raw_loans

DRIFT_DATE = "1998-01-01 00:00:00"
# PD columns that stand for competing models: the fixture PD and three plain scorecards.
CANDIDATES = {
    "fixture": "fixture_pd",
    "rate": "int_rate/40.0E0",
    "utilization": "COALESCE(revol_util,0.0E0)/170.0E0",
    "burden": "COALESCE(dti,0.0E0)/41.0E0",
}


def _over_loans(operator):
    return lambda spark, sf_dir: rounded(operator(clean_loans(spark, sf_dir)))


def _over_stored(operator):
    return lambda spark, sf_dir: rounded(operator(model_loans(spark, sf_dir)))


def _over_scored(operator):
    return lambda spark, sf_dir: rounded(operator(scored_loans(spark, sf_dir)))


def candidates(spark, sf_dir):
    wide = clean_loans(spark, sf_dir).select(
        S.KEY, S.TARGET, *[F.expr(e).alias(f"pd_{name}") for name, e in CANDIDATES.items()])
    return metrics.stack_models(wide, {name: f"pd_{name}" for name in CANDIDATES})


def leaderboard(spark, sf_dir):
    return metrics.all_metrics(candidates(spark, sf_dir))


def calibration_check(spark, sf_dir):
    loans = clean_loans(spark, sf_dir)
    return rounded(metrics.calibration_check(
        loans.withColumns({"raw_pd": F.col("fixture_pd"),
                           "predicted_pd": F.lit(0.05) + F.lit(0.325) * F.col("fixture_pd")})))


def validation_report(spark, sf_dir):
    return rounded(validation.validation_report(model_loans(spark, sf_dir)))


def check_duplicates(spark, sf_dir):
    """Coarse borrower profiles, so that equal rows do occur."""
    return validation.check_duplicates(clean_loans(spark, sf_dir).select(*TEXTS))


def check_class_balance(spark, sf_dir):
    """Balance of a rare outcome: defaults on grade A loans against everything else."""
    rare = F.when((F.col(S.TARGET) == 1) & (F.col("grade") == "A"), 1).otherwise(0)
    return rounded(validation.check_class_balance(clean_loans(spark, sf_dir).withColumn(S.TARGET, rare)))


def _halves(spark, sf_dir):
    loans = clean_loans(spark, sf_dir)
    early = F.col("issue_d") < F.lit(DRIFT_DATE).cast("timestamp_ntz")
    return loans.filter(early), loans.filter(~early)


def column_drift(spark, sf_dir):
    return rounded(drift.column_drift(*_halves(spark, sf_dir)))


def drift_from_profile(spark, sf_dir):
    """The reference comes from a stored profile of two parts; of the rows only the current ones are read."""
    (old, new), path = _halves(spark, sf_dir), scratch_path(spark, "profile")
    for part, rows in (("a", old.filter(F.col("int_rate") < 12)), ("b", old.filter(~F.coalesce(F.col("int_rate") < 12, F.lit(False))))):
        drift.add_to_profile(rows, path, part)
    return rounded(drift.drift_from_profile(drift.read_profile(spark, path), new))


def dataset_drift(spark, sf_dir):
    return rounded(drift.dataset_drift(drift.column_drift(*_halves(spark, sf_dir))))


def drift_report(spark, sf_dir):
    path = scratch_path(spark, "drift")
    return rounded(drift.drift_report(*_halves(spark, sf_dir), path).drop("run_at"))


def null_pattern_sample(spark, sf_dir):
    return eda.null_pattern_sample(model_loans(spark, sf_dir))


QUERIES = {
    "default_rate_by_grade": _over_loans(portfolio.default_rate_by_grade),
    "default_rate_by_home_ownership": _over_loans(portfolio.default_rate_by_home_ownership),
    "top20_states_by_default_rate": _over_loans(portfolio.top20_states_by_default_rate),
    "purpose_analysis": _over_loans(portfolio.purpose_analysis),
    "income_bracket_analysis": _over_loans(portfolio.income_bracket_analysis),
    "portfolio_summary": _over_loans(portfolio.portfolio_summary),
    "realized_loss_by_grade": _over_loans(portfolio.realized_loss_by_grade),
    "tier_summary": _over_scored(scoring.tier_summary),
    "portfolio_kpis": _over_scored(scoring.portfolio_kpis),
    "tier_distribution": _over_scored(scoring.tier_distribution),
    "default_rate_by_grade_simple": _over_loans(scoring.default_rate_by_grade_simple),
    "pd_histogram": _over_scored(scoring.pd_histogram),
    "expected_loss_by_grade": _over_scored(scoring.expected_loss_by_grade),
    "purpose_table": _over_loans(scoring.purpose_table),
    "status_distribution": lambda spark, sf_dir: eda.status_distribution(raw_loans(spark, sf_dir)),
    "null_profile": lambda spark, sf_dir: rounded(eda.null_profile(model_loans(spark, sf_dir))),
    "null_pattern_sample": null_pattern_sample,
    "class_histograms": _over_loans(eda.class_histograms),
    "box_stats": _over_stored(eda.box_stats),
    "rate_by_category": _over_loans(eda.rate_by_category),
    "rate_by_bracket": _over_loans(eda.rate_by_bracket),
    "rate_by_emp_length": _over_loans(eda.rate_by_emp_length),
    "rate_by_sub_grade": _over_loans(eda.rate_by_sub_grade),
    "pearson_matrix": _over_stored(eda.pearson_matrix),
    "spearman_matrix": _over_stored(eda.spearman_matrix),
    "top_target_correlations": _over_loans(eda.top_target_correlations),
    "check_not_empty": _over_loans(validation.check_not_empty),
    "check_duplicates": check_duplicates,
    "check_high_nulls": lambda spark, sf_dir: validation.check_high_nulls(model_loans(spark, sf_dir)),
    "check_class_balance": check_class_balance,
    "validation_report": validation_report,
    "calibration_check": calibration_check,
    "threshold_metrics": lambda s, d: rounded(metrics.threshold_metrics(candidates(s, d), by=["model"])),
    "roc_auc": _over_scored(metrics.roc_auc),
    "average_precision": _over_scored(metrics.average_precision),
    "confusion_matrix": _over_scored(metrics.confusion_matrix),
    "roc_curve": _over_scored(metrics.roc_curve),
    "pr_curve": _over_scored(metrics.pr_curve),
    "gain_lift": _over_scored(metrics.gain_lift),
    "gain_lift_deciles": _over_scored(metrics.gain_lift_deciles),
    "model_comparison": lambda s, d: rounded(metrics.model_comparison(leaderboard(s, d))),
    "select_best_model": lambda s, d: rounded(metrics.select_best_model(leaderboard(s, d))),
    "column_drift": column_drift, "dataset_drift": dataset_drift, "drift_report": drift_report,
    "drift_from_profile": drift_from_profile,
}

_rate = "ROUND(AVG(is_default)*100,2) AS default_rate_pct"
_n = "COUNT(*) AS total_loans"


def _mean(c, name):
    return f"ROUND(AVG({c}),2) AS {name}"


_left_closed = " ".join(f"WHEN annual_inc < {e} THEN '{n}'" for e, n in
                        zip(S.INCOME_BRACKETS[0][1:], S.INCOME_BRACKETS[1]))
_null_columns = [*TEXTS, *S.NUMERICAL, "emp_length_years", "term_months", S.KEY, S.STATUS, S.TARGET]


def _null_rows(columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", AVG(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END)*100 AS pct FROM clean"
        for c in columns)


def _long(columns, ids="is_default, ", source="clean"):
    return " UNION ALL ".join(
        f"SELECT {ids}'{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL" for c in columns)


_brackets = {"annual_inc": S.INCOME_BRACKETS, "loan_amnt": S.LOAN_BRACKETS, "dti": S.DTI_BRACKETS,
             "int_rate": S.RATE_BRACKETS_PCT}
_bracket_order = " ".join(f"WHEN col='{c}' AND b='{n}' THEN {i}" for c, (_, labels) in _brackets.items()
                          for i, n in enumerate(labels))
_corr = S.NUMERICAL + [S.TARGET]


def _corr_rows(value):
    """One row per unordered pair and both orders of it."""
    parts = [f"SELECT '{a}' AS x, '{b}' AS z, ({value(a, b)}) AS r" for a, b in combinations(_corr, 2)]
    both = " UNION ALL ".join(parts)
    ones = " UNION ALL ".join(f"SELECT '{c}' AS x, '{c}' AS z, 1.0E0 AS r" for c in _corr)
    return (f"SELECT x AS a, z AS b, ROUND(r,6) AS r FROM ({both} UNION ALL {ones}) "
            f"UNION ALL SELECT z AS a, x AS b, ROUND(r,6) AS r FROM ({both})")


def _avg_rank(c):
    return f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1)/2.0E0"


_cand = "cand AS (" + " UNION ALL ".join(
    f"SELECT loan_id, is_default, '{n}' AS model, {e} AS p FROM clean" for n, e in CANDIDATES.items()) + ")"
# Running counts per distinct score, from the top, per model.
_steps = """steps AS (SELECT model, p, pos, n, SUM(pos) OVER w AS tp, SUM(n) OVER w AS seen,
  SUM(pos) OVER (PARTITION BY model) AS all_pos, SUM(n) OVER (PARTITION BY model) AS all_n
  FROM (SELECT model, p, SUM(is_default) AS pos, COUNT(*) AS n FROM cand GROUP BY model, p)
  WINDOW w AS (PARTITION BY model ORDER BY p DESC))"""
_one_cand = "cand AS (SELECT loan_id, is_default, 'm' AS model, fixture_pd AS p FROM clean)"
_cells = """cells AS (SELECT model, SUM(CASE WHEN p>0.5 AND is_default=1 THEN 1 ELSE 0 END) AS tp,
  SUM(CASE WHEN p>0.5 AND is_default=0 THEN 1 ELSE 0 END) AS fp,
  SUM(CASE WHEN p<=0.5 AND is_default=1 THEN 1 ELSE 0 END) AS fn,
  SUM(CASE WHEN p<=0.5 AND is_default=0 THEN 1 ELSE 0 END) AS tn FROM cand GROUP BY model)"""
_threshold = """SELECT model, (tp+tn)/(tp+fp+fn+tn) AS accuracy, COALESCE(tp/NULLIF(tp+fp,0),0) AS "precision",
  COALESCE(tp/NULLIF(tp+fn,0),0) AS recall, COALESCE(2*tp/NULLIF(2*tp+fp+fn,0),0) AS f1_score FROM cells"""
_auc = """SELECT model, SUM(CAST(pos AS DOUBLE)*((all_n-all_pos)-(seen-tp)+(n-pos)/2.0E0))
  /(CAST(MAX(all_pos) AS DOUBLE)*(MAX(all_n)-MAX(all_pos))) AS roc_auc FROM steps GROUP BY model"""
_ap = "SELECT model, SUM(pos/all_pos*(tp/seen)) AS pr_auc FROM steps GROUP BY model"
_board = (f"thr AS ({_threshold}), auc AS ({_auc}), ap AS ({_ap}), board AS (SELECT thr.*, roc_auc, pr_auc FROM thr "
          "JOIN auc ON thr.model=auc.model JOIN ap ON thr.model=ap.model)")
_names = ["accuracy", '"precision"', "recall", "f1_score", "roc_auc", "pr_auc"]
_board_columns = ", ".join(f"ROUND({c},6) AS {c}" for c in _names)
_gain = """SELECT p AS threshold, seen/all_n*100 AS pct_population, tp/all_pos*100 AS pct_defaults,
  (tp/all_pos)/(seen/all_n) AS lift, CAST(CEIL(seen*10/all_n) AS INT) AS decile FROM steps"""

_few, _large = drift.FEW_VALUES, drift.LARGE_REFERENCE
_ks_series = "+".join(f"{2.0 * (-1) ** (k - 1)}E0*EXP({-2.0 * k * k}E0*x*x)" for k in range(1, 21))
_halves_long = " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c} AS v, CASE WHEN issue_d < TIMESTAMP '{DRIFT_DATE}' THEN 1 ELSE 0 END AS is_ref "
    f"FROM clean WHERE {c} IS NOT NULL" for c in S.NUMERICAL)
_drift = f"""long AS ({_halves_long}),
counts AS (SELECT col, v, SUM(is_ref) AS ref, SUM(1-is_ref) AS cur FROM long GROUP BY col, v),
cdf AS (SELECT col, v, ref/SUM(ref) OVER t AS p, cur/SUM(cur) OVER t AS q,
  SUM(ref) OVER w/SUM(ref) OVER t - SUM(cur) OVER w/SUM(cur) OVER t AS gap, LEAD(v) OVER (PARTITION BY col ORDER BY v)-v AS dx,
  SUM(ref) OVER t AS n_ref, SUM(cur) OVER t AS n_cur
  FROM counts WINDOW w AS (PARTITION BY col ORDER BY v), t AS (PARTITION BY col)),
found AS (SELECT col, CAST(MAX(n_ref) AS BIGINT) AS n_reference, CAST(MAX(n_cur) AS BIGINT) AS n_current,
  COUNT(*) FILTER (WHERE p>0) AS n_values, SUM(ABS(gap)*COALESCE(dx,0)) AS w1, MAX(ABS(gap)) AS ks,
  SUM((CASE WHEN p>0 THEN p*LOG2(p/((p+q)/2)) ELSE 0 END + CASE WHEN q>0 THEN q*LOG2(q/((p+q)/2)) ELSE 0 END)/2) AS js
  FROM cdf GROUP BY col),
dev AS (SELECT col, STDDEV_POP(v) AS s FROM long WHERE is_ref=1 GROUP BY col),
sized AS (SELECT *, SQRT(n_reference*n_current/(n_reference+n_current))*ks AS x FROM found),
tested AS (SELECT sized.*, CASE WHEN n_reference<={_large} THEN 'kolmogorov_smirnov'
    WHEN n_values<={_few} THEN 'jensen_shannon' ELSE 'wasserstein' END AS test,
  CASE WHEN n_reference<={_large} THEN (CASE WHEN x<0.2 THEN 1.0E0 ELSE LEAST(GREATEST({_ks_series},0.0E0),1.0E0) END)
    WHEN n_values<={_few} THEN SQRT(GREATEST(js,0)) ELSE w1/GREATEST(s,0.001) END AS statistic
  FROM sized JOIN dev ON sized.col=dev.col),
judged AS (SELECT *, CASE WHEN test='kolmogorov_smirnov' THEN statistic<0.05 ELSE statistic>=0.1 END AS drifted
  FROM tested)"""
_drift_rows = """SELECT col AS "column", n_reference, n_current, n_values, ROUND(w1,6) AS w1, ROUND(ks,6) AS ks, test,
  ROUND(statistic,6) AS statistic, drifted FROM judged"""

_hist = f"""long AS ({_long(S.NUMERICAL[:eda.HISTOGRAM_COLUMNS])}),
b AS (SELECT is_default, col, MIN(v) AS lo, MAX(v) AS hi, COUNT(*) AS total FROM long GROUP BY is_default, col),
h AS (SELECT l.is_default, l.col, lo, hi, total, CAST(LEAST(FLOOR((v-lo)/(hi-lo)*50),49) AS INT) AS bin, COUNT(*) AS n
  FROM long l JOIN b ON l.is_default=b.is_default AND l.col=b.col GROUP BY ALL)"""
_box = f"""long AS ({_long(eda.BOX_COLUMNS)}),
q AS (SELECT is_default, col, QUANTILE_CONT(v,0.25) AS q1, MEDIAN(v) AS median, QUANTILE_CONT(v,0.75) AS q3
  FROM long GROUP BY is_default, col)"""
_report = f"""dup AS (SELECT COALESCE(SUM(n-1),0) AS n FROM (SELECT COUNT(*) AS n FROM clean
  GROUP BY {', '.join(_null_columns)})), nulls AS ({_null_rows(_null_columns)}),
share AS (SELECT MIN(n)/SUM(n) AS s FROM (SELECT COUNT(*) AS n FROM clean GROUP BY is_default))"""

ORACLES = {
    "default_rate_by_grade": oracle(
        f"""SELECT grade, {_n}, CAST(SUM(is_default) AS BIGINT) AS defaults, {_rate},
            {_mean('loan_amnt', 'avg_loan_amount')}, {_mean('int_rate', 'avg_interest_rate')}
            FROM clean GROUP BY grade ORDER BY grade""", "clean"),
    "default_rate_by_home_ownership": oracle(
        f"SELECT home_ownership, {_n}, {_rate}, {_mean('annual_inc', 'avg_income')} FROM clean GROUP BY home_ownership",
        "clean"),
    "top20_states_by_default_rate": oracle(
        f"""SELECT addr_state, {_n}, {_rate}, {_mean('loan_amnt', 'avg_loan_amount')} FROM clean GROUP BY addr_state
            ORDER BY default_rate_pct DESC, addr_state LIMIT 20""", "clean"),
    "purpose_analysis": oracle(
        f"""SELECT purpose, {_n}, {_rate}, {_mean('loan_amnt', 'avg_loan_amount')},
            {_mean('int_rate', 'avg_interest_rate')} FROM clean GROUP BY purpose""", "clean"),
    "income_bracket_analysis": oracle(
        f"""SELECT CASE {_left_closed} ELSE '150K+' END AS income_bracket, {_n}, {_rate}, {_mean('dti', 'avg_dti')}
            FROM clean GROUP BY 1""", "clean"),
    "portfolio_summary": oracle(
        f"""SELECT {_n}, SUM(loan_amnt) AS total_portfolio_value, ROUND(AVG(is_default)*100,2) AS overall_default_rate,
            {_mean('int_rate', 'avg_interest_rate')}, {_mean('annual_inc', 'avg_borrower_income')},
            {_mean('dti', 'avg_dti')} FROM clean""", "clean"),
    "realized_loss_by_grade": oracle(
        f"""SELECT grade, {_n}, ROUND(SUM(loan_amnt*is_default*0.60E0),2) AS total_expected_loss,
            ROUND(AVG(loan_amnt*is_default*0.60E0),2) AS avg_expected_loss_per_loan FROM clean GROUP BY grade""", "clean"),
    "tier_summary": oracle(
        """SELECT risk_tier, COUNT(*) AS "count", ROUND(AVG(credit_score),2) AS avg_credit_score,
           ROUND(AVG(predicted_pd),2) AS avg_pd, ROUND(SUM(loan_amnt),2) AS total_exposure,
           ROUND(SUM(expected_loss),2) AS total_expected_loss FROM scored GROUP BY risk_tier""", "scored"),
    "portfolio_kpis": oracle(
        """SELECT COUNT(*) AS total_loans, ROUND(AVG(is_default)*100,6) AS default_rate_pct,
           ROUND(AVG(loan_amnt),6) AS avg_loan_amount, ROUND(SUM(expected_loss),6) AS total_expected_loss
           FROM scored""", "scored"),
    "tier_distribution": oracle("SELECT risk_tier, COUNT(*) AS n FROM scored GROUP BY risk_tier", "scored"),
    "default_rate_by_grade_simple": oracle(
        "SELECT grade, ROUND(AVG(is_default),6) AS default_rate FROM clean GROUP BY grade", "clean"),
    "pd_histogram": oracle(
        """SELECT bin, ROUND((bin-1)/50,6) AS from_pd, ROUND(bin/50,6) AS to_pd, COUNT(*) AS n
           FROM (SELECT CAST(LEAST(FLOOR(predicted_pd*50)+1,50) AS INT) AS bin FROM scored) GROUP BY bin""", "scored"),
    "expected_loss_by_grade": oracle(
        "SELECT grade, ROUND(SUM(expected_loss),6) AS total_expected_loss FROM scored GROUP BY grade", "scored"),
    "purpose_table": oracle(
        """SELECT purpose, COUNT(*) AS "count", ROUND(AVG(is_default)*100,2) AS default_rate_pct,
           ROUND(AVG(loan_amnt),0) AS avg_amount FROM clean GROUP BY purpose""", "clean"),
    "status_distribution": oracle("SELECT loan_status, COUNT(*) AS n FROM loans GROUP BY loan_status", "loans"),
    "null_profile": oracle(
        f"""SELECT "column", ROUND(pct,6) AS null_pct, pct>50 AS over_half, pct=0 AS complete
            FROM ({_null_rows(_null_columns)})""", "clean"),
    "class_histograms": oracle(
        """SELECT is_default, col AS "column", bin, ROUND(lo+bin*((hi-lo)/50),6) AS from_value, n,
           ROUND(n/(total*((hi-lo)/50)),6) AS density FROM h""", "clean", extra=_hist),
    "box_stats": oracle(
        """SELECT q.is_default, q.col AS "column", ROUND(q1,6) AS q1, ROUND(median,6) AS median, ROUND(q3,6) AS q3,
           ROUND(MIN(CASE WHEN v>=q1-1.5E0*(q3-q1) THEN v END),6) AS whisker_low,
           ROUND(MAX(CASE WHEN v<=q3+1.5E0*(q3-q1) THEN v END),6) AS whisker_high
           FROM long l JOIN q ON l.is_default=q.is_default AND l.col=q.col GROUP BY q.is_default, q.col, q1, median, q3""",
        "clean", extra=_box),
    "rate_by_category": oracle(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS "value", COUNT(*) AS n, ROUND(AVG(is_default),6) AS default_rate
            FROM clean GROUP BY {c}""" for c in eda.RATE_COLUMNS), "clean"),
    "rate_by_bracket": oracle(
        f"""SELECT col AS "column", b AS bracket, CASE {_bracket_order} END AS position,
            ROUND(AVG(is_default),6) AS default_rate, COUNT(*) AS n FROM ("""
        + " UNION ALL ".join(f"SELECT is_default, '{c}' AS col, {sql_bracket(c, *p)} AS b FROM clean"
                             for c, p in _brackets.items())
        + ") WHERE b IS NOT NULL GROUP BY col, b", "clean"),
    "rate_by_emp_length": oracle(
        """SELECT emp_length, ROUND(AVG(is_default),6) AS default_rate, CAST(MAX(emp_length_years) AS INT) AS years
           FROM clean WHERE emp_length IS NOT NULL GROUP BY emp_length""", "clean"),
    "rate_by_sub_grade": oracle(
        "SELECT sub_grade, ROUND(AVG(is_default),6) AS default_rate FROM clean GROUP BY sub_grade", "clean"),
    "pearson_matrix": oracle(_corr_rows(lambda a, b: f"SELECT CORR({a},{b}) FROM clean"), "clean"),
    "spearman_matrix": oracle(_corr_rows(
        lambda a, b: f"SELECT CORR(x,z) FROM (SELECT {_avg_rank(a)} AS x, {_avg_rank(b)} AS z FROM clean "
                     f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"), "clean"),
    "top_target_correlations": oracle(
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", ROUND(ABS(CORR({c},is_default)),6) AS abs_r FROM clean" for c in S.NUMERICAL)
        + ') ORDER BY abs_r DESC, "column" LIMIT 10', "clean"),
    "check_not_empty": oracle(
        """SELECT CASE WHEN COUNT(*)>0 THEN 'PASS' ELSE 'FAIL' END AS level, 'rows' AS "check",
           CAST(COUNT(*) AS DOUBLE) AS value, '' AS detail FROM clean""", "clean"),
    "check_duplicates": oracle(
        f"""SELECT 'WARN' AS level, 'duplicate_rows' AS "check", CAST(SUM(n-1) AS DOUBLE) AS value, '' AS detail
            FROM (SELECT COUNT(*) AS n FROM clean GROUP BY {', '.join(TEXTS)}) HAVING SUM(n-1)>0""", "clean"),
    "check_high_nulls": oracle(
        f"""SELECT 'WARN' AS level, 'high_null_columns' AS "check", CAST(COUNT(*) AS DOUBLE) AS value, '' AS detail
            FROM ({_null_rows(_null_columns)}) WHERE pct>50 HAVING COUNT(*)>0""", "clean"),
    "check_class_balance": oracle(
        """SELECT 'INFO' AS level, 'minority_share' AS "check", ROUND(s,6) AS value, '' AS detail FROM share
           UNION ALL SELECT 'WARN', 'severe_imbalance', ROUND(s,6), '' FROM share WHERE s<0.05""", "clean",
        extra="""share AS (SELECT MIN(n)/SUM(n) AS s FROM (SELECT COUNT(*) AS n FROM clean
                 GROUP BY is_default=1 AND grade='A'))"""),
    "validation_report": oracle(
        """SELECT 'PASS' AS level, 'target_present' AS "check", 1.0E0 AS value, 'is_default' AS detail
           UNION ALL SELECT 'INFO','numerical_present',15.0E0,'of 15'
           UNION ALL SELECT 'INFO','categorical_present',9.0E0,'of 9'
           UNION ALL SELECT 'PASS','rows',CAST(COUNT(*) AS DOUBLE),'' FROM clean
           UNION ALL SELECT 'WARN','duplicate_rows',CAST(n AS DOUBLE),'' FROM dup WHERE n>0
           UNION ALL SELECT 'WARN','high_null_columns',CAST(COUNT(*) AS DOUBLE),'' FROM nulls WHERE pct>50 HAVING COUNT(*)>0
           UNION ALL SELECT 'INFO','minority_share',ROUND(s,6),'' FROM share
           UNION ALL SELECT 'WARN','severe_imbalance',ROUND(s,6),'' FROM share WHERE s<0.05
           UNION ALL SELECT 'PASS','verdict',0.0E0,''""", "clean", extra=_report),
    "calibration_check": oracle(
        """SELECT m.model, ROUND(mean_pd,6) AS mean_pd, ROUND(base_rate,6) AS base_rate, ROUND(roc_auc,6) AS roc_auc
           FROM (SELECT model, AVG(p) AS mean_pd, AVG(is_default) AS base_rate FROM cand GROUP BY model) m
           JOIN auc ON m.model=auc.model""", "clean",
        extra="""cand AS (SELECT loan_id, is_default, 'raw' AS model, fixture_pd AS p FROM clean UNION ALL
                 SELECT loan_id, is_default, 'calibrated', 0.05E0+0.325E0*fixture_pd FROM clean), """
              + _steps + f", auc AS ({_auc})"),
    "threshold_metrics": oracle(
        f"SELECT model, {', '.join(f'ROUND({c},6) AS {c}' for c in _names[:4])} FROM ({_threshold})", "clean",
        extra=f"{_cand}, {_cells}"),
    "roc_auc": oracle(f"SELECT ROUND(roc_auc,6) AS roc_auc FROM ({_auc})", "clean", extra=f"{_one_cand}, {_steps}"),
    "average_precision": oracle(f"SELECT ROUND(pr_auc,6) AS pr_auc FROM ({_ap})", "clean",
                                extra=f"{_one_cand}, {_steps}"),
    "confusion_matrix": oracle(
        """SELECT a AS actual, q AS predicted, CAST(COUNT(loan_id) AS BIGINT) AS n
           FROM (SELECT 0 AS a UNION ALL SELECT 1) CROSS JOIN (SELECT 0 AS q UNION ALL SELECT 1)
           LEFT JOIN cand ON is_default=a AND (CASE WHEN p>0.5 THEN 1 ELSE 0 END)=q GROUP BY a, q""",
        "clean", extra=_one_cand),
    "roc_curve": oracle(
        """SELECT ROUND(p,6) AS threshold, ROUND((seen-tp)/(all_n-all_pos),6) AS fpr, ROUND(tp/all_pos,6) AS tpr
           FROM steps""", "clean", extra=f"{_one_cand}, {_steps}"),
    "pr_curve": oracle(
        """SELECT ROUND(p,6) AS threshold, ROUND(tp/seen,6) AS "precision", ROUND(tp/all_pos,6) AS recall FROM steps""",
        "clean", extra=f"{_one_cand}, {_steps}"),
    "gain_lift": oracle(
        f"SELECT {r6('threshold', 'pct_population', 'pct_defaults', 'lift')}, decile FROM ({_gain})", "clean",
        extra=f"{_one_cand}, {_steps}"),
    "gain_lift_deciles": oracle(
        f"""SELECT decile, {r6('pct_population', 'pct_defaults', 'lift')} FROM (SELECT *, ROW_NUMBER() OVER
            (PARTITION BY decile ORDER BY pct_population DESC) AS i FROM ({_gain})) WHERE i=1""", "clean",
        extra=f"{_one_cand}, {_steps}"),
    "model_comparison": oracle(
        " UNION ALL ".join(f"SELECT place, model, '{m}' AS metric, ROUND(\"{m}\",6) AS value FROM placed"
                           for m in metrics.COMPARED), "clean",
        extra=f"""{_cand}, {_cells}, {_steps}, {_board}, placed AS (SELECT *,
                  CAST(ROW_NUMBER() OVER (ORDER BY roc_auc DESC, model) AS INT) AS place FROM board)"""),
    "select_best_model": oracle(
        f"""SELECT model, {_board_columns} FROM board WHERE roc_auc >= (SELECT MAX(roc_auc) FROM board)-0.005
            ORDER BY f1_score DESC, roc_auc DESC, model LIMIT 1""", "clean",
        extra=f"{_cand}, {_cells}, {_steps}, {_board}"),
    "column_drift": oracle(_drift_rows, "clean", extra=_drift),
    "drift_report": oracle(_drift_rows, "clean", extra=_drift),
    "drift_from_profile": oracle(_drift_rows, "clean", extra=_drift),
    "dataset_drift": oracle(
        """SELECT n_columns, n_drifted, ROUND(n_drifted/n_columns,6) AS drifted_share,
           n_drifted/n_columns>=0.5 AS dataset_drifted FROM (SELECT COUNT(*) AS n_columns,
           CAST(SUM(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted FROM judged)""",
        "clean", extra=_drift),
}
_sampled = "SELECT * FROM clean ORDER BY MD5(CONCAT(CAST(loan_id AS VARCHAR),'|42')), loan_id LIMIT 500"
_partial = ["total_rev_hi_lim", "emp_length", "emp_length_years", "annual_inc", "delinq_2yrs", "dti", "inq_last_6mths",
            "open_acc", "revol_bal", "revol_util", "tot_cur_bal", "total_acc"]
ORACLES["null_pattern_sample"] = oracle(
    "SELECT loan_id, " + ", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}" for c in _partial)
    + f" FROM ({_sampled})", "clean")
