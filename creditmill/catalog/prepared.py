"""Imputation, encoding, scaling, outliers, splits and resampling."""

from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.catalog.base import NUMBERS, TEXTS, feature_loans, model_loans, oracle, rounded, stored_loans
from creditmill.operators import anomalies, neighbors, preprocess, sampling
from creditmill.session import settle
from creditmill.sources.loans_view import clean_loans

KEPT = [c for c in NUMBERS if c != "total_rev_hi_lim"]
GAPPY = ["annual_inc", "dti", "delinq_2yrs", "inq_last_6mths", "open_acc", "revol_bal", "revol_util", "total_acc",
         "tot_cur_bal", "emp_length_years"]
SPACE = ["loan_amnt", "annual_inc", "dti", "installment"]


def numbers(spark, sf_dir):
    return stored_loans(spark, sf_dir, S.KEY, *KEPT, S.TARGET)


def texts(spark, sf_dir):
    return stored_loans(spark, sf_dir, S.KEY, *TEXTS, S.TARGET)


def sparse_texts(spark, sf_dir):
    """Text columns with NULLs in two of them: purpose is unknown for every seventh loan."""
    gap = F.when(F.col(S.KEY) % 7 == 0, F.lit(None)).otherwise(F.col("purpose"))
    return texts(spark, sf_dir).withColumn("purpose", gap)


def _impute(strategy):
    return lambda spark, sf_dir: rounded(preprocess.impute_numeric(numbers(spark, sf_dir), strategy))


def _scale(method):
    return lambda spark, sf_dir: rounded(preprocess.scale(numbers(spark, sf_dir), method))


def impute_knn(spark, sf_dir):
    return rounded(neighbors.impute_knn(stored_loans(spark, sf_dir, S.KEY, *GAPPY)))


def scaled_points(spark, sf_dir):
    loans = stored_loans(spark, sf_dir, S.KEY, *SPACE, S.TARGET)
    return settle(preprocess.scale(preprocess.impute_numeric(loans), "robust"))


def scaled_features(spark, sf_dir):
    loans = settle(feature_loans(spark, sf_dir).select(S.KEY, *S.MODEL_FEATURES, S.TARGET))
    return settle(preprocess.scale(preprocess.impute_numeric(loans), "robust"))


def smote_neighbors(spark, sf_dir):
    minority = scaled_points(spark, sf_dir).filter(F.col(S.TARGET) == 1)
    return rounded(neighbors.neighbor_table(minority, minority, SPACE))


def smote_neighbors_of_model(spark, sf_dir):
    """As smote_neighbors, in the space of all model features."""
    minority = scaled_features(spark, sf_dir).filter(F.col(S.TARGET) == 1)
    return rounded(neighbors.neighbor_table(minority, minority, S.MODEL_FEATURES))


def smote(spark, sf_dir):
    return neighbors.smote(scaled_features(spark, sf_dir), S.MODEL_FEATURES)


def adasyn(spark, sf_dir):
    return neighbors.adasyn(scaled_features(spark, sf_dir), S.MODEL_FEATURES)


def outliers_iqr(spark, sf_dir):
    return preprocess.outliers_iqr(numbers(spark, sf_dir)).select(S.KEY, "is_outlier")


def outliers_isolation_forest(spark, sf_dir):
    return rounded(anomalies.outliers_isolation_forest(numbers(spark, sf_dir))
                   .select(S.KEY, "anomaly_score", "is_outlier"))


def preprocess_all(spark, sf_dir):
    return rounded(preprocess.preprocess(model_loans(spark, sf_dir))[0])


def preprocess_on_train(spark, sf_dir):
    """State fitted on the training rows only, applied to every row."""
    marked = sampling.stratified_split(model_loans(spark, sf_dir))
    done, _ = preprocess.preprocess(marked.drop("is_test"), marked.filter(~F.col("is_test")).drop("is_test"))
    return rounded(done)


def stratified_split(spark, sf_dir):
    return sampling.stratified_split(stored_loans(spark, sf_dir, S.KEY, S.TARGET))


def stratified_folds(spark, sf_dir):
    return sampling.stratified_folds(stored_loans(spark, sf_dir, S.KEY, S.TARGET))


def fixed_sample(spark, sf_dir):
    return sampling.fixed_sample(clean_loans(spark, sf_dir).select(S.KEY, "loan_amnt"), 5000)


def undersample(spark, sf_dir):
    return sampling.undersample(stored_loans(spark, sf_dir, S.KEY, S.TARGET))


def class_weights(spark, sf_dir):
    loans = stored_loans(spark, sf_dir, S.KEY, S.TARGET)
    table = F.broadcast(sampling.class_weight_table(loans).drop("n", "balanced_weight"))  # one row per class
    return rounded(sampling.class_weights(loans).join(table, S.TARGET))


QUERIES = {
    "impute_median": _impute("median"), "impute_mean": _impute("mean"),
    "impute_most_frequent": _impute("most_frequent"), "impute_constant": _impute("constant"),
    "impute_knn": impute_knn,
    "impute_mode": lambda s, d: preprocess.impute_mode(sparse_texts(s, d)),
    "label_encode": lambda s, d: preprocess.label_encode(sparse_texts(s, d)),
    "target_encode": lambda s, d: rounded(preprocess.target_encode(sparse_texts(s, d))),
    "onehot_encode": lambda s, d: preprocess.onehot_encode(
        sparse_texts(s, d).select(S.KEY, "grade", "home_ownership", "purpose", S.TARGET)),
    "onehot_encode_all": lambda s, d: preprocess.onehot_encode(sparse_texts(s, d)),
    "scale_standard": _scale("standard"), "scale_minmax": _scale("minmax"), "scale_robust": _scale("robust"),
    "outliers_iqr": outliers_iqr, "outliers_isolation_forest": outliers_isolation_forest,
    "preprocess": preprocess_all, "preprocess_on_train": preprocess_on_train,
    "stratified_split": stratified_split, "stratified_folds": stratified_folds, "fixed_sample": fixed_sample,
    "undersample": undersample, "smote_neighbors": smote_neighbors,
    "smote_neighbors_of_model": smote_neighbors_of_model, "smote": smote, "adasyn": adasyn,
    "class_weights": class_weights,
}



def _filled(value):
    """Every kept number with NULLs replaced by `value(column)`."""
    cells = ", ".join(f"ROUND(COALESCE({c},{value(c)}),6) AS {c}" for c in KEPT)
    return oracle(f"SELECT loan_id, {cells}, is_default FROM clean", "clean")


def _over(expr):
    cells = ", ".join(f"ROUND({expr(c)},6) AS {c}" for c in KEPT)
    return oracle(f"SELECT loan_id, {cells}, is_default FROM clean", "clean")


def _or_one(x):
    return f"COALESCE(NULLIF({x},0),1)"


_gap = "CASE WHEN loan_id%7=0 THEN NULL ELSE purpose END AS purpose"
_sparse = f"sparse AS (SELECT * REPLACE ({_gap}) FROM clean)"


def _mode_of(c, source="sparse"):
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"


_codes = ", ".join(f"CAST(DENSE_RANK() OVER (ORDER BY COALESCE({c},'nan'))-1 AS INT) AS {c}" for c in TEXTS)
_means = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN ROUND(AVG(is_default) OVER (PARTITION BY {c}),6) END AS {c}"
                   for c in TEXTS)
# The levels of the three one-hot columns, the first one dropped.
_levels = {"grade": list("BCDEFG"), "home_ownership": ["MORTGAGE", "OTHER", "OWN", "RENT"],
           "purpose": ["debt_consolidation", "home_improvement", "other", "small_business"]}
_onehot = ", ".join(f"COALESCE({c}='{v}',FALSE) AS \"{c}_{v}\"" for c, vs in _levels.items() for v in vs)
_iqr = " OR ".join(f"COALESCE({c}<{c}_1-1.5E0*({c}_3-{c}_1) OR {c}>{c}_3+1.5E0*({c}_3-{c}_1),FALSE)" for c in KEPT)
_quartiles = ", ".join(f"QUANTILE_CONT({c},0.25) AS {c}_1, QUANTILE_CONT({c},0.75) AS {c}_3" for c in KEPT)
_md5 = "MD5(CONCAT(CAST(loan_id AS VARCHAR),'|42'))"
_ranked = f"""SELECT loan_id, is_default, ROW_NUMBER() OVER (PARTITION BY is_default ORDER BY {_md5}, loan_id) AS i,
  COUNT(*) OVER (PARTITION BY is_default) AS n FROM clean"""
_split = f"SELECT loan_id, is_default, i<=FLOOR(n*0.2E0+0.5) AS is_test FROM ({_ranked})"


def _chain(fit_on):
    """The preprocessing chain in SQL, its state taken from the rows of `fit_on`."""
    fill = ", ".join([f"COALESCE(c.{c},(SELECT MEDIAN({c}) FROM {fit_on})) AS {c}" for c in KEPT]
                     + [f"COALESCE(c.{c},{_mode_of(c, fit_on)}) AS {c}" for c in TEXTS])
    train = f"SELECT * FROM filled WHERE loan_id IN (SELECT loan_id FROM {fit_on})"
    extra = f"filled AS (SELECT c.loan_id, c.loan_status, c.is_default, {fill} FROM clean c), fitted AS ({train})"
    for c in TEXTS:
        extra += f", m_{c} AS (SELECT {c}, AVG(is_default) AS m FROM fitted GROUP BY {c})"
    late = ", ".join(
        f"ROUND(COALESCE(m_{c}.m,(SELECT MEDIAN(m) FROM fitted JOIN m_{c} ON fitted.{c}=m_{c}.{c})),6) AS {c}"
        for c in TEXTS)
    joins = " ".join(f"LEFT JOIN m_{c} ON filled.{c}=m_{c}.{c}" for c in TEXTS)
    cells = ", ".join(f"ROUND(filled.{c},6) AS {c}" for c in KEPT)
    return extra, f"SELECT filled.loan_id, loan_status, is_default, {cells}, {late} FROM filled {joins}"


_all_extra, _all_body = _chain("clean")
_train_extra, _train_body = _chain("train")
_train = f"split AS ({_split}), train AS (SELECT * FROM clean WHERE loan_id IN (SELECT loan_id FROM split WHERE NOT is_test)), "

# Nearest neighbours by brute force: all pairs, ties to 9 decimals by donor id.
_scale_state = ", ".join(f"MEDIAN({c}) AS {c}_m" for c in SPACE)
_filled_space = ", ".join(f"COALESCE({c},{c}_m) AS {c}" for c in SPACE)
_space_q = ", ".join(f"QUANTILE_CONT({c},0.25) AS {c}_1, MEDIAN({c}) AS {c}_2, QUANTILE_CONT({c},0.75) AS {c}_3"
                     for c in SPACE)
_points = f"""med AS (SELECT {_scale_state} FROM clean),
full_rows AS (SELECT loan_id, is_default, {_filled_space} FROM clean, med),
q AS (SELECT {_space_q} FROM full_rows),
pts AS (SELECT loan_id, is_default, {", ".join(f"({c}-{c}_2)/({c}_3-{c}_1) AS {c}" for c in SPACE)} FROM full_rows, q)"""
_dist = "+".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in SPACE)
_both = "+".join(f"(CASE WHEN a.{c} IS NULL OR b.{c} IS NULL THEN 0 ELSE 1 END)" for c in GAPPY)
_gap_dist = "+".join(f"COALESCE((a.{c}-b.{c})*(a.{c}-b.{c}),0)" for c in GAPPY)
_any_null = " OR ".join(f"{c} IS NULL" for c in GAPPY)
# Common columns first, then the scale factor, in the order the distance is rounded in.
_near = f"""pairs AS (SELECT a.loan_id, b.loan_id AS donor,
  ROUND(ROUND(SQRT({_gap_dist}),9)*SQRT({float(len(GAPPY))}E0/NULLIF({_both},0)),9) AS d,
  {", ".join(f"a.{c} IS NULL AS need_{c}, b.{c} AS {c}" for c in GAPPY)}
  FROM (SELECT * FROM clean WHERE {_any_null}) a JOIN clean b ON a.loan_id<>b.loan_id)"""


def _donor_mean(c):
    return f"""n_{c} AS (SELECT loan_id, AVG({c}) AS m FROM (SELECT loan_id, {c}, ROW_NUMBER() OVER
  (PARTITION BY loan_id ORDER BY d, donor) AS i FROM pairs WHERE need_{c} AND {c} IS NOT NULL AND d IS NOT NULL)
  WHERE i<=5 GROUP BY loan_id)"""


_knn_cells = ", ".join(f"ROUND(COALESCE(clean.{c},n_{c}.m,(SELECT AVG({c}) FROM clean)),6) AS {c}" for c in GAPPY)
_knn_joins = " ".join(f"LEFT JOIN n_{c} ON clean.loan_id=n_{c}.loan_id" for c in GAPPY)

ORACLES = {
    "impute_median": _filled(lambda c: f"(SELECT MEDIAN({c}) FROM clean)"),
    "impute_mean": _filled(lambda c: f"(SELECT AVG({c}) FROM clean)"),
    "impute_most_frequent": _filled(lambda c: _mode_of(c, "clean")),
    "impute_constant": _filled(lambda c: "0.0E0"),
    "impute_knn": oracle(f"SELECT clean.loan_id, {_knn_cells} FROM clean {_knn_joins}", "clean",
                         extra=_near + ", " + ", ".join(_donor_mean(c) for c in GAPPY)),
    "impute_mode": oracle(
        "SELECT loan_id, " + ", ".join(f"COALESCE({c},{_mode_of(c)}) AS {c}" for c in TEXTS)
        + ", is_default FROM sparse", "clean", extra=_sparse),
    "label_encode": oracle(f"SELECT loan_id, {_codes}, is_default FROM sparse", "clean", extra=_sparse),
    "target_encode": oracle(f"SELECT loan_id, {_means}, is_default FROM sparse", "clean", extra=_sparse),
    "onehot_encode": oracle(f"SELECT loan_id, is_default, {_onehot} FROM sparse", "clean", extra=_sparse),
    "scale_standard": _over(lambda c: f"({c}-(SELECT AVG({c}) FROM clean))/(SELECT {_or_one(f'STDDEV_POP({c})')} FROM clean)"),
    "scale_minmax": _over(lambda c: f"({c}-(SELECT MIN({c}) FROM clean))/(SELECT {_or_one(f'(MAX({c})-MIN({c}))')} FROM clean)"),
    "scale_robust": _over(lambda c: f"""({c}-(SELECT MEDIAN({c}) FROM clean))
        /(SELECT {_or_one(f'(QUANTILE_CONT({c},0.75)-QUANTILE_CONT({c},0.25))')} FROM clean)"""),
    "outliers_iqr": oracle(f"SELECT loan_id, ({_iqr}) AS is_outlier FROM clean, q", "clean",
                           extra=f"q AS (SELECT {_quartiles} FROM clean)"),
    "preprocess": oracle(_all_body, "clean", extra=_all_extra),
    "preprocess_on_train": oracle(_train_body, "clean", extra=_train + _train_extra),
    "stratified_split": oracle(_split, "clean"),
    "stratified_folds": oracle(f"""SELECT loan_id, is_default, CAST((i>n//5)::INT+(i>n*2//5)::INT+(i>n*3//5)::INT+(i>n*4//5)::INT AS INT)
        AS fold FROM (SELECT *, COUNT(*) OVER (PARTITION BY is_default) AS n FROM ({_ranked}))""", "clean"),
    "fixed_sample": oracle(f"SELECT loan_id, loan_amnt FROM clean ORDER BY {_md5}, loan_id LIMIT 5000", "clean"),
    "undersample": oracle(f"""SELECT loan_id, is_default FROM ({_ranked}) WHERE i<=(SELECT MIN(c) FROM
        (SELECT COUNT(*) AS c FROM clean GROUP BY is_default))""", "clean"),
    "smote_neighbors": oracle(
        f"""SELECT loan_id, place, neighbor, ROUND(d,6) AS distance FROM (SELECT *, CAST(ROW_NUMBER() OVER
            (PARTITION BY loan_id ORDER BY d, neighbor) AS INT) AS place FROM (SELECT a.loan_id, b.loan_id AS neighbor,
            ROUND(SQRT({_dist}),9) AS d FROM pts a JOIN pts b ON a.loan_id<>b.loan_id
            WHERE a.is_default=1 AND b.is_default=1)) WHERE place<=5""", "clean", extra=_points),
    "class_weights": oracle(
        """SELECT loan_id, is_default, ROUND(n/(2.0E0*COUNT(*) OVER (PARTITION BY is_default)),6) AS weight,
           ROUND((n-pos)/GREATEST(pos,1),6) AS scale_pos_weight
           FROM clean, (SELECT COUNT(*) AS n, SUM(is_default) AS pos FROM clean)""", "clean"),
}
