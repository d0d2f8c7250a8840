"""Row filters, labels and text clean-up of raw loans."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as S

PERCENT_COLUMNS = ("int_rate", "revol_util")


def _is_text(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, T.StringType)


def filter_loan_status(df: DataFrame) -> DataFrame:
    return df.filter(F.col(S.STATUS).isin(S.KEPT_STATUSES))


def binary_target(df: DataFrame) -> DataFrame:
    hit = F.col(S.STATUS) == S.DEFAULT_STATUS
    return df.withColumn(S.TARGET, F.when(hit, 1).otherwise(0))


def drop_leaky_columns(df: DataFrame, columns: Iterable[str] = tuple(S.LEAKY)) -> DataFrame:
    return df.drop(*columns)


def clean_percentages(df: DataFrame, columns: Iterable[str] = PERCENT_COLUMNS) -> DataFrame:
    parsed = {c: F.rtrim(F.col(c), F.lit("%")).try_cast("double") for c in columns if _is_text(df, c)}
    return df.withColumns(parsed) if parsed else df


def clean_emp_length(df: DataFrame) -> DataFrame:
    if "emp_length" not in df.columns:
        return df
    pairs = [F.lit(x) for text, years in S.EMP_YEARS.items() for x in (text, float(years))]
    years = F.create_map(*pairs)
    return df.withColumn("emp_length_years", F.try_element_at(years, F.col("emp_length")))


def clean_term(df: DataFrame) -> DataFrame:
    if not _is_text(df, "term"):
        return df
    first = F.split(F.trim("term"), r"\s+")[0]
    return df.withColumn("term_months", first.try_cast("double"))


def clean(df: DataFrame) -> DataFrame:
    """Filter, label and parse; identifiers stay until the model vector is selected."""
    for step in (filter_loan_status, binary_target, clean_percentages, clean_emp_length, clean_term):
        df = df.transform(step)
    return df


def null_infinities(df: DataFrame) -> DataFrame:
    """Turn ±inf and NaN into NULL in every floating-point column."""
    real = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    finite = {c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in real}
    return df.withColumns(finite) if finite else df


def select_model_features(df: DataFrame, use_model_features: bool = True,
                          keep: Iterable[str] = (S.KEY,)) -> DataFrame:
    """Model columns that exist, in list order; or everything but target and status."""
    keys = [c for c in keep if c in df.columns]
    if not use_model_features:
        return df.drop(S.TARGET, S.STATUS)
    return df.select(*keys, *[c for c in S.MODEL_FEATURES if c in df.columns])


def align_to_model(df: DataFrame, columns: Iterable[str], fill_nulls: bool = False,
                   keep: Iterable[str] = (S.KEY,)) -> DataFrame:
    """Exactly `columns`, in order: absent ones become 0, and NULLs too if `fill_nulls`."""
    def pick(c):
        if c not in df.columns:
            return F.lit(0.0).alias(c)
        return (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if fill_nulls else F.col(c)).alias(c)
    return df.select(*[c for c in keep if c in df.columns], *[pick(c) for c in columns])
