"""Drift between a reference and a current frame, column by column."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions.columns import share_or_zero
from creditmill.operators import ranks
from creditmill.session import settle

# Limits of the default test choice.
LARGE_REFERENCE = 1000
FEW_VALUES = 5
DISTANCE_LIMIT = 0.1
P_LIMIT = 0.05
LEAST_STD = 0.001
SHARE_LIMIT = 0.5


def _ks_p_value(d, n, m):
    """Two-sided asymptotic p-value of the two-sample Kolmogorov-Smirnov distance."""
    size = n.cast("double") * m / (n + m)
    x = F.sqrt(size) * d
    series = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * x * x) for k in range(1, 21)), F.lit(0.0))
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


TESTS = ("auto", "kolmogorov_smirnov", "jensen_shannon", "wasserstein")


def column_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] = tuple(S.NUMERICAL),
                 test: str = "auto") -> DataFrame:
    """One row per numerical column in both frames: statistic, test used and verdict.

    `test="auto"` chooses by the reference: above 1000 rows the Wasserstein-1 distance over the reference deviation
    (Jensen-Shannon distance for columns of at most five values), drifted from 0.1 on; else Kolmogorov-Smirnov, p < 0.05.
    Any other name fixes the test. Both frames are read once; everything follows from counts per distinct value.
    """
    columns = [c for c in columns if c in reference.columns and c in current.columns]
    rows = ranks.long_values(reference, columns)
    return _compared(rows.withColumn("n", F.lit(1).cast("bigint")), current, columns, test)


def profile(df: DataFrame, columns: Sequence[str] = tuple(S.NUMERICAL)) -> DataFrame:
    """(column, value, n): how often each value occurs, all a drift test needs to know of a reference."""
    columns = [c for c in columns if c in df.columns]
    return ranks.long_values(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def add_to_profile(df: DataFrame, path: str, part: str, columns: Sequence[str] = tuple(S.NUMERICAL)) -> None:
    """Store the profile of some rows as one part of a reference. Parts add up; storing a part again replaces it."""
    profile(df, columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={part}")


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """The stored parts; a value that several parts hold has a row in each."""
    return spark.read.parquet(path).select("column", "value", "n")


def drift_from_profile(reference: DataFrame, current: DataFrame, columns: Sequence[str] = tuple(S.NUMERICAL),
                       test: str = "auto") -> DataFrame:
    """As `column_drift`, from the stored profile of the reference: of the rows only the current ones are read.

    Columns without a value in the profile (all were NULL, or it was not profiled) are left out.
    """
    columns = [c for c in columns if c in current.columns]
    return _compared(reference.filter(F.col("column").isin(columns)), current, columns, test).filter("n_reference > 0")


def _compared(reference: DataFrame, current: DataFrame, columns: Sequence[str], test: str) -> DataFrame:
    """`reference` has (column, value, n), several rows a value if need be; `current` is a frame."""
    if test not in TESTS:
        raise ValueError(f"unknown test: {test}")
    none = F.lit(0).cast("bigint")
    both = (reference.select("column", "value", F.col("n").alias("ref"), none.alias("cur"))
            .unionByName(ranks.long_values(current, columns).select("column", "value", none.alias("ref"), F.lit(1).cast("bigint").alias("cur"))))
    counts = settle(both.groupBy("column", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")))
    steps = ranks.cumulate(counts, "value", ["ref", "cur"], ["column"], with_next=True)
    c = F.col
    gap = F.abs(share_or_zero("upto_ref", "total_ref") - share_or_zero("upto_cur", "total_cur"))
    width = F.coalesce(c("next_value") - c("value"), F.lit(0.0))
    p, q = share_or_zero("ref", "total_ref"), share_or_zero("cur", "total_cur")
    mid = (p + q) / 2
    def bits(x):
        return F.when(x > 0, x * F.log2(x / mid)).otherwise(0.0)
    found = steps.groupBy("column").agg(
        F.max("total_ref").alias("n_reference"), F.max("total_cur").alias("n_current"),
        F.count_if(c("ref") > 0).alias("n_values"), F.sum(gap * width).alias("w1"), F.max(gap).alias("ks"),
        F.sum((bits(p) + bits(q)) / 2).alias("divergence"))
    # one row per column; moments about the mean keep the deviation exact for large numbers
    mean = counts.groupBy("column").agg(F.try_divide(F.sum(c("ref") * c("value")), F.sum("ref")).alias("mean"))
    far = (c("value") - c("mean")) * (c("value") - c("mean"))
    spread = (counts.join(F.broadcast(mean), "column").groupBy("column")
              .agg(F.sqrt(F.try_divide(F.sum(c("ref") * far), F.sum("ref"))).alias("reference_std")))
    joined = found.join(F.broadcast(spread), "column")
    large = c("n_reference") > LARGE_REFERENCE
    few = c("n_values") <= FEW_VALUES
    chosen = (F.when(~large, "kolmogorov_smirnov").when(few, "jensen_shannon").otherwise("wasserstein") if test == "auto"
              else F.lit(test))
    stat = (F.when(c("test") == "kolmogorov_smirnov", _ks_p_value(c("ks"), c("n_reference"), c("n_current")))
            .when(c("test") == "jensen_shannon", F.sqrt(F.greatest(c("divergence"), F.lit(0.0))))
            .otherwise(c("w1") / F.greatest("reference_std", F.lit(LEAST_STD))))
    limit_hit = (F.when(c("test") == "kolmogorov_smirnov", c("statistic") < P_LIMIT)
                 .otherwise(c("statistic") >= DISTANCE_LIMIT))
    return (joined.withColumn("test", chosen).withColumn("statistic", stat).withColumn("drifted", limit_hit)
            .select("column", "n_reference", "n_current", "n_values", "w1", "ks", "test", "statistic", "drifted"))


def dataset_drift(columns: DataFrame, limit: float = SHARE_LIMIT) -> DataFrame:
    """Drifted if at least half of the columns are."""
    hits = columns.agg(F.count("*").alias("n_columns"), F.count_if("drifted").alias("n_drifted"))
    share = share_or_zero("n_drifted", "n_columns")
    return hits.withColumn("drifted_share", share).withColumn("dataset_drifted", share >= limit)


def drift_report(reference: DataFrame, current: DataFrame, path: str,
                 columns: Sequence[str] = tuple(S.NUMERICAL)) -> DataFrame:
    """Append this run's column rows, stamped with its time, to the report table; returns the table."""
    rows = column_drift(reference, current, columns).withColumn("run_at", F.current_timestamp())
    rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.parquet(path)
