"""Schema and quality checks as rows (level, check, value, detail)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill import schema as S

HIGH_NULL = 0.5
SEVERE_IMBALANCE = 0.05
ROW = "level string, check string, value double, detail string"


class ValidationFailed(ValueError):
    """Raised by the gate when a check has level FAIL."""


def _row(level: Column | str, check: str, value: Column, detail: Column | None = None) -> list[Column]:
    level = F.lit(level) if isinstance(level, str) else level
    return [level.alias("level"), F.lit(check).alias("check"), value.cast("double").alias("value"),
            (F.lit("") if detail is None else detail).alias("detail")]


def check_schema(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    missing = [c for c in S.NUMERICAL if c not in have]
    rows = [("PASS" if S.TARGET in have else "FAIL", "target_present", float(S.TARGET in have), S.TARGET),
            ("INFO", "numerical_present", float(len(S.NUMERICAL) - len(missing)), f"of {len(S.NUMERICAL)}")]
    if missing:
        rows.append(("WARN", "numerical_missing", float(len(missing)), ", ".join(missing)))
    present = sum(c in have for c in S.CATEGORICAL)
    rows.append(("INFO", "categorical_present", float(present), f"of {len(S.CATEGORICAL)}"))
    return df.sparkSession.createDataFrame(rows, ROW)


def check_not_empty(df: DataFrame) -> DataFrame:
    n = df.agg(F.count("*").alias("n"))
    return n.select(*_row(F.when(F.col("n") > 0, "PASS").otherwise("FAIL"), "rows", F.col("n")))


def check_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column; equal rows are counted before the shuffle."""
    copies = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count("*").alias("_n"))
    extra = copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n"))
    return extra.filter("n > 0").select(*_row("WARN", "duplicate_rows", F.col("n")))


def check_high_nulls(df: DataFrame, threshold: float = HIGH_NULL) -> DataFrame:
    seen = df.agg(F.count("*").alias("_n"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    over = sum((F.when(F.col(f"_{i}") > threshold * F.col("_n"), 1).otherwise(0)
                for i in range(len(df.columns))), F.lit(0))
    return seen.select(over.alias("n")).filter("n > 0").select(*_row("WARN", "high_null_columns", F.col("n")))


def check_class_balance(df: DataFrame, y: str = S.TARGET) -> DataFrame:
    """Share of the rarest class, and a warning if it is below 5 %. One class alone counts as 100 %."""
    classes = df.filter(F.col(y).isNotNull()).groupBy(y).agg(F.count("*").alias("n"))
    share = classes.agg((F.min("n") / F.sum("n")).alias("share")).filter("share IS NOT NULL")
    rows = F.array(
        F.struct(*_row("INFO", "minority_share", F.col("share"))),
        F.when(F.col("share") < SEVERE_IMBALANCE, F.struct(*_row("WARN", "severe_imbalance", F.col("share")))))
    return share.select(F.inline(F.array_compact(rows)))


def validation_report(df: DataFrame) -> DataFrame:
    """All checks and a closing verdict. An empty frame reports only its schema and the failure."""
    must_pass = check_schema(df).unionByName(check_not_empty(df))  # the only checks that can fail
    rows = must_pass.unionByName(check_duplicates(df)).unionByName(check_high_nulls(df))
    if S.TARGET in df.columns:
        rows = rows.unionByName(check_class_balance(df))
    verdict = must_pass.agg(F.count_if(F.col("level") == "FAIL").alias("n")).select(
        *_row(F.when(F.col("n") == 0, "PASS").otherwise("FAIL"), "verdict", F.col("n")))
    return rows.unionByName(verdict)


def require_valid(df: DataFrame) -> DataFrame:
    """The frame itself, or ValidationFailed naming the broken checks."""
    failed = check_schema(df).unionByName(check_not_empty(df)).filter("level = 'FAIL'").collect()
    if failed:
        raise ValidationFailed(", ".join(sorted(r["check"] for r in failed)))
    return df
