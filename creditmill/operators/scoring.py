"""Scored loans: profiles, tiers, losses and their summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions import rules, scoring
from creditmill.functions.columns import clamp, round_exact

PD = "predicted_pd"
HISTOGRAM_BINS = 50


def score_portfolio(df: DataFrame, pd_col: str = PD) -> DataFrame:
    """Add credit score, tier and expected loss; unchanged if there is no PD column."""
    if pd_col not in df.columns:
        return df
    return (df.withColumn("credit_score", scoring.pd_to_credit_score(pd_col))
            .withColumns({"risk_tier": scoring.assign_risk_tier("credit_score"),
                          "expected_loss": scoring.expected_loss(pd_col, "loan_amnt")}))


def risk_profile(df: DataFrame, pd_col: str = PD, keep=(S.KEY,)) -> DataFrame:
    score = scoring.pd_to_credit_score(pd_col)
    return df.select(
        *[c for c in keep if c in df.columns],
        round_exact(F.col(pd_col) * 100, 2).alias("probability_of_default"),
        score.alias("credit_score"), scoring.assign_risk_tier(score).alias("risk_tier"),
        round_exact(scoring.expected_loss(pd_col, "loan_amnt"), 2).alias("expected_loss"),
        F.col("loan_amnt").alias("loan_amount"), F.col("annual_inc").alias("annual_income"), "dti",
        F.col("int_rate").alias("interest_rate"),
        round_exact(F.col("loan_amnt") / clamp("annual_inc", 1, float("inf")) * 100, 2).alias("loan_to_income"))


def tier_summary(scored: DataFrame, pd_col: str = PD) -> DataFrame:
    return scored.groupBy("risk_tier").agg(
        F.count("*").alias("count"), F.round(F.avg("credit_score"), 2).alias("avg_credit_score"),
        F.round(F.avg(pd_col), 2).alias("avg_pd"), F.round(F.sum("loan_amnt"), 2).alias("total_exposure"),
        F.round(F.sum("expected_loss"), 2).alias("total_expected_loss"))


def portfolio_kpis(df: DataFrame) -> DataFrame:
    """Headline numbers; total defaults stand in where no expected loss is known."""
    last = (F.sum("expected_loss").alias("total_expected_loss") if "expected_loss" in df.columns
            else F.sum(S.TARGET).alias("total_defaults"))
    return df.agg(F.count("*").alias("total_loans"), (F.avg(S.TARGET) * 100).alias("default_rate_pct"),
                  F.avg("loan_amnt").alias("avg_loan_amount"), last)


def tier_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_tier").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "risk_tier")


def default_rate_by_grade_simple(df: DataFrame) -> DataFrame:
    return df.groupBy("grade").agg(F.avg(S.TARGET).alias("default_rate")).orderBy("grade")


def pd_histogram(scored: DataFrame, pd_col: str = PD, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Loans per equal-width PD bin over [0, 1]; 1.0 belongs to the last bin, empty bins are omitted."""
    number = F.least(F.width_bucket(F.col(pd_col), F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return (scored.filter(F.col(pd_col).isNotNull()).groupBy(number.cast("int").alias("bin"))
            .agg(F.count("*").alias("n"))
            .select("bin", ((F.col("bin") - 1) / bins).alias("from_pd"), (F.col("bin") / bins).alias("to_pd"), "n"))


def expected_loss_by_grade(scored: DataFrame) -> DataFrame:
    return scored.groupBy("grade").agg(F.sum("expected_loss").alias("total_expected_loss")).orderBy("grade")


def purpose_table(df: DataFrame) -> DataFrame:
    grouped = df.groupBy("purpose").agg(F.count("*").alias("count"), F.avg(S.TARGET).alias("_rate"),
                                        F.avg("loan_amnt").alias("_amount"))
    return (grouped.orderBy(F.desc("_rate"), "purpose")
            .select("purpose", "count", F.round(F.col("_rate") * 100, 2).alias("default_rate_pct"),
                    F.round("_amount", 0).alias("avg_amount")))


def risk_factors(applications: DataFrame, dashboard: bool = False) -> DataFrame:
    """Add up to five risk and five protective reasons per application."""
    return applications.withColumns({"top_risk_factors": rules.reasons("risk", dashboard),
                                     "protective_factors": rules.reasons("protective", dashboard)})
