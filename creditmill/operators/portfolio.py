"""Portfolio questions over cleaned loans: default rates, averages and losses by segment."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill import schema as S

STATES_SHOWN = 20


def _rate() -> Column:
    return F.round(F.avg(S.TARGET) * 100, 2).alias("default_rate_pct")


def _mean(source: str, name: str) -> Column:
    return F.round(F.avg(source), 2).alias(name)


def _loans() -> Column:
    return F.count("*").alias("total_loans")


def default_rate_by_grade(loans: DataFrame) -> DataFrame:
    return (loans.groupBy("grade")
            .agg(_loans(), F.sum(S.TARGET).alias("defaults"), _rate(),
                 _mean("loan_amnt", "avg_loan_amount"), _mean("int_rate", "avg_interest_rate"))
            .orderBy("grade"))


def default_rate_by_home_ownership(loans: DataFrame) -> DataFrame:
    return (loans.groupBy("home_ownership").agg(_loans(), _rate(), _mean("annual_inc", "avg_income"))
            .orderBy(F.desc("default_rate_pct"), "home_ownership"))


def top20_states_by_default_rate(loans: DataFrame) -> DataFrame:
    """The 20 states of highest default rate; equal rates go by state name."""
    return (loans.groupBy("addr_state").agg(_loans(), _rate(), _mean("loan_amnt", "avg_loan_amount"))
            .orderBy(F.desc("default_rate_pct"), "addr_state").limit(STATES_SHOWN))


def purpose_analysis(loans: DataFrame) -> DataFrame:
    return (loans.groupBy("purpose")
            .agg(_loans(), _rate(), _mean("loan_amnt", "avg_loan_amount"), _mean("int_rate", "avg_interest_rate"))
            .orderBy(F.desc("default_rate_pct"), "purpose"))


def income_bracket_analysis(loans: DataFrame) -> DataFrame:
    """Left-closed income brackets; an unknown income falls into the last one."""
    edges, labels = S.INCOME_BRACKETS
    income = F.col("annual_inc")
    label = F.when(income < edges[1], labels[0])
    for upper, name in zip(edges[2:], labels[1:]):
        label = label.when(income < upper, name)
    return (loans.groupBy(label.otherwise(labels[-1]).alias("income_bracket"))
            .agg(_loans(), _rate(), _mean("dti", "avg_dti"), F.min("annual_inc").alias("_from"))
            .orderBy("_from").drop("_from"))


def portfolio_summary(loans: DataFrame) -> DataFrame:
    return loans.agg(
        _loans(), F.sum("loan_amnt").alias("total_portfolio_value"),
        F.round(F.avg(S.TARGET) * 100, 2).alias("overall_default_rate"),
        _mean("int_rate", "avg_interest_rate"), _mean("annual_inc", "avg_borrower_income"), _mean("dti", "avg_dti"))


def realized_loss_by_grade(loans: DataFrame) -> DataFrame:
    loss = F.col("loan_amnt") * F.col(S.TARGET) * F.lit(S.REALIZED_LGD)
    return (loans.groupBy("grade")
            .agg(_loans(), F.round(F.sum(loss), 2).alias("total_expected_loss"),
                 F.round(F.avg(loss), 2).alias("avg_expected_loss_per_loan"))
            .orderBy("grade"))
