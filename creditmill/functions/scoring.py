"""Default probability to score, tier, loss and decision."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions.columns import as_col, clamp, fixed_text

# Decision texts by tier and by default probability.
TIER_DECISIONS = {
    "High Risk": "HIGH RISK (Subprime) — Recommend Denial or High-Rate Pricing",
    "Medium Risk": "MEDIUM RISK (Near-Prime) — Standard Approval with Review",
    "Low Risk": "LOW RISK (Prime) — Recommend Approval at Best Rates",
}
PD_DECISIONS = [
    (0.5, "HIGH RISK — Recommend Denial"),
    (0.25, "ELEVATED RISK — Recommend Review"),
    (0.10, "MODERATE RISK — Conditional Approval"),
]
PD_APPROVE = "LOW RISK — Recommend Approval"


def pd_to_credit_score(pd_value) -> Column:
    """Linear in PD, clipped to the score range, truncated to an integer."""
    score = F.lit(float(S.SCORE_MAX)) - as_col(pd_value) * F.lit(float(S.SCORE_SLOPE))
    return clamp(score, S.SCORE_MIN, S.SCORE_MAX).cast("int")


def assign_risk_tier(score) -> Column:
    score = as_col(score)
    expr = F.when(score.isNull(), F.lit(None))
    for name, floor in S.TIER_FLOORS:
        expr = expr.when(score >= floor, F.lit(name))
    return expr.otherwise(F.lit(S.LOWEST_TIER))


def expected_loss(pd_value, exposure, lgd: float = S.LGD) -> Column:
    return as_col(pd_value) * as_col(exposure) * F.lit(lgd)


def decision_by_tier(tier) -> Column:
    tier = as_col(tier)
    return (F.when(tier == "High Risk", TIER_DECISIONS["High Risk"])
            .when(tier == "Medium Risk", TIER_DECISIONS["Medium Risk"])
            .otherwise(TIER_DECISIONS["Low Risk"]))


def decision_by_pd(pd_value) -> Column:
    pd_value = as_col(pd_value)
    (high, deny), (mid, review), (low, conditional) = PD_DECISIONS
    return (F.when(pd_value >= high, deny).when(pd_value >= mid, review)
            .when(pd_value >= low, conditional).otherwise(PD_APPROVE))


def expected_loss_text(pd_value, exposure, loss, lgd: float = S.LGD) -> Column:
    """PD(x%) x EAD($n) x LGD(45%) = $n"""
    return F.concat(
        F.lit("PD("), fixed_text(as_col(pd_value) * 100, 2),
        F.lit("%) x EAD($"), F.format_number(as_col(exposure), 0),
        F.lit(f") x LGD({lgd:.0%}) = $"), F.format_number(as_col(loss), 0))
