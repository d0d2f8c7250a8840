"""Exact rank metrics and curves of predicted probabilities, from counts per distinct score.

Every function takes `by`, so several models are measured in one pass.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions.columns import ratio, share_or_zero
from creditmill.operators import ranks
from creditmill.operators.scoring import PD

COMPARED = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


def stack_models(df: DataFrame, models: Mapping[str, str], y: str = S.TARGET, key: str = S.KEY) -> DataFrame:
    """(key, y, model, predicted_pd): one row per loan and model, from one PD column per model."""
    wide = df.select(key, y, *[F.col(c).cast("double").alias(name) for name, c in models.items()])
    return wide.unpivot([key, y], list(models), "model", PD)


def _rates():
    c = F.col
    return [share_or_zero(c("tp") + c("tn"), c("tp") + c("fp") + c("fn") + c("tn")).alias("accuracy"),
            share_or_zero("tp", c("tp") + c("fp")).alias("precision"),
            share_or_zero("tp", c("tp") + c("fn")).alias("recall"),
            share_or_zero(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")).alias("f1_score")]


def threshold_metrics(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = (),
                      cut: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1 of p > cut; 0 where undefined."""
    hit, bad = F.col(p) > cut, F.col(y) == 1
    cells = df.groupBy(*by).agg(F.count_if(hit & bad).alias("tp"), F.count_if(hit & ~bad).alias("fp"),
                                F.count_if(~hit & bad).alias("fn"), F.count_if(~hit & ~bad).alias("tn"))
    return cells.select(*by, *_rates())


def score_steps(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from the top: pos, n and their running and whole sums."""
    grouped = (df.filter(F.col(p).isNotNull()).groupBy(*by, F.col(p).alias("score"))
               .agg(F.sum(F.col(y).cast("long")).alias("pos"), F.count("*").alias("n")))
    return ranks.cumulate(grouped, "score", ["pos", "n"], by, descending=True)


def _sums(df, by, aggs):
    return (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)


def roc_auc(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ()) -> DataFrame:
    """Chance that a default outscores a paid loan, ties counting one half."""
    c = F.col
    neg = (c("n") - c("pos")).cast("double")
    below = (c("total_n") - c("total_pos") - (c("upto_n") - c("upto_pos"))).cast("double")
    won = _sums(score_steps(df, y, p, by), by, [
        F.sum(c("pos") * (below + neg / 2)).alias("won"), F.max("total_pos").alias("pos"),
        F.max("total_n").alias("n")])
    pairs = c("pos").cast("double") * (c("n") - c("pos"))
    return won.select(*by, ratio("won", pairs).alias("roc_auc"))


def average_precision(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ()) -> DataFrame:
    """Sum over scores of recall gained times precision there (steps, not trapezoids)."""
    c = F.col
    area = F.sum(ratio("pos", "total_pos") * (c("upto_pos") / c("upto_n")))
    return _sums(score_steps(df, y, p, by), by, [area.alias("pr_auc")])


def confusion_matrix(df: DataFrame, y: str = S.TARGET, p: str = PD, cut: float = 0.5) -> DataFrame:
    """All four cells (actual, predicted, n), zeros included."""
    hit, bad = F.col(p) > cut, F.col(y) == 1
    cells = [(a, q) for a in (0, 1) for q in (0, 1)]
    one_row = df.agg(*[F.count_if((bad if a else ~bad) & (hit if q else ~hit)).alias(f"c{a}{q}") for a, q in cells])
    structs = [F.struct(F.lit(a).alias("actual"), F.lit(q).alias("predicted"), F.col(f"c{a}{q}").alias("n"))
               for a, q in cells]
    return one_row.select(F.inline(F.array(*structs)))


def roc_curve(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ()) -> DataFrame:
    c = F.col
    neg_total = c("total_n") - c("total_pos")
    return score_steps(df, y, p, by).select(
        *by, c("score").alias("threshold"), ratio(c("upto_n") - c("upto_pos"), neg_total).alias("fpr"),
        ratio("upto_pos", "total_pos").alias("tpr"))


def pr_curve(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ()) -> DataFrame:
    return score_steps(df, y, p, by).select(
        *by, F.col("score").alias("threshold"), ratio("upto_pos", "upto_n").alias("precision"),
        ratio("upto_pos", "total_pos").alias("recall"))


def gain_lift(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score from the top: % of loans, % of defaults captured, lift and decile."""
    c = F.col
    population = c("upto_n") / c("total_n")
    captured = ratio("upto_pos", "total_pos")
    return score_steps(df, y, p, by).select(
        *by, c("score").alias("threshold"), (population * 100).alias("pct_population"),
        (captured * 100).alias("pct_defaults"), (captured / population).alias("lift"),
        F.ceil(c("upto_n") * 10 / c("total_n")).cast("int").alias("decile"))


def gain_lift_deciles(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ()) -> DataFrame:
    """The last curve point inside each decile of the population."""
    last = F.max(F.struct("pct_population", "pct_defaults", "lift")).alias("at")
    return (gain_lift(df, y, p, by).groupBy(*by, "decile").agg(last)
            .select(*by, "decile", "at.pct_population", "at.pct_defaults", "at.lift"))


def all_metrics(df: DataFrame, y: str = S.TARGET, p: str = PD, by: Sequence[str] = ("model",), cut: float = 0.5) -> DataFrame:
    """One row per model: threshold metrics, ROC AUC and PR AUC, all from one count per distinct score."""
    by, c = list(by), F.col
    hit, neg = c("score") > cut, c("n") - c("pos")
    below = (c("total_n") - c("total_pos") - (c("upto_n") - c("upto_pos"))).cast("double")

    def count(keep, what):
        return F.sum(F.when(keep, what).otherwise(F.lit(0)))

    told = _sums(score_steps(df, y, p, by), by, [
        count(hit, c("pos")).alias("tp"), count(hit, neg).alias("fp"), count(~hit, c("pos")).alias("fn"), count(~hit, neg).alias("tn"),
        F.sum(c("pos") * (below + neg.cast("double") / 2)).alias("won"),
        F.sum(ratio("pos", "total_pos") * (c("upto_pos") / c("upto_n"))).alias("pr_auc"),
        F.max("total_pos").alias("pos"), F.max("total_n").alias("n")])
    pairs = c("pos").cast("double") * (c("n") - c("pos"))
    return told.select(*by, *_rates(), ratio("won", pairs).alias("roc_auc"), "pr_auc")


def model_comparison(leaderboard: DataFrame) -> DataFrame:
    """(place, model, metric, value), models ordered by AUC."""
    present = [m for m in COMPARED if m in leaderboard.columns]
    placed = leaderboard.withColumn("place", F.row_number().over(W.orderBy(F.desc("roc_auc"), "model")))
    return placed.unpivot(["place", "model"], present, "metric", "value").orderBy("place", "metric")


def select_best_model(leaderboard: DataFrame, slack: float = 0.005) -> DataFrame:
    """Among models within `slack` of the top AUC, the one of highest F1."""
    top = leaderboard.agg(F.max("roc_auc")).scalar()
    return (leaderboard.filter(F.col("roc_auc") >= top - F.lit(slack))
            .orderBy(F.desc("f1_score"), F.desc("roc_auc"), "model").limit(1))


def calibration_check(df: DataFrame, raw: str = "raw_pd", calibrated: str = PD, y: str = S.TARGET,
                      key: str = S.KEY) -> DataFrame:
    """Mean PD against the base rate and AUC, before and after calibration."""
    both = stack_models(df, {"raw": raw, "calibrated": calibrated}, y, key)
    means = both.groupBy("model").agg(F.avg(PD).alias("mean_pd"), F.avg(y).alias("base_rate"))
    return means.join(roc_auc(both, y, PD, ["model"]), "model")
