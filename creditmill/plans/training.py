"""From feature frame to a calibrated model."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions.columns import ordered_hash
from creditmill.operators import preprocess, sampling
from creditmill.operators.cleaning import select_model_features
from creditmill.session import settle


def model_frames(loans: DataFrame, fit_on: str = "train", seed: int = S.SEED,
                 features: Sequence[str] = tuple(S.MODEL_FEATURES)) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, features): split, then impute with medians of the training rows.

    `fit_on='all'` takes the medians from all rows instead. The result is written once to the shared
    folder, because training reads it many times; so are the features, which the fit reads repeatedly, with the hash that
    splits them.
    """
    frame = settle(select_model_features(loans, keep=(S.KEY, S.TARGET)).withColumn("_place", ordered_hash(S.KEY, seed)))
    marked = sampling.stratified_split(frame, seed=seed, place=F.col("_place")).drop("_place")
    base = marked if fit_on == "all" else marked.filter(~F.col("is_test"))
    ready, state = preprocess.preprocess(marked, base)
    kept = [c for c in features if c in frame.columns and c not in state["dropped"]]
    whole = settle(preprocess.fill(ready, dict.fromkeys(kept, 0.0)).select(S.KEY, S.TARGET, "is_test", *kept))
    return whole.filter(~F.col("is_test")).drop("is_test"), whole.filter("is_test").drop("is_test"), kept
