"""Exact splits, folds, samples and class weights from seeded row hashes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions.columns import ordered_hash
from creditmill.operators import ranks


def class_counts(df: DataFrame, y: str = S.TARGET) -> dict:
    """Rows per class: one row per label comes to the driver."""
    return {r[y]: r["n"] for r in df.groupBy(y).agg(F.count("*").alias("n")).collect()}


def stratified_split(df: DataFrame, y: str = S.TARGET, test_share: float = S.TEST_SHARE,
                     seed: int = S.SEED, key: str = S.KEY, place: Column | None = None) -> DataFrame:
    """Add `is_test`; every class gives exactly its rounded share. Rows are not shuffled. `place` is the seeded hash of the key
    where a frame holds it already."""
    sizes = {g: int(n * test_share + 0.5) for g, n in class_counts(df, y).items()}
    return df.withColumn("is_test", ranks.hash_cut(df, key, seed, y, sizes, place))


def stratified_folds(df: DataFrame, y: str = S.TARGET, k: int = 5, seed: int = S.SEED,
                     key: str = S.KEY) -> DataFrame:
    """Add `fold` 0..k-1: each class, ordered by seeded hash, is cut into k parts whose sizes differ by one at most.

    The k - 1 cut-offs of all classes come from counts, so marking the rows is a projection and no row is shuffled. Rows
    without a class are dealt out by their hash alone.
    """
    needs = {g: [n * i // k for i in range(1, k)] for g, n in class_counts(df, y).items() if g is not None}
    cuts = ranks.hash_cuts(df, key, seed, y, needs)
    place = ordered_hash(key, seed)
    fold = F.pmod(place, F.lit(k))
    for g, wanted in needs.items():
        before = sum((F.when(place >= F.lit(cuts[g, n]), 1).otherwise(0) for n in wanted), F.lit(0))
        fold = F.when(F.col(y) == F.lit(g), before).otherwise(fold)
    return df.withColumn("fold", fold.cast("int"))


def fixed_sample(df: DataFrame, n: int, seed: int = S.SEED, key: str = S.KEY) -> DataFrame:
    """The n rows of smallest seeded hash (all rows if fewer): a top-n, not a sort of the table."""
    hashed = df.withColumn("_hash", ordered_hash(key, seed))
    return hashed.orderBy("_hash", key).limit(n).drop("_hash")


def undersample(df: DataFrame, y: str = S.TARGET, seed: int = S.SEED, key: str = S.KEY) -> DataFrame:
    """Cut every class to the size of the smallest, without replacement."""
    counts = class_counts(df, y)
    least = min(counts.values(), default=0)
    return df.filter(ranks.hash_cut(df, key, seed, y, dict.fromkeys(counts, least)))


def class_weight_table(df: DataFrame, y: str = S.TARGET) -> DataFrame:
    """Per class: rows, balanced weight n/(classes*n_c), and neg/max(pos, 1) of the whole frame."""
    counts = df.groupBy(y).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k"),
                       F.sum(F.when(F.col(y) == 1, F.col("n")).otherwise(0)).alias("pos")).first()
    pos = max(whole["pos"] or 0, 1)
    neg = (whole["n"] or 0) - (whole["pos"] or 0)
    return counts.select(
        y, "n", (F.lit(float(whole["n"] or 0)) / (F.lit(whole["k"]) * F.col("n"))).alias("balanced_weight"),
        F.lit(neg / pos).alias("scale_pos_weight"))


def class_weights(df: DataFrame, y: str = S.TARGET, resampled: bool = False, name: str = "weight") -> DataFrame:
    """Add the balanced weight of the row's class; 1.0 throughout if the frame was resampled."""
    if resampled:
        return df.withColumn(name, F.lit(1.0))
    counts = class_counts(df, y)
    total = sum(counts.values())
    expr = F.lit(1.0)
    for g, n in counts.items():
        expr = F.when(F.col(y) == F.lit(g), F.lit(total / (len(counts) * n))).otherwise(expr)
    return df.withColumn(name, expr)
