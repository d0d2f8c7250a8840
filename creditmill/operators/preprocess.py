"""Impute, encode, scale and flag outliers: fit is a small aggregate, transform a projection."""

from collections.abc import Sequence
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as S
from creditmill.functions.columns import any_of
from creditmill.operators import lookup, ranks
from creditmill.operators.cleaning import null_infinities
from creditmill.session import settle

IDENTIFIERS = ("id", "member_id", S.KEY)
LOCAL_LEVELS = 10_000


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (S.TARGET,)) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
            and f.name not in exclude and f.name not in IDENTIFIERS]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """NULLs per column and, under the empty name, all rows; one pass."""
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return {"": row["_n"], **{c: row[c] for c in columns}}


def null_and_odd_counts(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, int], dict[str, int]]:
    """`null_counts`, and how many values of each floating-point column are infinite or NaN; one pass."""
    real = [c for c in columns if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null{i}") for i, c in enumerate(columns)],
                 *[F.count_if(F.isnan(f"`{c}`") | (F.abs(f"`{c}`") == float("inf"))).alias(f"_odd{i}") for i, c in enumerate(real)]).first()
    return ({"": row["_n"], **{c: row[f"_null{i}"] for i, c in enumerate(columns)}}, {c: row[f"_odd{i}"] for i, c in enumerate(real)})


def high_null_columns(df: DataFrame, threshold: float = 0.5) -> list[str]:
    columns = [c for c in df.columns if c != S.TARGET]
    seen = null_counts(df, columns)
    return [c for c in columns if seen[c] > threshold * seen[""]]


def drop_high_null_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.drop(*high_null_columns(df, threshold))


# --- imputation -------------------------------------------------------------------------------

def with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    seen = null_counts(df, columns)
    return [c for c in columns if seen[c]]


def most_frequent(df: DataFrame, columns: Sequence[str], data_type: str) -> dict:
    """Most frequent value per column, smallest on ties; counted per value, never collected per column."""
    wide = df.select(*[F.col(c).cast(data_type).alias(c) for c in columns])
    counts = (wide.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count("*").alias("n")))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("b"))
    return {r["column"]: r["b"]["value"] for r in best.collect()}


def fit_fill(df: DataFrame, strategy: str = "median", columns: Sequence[str] | None = None,
             accuracy: int | None = None) -> dict[str, float]:
    """Fill value per numeric column; by default for those that have NULLs."""
    columns = with_nulls(df, numeric_columns(df)) if columns is None else list(columns)
    if not columns:
        return {}
    if strategy == "median":
        return {c: q[0] for c, q in ranks.quantile_map(df, columns, [0.5], accuracy).items()}
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns if row[c] is not None}
    if strategy == "most_frequent":
        return most_frequent(df, columns, "double")
    if strategy == "constant":
        return dict.fromkeys(columns, 0.0)
    raise ValueError(f"unknown strategy: {strategy}")


def fill(df: DataFrame, values: dict) -> DataFrame:
    new = {c: F.coalesce(F.col(c).cast("double") if isinstance(v, (int, float)) else F.col(c), F.lit(v))
           for c, v in values.items() if c in df.columns}
    return df.withColumns(new) if new else df


def impute_numeric(df: DataFrame, strategy: str = "median", fit_on: DataFrame | None = None,
                   accuracy: int | None = None) -> DataFrame:
    return fill(df, fit_fill(df if fit_on is None else fit_on, strategy, accuracy=accuracy))


def fit_mode(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    columns = with_nulls(df, text_columns(df)) if columns is None else list(columns)
    if not columns:
        return {}
    modes = most_frequent(df, columns, "string")
    return {c: modes.get(c, "Unknown") for c in columns}


def impute_mode(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    return fill(df, fit_mode(df if fit_on is None else fit_on))


# --- encoding ---------------------------------------------------------------------------------

def encodable(df: DataFrame) -> list[str]:
    return text_columns(df, exclude=(S.TARGET, S.STATUS))


def level_counts(df: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """(column, value, n[, mean]) for every level of every column, in one grouped pass."""
    ids = [target] if target else []
    wide = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    aggs = [F.count("*").alias("n")] + ([F.avg(target).alias("mean")] if target else [])
    return wide.unpivot(ids, list(columns), "column", "value").groupBy("column", "value").agg(*aggs)


def _small_or_settled(levels: DataFrame) -> DataFrame:
    """A local table if the levels are few; else one written to the shared folder."""
    rows = levels.limit(LOCAL_LEVELS + 1).collect()
    if len(rows) <= LOCAL_LEVELS:
        return levels.sparkSession.createDataFrame(rows, levels.schema)
    return settle(levels)


def _level_codes(levels: DataFrame, column: str) -> DataFrame:
    """(value, code): 0-based position among the sorted distinct values of one column.

    Few levels are numbered in one window; many are cut into ranges at sampled values first.
    """
    from pyspark.sql import Window as W

    mine = levels.filter(F.col("column") == column).select("value")
    if mine.limit(LOCAL_LEVELS + 1).count() <= LOCAL_LEVELS:
        return mine.withColumn("code", (F.row_number().over(W.orderBy("value")) - 1).cast("int"))
    sample = [r["value"] for r in mine.orderBy(F.xxhash64("value"), "value").limit(LOCAL_LEVELS).collect()]
    cuts = sorted(sample)[100::100]
    marked = mine.withColumn("_range", F.size(F.filter(F.lit(cuts), lambda s: s <= F.col("value"))))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = marked.groupBy("_range").agg(F.count("*").alias("_n"))  # at most len(cuts) + 1 rows
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = W.partitionBy("_range").orderBy("value")
    return (marked.join(F.broadcast(offsets), "_range")
            .select("value", (F.row_number().over(inside) - 1 + F.col("_off")).cast("int").alias("code")))


def _swap(df: DataFrame, column: str, table: DataFrame, value: str) -> DataFrame:
    """Replace a text column by its looked-up value, keeping the column order."""
    keyed = table.select(F.col("value").alias(column), F.col(value).alias("_code"))
    order = df.columns
    spread = S.KEY if S.KEY in df.columns else F.struct(*[c for c in df.columns if c != column])
    joined = lookup.attach(df, keyed, column, spread).drop(column).withColumnRenamed("_code", column)
    return joined.select(*order)


def label_encode(df: DataFrame, columns: Sequence[str] | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Integer code per sorted level; NULL is the level `nan`."""
    columns = encodable(df) if columns is None else list(columns)
    if not columns:
        return df
    def as_text(d):
        return d.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns})
    base = as_text(df if fit_on is None else fit_on)
    levels = _small_or_settled(level_counts(base, columns).select("column", "value"))
    out = as_text(df)
    for c in columns:
        out = _swap(out, c, _level_codes(levels, c), "code")
    return out


def fit_target_means(df: DataFrame, columns: Sequence[str], target: str = S.TARGET) -> DataFrame:
    return _small_or_settled(level_counts(df, columns, target).filter(F.col("value").isNotNull()))


def apply_target_means(df: DataFrame, columns: Sequence[str], means: DataFrame) -> DataFrame:
    for c in columns:
        df = _swap(df, c, means.filter(F.col("column") == c), "mean")
    return df


def target_encode(df: DataFrame, columns: Sequence[str] | None = None, target: str = S.TARGET,
                  fit_on: DataFrame | None = None) -> DataFrame:
    """Mean target per level; NULL and unseen levels stay NULL."""
    columns = encodable(df) if columns is None else list(columns)
    if not columns:
        return df
    return apply_target_means(df, columns, fit_target_means(df if fit_on is None else fit_on, columns, target))


def onehot_encode(df: DataFrame, columns: Sequence[str] | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """A boolean per level but the first sorted one; NULL is false everywhere."""
    columns = encodable(df) if columns is None else list(columns)
    if not columns:
        return df
    levels = level_counts(df if fit_on is None else fit_on, columns).filter(F.col("value").isNotNull())
    rows = levels.select("column", "value").collect()  # one column comes out of each
    new = []
    for c in columns:
        for v in sorted(r["value"] for r in rows if r["column"] == c)[1:]:
            new.append(F.coalesce(F.col(c) == F.lit(v), F.lit(False)).alias(f"{c}_{v}"))
    return df.select(*[f"`{c}`" for c in df.columns if c not in columns], *new)


# --- scaling ----------------------------------------------------------------------------------

def fit_scale(df: DataFrame, method: str = "robust", exclude: Sequence[str] | None = None,
              accuracy: int | None = None) -> dict[str, tuple[float, float]]:
    """(centre, width) per numeric column. A given `exclude` replaces the target default."""
    columns = numeric_columns(df, tuple(exclude) if exclude else (S.TARGET,))
    if method == "robust":
        found = ranks.quantile_map(df, columns, [0.25, 0.5, 0.75], accuracy)
        pairs = {c: (q[1], q[2] - q[0]) for c, q in found.items()}
    elif method in ("standard", "minmax"):
        parts = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, F.max)}[method]
        row = df.agg(*[f(c).cast("double").alias(f"{i}{c}") for c in columns for i, f in enumerate(parts)]).first()
        pairs = {c: (row[f"0{c}"], row[f"1{c}"] - (row[f"0{c}"] if method == "minmax" else 0.0))
                 for c in columns if row[f"0{c}"] is not None}
    else:
        raise ValueError(f"unknown method: {method}")
    return {c: (mid, width or 1.0) for c, (mid, width) in pairs.items()}


def apply_scale(df: DataFrame, state: dict[str, tuple[float, float]]) -> DataFrame:
    new = {c: (F.col(c) - F.lit(float(mid))) / F.lit(float(width)) for c, (mid, width) in state.items()}
    return df.withColumns(new) if new else df


def scale(df: DataFrame, method: str = "robust", exclude: Sequence[str] | None = None,
          fit_on: DataFrame | None = None, accuracy: int | None = None) -> DataFrame:
    return apply_scale(df, fit_scale(df if fit_on is None else fit_on, method, exclude, accuracy))


# --- outliers ---------------------------------------------------------------------------------

def iqr_flag(bounds: dict[str, list[float]], factor: float = 1.5) -> Column:
    tests = []
    for c, (q1, q3) in bounds.items():
        reach = factor * (q3 - q1)
        outside = (F.col(c) < F.lit(q1 - reach)) | (F.col(c) > F.lit(q3 + reach))
        tests.append(F.coalesce(outside, F.lit(False)))
    return any_of(tests)


def outliers_iqr(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5,
                 accuracy: int | None = None) -> DataFrame:
    """Add `is_outlier`: some column lies beyond `factor` interquartile ranges; NULL never counts."""
    columns = [c for c in (columns or numeric_columns(df)) if c != S.TARGET]
    return df.withColumn("is_outlier", iqr_flag(ranks.quantile_map(df, columns, [0.25, 0.75], accuracy), factor))


# --- the whole chain --------------------------------------------------------------------------

def fit_preprocess(df: DataFrame) -> dict:
    """State of the chain: dropped columns, fill values, level means."""
    seen, odd = null_and_odd_counts(df, [c for c in df.columns if c != S.TARGET])
    dropped = [c for c in seen if c and seen[c] > 0.5 * seen[""]]
    kept = df.drop(*dropped)
    medians = fit_fill(kept, columns=[c for c in numeric_columns(kept) if seen[c]])
    modes = fit_mode(kept, [c for c in text_columns(kept) if seen.get(c)])
    filled = fill(fill(kept, medians), modes)
    texts = encodable(filled)
    state = {"dropped": dropped, "medians": medians, "modes": modes, "texts": texts, "means": None, "late": {}}
    if texts:
        state["means"] = fit_target_means(filled, texts)
        # the median of an encoded column follows from its level counts
        counts = (state["means"].select("column", F.col("mean").alias("value"), "n")
                  .groupBy("column", "value").agg(F.sum("n").alias("n")))
        late = ranks.quantiles_of_counts(counts, [0.5], ["column"]).collect()
        state["late"] = {r["column"]: r["q0"] for r in late}
    infinite = [c for c in numeric_columns(filled) if odd.get(c) or not isfinite(medians.get(c, 0.0))]
    if infinite:
        state["late"].update(fit_fill(null_infinities(filled), "median", infinite))
    return state


def apply_preprocess(df: DataFrame, state: dict) -> DataFrame:
    out = fill(fill(df.drop(*state["dropped"]), state["medians"]), state["modes"])
    if state["texts"]:
        out = apply_target_means(out, state["texts"], state["means"])
    return fill(null_infinities(out), state["late"])


def preprocess(df: DataFrame, fit_on: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """Drop sparse columns, impute, target-encode, null infinities, impute again.

    Pass the training rows as `fit_on`; without it the state is fitted on all rows.
    """
    state = fit_preprocess(df if fit_on is None else fit_on)
    return apply_preprocess(df, state), state
