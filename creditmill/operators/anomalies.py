"""Isolation forest (Liu, Ting and Zhou, 2008): trees of small samples grown and applied in tasks."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.operators import preprocess, ranks
from creditmill.session import settle

TREES, SAMPLE = 100, 256
EULER = 0.5772156649015329
NODE = "tree int, node int, feature int, cut double, left int, right int, depth double"


def _path_length(n):
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    long = 2 * (np.log(np.maximum(n - 1, 1)) + EULER) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """(node, feature, cut, left, right, depth) rows; a leaf has feature -1 and its expected depth."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    rows: list[tuple] = []
    waiting = [(0, points, 0)]
    used = 1
    while waiting:
        node, part, depth = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or len(open_features) == 0:
            rows.append((node, -1, 0.0, -1, -1, depth + float(_path_length(len(part)))))
            continue
        f = int(rng.choice(open_features))
        cut = float(rng.uniform(low[f], high[f]))
        below = part[:, f] <= cut
        rows.append((node, f, cut, used, used + 1, float(depth)))
        waiting += [(used, part[below], depth + 1), (used + 1, part[~below], depth + 1)]
        used += 2
    return rows


def draw_samples(points: DataFrame, columns: Sequence[str], trees: int = TREES, sample: int = SAMPLE,
                 seed: int = S.SEED, key: str = S.KEY, n: int | None = None) -> DataFrame:
    """(tree, _i, columns): for every tree the `sample` rows of smallest hash, fewer only if the table has fewer.

    A bound on the hash, which leaves about twice as many rows as wanted, is tested inside each row, so a row is written
    out only for the trees that draw it and the shuffle carries about 2 * trees * sample rows at any size of the table. If
    the bound leaves a tree too few, all are drawn again under a wider one.
    """
    n = points.count() if n is None else n
    wanted = min(sample, n)
    share = 2.0 * sample / max(n, 1)
    first = W.partitionBy("tree").orderBy("_h", key)
    while True:
        # hashes take up 63 bits, so the bound stays far above 0 however many rows there are
        bound = F.lit(min(int(min(1.0, share) * (1 << 63)), (1 << 63) - 1))
        hashes = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
            t.alias("tree"), F.xxhash64(F.lit(seed), t, F.col(key)).bitwiseAND(F.lit((1 << 63) - 1)).alias("_h")))
        drawn = points.select(key, *columns, F.explode(F.filter(hashes, lambda d: d["_h"] <= bound)).alias("_d"))
        drawn = drawn.select(key, *columns, "_d.tree", "_d._h").withColumn("_i", F.row_number().over(first))
        held = settle(drawn.filter(F.col("_i") <= sample).select("tree", "_i", *columns))
        if share >= 1.0 or held.count() == trees * wanted:
            return held
        share *= 4.0


def fit_isolation_forest(points: DataFrame, columns: Sequence[str], trees: int = TREES, sample: int = SAMPLE,
                         seed: int = S.SEED, key: str = S.KEY, n: int | None = None) -> list:
    """Tree nodes, at most 2 * sample per tree. Each tree sees `sample` of the `n` rows (counted if not given), drawn by hash."""
    drawn = draw_samples(points, columns, trees, sample, seed, key, n)
    columns = list(columns)

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        part = part.sort_values("_i")
        rows = _grow(part[columns].to_numpy(dtype=float), np.random.default_rng([seed, tree]))
        out = pd.DataFrame(rows, columns=["node", "feature", "cut", "left", "right", "depth"])
        out.insert(0, "tree", tree)
        return out

    return drawn.groupBy("tree").applyInPandas(grow, NODE).collect()


def score_isolation_forest(df: DataFrame, nodes: list, columns: Sequence[str], sample: int = SAMPLE) -> DataFrame:
    """Add `anomaly_score` in (0, 1], larger for rows that are isolated sooner."""
    grouped: dict[int, list] = {}
    for r in nodes:
        grouped.setdefault(r["tree"], []).append(r)
    forest = []
    for rows in grouped.values():
        rows = sorted(rows, key=lambda r: r["node"])
        forest.append(tuple(np.array([r[f] for r in rows]) for f in ("feature", "cut", "left", "right", "depth")))
    held = df.sparkSession.sparkContext.broadcast(forest)  # trees x 2 * sample nodes
    usual = float(_path_length(sample))

    @F.pandas_udf("double")
    def score(*parts: pd.Series) -> pd.Series:
        x = np.column_stack([p.to_numpy(dtype=float) for p in parts])
        total = np.zeros(len(x))
        for feature, cut, left, right, depth in held.value:
            at = np.zeros(len(x), dtype=int)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if len(inner) == 0:
                    break
                here = at[inner]
                below = x[inner, feature[here]] <= cut[here]
                at[inner] = np.where(below, left[here], right[here])
            total += depth[at]
        return pd.Series(2.0 ** (-total / len(held.value) / usual))

    return df.withColumn("anomaly_score", score(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]))


def outliers_isolation_forest(df: DataFrame, columns: Sequence[str] | None = None, contamination: float = 0.05,
                              trees: int = TREES, sample: int = SAMPLE, seed: int = S.SEED,
                              key: str = S.KEY) -> DataFrame:
    """Add `anomaly_score` and `is_outlier` for the most anomalous `contamination` of the rows; NULLs count as 0."""
    columns = [c for c in (columns or preprocess.numeric_columns(df)) if c != S.TARGET]
    points = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    n = points.count()
    nodes = fit_isolation_forest(points, columns, trees, sample, seed, key, n)
    scored = settle(score_isolation_forest(df, nodes, columns, min(sample, max(2, n))))  # scored once, read twice
    cut = ranks.quantile_map(scored, ["anomaly_score"], [1 - contamination])["anomaly_score"][0]
    return scored.withColumn("is_outlier", F.col("anomaly_score") > F.lit(cut))
