"""Feature relevance and per-loan attributions."""

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.functions import scoring as fn
from creditmill.functions.columns import fixed_text, round_exact
from creditmill.operators import models, ranks, sampling
from creditmill.operators.scoring import PD
from creditmill.session import settle, shuffle_width

BINS = 20
TOP_FEATURES = 30
SUMMARY_FEATURES = 20
EXPLAINED, PER_SIDE = 10, 5
BACKGROUND_ROWS = 100
PHI_A_TASK = 1 << 20  # attributions that one task sorts by loan
MARGINS_AT_ONCE = 4096  # rows whose draws are held side by side
WALKS_AT_ONCE = 1 << 18  # rows that go down a tree side by side


# --- relevance --------------------------------------------------------------------------------

def mutual_information(df: DataFrame, features: Sequence[str], y: str = S.TARGET, bins: int = BINS,
                       top_n: int | None = None) -> DataFrame:
    """(feature, score): information in nats between the target and a feature cut at its quantiles; NULL is 0."""
    filled = df.select(y, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    features = list(features)
    found = ranks.quantile_map(filled, features, [i / bins for i in range(1, bins)])
    edges = [np.sort(found[c]) for c in features] if found else []

    def to_cells(batches):
        """Counts of a batch by feature, bin and class: the bin is the number of edges below the value."""
        for batch in batches:
            labels = batch.column("_y").dictionary_encode()
            codes = labels.indices.fill_null(len(labels.dictionary)).to_numpy(zero_copy_only=False)
            width = len(labels.dictionary) + 1
            rows = []
            for i, cuts in enumerate(edges):
                at = np.searchsorted(cuts, batch.column(f"_{i}").to_numpy(zero_copy_only=False))
                counts = np.bincount(at * width + codes, minlength=bins * width)
                rows += [(i, int(c // width), int(c % width), int(counts[c])) for c in np.flatnonzero(counts)]
            no, at, code, n = zip(*rows) if rows else ((), (), (), ())
            told = [None if c == width - 1 else c for c in code]
            yield pa.RecordBatch.from_arrays(
                [pa.array([features[i] for i in no], pa.string()), pa.array(at, pa.int32()),
                 labels.dictionary.take(pa.array(told, pa.int32())), pa.array(n, pa.int64())], ["feature", "bin", "y", "n"])

    wide = filled.select(F.col(y).alias("_y"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(features)])
    kind = wide.schema["_y"].dataType.simpleString()
    cells = (wide.mapInArrow(to_cells, f"feature string, bin int, y {kind}, n bigint")
             .groupBy("feature", "bin", "y").agg(F.sum("n").alias("n")))
    # features x bins x classes rows from here on
    def total(*by):
        return F.sum("n").over(W.partitionBy(*by))
    n = total("feature").cast("double")
    gain = F.col("n") / n * F.log(F.col("n") * n / (total("feature", "bin").cast("double") * total("feature", "y")))
    scores = cells.withColumn("gain", gain).groupBy("feature").agg(F.sum("gain").alias("score"))
    ordered = scores.orderBy(F.desc("score"), "feature")
    return ordered.limit(top_n) if top_n else ordered


def permutation_importance(df: DataFrame, features: Sequence[str], y: str = S.TARGET, repeats: int = 5,
                           seed: int = S.SEED, key: str = S.KEY, top_n: int | None = None,
                           **forest) -> DataFrame:
    """(feature, score): accuracy a forest loses when one feature is shuffled, mean of `repeats`.

    Rows are numbered as they are stored, and a seeded permutation of the numbers names each row's donor; one pairing serves
    all features. Donors are shuffled once for all repeats, rows once a repeat.
    """
    filled = df.select(key, y, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    model = models.train("RandomForest", filled, features, y, weight=False, seed=seed,
                         **{"numTrees": 100, **forest})
    point = F.struct(*features)
    tries = []
    rows, n = ranks.numbered(filled.select(y, point.alias("own")))
    donors = rows.select(F.col("position").alias("donor"), F.col("own").alias("given"))
    for i in range(repeats):
        here = rows.select(y, "own", ranks.bijection(F.col("position"), n, f"{seed}.{i}").alias("donor"))
        tries.append(here.join(donors, "donor").select(y, "own", "given"))
    swapped = reduce(DataFrame.unionByName, tries)
    fanned = swapped.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    mixed = fanned.select(y, "feature", *[
        F.when(F.col("feature") == f, F.col("given")[f]).otherwise(F.col("own")[f]).alias(f) for f in features])
    def accuracy(frame, *by):
        hits = models.predict_pd(model, frame).select(y, *by, (F.col(PD) > 0.5).cast("int").alias("hit"))
        right = F.avg((F.col("hit") == F.col(y)).cast("int"))
        return hits.groupBy(*by).agg(right.alias("accuracy"))
    base = accuracy(filled).first()["accuracy"]
    lost = accuracy(mixed, "feature").select("feature", (F.lit(base) - F.col("accuracy")).alias("score"))
    ordered = lost.orderBy(F.desc("score"), "feature")
    return ordered.limit(top_n) if top_n else ordered


def select_features(df: DataFrame, features: Sequence[str], y: str = S.TARGET, method: str = "mutual_info",
                    top_n: int = TOP_FEATURES, **kw) -> DataFrame:
    """The `top_n` features by `mutual_info` or `permutation`."""
    if method == "mutual_info":
        return mutual_information(df, features, y, top_n=top_n, **kw)
    if method == "permutation":
        return permutation_importance(df, features, y, top_n=top_n, **kw)
    raise ValueError(f"unknown method: {method}")


# --- attribution ------------------------------------------------------------------------------

def linear_attributions(df: DataFrame, coefficients: Mapping[str, float], key: str = S.KEY) -> DataFrame:
    """(key, feature, value, phi) of a linear model: coefficient times distance from the mean. NULL is the mean."""
    names = list(coefficients)
    centre = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    cells = [F.struct(
        F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("double"), F.lit(float(centre[c]))).alias("value"),
        (F.lit(float(w)) * (F.coalesce(F.col(c).cast("double"), F.lit(float(centre[c]))) - F.lit(float(centre[c]))))
        .alias("phi")) for c, w in coefficients.items()]
    return df.select(key, F.inline(F.array(*cells)))


def _tree(model, features: Sequence[str]) -> dict | None:
    """Arrays of a decision tree's nodes (feature or -1, threshold, children, PD); None for other models or splits."""
    if not (isinstance(model, PipelineModel) and [type(x) for x in model.stages] == [VectorAssembler, DecisionTreeClassificationModel]):
        return None
    used, fitted = model.stages[0].getInputCols(), model.stages[1]
    if fitted.numClasses != 2 or fitted.isSet(fitted.thresholds) or len(used) != fitted.numFeatures or not set(used) <= set(features):
        return None
    at = [list(features).index(f) for f in used]
    feature, cut, left, right, pd = [], [], [], [], []
    waiting = [(fitted._java_obj.rootNode(), -1, left)]
    while waiting:
        node, parent, side = waiting.pop()
        me = len(feature)
        if parent >= 0:
            side[parent] = me
        feature.append(-1), cut.append(0.0), left.append(me), right.append(me), pd.append(0.0)
        if node.getClass().getSimpleName() == "LeafNode":
            counts = list(node.impurityStats().stats())
            pd[me] = counts[1] / sum(counts) if sum(counts) else 0.0
            continue
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            return None
        feature[me], cut[me] = at[split.featureIndex()], split.threshold()
        waiting += [(node.rightChild(), me, right), (node.leftChild(), me, left)]
    return {"feature": np.array(feature), "cut": np.array(cut), "left": np.array(left), "right": np.array(right), "pd": np.array(pd),
            "depth": fitted.depth}


def _tree_shapley(turns: DataFrame, tree: dict, features: Sequence[str], permutations: int, key: str) -> DataFrame:
    """Attributions of a decision tree: a turn's steps are walked down it from two rows instead of being made as rows."""
    d = len(features)

    def walked(x, z, place):
        """PD of each turn after 0 to d steps."""
        n = len(x)
        turn, step = np.repeat(np.arange(n), d + 1), np.tile(np.arange(d + 1), n)
        node = np.zeros(n * (d + 1), np.int64)
        for _ in range(tree["depth"]):
            f = tree["feature"][node]
            value = np.where(place[turn, f] <= step, x[turn, f], z[turn, f])
            node = np.where(value <= tree["cut"][node], tree["left"][node], tree["right"][node])  # a leaf is its own child
        return tree["pd"][node].reshape(n, d + 1)

    def to_phi(batches):
        for batch in batches:
            x, z, h = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d) for c in ("x", "z", "_h"))
            if np.isnan(x).any() or np.isnan(z).any():
                raise ValueError("a feature is NULL or not a number")  # as the assembler says
            phi = np.empty((batch.num_rows, d))
            some = max(1, WALKS_AT_ONCE // (d + 1))
            for i in range(0, batch.num_rows, some):
                here = slice(i, i + some)
                place = 1 + (np.sort(h[here], axis=1)[:, None, :] < h[here][:, :, None]).sum(axis=2)
                gain = np.diff(walked(x[here], z[here], place), axis=1) / permutations
                phi[here] = np.take_along_axis(gain, place - 1, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("x"), *[pa.array(phi[:, i]) for i in range(d)]],
                                             [key, "x", *[f"_phi{i}" for i in range(d)]])

    known = turns.select(key, F.array(*features).alias("x"), "z", "_h")
    kind = known.schema[key].dataType.simpleString()
    phi = known.mapInArrow(to_phi, f"`{key}` {kind}, x array<double>, " + ", ".join(f"_phi{i} double" for i in range(d)))
    summed = phi.groupBy(key).agg(*[F.sum(f"_phi{i}").alias(f"_phi{i}") for i in range(d)],
                                  *[F.max(F.get("x", F.lit(i))).alias(f"_value{i}") for i in range(d)])
    return summed.select(key, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"_value{i}").alias("value"), F.col(f"_phi{i}").alias("phi"))
        for i, f in enumerate(features)])))


def shapley_values(model, df: DataFrame, features: Sequence[str], permutations: int = 8,
                   background: DataFrame | None = None, background_rows: int = BACKGROUND_ROWS,
                   max_rows: int | None = None, seed: int = S.SEED, key: str = S.KEY) -> DataFrame:
    """(key, feature, value, phi): sampled Shapley values (Strumbelj and Kononenko, 2014) of any model.

    Per row and permutation, a background row turns into the explained row feature by feature; each
    step's change in PD is credited to the feature that moved. Every evaluation adds to one feature and
    subtracts from the next, so all rows of a loan are summed where they were made. A decision tree is walked by all steps of a
    turn without making their rows. The background is a
    seeded sample of `background_rows` rows of `background` (`df` itself by default). `max_rows` explains a
    seeded sample instead of every row.
    """
    features = list(features)
    d = len(features)
    rows = df.select(key, *[F.col(f).cast("double").alias(f) for f in features])
    if max_rows:
        rows = sampling.fixed_sample(rows, max_rows, seed, key)
    source = df if background is None else background
    population = settle(sampling.fixed_sample(source.select(key, *features), background_rows, seed, key).select(
        (F.row_number().over(W.orderBy(key)) - 1).alias("_z"),
        F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]).alias("z")))
    held = population.count()
    turns = rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    hashes = F.array(*[F.xxhash64(F.lit(seed), key, "turn", F.lit(i)) for i in range(d)])
    turns = (turns.withColumn("_h", hashes)
             .withColumn("_z", F.pmod(F.xxhash64(F.lit(seed + 1), key, "turn"), F.lit(held)).cast("int"))
             .join(F.broadcast(population), "_z").drop("_z"))  # background_rows rows
    tree = _tree(model, features)
    if tree is not None:
        return _tree_shapley(turns, tree, features, permutations, key)
    # a feature moves at the place of its hash in order
    turns = turns.withColumn("_s", F.sort_array("_h")).withColumn("place", F.transform("_h", lambda h: F.array_position("_s", h).cast("int")))
    steps = turns.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    mixed = steps.select(
        key, "place", "step",
        *[F.when(F.col("place")[i] <= F.col("step"), F.col(f)).otherwise(F.col("z")[i]).alias(f)
          for i, f in enumerate(features)])
    share, step = F.col(PD) / permutations, F.col("step")
    credit = [F.sum(F.when(F.col("place")[i] == step, share).when(F.col("place")[i] == step + 1, -share)) for i in range(d)]
    # all rows of a loan are made side by side, so they shrink to one before the shuffle; after the last step a row is the loan itself
    summed = models.predict_pd(model, mixed).groupBy(key).agg(
        *[c.alias(f"_phi{i}") for i, c in enumerate(credit)],
        *[F.max(F.when(step == d, F.col(f))).alias(f"_value{i}") for i, f in enumerate(features)])
    return summed.select(key, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"_value{i}").alias("value"), F.col(f"_phi{i}").alias("phi"))
        for i, f in enumerate(features)])))


def attribution_summary(phi: DataFrame, top: int = SUMMARY_FEATURES) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return (phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
            .orderBy(F.desc("mean_abs_phi"), "feature").limit(top))


def attribution_dependence(phi: DataFrame, feature: str, key: str = S.KEY) -> DataFrame:
    return phi.filter(F.col("feature") == feature).select(key, "value", "phi")


def _slopes(model, features: Sequence[str]) -> np.ndarray | None:
    """What one unit of each feature adds to the log odds of a binary logistic model; None for other models."""
    if not (isinstance(model, PipelineModel) and [type(x) for x in model.stages] == [VectorAssembler, LogisticRegressionModel]):
        return None
    used, fitted = model.stages[0].getInputCols(), model.stages[1]
    if fitted.coefficientMatrix.numRows != 1 or len(used) != fitted.numFeatures or not set(used) <= set(features):
        return None
    slope = dict.fromkeys(features, 0.0)
    for name, x in zip(used, fitted.coefficients.toArray()):
        slope[name] += x
    return np.array([slope[f] for f in features])


def _logistic_surrogate(model, rows: DataFrame, features: Sequence[str], move: np.ndarray, share: np.ndarray, top: int, key: str) -> DataFrame:
    """The weights where draw number i adds `move[i]` to the log odds of every row: only the row's own log odds are moved."""
    scored = model.transform(rows).select(key, vector_to_array("rawPrediction")[1].alias("_odds"))
    held = scored.groupBy(key).agg(F.collect_list("_odds").alias("_odds"))  # one, but for rows that share a key
    names = pa.array(features, pa.string())
    most = min(top, len(features))

    def strongest(batches):
        for batch in batches:
            lists = batch.column("_odds")
            odds = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            weight = np.zeros((batch.num_rows, len(features)))
            for i in range(0, len(odds), MARGINS_AT_ONCE):
                with np.errstate(over="ignore"):
                    pd = 1.0 / (1.0 + np.exp(-(odds[i:i + MARGINS_AT_ONCE, None] + move)))
                np.add.at(weight, owner[i:i + MARGINS_AT_ONCE], pd @ share.T)
            place = np.argsort(-np.abs(weight), axis=1, kind="stable")[:, :most]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(np.repeat(np.arange(batch.num_rows), most))), names.take(pa.array(place.ravel())),
                 pa.array(np.take_along_axis(weight, place, axis=1).ravel())], [key, "feature", "weight"])

    kind = rows.schema[key].dataType.simpleString()
    return held.mapInArrow(strongest, f"`{key}` {kind}, feature string, weight double")


def local_surrogate(model, df: DataFrame, features: Sequence[str], samples: int = 200, top: int = 10,
                    ridge: float = 1.0, seed: int = S.SEED, key: str = S.KEY) -> DataFrame:
    """(key, feature, weight): the strongest weights of a local linear model around each row.

    Each row is perturbed `samples` times by the spread of every feature; samples are weighted by closeness and a ridge
    regression of the PD is solved per row. All rows share the draws, so the regression matrix is solved once and a weight
    is a sum of PDs times constants: a plain aggregate. A logistic model's log odds move by the same amount for all rows in a
    draw, so their PDs need no copies of the rows.
    """
    features = list(features)
    d, spark = len(features), df.sparkSession
    spread = df.agg(*[F.stddev_pop(f).alias(f) for f in features]).first()
    std = [float(spread[f] or 0.0) or 1.0 for f in features]
    step = np.random.default_rng(seed).standard_normal((samples, d))
    step[0] = 0.0  # the row itself
    x = np.column_stack([np.ones(samples), step])
    closeness = np.sqrt(np.exp(-(step ** 2).sum(axis=1) / (0.75 * np.sqrt(d)) ** 2))
    left = x.T @ (x * closeness[:, None])
    left[1:, 1:] += ridge * np.eye(d)
    share = np.linalg.solve(left, x.T * closeness)[1:]  # feature x draw
    rows = df.select(key, *[F.col(f).cast("double").alias(f) for f in features])
    slopes = _slopes(model, features)
    if slopes is not None:
        return _logistic_surrogate(model, rows, features, step @ (slopes * std), share, top, key)
    draws = spark.createDataFrame([(i, step[i].tolist(), share[:, i].tolist()) for i in range(samples)],
                                  "draw int, step array<double>, share array<double>")
    noisy = (rows.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
             .join(F.broadcast(draws), "draw")  # one row a draw
             .select(key, "share", *[(F.col(f) + F.col("step")[i] * std[i]).alias(f) for i, f in enumerate(features)]))
    summed = (models.predict_pd(model, noisy).groupBy(key)
              .agg(*[F.sum(F.col(PD) * F.col("share")[i]).alias(f"w{i}") for i in range(d)]))
    ranked = F.sort_array(F.array(*[F.struct((-F.abs(f"w{i}")).alias("place"), F.lit(i).alias("no"), F.lit(f).alias("feature"),
                                             F.col(f"w{i}").alias("weight")) for i, f in enumerate(features)]))
    return summed.select(key, F.inline(F.slice(ranked, 1, top))).select(key, "feature", "weight")


def business_explanation(phi: DataFrame, scored: DataFrame, pd_col: str = PD, key: str = S.KEY) -> DataFrame:
    """PD in percent, decision, and up to five risk and five protective reasons from the ten largest attributions.

    Attributions are dealt to more tasks the more there are, so that what a task sorts does not grow with them.
    """
    parts = -(-phi.count() // PHI_A_TASK)
    if parts > shuffle_width(phi.sparkSession):
        phi = phi.repartition(parts, key)
    pairs = [F.lit(x) for item in S.DESCRIPTIONS.items() for x in item]
    name = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("feature")),
                      F.initcap(F.replace("feature", F.lit("_"), F.lit(" "))))
    sign = F.when(F.col("value") < 0, "-").otherwise("")
    text = F.concat(name, F.lit(" (value: "), sign, fixed_text(F.abs("value"), 2), F.lit(")"))
    largest = W.partitionBy(key).orderBy(F.desc(F.abs("phi")), "feature")
    top = phi.withColumn("place", F.row_number().over(largest)).filter(F.col("place") <= EXPLAINED)
    lists = top.withColumn("text", text).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("place", "phi", "text"))).alias("t"))
    def side(keep):
        return F.slice(F.transform(F.filter("t", keep), lambda r: r["text"]), 1, PER_SIDE)
    return (scored.select(key, pd_col).join(lists, key)
            .select(key, round_exact(F.col(pd_col) * 100, 2).alias("probability_of_default"),
                    fn.decision_by_pd(pd_col).alias("decision"),
                    side(lambda r: r["phi"] > 0).alias("top_risk_factors"),
                    side(lambda r: r["phi"] <= 0).alias("top_positive_factors")))
