import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditmill.operators import anomalies, neighbors, preprocess, sampling


@pytest.fixture(scope="module")
def loans(spark):
    """130 rows by rule: every ninth income and every 26th grade unknown, every fourth loan in default."""
    def row(i):
        return (i, 2500.0 + 137 * i % 21000, None if i % 9 == 0 else 30000.0 + 911 * i % 90000, 3.0 + 7 * i % 31,
                None if i % 26 == 7 else "ABCDE"[i * i % 5], ("car", "medical", "wedding", "home")[i // 3 % 4], int(i % 4 == 1))

    return spark.createDataFrame([row(i) for i in range(130)], "loan_id long, loan_amnt double, annual_inc double, dti double, "
                                                               "grade string, purpose string, is_default int").persist()


def test_drops_only_above_threshold(loans):
    half = F.when(F.col("loan_id") % 2 == 0, 1.0)
    wide = loans.withColumns({"empty": F.lit(None).cast("double"), "half": half})
    assert preprocess.high_null_columns(wide) == ["empty"]


def test_imputers_leave_no_nulls(loans):
    for strategy in ("median", "mean", "most_frequent", "constant"):
        assert preprocess.impute_numeric(loans, strategy).filter("annual_inc IS NULL").count() == 0
    assert preprocess.impute_mode(loans).filter("grade IS NULL").count() == 0
    blank = loans.withColumn("grade", F.lit(None).cast("string"))
    assert preprocess.impute_mode(blank).select("grade").distinct().collect()[0]["grade"] == "Unknown"
    with pytest.raises(ValueError):
        preprocess.fit_fill(loans, "magic")


def test_label_codes_with_few_and_many_levels(loans, monkeypatch):
    few = {r["loan_id"]: (r["grade"], r["purpose"]) for r in preprocess.label_encode(loans).collect()}
    monkeypatch.setattr(preprocess, "LOCAL_LEVELS", 2)
    many = {r["loan_id"]: (r["grade"], r["purpose"]) for r in preprocess.label_encode(loans).collect()}
    assert few == many
    names = sorted({r["grade"] or "nan" for r in loans.collect()})
    assert all(few[r["loan_id"]][0] == names.index(r["grade"] or "nan") for r in loans.collect())


def test_many_levels_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(preprocess, "LOCAL_LEVELS", 500)
    words = [f"w{i * 7919 % 5000:05d}" for i in range(2000)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "loan_id long, emp_title string")
    got = {r["loan_id"]: r["emp_title"] for r in preprocess.label_encode(df).collect()}
    order = {w: i for i, w in enumerate(sorted(set(words)))}
    assert got == {i: order[w] for i, w in enumerate(words)}


def test_target_encoding_of_unseen_and_null(loans):
    train = loans.filter("purpose <> 'home'")
    out = preprocess.target_encode(loans, ["grade", "purpose"], fit_on=train)
    assert out.filter("purpose IS NULL").count() == loans.filter("purpose = 'home'").count()
    assert out.filter("grade IS NULL").count() == 5


def test_state_comes_from_training_rows(loans):
    train = loans.filter("loan_id < 60")
    done, state = preprocess.preprocess(loans, train)
    median = train.toPandas()["annual_inc"].median()
    assert state["medians"]["annual_inc"] == pytest.approx(median)
    assert done.filter("loan_id = 0").first()["annual_inc"] == pytest.approx(median)
    assert done.filter("grade IS NULL OR purpose IS NULL OR annual_inc IS NULL").count() == 0


def test_scaling_constant_column_and_exclude(loans):
    flat = loans.withColumn("flat", F.lit(3.0))
    for method in ("standard", "minmax", "robust"):
        assert preprocess.scale(flat, method).select("flat").distinct().first()["flat"] == 0.0
    state = preprocess.fit_scale(loans, "minmax", exclude=["dti"])
    assert "dti" not in state and "is_default" in state


def test_iqr_flag_is_never_null(loans):
    out = preprocess.outliers_iqr(loans)
    assert out.filter("is_outlier IS NULL").count() == 0
    spike = loans.withColumn("dti", F.when(F.col("loan_id") == 50, 1e6).otherwise(F.col("dti")))
    assert preprocess.outliers_iqr(spike).filter("loan_id = 50").first()["is_outlier"]


def brute(points, donors, k):
    out = {}
    for i, x in points.items():
        d = sorted((round(float(np.sqrt(((np.array(x) - np.array(z)) ** 2).sum())), 9), j)
                   for j, z in donors.items() if j != i)
        out[i] = d[:k]
    return out


@pytest.mark.parametrize("block", [8, 2048])
def test_neighbors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neighbors, "BLOCK", block)
    rng = np.random.default_rng(3)
    pts = {i: ([1.0, 1.0, 1.0] if i % 3 == 0 else rng.normal(0, 1, 3).round(1).tolist()) for i in range(240)}
    df = spark.createDataFrame([(i, *v) for i, v in pts.items()], "loan_id long, a double, b double, c double")
    found: dict = {}
    for r in neighbors.neighbor_table(df, df, ["a", "b", "c"], k=4).collect():
        found.setdefault(r["loan_id"], []).append((r["place"], r["distance"], r["neighbor"]))
    found = {i: [(d, j) for _, d, j in sorted(v)] for i, v in found.items()}
    assert found == brute(pts, pts, 4)


@pytest.mark.parametrize("width,unknown,patterns,own,block", [(4, 0.15, 4, 256, 2048), (7, 0.4, 64, 256, 2048), (7, 0.4, 64, 3, 2), (5, 0.3, 16, 0, 2)])
def test_knn_imputer_equals_brute_force(spark, monkeypatch, width, unknown, patterns, own, block):
    monkeypatch.setattr(neighbors, "PATTERNS", own)  # all other patterns share cells
    monkeypatch.setattr(neighbors, "BLOCK", block)
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (150, width)).round(2)
    x[rng.random(x.shape) < unknown] = np.nan
    x[0] = np.nan
    assert len({tuple(r) for r in np.isnan(x)}) >= patterns
    columns = list("abcdefg"[:width])
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "loan_id long, " + ", ".join(f"{c} double" for c in columns))
    got = neighbors.impute_knn(df, k=5).orderBy("loan_id").toPandas()[columns].to_numpy()
    expected = x.copy()
    for i, j in zip(*np.where(np.isnan(x))):
        near = []
        for m in range(len(x)):
            both = ~np.isnan(x[i]) & ~np.isnan(x[m])
            if not np.isnan(x[m, j]) and both.any():
                gap = round(float(np.sqrt(((x[i] - x[m])[both] ** 2).sum())), 9)
                near.append((round(gap * np.sqrt(width / both.sum()), 9), m))
        near = [m for _, m in sorted(near)[:5]]
        expected[i, j] = x[near, j].mean() if near else np.nanmean(x[:, j])
    np.testing.assert_allclose(got, expected, atol=1e-9)


def test_knn_imputer_without_neighbours(spark):
    rows = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, None, 4.0)], "loan_id long, a double, b double")
    assert neighbors.impute_knn(rows.filter("loan_id > 3"), ["a", "b"]).collect() == []
    got = {r["loan_id"]: (r["a"], r["b"]) for r in neighbors.impute_knn(rows).collect()}
    assert got == {1: (1.0, 4.0), 2: (1.0, 4.0), 3: (1.0, 4.0)}  # nothing in common: the means
    alone = neighbors.impute_knn(rows.filter("loan_id < 3"), ["a", "b"]).collect()
    assert {(r["loan_id"], r["a"], r["b"]) for r in alone} == {(1, 1.0, None), (2, 1.0, None)}


@pytest.mark.parametrize("own", [256, 5])
def test_a_donor_is_in_one_cell_whatever_the_patterns(spark, monkeypatch, own):
    monkeypatch.setattr(neighbors, "PATTERNS", own)
    rng = np.random.default_rng(2)
    known = rng.random((600, 6)) < 0.6
    known[:, 0] = True
    x = np.where(known, rng.normal(0, 1, known.shape), 0.0)
    rows = [("".join("01"[int(b)] for b in k), v.tolist(), [i]) for i, (k, v) in enumerate(zip(known, x))]
    donors = spark.createDataFrame(rows, "pattern string, values array<double>, ids array<bigint>")
    placed, cells = neighbors.gap_cells(donors, 6)
    assert placed.count() == 600 and sum(r["n"] for r in cells) == 600
    assert len(cells) <= np.sqrt(600 * 33) + 33
    box = {r["cell"]: r for r in cells}
    for r in placed.collect():
        for c in range(6):
            if r["pattern"][c] == "1":
                assert box[r["cell"]]["low"][c] <= r["values"][c] <= box[r["cell"]]["high"][c]


@pytest.mark.parametrize("method", [neighbors.smote, neighbors.adasyn])
def test_oversampling_stays_between_parents(loans, method):
    ready = preprocess.impute_numeric(loans)
    columns = ["loan_amnt", "dti"]
    out = method(ready, columns).toPandas()
    made = out[out["base"].notna()]
    old = out[out["base"].isna()].set_index("loan_id")
    assert len(old) == 130 and (made["is_default"] == 1).all() and (made["loan_id"] < 0).all()
    if method is neighbors.smote:
        assert (out["is_default"] == 1).sum() == (out["is_default"] == 0).sum()
    for _, r in made.iterrows():
        a, b = old.loc[int(r["base"])], old.loc[int(r["toward"])]
        assert a["is_default"] == b["is_default"] == 1
        for c in columns:
            assert min(a[c], b[c]) - 1e-9 <= r[c] <= max(a[c], b[c]) + 1e-9


def test_isolation_forest_finds_the_far_points(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 2))
    x[:8] += 12
    df = spark.createDataFrame(pd.DataFrame({"loan_id": range(400), "a": x[:, 0], "b": x[:, 1]}))
    out = anomalies.outliers_isolation_forest(df, contamination=0.02, trees=50, sample=128)
    assert {r["loan_id"] for r in out.filter("is_outlier").collect()} == set(range(8))


@pytest.mark.parametrize("n", [0, 3, 5000])
def test_every_tree_draws_the_rows_of_smallest_hash(spark, n):
    points = spark.range(n).select(F.col("id").alias("loan_id"), F.col("id").cast("double").alias("a"))
    got = {}
    for r in anomalies.draw_samples(points, ["a"], trees=20, sample=16, seed=3).collect():
        got.setdefault(r["tree"], {})[r["_i"]] = r["a"]
    hashes = points.select("a", *[F.xxhash64(F.lit(3), F.lit(t), "loan_id").bitwiseAND(F.lit((1 << 63) - 1)).alias(f"h{t}")
                                  for t in range(20)]).toPandas()
    want = {t: dict(enumerate(hashes.sort_values(f"h{t}")["a"].head(16), 1)) for t in range(20)}
    assert got == {t: rows for t, rows in want.items() if rows}


def test_a_bound_that_leaves_too_few_is_widened(spark):
    points = spark.range(4000).select(F.col("id").alias("loan_id"), F.col("id").cast("double").alias("a"))
    right = anomalies.draw_samples(points, ["a"], trees=8, sample=16)
    wrong = anomalies.draw_samples(points, ["a"], trees=8, sample=16, n=400_000)  # a bound for a hundred times the rows
    assert sorted(right.collect()) == sorted(wrong.collect())


def test_split_folds_and_weights(loans):
    counts = sampling.class_counts(loans)
    split = sampling.stratified_split(loans).filter("is_test")
    assert sampling.class_counts(split) == {g: int(n * 0.2 + 0.5) for g, n in counts.items()}
    folds = sampling.stratified_folds(loans).groupBy("is_default", "fold").count().collect()
    for g, n in counts.items():
        sizes = [r["count"] for r in folds if r["is_default"] == g]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    weights = {r["is_default"]: r["weight"] for r in sampling.class_weights(loans).collect()}
    assert weights[1] == pytest.approx(130 / (2 * counts[1]))
    assert sampling.class_weights(loans, resampled=True).filter("weight <> 1").count() == 0
    assert set(sampling.class_counts(sampling.undersample(loans)).values()) == {min(counts.values())}


def test_neighbors_over_many_blocks_equal_brute_force(spark, monkeypatch):
    """Blocks of few donors, some cells larger than a block, and more columns than prune well."""
    monkeypatch.setattr(neighbors, "BLOCK", 3)
    monkeypatch.setattr(neighbors, "SPAN", 4)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (150, 9)), rng.normal(50, 1e-3, (90, 9)), 100 * rng.normal(0, 1, (20, 9))])
    pts = {i: v.tolist() for i, v in enumerate(x)}
    names = [f"c{i}" for i in range(9)]
    df = spark.createDataFrame([(i, *v) for i, v in pts.items()], "loan_id long, " + ", ".join(f"{c} double" for c in names))
    found: dict = {}
    for r in neighbors.neighbor_table(df.filter("loan_id % 2 = 0"), df, names, k=5).collect():
        found.setdefault(r["loan_id"], []).append((r["distance"], r["neighbor"]))
    assert {i: sorted(v) for i, v in found.items()} == brute({i: v for i, v in pts.items() if i % 2 == 0}, pts, 5)


def test_nearest_stores_a_vector_once_for_all_its_visits(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK", 4)
    monkeypatch.setattr(neighbors, "SPAN", 1)
    stored = []
    monkeypatch.setattr(neighbors, "settle", lambda df, keep=neighbors.settle: (stored.append(found := keep(df)), found)[1])
    x = np.random.default_rng(6).normal(0, 1, (60, 12))
    points = spark.createDataFrame([("all", v.tolist(), i) for i, v in enumerate(x)], "space string, v array<double>, id long")
    near = neighbors.nearest(points, points, 3).collect()
    assert {tuple(r["v"]): [n["donor"] for n in r["near"]] for r in near} == {
        tuple(v): np.round(((x - v) ** 2).sum(axis=1) ** 0.5, 9).argsort(kind="stable")[:3].tolist() for v in x}
    assert len(stored) >= 4 and max(df.count() for df in stored) <= 60  # before: a row per block


def test_nearest_compares_few_pairs_exactly():
    """Products leave little more than the k nearest to be computed from differences; a far cell is skipped."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (400, 36)), rng.normal(90, 1, (400, 36))])
    bound = np.array([[0.0, 400.0]] * 30)
    i, j, d = neighbors._k_nearest(x[:30], np.full(30, np.inf), bound, [np.arange(400), np.arange(400, 800)], x, 6)
    assert len(i) < 30 * 12 and j.max() < 400
    whole = np.round(neighbors._distances(x[:30], x), neighbors.TIE_DIGITS)
    for q in range(30):
        assert sorted(d[i == q])[:6] == sorted(whole[q])[:6]


def test_preprocess_state_counts_nulls_and_infinities_in_one_pass(spark, monkeypatch):
    rows = [(i, None if i < 4 else float(i), float("inf") if i == 3 else float(i), None if i % 2 else 1.0, 5, i % 2) for i in range(11)]
    df = spark.createDataFrame(rows, "loan_id long, a double, b double, c double, d int, is_default int")
    passes = []
    real = preprocess.null_counts
    monkeypatch.setattr(preprocess, "null_counts", lambda *a: passes.append(a) or real(*a))
    state = preprocess.fit_preprocess(df)
    assert not passes  # it took four before
    assert state["dropped"] == [] and state["medians"] == {"a": 7.0, "c": 1.0} and state["modes"] == {}
    assert state["late"] == {"b": 5.5}
