import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmill.functions.columns import ordered_hash
from creditmill.operators import eda, lookup, ranks, sampling

RNG = np.random.default_rng(7)
N = 3000


@pytest.fixture(scope="module")
def data(spark):
    hot = np.where(RNG.random(N) < 0.4, 5.0, RNG.normal(0, 1e4, N).round(1))
    skewed = RNG.pareto(0.5, N)
    few = RNG.integers(0, 3, N).astype(float)
    gappy = [None if x < 0.2 else float(x) for x in RNG.random(N)]
    rows = [(i, float(a), float(b), float(c), d, int(i % 2)) for i, (a, b, c, d) in
            enumerate(zip(hot, skewed, few, gappy))]
    df = spark.createDataFrame(rows, "loan_id long, hot double, skewed double, few double, gappy double, y int")
    return df.persist(), {"hot": hot, "skewed": skewed, "few": few,
                          "gappy": np.array([x for x in gappy if x is not None])}


@pytest.mark.parametrize("bound", [ranks.LOCAL_COUNTS, 0])
def test_quantiles_equal_numpy(data, monkeypatch, bound):
    monkeypatch.setattr(ranks, "LOCAL_COUNTS", bound)
    df, arrays = data
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = ranks.quantile_map(df, list(arrays), probs)
    for c, x in arrays.items():
        assert found[c] == pytest.approx(list(np.quantile(x, probs)), rel=1e-12)


@pytest.mark.parametrize("width", [1, 2, 7, 33, 150])
@pytest.mark.parametrize("descending", [False, True])
def test_cumulate_for_any_width(data, width, descending):
    df, arrays = data
    counts = ranks.value_counts(df, ["hot", "few"])
    out = ranks.cumulate(counts, "value", ["n"], ["column"], descending, with_next=True, width=width)
    for c in ("hot", "few"):
        values, n = np.unique(arrays[c], return_counts=True)
        if descending:
            values, n = values[::-1], n[::-1]
        rows = sorted(out.filter(F.col("column") == c).collect(), key=lambda r: -r["value"] if descending else r["value"])
        assert [r["value"] for r in rows] == list(values)
        assert [r["upto_n"] for r in rows] == list(np.cumsum(n))
        assert {r["total_n"] for r in rows} == {N}
        assert [r["next_value"] for r in rows] == [*values[1:], None]


def test_cumulate_without_keys(data):
    df, arrays = data
    counts = df.groupBy(F.col("skewed").alias("value")).agg(F.count("*").alias("n"))
    rows = ranks.cumulate(counts, "value", ["n"], width=40).orderBy("value").collect()
    assert [r["upto_n"] for r in rows] == list(np.cumsum(np.unique(arrays["skewed"], return_counts=True)[1]))


def test_quantiles_survive_wrong_brackets(data, monkeypatch):
    df, arrays = data
    probs = [0.25, 0.5]
    monkeypatch.setattr(ranks, "_sketch", lambda df, columns, p, by, a: {(None, c): [3.0] * len(p) for c in columns})
    found = ranks.quantile_map(df, ["skewed", "gappy"], probs)
    for c in found:
        assert found[c] == pytest.approx(list(np.quantile(arrays[c], probs)), rel=1e-12)


def test_quantiles_by_group(data):
    df, arrays = data
    found = ranks.quantile_map(df, ["hot", "few"], [0.3, 0.5], by="y")
    for g in (0, 1):
        for c in ("hot", "few"):
            assert found[g, c] == pytest.approx(list(np.quantile(arrays[c][g::2], [0.3, 0.5])), rel=1e-12)


def test_sketched_quantiles_are_close(data):
    df, arrays = data
    q = ranks.quantile_map(df, ["gappy"], [0.5], accuracy=1000)["gappy"][0]
    assert abs((arrays["gappy"] <= q).mean() - 0.5) < 0.01


def test_hash_cut_takes_exact_sizes(data):
    df, _ = data
    for sizes in ({0: 1, 1: 1500}, {0: 777, 1: 0}, {0: 5000, 1: 3}):
        cut = df.filter(ranks.hash_cut(df, "loan_id", 1, "y", sizes)).groupBy("y").count().collect()
        assert {r["y"]: r["count"] for r in cut} == {g: min(n, 1500) for g, n in sizes.items() if n}


def test_hash_cut_is_the_head_of_seeded_positions(data):
    df, _ = data
    placed = ranks.seeded_positions(df, "loan_id", 1, ["y"])
    both = placed.withColumn("cut", ranks.hash_cut(df, "loan_id", 1, "y", {0: 400, 1: 400}))
    assert both.filter(F.col("cut") != (F.col("position") < 400)).count() == 0
    assert both.select("y", "position").distinct().count() == N


def test_spearman_ranks_anew_per_pair(data):
    df, _ = data
    frame = df.withColumn("late", F.when(F.col("loan_id") % 5 != 0, F.col("skewed")))
    columns = ["hot", "skewed", "few", "gappy", "late"]
    found = {(r["a"], r["b"]): r["r"] for r in eda.spearman_matrix(frame, columns).collect()}
    expected = frame.toPandas()[columns].corr(method="pearson")
    for a in columns:
        for b in columns:
            pair = frame.toPandas()[[a, b]] if a != b else frame.toPandas()[[a]]
            r = pair.dropna().rank()
            assert found[a, b] == pytest.approx(r[a].corr(r[b]) if a != b else 1.0, abs=1e-9)
    pearson = {(r["a"], r["b"]): r["r"] for r in eda.pearson_matrix(frame, columns).collect()}
    assert all(pearson[a, b] == pytest.approx(expected.loc[a, b], abs=1e-9) for a in columns for b in columns)


def test_spearman_looks_ranks_up_without_moving_rows(spark, data, monkeypatch):
    df, _ = data
    columns = ["hot", "skewed", "few", "gappy", "late"]
    frame = df.withColumn("late", F.when(F.col("loan_id") % 5 != 0, F.col("skewed"))).localCheckpoint()
    def found():
        return {(r["a"], r["b"]): r["r"] for r in eda.spearman_matrix(frame, columns).collect()}
    with monkeypatch.context() as m:
        m.setattr(eda.ranks, "with_average_ranks", None)  # ranks the rows
        looked_up = found()
    with monkeypatch.context() as m:
        m.setattr(eda, "RANKED_VALUES", 10)  # too many values: the rows are ranked
        assert found() == pytest.approx(looked_up, abs=1e-12)
    frame = frame.unionByName(frame.filter("loan_id < 50"))  # rows that share a key count as one
    with monkeypatch.context() as m:
        m.setattr(eda, "_rank_tables", None)
        assert len(found()) == len(looked_up)


def test_attach_beyond_the_broadcast_bound(spark, data):
    df, _ = data
    table = df.groupBy("few").agg(F.count("*").alias("n"))
    left = df.select("loan_id", F.when(F.col("loan_id") > 10, F.col("few")).alias("few"))
    small = lookup.attach(left, table, "few").select("loan_id", "few", "n")
    large = lookup.attach(left, table, "few", max_rows=1).select("loan_id", "few", "n")
    assert sorted(small.collect()) == sorted(large.collect()) and large.count() == N


def test_attach_shuffles_a_large_table_and_cuts_only_hot_keys(spark, monkeypatch):
    """A table beyond the bound is not broadcast however small the planner thinks it is, and its rows are not copied."""
    table = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    left = spark.range(2000).select(F.col("id").alias("loan_id"), F.when(F.col("id") % 5 == 0, 7).when(F.col("id") % 5 == 1, None)
                                    .otherwise(F.col("id") % 400).cast("long").alias("k"))
    plain = sorted(lookup.attach(left, table, "k").select("loan_id", "k", "v").collect(), key=str)
    def told():
        found = lookup.attach(left, table, "k", max_rows=10)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(found.select("loan_id", "k", "v").collect(), key=str) == plain and "SortMergeJoin" in plan
        return plan
    assert "Broadcast" not in (plan := told()) and "Generate" not in plan
    monkeypatch.setattr(lookup, "HOT_ROWS", 50)  # 7 and NULL
    assert "Generate" in told()


def test_hash_cuts_of_several_sizes(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 7 == 0, 1).when(F.col("id") % 1000 == 3, F.lit(None)).otherwise(0).alias("g"))
    wanted = {0: [0, 1, 17, 2000, 10**6], 1: [300, 714, 715]}
    cuts = ranks.hash_cuts(rows, "id", 5, "g", wanted)
    assert set(cuts) == {(g, n) for g, several in wanted.items() for n in several}
    for (g, n), limit in cuts.items():
        size = rows.filter(F.col("g") == g).count()
        assert rows.filter((F.col("g") == g) & (ordered_hash("id", 5) < F.lit(limit))).count() == min(n, size)
    assert ranks.hash_cuts(rows, "id", 5, "g", {}) == {}
    assert rows.filter(ranks.hash_cut(rows, "id", 5, "g", {0: 0})).count() == 0


def test_folds_shuffle_no_row(spark):
    rows = spark.range(1003).select(F.col("id").alias("loan_id"), F.when(F.col("id") % 9 == 0, 1).otherwise(0).alias("is_default"),
                                    F.lit("wide").alias("x"))
    rows = rows.unionByName(spark.createDataFrame([(2000, None, "y")], "loan_id bigint, is_default int, x string"))
    placed = sampling.stratified_folds(rows, k=4)
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    sizes = {(r["is_default"], r["fold"]): r["count"] for r in placed.groupBy("is_default", "fold").count().collect()}
    for g, n in ((0, 891), (1, 112)):
        assert [sizes[g, k] for k in range(4)] == [n * (k + 1) // 4 - n * k // 4 for k in range(4)]
    assert sum(n for (g, _), n in sizes.items() if g is None) == 1 and {k for _, k in sizes} <= set(range(4))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 97, 1000, 4096])
def test_donors_are_a_permutation(spark, n):
    rows, size = ranks.numbered(spark.range(n).repartition(5).withColumn("x", F.col("id") * 2))
    told = rows.select("position", "x", *[ranks.bijection(F.col("position"), size, f"7.{i}").alias(f"d{i}") for i in range(3)]).collect()
    assert size == n and sorted(r["position"] for r in told) == list(range(n)) and sorted(r["x"] for r in told) == list(range(0, 2 * n, 2))
    for i in range(3):
        assert sorted(r[f"d{i}"] for r in told) == list(range(n))
    if n > 90:
        assert len({tuple(r[f"d{i}"] for r in told) for i in range(3)}) == 3


def test_permutations_of_very_many_positions(spark):
    n = 3 * 10**11
    near = spark.range(1000).select(ranks.bijection(n - 1 - F.col("id"), n, 1).alias("d")).collect()
    assert len({r["d"] for r in near}) == 1000 and all(0 <= r["d"] < n for r in near)
