"""Drift against a stored profile of the reference."""

import pytest
from pyspark.sql import functions as F

from creditmill.operators import drift
from creditmill.session import scratch_path

COLUMNS = ["a", "b", "empty"]


def frame(spark, start, rows, shift):
    return spark.range(start, start + rows).select(
        ((F.pmod(F.xxhash64("id"), F.lit(97)) + shift) / 3).alias("a"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("double")).alias("b"), F.lit(None).cast("double").alias("empty"))


def told(df):
    return sorted((r["column"], r["n_reference"], r["n_current"], r["n_values"], r["test"], r["drifted"],
                   round(r["w1"], 9), round(r["ks"], 9), round(r["statistic"], 9)) for r in df.collect())


@pytest.mark.parametrize("rows,shift", [(3000, 0), (3000, 9), (300, 4)])
def test_a_profile_stands_for_its_rows(spark, rows, shift):
    old, new = frame(spark, 0, rows, 0), frame(spark, 10**6, rows // 2, shift)
    path = scratch_path(spark, "profile")
    parts = {"x": old.filter("a < 10"), "y": old.filter("a >= 10 AND a < 20"), "z": old.filter("a >= 20")}
    for part, some in parts.items():
        drift.add_to_profile(some, path, part, COLUMNS)
    drift.add_to_profile(parts["y"], path, "y", COLUMNS)  # storing a part again adds nothing
    want = told(drift.column_drift(old, new, ["a", "b"]))
    assert told(drift.drift_from_profile(drift.read_profile(spark, path), new, COLUMNS)) == want
    assert told(drift.drift_from_profile(drift.profile(old, COLUMNS), new, COLUMNS)) == want


def test_only_profiled_columns_count(spark):
    old, new = frame(spark, 0, 50, 0), frame(spark, 100, 50, 0)
    assert [r["column"] for r in drift.drift_from_profile(drift.profile(old, ["a"]), new, COLUMNS).collect()] == ["a"]
    assert drift.drift_from_profile(drift.profile(old.filter("false"), COLUMNS), new, COLUMNS).collect() == []
