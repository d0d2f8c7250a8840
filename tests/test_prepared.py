"""Registered preparation queries run over all model features and text columns."""

import numpy as np
import pytest

from creditmill import schema as S
from creditmill.catalog import prepared


def test_neighbors_in_all_model_features_equal_brute_force(spark, sf_dir):
    points = prepared.scaled_features(spark, sf_dir).filter(f"{S.TARGET} = 1").toPandas().sort_values(S.KEY)
    ids, x = points[S.KEY].to_numpy(), points[S.MODEL_FEATURES].to_numpy(float)
    got = {}
    for r in prepared.QUERIES["smote_neighbors_of_model"](spark, sf_dir).collect():
        got.setdefault(r[S.KEY], {})[r["place"]] = (r["neighbor"], r["distance"])
    assert sorted(got) == ids.tolist()
    for k in range(len(ids)):
        gaps = np.sqrt(((x - x[k]) ** 2).sum(axis=1)).round(9)
        order = [j for j in np.lexsort((ids, gaps)) if j != k][:5]
        told = [got[ids[k]][i + 1] for i in range(5)]
        # distances that differ by less than rounding may change places
        assert [d for _, d in told] == pytest.approx(gaps[order].tolist(), abs=1e-6)
        assert all(gaps[np.searchsorted(ids, j)] == pytest.approx(d, abs=1e-6) for j, d in told)


@pytest.mark.parametrize("name", ["smote", "adasyn"])
def test_oversamplers_make_all_model_features(spark, sf_dir, name):
    out = prepared.QUERIES[name](spark, sf_dir)
    assert set(S.MODEL_FEATURES) < set(out.columns)
    made = out.filter("base IS NOT NULL")
    assert made.count() > 0 and made.filter(" OR ".join(f"{c} IS NULL" for c in S.MODEL_FEATURES)).count() == 0


def test_every_text_column_is_encoded(spark, sf_dir):
    rows = prepared.sparse_texts(spark, sf_dir)
    out = prepared.QUERIES["onehot_encode_all"](spark, sf_dir)
    for c in S.CATEGORICAL:
        levels = {r[0] for r in rows.select(c).distinct().collect()} - {None}
        told = {n for n in out.columns if any(n == f"{c}_{v}" for v in levels)}
        assert c not in out.columns and len(told) == len(levels) - 1
