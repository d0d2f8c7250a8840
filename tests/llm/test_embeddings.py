"""Whitening against a plain eigenvalue solver, and near-duplicate embeddings against all pairs."""

import math

import numpy as np
import pytest

from creditmill.llm import embedding_dedup, whitening
from creditmill.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, kept string, cls bigint, component int"


def frame(spark, rows, parts=3):
    """Rows (vec_id, embedding, label) with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], g, 1, "k", 2, 3)
                                  for i, v, g in rows], SCHEMA).repartition(parts)


# --- whitening ---------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["random", "geometric", "double", "equal", "one large"])
@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_components_are_eigenvectors(n, kind):
    rng = np.random.default_rng(n)
    values = np.resize({"random": rng.random(n), "geometric": 10.0 ** -np.arange(n), "double": np.repeat(rng.random(n), 2)[:n],
                        "equal": np.ones(n), "one large": np.concatenate([[1e6], 1 + 1e-3 * rng.random(n)])}[kind], n)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    h = (q * values) @ q.T
    h = (h + h.T) / 2
    got, basis = whitening.components(h, 8)
    assert got == pytest.approx(np.linalg.eigvalsh(h)[::-1][:8], abs=1e-12 * values.max())
    assert np.abs(h @ basis - basis * got).max() < 1e-13 * values.max() * n
    assert np.abs(basis.T @ basis - np.eye(min(n, 8))).max() < 1e-13


def test_polar_factor_is_the_sign_of_the_spectrum():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    values = np.concatenate([rng.uniform(1e-6, 5, 7), -rng.uniform(1e-6, 3, 5)])
    assert whitening.polar_factor((q * values) @ q.T) == pytest.approx((q * np.sign(values)) @ q.T, abs=1e-9)


@pytest.mark.parametrize("top", [500, 1 << 27, 1 << 40])
def test_products_are_exact(top):
    y = np.random.default_rng(3).integers(-top, top, (700, 5))
    exact = y.astype(object).T @ y.astype(object)
    assert (sum(m.astype(object) for m in whitening.exact_product(y)) == exact).all()


def expected(x, most=8):
    n, d = x.shape
    s = x.astype(object).sum(axis=0)
    deviation = [int(sum((n * v - t) ** 2 for v, t in zip(row, s))) for row in x.astype(object)]
    c = x - np.array([t / n for t in s], float)
    v = c.T @ c / n
    e, basis = np.linalg.eigh(v)
    e, basis = e[::-1][:most], basis[:, ::-1][:, :most]
    return deviation, (c @ basis) / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(v)


def test_whitening_equals_the_definition(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((300, 10)) @ rng.standard_normal((10, 10)) / 4).astype(np.float32)
    dirty = [(900, None, 1), (901, [1.0] * 9 + [None], 1), (902, [math.nan] * 10, 1), (903, [math.inf] * 10, 1), (904, [], 1),
             (905, [1.0] * 9, 1), (906, [1e30] * 10, 1)]
    rows = [(i, v.tolist(), None) for i, v in enumerate(vectors)] + dirty
    rows += [(None, vectors[0].tolist(), 1), (5, vectors[1].tolist(), 1)]  # no key, and a key that repeats
    got = whitening.whitening(frame(spark, rows, 7)).collect()
    x = np.floor(1024 * np.array([v for _, v, _ in rows if v is not None and len(v) == 10 and None not in v
                                  and np.isfinite(v).all() and max(v) < 1e9], np.float32).astype(float)).astype(np.int64) + 100_000
    deviation, white, share = expected(x)
    assert len(got) == 302 * 8 and {r.n for r in got} == {302} and {r.component for r in got} == set(range(1, 9))
    keys = [*range(300), None, 5]
    by_key = {}
    for r in got:
        by_key.setdefault((r.vec_id, int(r.deviation)), {})[r.component] = r
    for k, far, w in zip(keys, deviation, white):
        mine = by_key[k, far]
        assert np.abs([mine[c].whitened for c in range(1, 9)]) == pytest.approx(np.abs(w), abs=1e-8)
        assert [mine[c].explained for c in range(1, 9)] == pytest.approx(share, rel=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    signs = [{np.sign(by_key[k, far][c].whitened * w[c - 1]) for k, far, w in zip(keys, deviation, white) if abs(w[c - 1]) > 1e-6}
             for c in range(1, 9)]
    assert all(len(s) == 1 for s in signs)  # the same sign for all rows


def test_large_numbers_stay_exact(spark):
    vectors = [[1e9, -1e9, 3.5], [-1e9, 1e9, 0.0], [1e9, 1e9, -7.25], [0.0, 5e8, 1.0]]
    got = whitening.whitening(frame(spark, [(i, v, 0) for i, v in enumerate(vectors)], 2)).collect()
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    deviation, _, share = expected(x)
    assert {(r.vec_id, int(r.deviation)) for r in got} == set(enumerate(deviation)) and max(deviation) > 2**63
    assert sorted({round(r.explained, 9) for r in got}, reverse=True) == pytest.approx(share, abs=1e-9)


def test_whitening_without_variation(spark):
    assert whitening.whitening(frame(spark, [])).collect() == []
    assert whitening.whitening(frame(spark, [(1, [], 0), (2, None, 0)])).collect() == []
    same = whitening.whitening(frame(spark, [(i, [0.5, 0.25], 0) for i in range(5)])).collect()
    assert len(same) == 10 and {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in same} == {(None, None, 0.0, 0)}
    line = whitening.whitening(frame(spark, [(i, [i / 4, i / 2], 0) for i in range(6)])).collect()
    assert len(line) == 12 and all((r.whitened is None) == (r.component == 2) for r in line) and line[0].identity_error < 1e-9


def test_whitening_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(1024 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 100_000
    deviation, white, share = expected(x)
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_whitening"](spark, sf_dir).collect()}
    assert len(got) == 8 * len(rows)
    for k, r in enumerate(rows):
        told = [got[r.vec_id, c] for c in range(1, 9)]
        assert {t.deviation for t in told} == {deviation[k]} and {t.n for t in told} == {len(rows)}
        assert [abs(t.whitened) for t in told] == pytest.approx(np.abs(white[k]), abs=1e-7)
        assert [t.explained for t in told] == pytest.approx(share, rel=1e-9)
    assert all(r.identity_error < 1e-9 for r in got.values())


# --- near duplicates ------------------------------------------------------------------------------

def brute(rows, threshold=0.93):
    """(n_links, component) of each row by all pairs."""
    fine = [v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v) and g is not None for _, v, g in rows]
    links = {i: set() for i in range(len(rows))}
    by_kind = {}
    for i, (_, v, g) in enumerate(rows):
        if fine[i]:
            by_kind.setdefault((g, len(v)), []).append(i)
    for members in by_kind.values():
        m = np.array([np.float32(rows[i][1]) for i in members], float)
        m /= np.linalg.norm(m, axis=1)[:, None]
        for i, j in zip(*np.nonzero(m @ m.T >= threshold)):
            if i != j:
                links[members[i]].add(members[j])
    out, seen = {}, {}
    for i in links:
        if i not in seen:
            todo, group = [i], {i}
            while todo:
                for j in links[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
            seen.update(dict.fromkeys(group, low))
        out[i] = (len(links[i]), seen[i])
    return out


def near(rng, v, cosine):
    v = np.array(v) / np.linalg.norm(v)
    o = rng.standard_normal(len(v))
    o -= (o @ v) * v
    return cosine * v + math.sqrt(1 - cosine**2) * o / np.linalg.norm(o)


def same(got, rows):
    want = brute(rows)
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted(
        (str(rows[i][0]), n, str(c), rows[i][0] == c) for i, (n, c) in want.items())
    return want


def test_links_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(60):
        v = rng.standard_normal(32)
        rows += [(len(rows) + 1000 * (k % 3), v, k % 4)]
        for _ in range(rng.integers(0, 12)):
            rows += [(-len(rows), near(rng, v, rng.choice([0.9, 0.94, 0.96, 0.99])) * rng.uniform(0.1, 9), (k + (rng.random() < 0.1)) % 4)]
    for k in range(5):  # a chain: neighbours are linked, ends are not
        rows += [(5000 - k, [math.cos(0.3 * k), math.sin(0.3 * k)] + [0.0] * 30, 1)]
    rows += [(7000 + k, rows[3][1], rows[3][2]) for k in range(40)]  # copies
    rows = [(int(i), [float(np.float32(c)) for c in v], None if g is None else int(g)) for i, v, g in rows]
    want = same(embedding_dedup.near_duplicates(frame(spark, rows, 5), miss=1e-9).collect(), rows)
    assert sum(n > 0 for n, _ in want.values()) > 200


def test_rows_that_link_with_nothing(spark):
    v = [0.25, 0.5, 1.0]
    rows = [(1, v, 1), (2, v, None), (3, None, 1), (4, [0.0] * 3, 1), (5, [0.25, None, 1.0], 1), (6, [0.25, math.nan, 1.0], 1), (7, [], 1),
            (8, [math.inf, 0.5, 1.0], 1), (9, v + [0.0], 1), (10, v, 2), (None, v, 1), (12, [2 * c for c in v], 1), (12, v, 1),
            (13, [1e-30 * c for c in v], 1), (14, [-c for c in v], 1), (None, [5.0, 0.0, 0.0], 3), (None, [5.0, 0.1, 0.0], 3)]
    got = embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    same_rows = [(i, v, g) for i, v, g in rows]
    want = brute(same_rows)
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == sorted(
        (str(rows[i][0]), n, str(c)) for i, (n, c) in want.items())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(frame(spark, [])).collect() == []


def test_buckets_beyond_a_part(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PART", 16)
    rng = np.random.default_rng(6)
    v = rng.standard_normal(24)
    rows = [(i, near(rng, v, 0.975), 1) for i in range(150)] + [(200 + i, rng.standard_normal(24), 1) for i in range(100)]
    rows = [(i, [float(np.float32(c)) for c in x], g) for i, x, g in rows]
    want = same(embedding_dedup.near_duplicates(frame(spark, rows, 6), miss=1e-9).collect(), rows)
    assert max(n for n, _ in want.values()) > 100


def test_tables_reach_the_recall():
    """Pairs right at the threshold share a bucket about as often as is computed; far ones seldom do."""
    rng = np.random.default_rng(8)
    tables = embedding_dedup.Tables.for_size(20_000)
    a = rng.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = np.array([near(rng, x, 0.9301) for x in a])
    x, y, z = tables.hashes(a), tables.hashes(b), tables.hashes(np.roll(a, 1, axis=0))
    assert (x == y).any(axis=1).mean() >= 0.998
    assert (x == y).mean() == pytest.approx(
        embedding_dedup.collision(math.sqrt(0.14), tables.step) ** tables.projections, rel=0.1)
    assert (x == z).mean() < 3 * embedding_dedup.OCCUPANCY / 20_000
    apart = np.bitwise_count(tables.signs(a) ^ tables.signs(b)).sum(axis=1)
    assert apart.max() <= embedding_dedup.sign_limit(0.93)


def test_all_links_of_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    same(QUERIES["op13_embedding_dedup"](spark, sf_dir).collect(), rows)
