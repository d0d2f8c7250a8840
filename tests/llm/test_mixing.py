"""Capped water-filling and the sampling of copies."""

import random

import pytest

from creditmill.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), budget=1.5, epochs=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), budget * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(epochs * sizes[s] for s in full)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


def rows(seed, n=600):
    rng = random.Random(seed)
    sources = ["b", "a", "\U00010000", "￿", None, "hot", "empty"]
    out = []
    for i in range(n):
        s = "hot" if i % 3 == 0 else rng.choice(sources)
        words = 0 if s == "empty" else rng.randint(0, 40)
        out.append((i, None if rng.random() < 0.02 else "w x " * words, "en", s))
    return out + [(3, "dup dup", "en", "hot"), (3, "dup dup", "en", "hot"), (None, "no id", "en", "a")]


def test_targets_and_takes(documents):
    data = rows(1)
    mixed = mixing.mix(documents(data))
    got = mixed.collect()
    assert len(got) == len(data)
    sizes, taken, target, largest = {}, {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        target[r.source], largest[r.source] = r.target, max(largest.get(r.source, 0), r["size"])
        assert 0 <= r.copies <= 2
    for s, t in brute_targets(sizes).items():
        assert target[s] == pytest.approx(t)
        assert abs(taken[s] - t) <= 3 * largest[s] / 2 + 1e-9
    again = {(r.doc_id, r.source): r.copies for r in mixing.mix(documents(data, parts=7)).collect()}
    assert again == {(r.doc_id, r.source): r.copies for r in got}


def test_salted_join_gives_the_same(documents, monkeypatch):
    data = rows(3, 200)
    want = sorted(map(str, mixing.mix(documents(data)).select("doc_id", "source", "size", "target", "copies").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(str, mixing.mix(documents(data)).select("doc_id", "source", "size", "target", "copies").collect())) == want


def test_mixture_repeats_rows(documents):
    docs = documents(rows(4, 200))
    want = {}
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.text] = want.get((r.doc_id, r.text), 0) + r.copies
    out = mixing.mixture(docs)
    assert out.columns == docs.columns and out.schema["size"].dataType.simpleString() == "string"
    got = {}
    for r in out.collect():
        got[r.doc_id, r.text] = got.get((r.doc_id, r.text), 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_edges(documents):
    assert mixing.mix(documents([])).collect() == []
    only = mixing.mix(documents([(1, "a b c", "en", "x"), (2, None, "en", "x")])).collect()
    assert {r.doc_id: r["size"] for r in only} == {1: 3, 2: 0} and {r.target for r in only} == {4.5}
    nothing = mixing.mix(documents([(1, None, None, None), (2, "  ", None, "x")])).collect()
    assert {(r.target, r.copies * r["size"]) for r in nothing} == {(0.0, 0)}


def test_main_path_is_native(documents):
    plan = mixing.mixture(documents(rows(5, 50)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("epochs", [2.5, 1.25, 0.5])
def test_fractional_epochs_reach_their_target(documents, epochs):
    data = [(i, "w " * 10, "en", "zsmall" if i < 200 else "large") for i in range(2000)]
    got = mixing.mix(documents(data), weights=(1, 30), budget=1.5, epochs=epochs).collect()
    small = [r for r in got if r.source == "zsmall"]
    assert {r.target for r in small} == {epochs * 2000}  # capped
    assert sum(r.size * r.copies for r in got if r.source == "zsmall") * 1.0 == pytest.approx(epochs * 2000, abs=10)
    assert max(r.copies for r in small) <= -(-epochs // 1)


def test_columns_named_as_inside_stay(spark):
    schema = "doc_id bigint, text string, source string, _hash string, _source string, _size int, _cut string, _doc string, _weight int"
    rows = [(i, "a b", "s", "h", "o", 7, "c", "d", 9) for i in range(5)]
    got = mixing.mix(spark.createDataFrame(rows, schema)).collect()
    assert sorted(tuple(r)[:9] for r in got) == rows and {(r["size"], r["source_size"]) for r in got} == {(2, 10)}
    assert {tuple(r) for r in mixing.mixture(spark.createDataFrame(rows, schema)).collect()} <= set(rows)
