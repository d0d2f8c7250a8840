"""The n-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditmill.llm import jaccard_join as J


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(r[0]), len(s), str(least.get(find(i)) if s else r[0])) for i, (r, s) in enumerate(zip(rows, sets)))


def corpus(seed, n=220):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 6, 7, 8, 9, 12, 20, 40, 90, 160]))] for _ in range(25)]
    rows = []
    for i in range(n):
        words = list(bases[0] if i % 3 == 0 else rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            k = rng.randrange(len(words))
            words[k:k + 1] = rng.choice([[], [rng.choice(vocabulary)], [words[k], rng.choice(vocabulary)]]) or words[k:k + 1]
        if rng.random() < 0.2:
            words += passage
        rows.append((1000 - i, rng.choice([" ", "  ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(5, None), (6, ""), (7, " \n"), (8, "one"), (9, "ONE"), (10, "one two"), (None, "one"), (None, "nobody else"),
                   (11, "Été"), (12, "été"), (11, "again"), (11, "again")]


def told(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def test_against_brute_force(documents):
    rows = corpus(1)
    assert told(J.near_duplicates(documents(rows, 5))) == brute(rows)


def test_cut_lists_and_shuffled_fetch(documents, monkeypatch):
    """Lists in many parts, all shingles counted as frequent, and no broadcast: the same result."""
    rows = corpus(3)
    monkeypatch.setattr(J, "PART", 4)
    monkeypatch.setattr(J, "FREQUENT", 2)
    monkeypatch.setattr(J, "BROADCAST_IDS", 0)
    assert told(J.near_duplicates(documents(rows, 5))) == brute(rows)


@pytest.mark.parametrize("boundary", [0, 128])
def test_any_boundary_is_right(documents, monkeypatch, boundary):
    rows = corpus(4, 120)
    monkeypatch.setattr(J, "choose_boundary", lambda *a: boundary)
    assert told(J.near_duplicates(documents(rows, 4))) == brute(rows)


def test_many_distinct_copies_stay_linear(documents):
    words = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join(words[:40] + [f"own{i}"] + words[40:])) for i in range(400)]
    got = J.near_duplicates(documents(rows, 4)).collect()
    assert {r.component_id for r in got} == {0}


@pytest.mark.parametrize("n, across", [(4, 0), (5, 10)])
def test_short_lists_are_done_by_their_leaders(spark, documents, monkeypatch, n, across):
    """Up to four classes all pairs meet among the leaders; only longer lists are gone through again."""
    monkeypatch.setattr(J, "choose_boundary", lambda *a: 0)
    words = " ".join(f"v{i}" for i in range(60))
    join = J.Join(documents([(i, f"{words} own{i}") for i in range(n)], 2), "text", "doc_id", J.PERCENT)
    lists = join.lists()
    apart = spark.createDataFrame([], "node bigint, component bigint")
    assert join.leaders(lists).count() >= (6 if n == 4 else 9)
    assert join.across(lists, apart, nearest=False).count() == across


def test_a_shingle_counted_once_at_a_time_is_told(spark, documents, monkeypatch):
    """Every document is counted by itself, so no shingle is found twice: the sampled sets tell the shared ones."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "1")
    monkeypatch.setattr(J, "CODES_HELD", 1)
    monkeypatch.setattr(J, "SAMPLED", 4)
    shared = " ".join(f"s{i}" for i in range(20))
    rows = [(i, f"{shared} " + " ".join(f"own{i}x{k}" for k in range(60))) for i in range(200)]
    join = J.Join(documents(rows, 4), "text", "doc_id", J.PERCENT)
    spark.conf.set(batch, before)
    assert join.codes.count() == 0
    told = {r.code: r.n for r in join.often(join.codes.groupBy("code").agg(J.F.sum("found").alias("n"))).collect()}
    both = set.intersection(*[set(J.shingle_set(t, J.WordHash()).view(np.int64).tolist()) for _, t in rows])
    assert set(told) == both and len(both) == 16 and all(100 <= n <= 300 for n in told.values())


def test_a_large_batch_is_counted_slice_by_slice(monkeypatch):
    class Frame:
        def mapInArrow(self, run, _):
            return run

    monkeypatch.setattr(J, "CODES_HELD", 1)
    texts = [f"a b c d e own{i}" for i in range(1100)]  # two shingles each, the first one shared
    batch = J.pa.RecordBatch.from_pydict({"doc_id": J.pa.array(range(1100), J.pa.int64()), "text": texts})
    out = [r for b in J._surveyed(Frame())([batch]) for r in b.to_pylist() if r["found"] is not None]
    shared = J.shingle_set("a b c d e", J.WordHash()).view(np.int64)[0]
    assert [(r["code"], r["found"]) for r in out] == [(shared, 512), (shared, 512), (shared, 76)]


def test_sampled_sets_change_no_link(documents, monkeypatch):
    rows = corpus(6)
    monkeypatch.setattr(J, "SAMPLED", 1)
    monkeypatch.setattr(J, "SAMPLE_FREQUENT", 2)
    monkeypatch.setattr(J, "PART", 4)
    assert told(J.near_duplicates(documents(rows, 5))) == brute(rows)


def test_empty(documents):
    assert J.near_duplicates(documents([])).collect() == []
    assert told(J.near_duplicates(documents([(1, None), (2, "")]))) == [("1", 0, "1"), ("2", 0, "2")]


@given(st.sets(st.integers(0, 10**6), min_size=2, max_size=60), st.randoms(), st.sampled_from([0, 4, 8, 24, 64]))
@settings(max_examples=200, deadline=None)
def test_linked_sets_share_a_key(base, rng, boundary):
    other = set(base)
    for _ in range(rng.randint(1, max(1, len(base) // 4))):
        other.symmetric_difference_update({rng.choice(sorted(other)) if other and rng.random() < 0.5 else rng.randrange(10**6)})
    if not other or base == other or 100 * len(base & other) < 75 * len(base | other):
        return
    a, b = (np.array(sorted(s), np.uint64) for s in (base, other))
    both = np.array(sorted(base | other), np.uint64)
    often = both[::3], np.full(len(both[::3]), 5000)
    keys = [{(k, p): i for k, p, i in zip(*(x.tolist() for x in J.list_keys(s, often, boundary)))} for s in (a, b)]
    least = min(keys[0][k] + keys[1][k] for k in keys[0].keys() & keys[1].keys())  # the same key, cut into as many parts
    assert J.may_link(least, len(a) + len(b), J.PERCENT)


def test_bitmap_never_overstates():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 3000), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 1 << 63, rng.integers(0, 900), dtype=np.uint64)]))
        bits = [J.bitmap(a), J.bitmap(b)]
        assert J.bits_apart(np.array([0]), np.array([1]), bits)[0] <= len(np.setxor1d(a, b))
        assert J.folded(bits[0], 64).tobytes() == np.packbits(
            (np.bincount((a >> np.uint64(40)).astype(np.int64) % 512, minlength=512) & 1).astype(np.uint8), bitorder="little").tobytes()


def test_few_edges_are_joined_without_a_shuffle(spark, monkeypatch):
    from creditmill.llm import components as C

    rng = np.random.default_rng(8)
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (129, 500)]
    pairs += [(int(a), int(b)) for a, b in rng.integers(1000, 1080, (60, 2))]
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    few = C.components(edges)
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(C, "FEW_EDGES", 0)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, C.components(edges).collect()))
    assert C.components(edges.filter("a < 0")).count() == 0


def test_word_hashes_hold_no_words():
    hashes = J.WordHash()
    J.shingle_set("one two three four five six", hashes)
    assert not isinstance(hashes, dict) and list(vars(hashes)) == ["of"]
    codes = J.shingle_set("a b c d e f a b c d e F", hashes)
    assert len(codes) == 6 and (codes[1:] > codes[:-1]).all()
