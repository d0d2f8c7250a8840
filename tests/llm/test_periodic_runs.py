"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from creditmill.llm import periodic_runs
from creditmill.llm.queries import QUERIES


def brute_runs(words, least=6, times=4):
    n, found = len(words), {}
    ids = np.unique(np.array([w.decode() for w in words] or [""]), return_inverse=True)[1][:n]
    for q in range(1, n // times + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids[:-q] == ids[q:]).astype(int), [0]])))
        for s, e in zip(edges[::2], edges[1::2]):
            if e - s + q >= max(least, times * q):
                found.setdefault((int(s), int(e - s + q)), q)
    return sorted(((s, k, q) for (s, k), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, k = rng.choice([0, 1, 5, 6, 7, 24, 60, 160]), rng.choice([1, 2, 2, 3, 26])
    words = [bytes([97 + rng.randrange(k)]) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.3:
            words[rng.randrange(n)] = b"z"
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        texts = [random_words(rng) for _ in range(rng.randint(1, 12))]
        assert periodic_runs.find_runs(texts) == [brute_runs(w) for w in texts]


@pytest.mark.parametrize("least,times", [(4, 2), (6, 3), (9, 5), (1, 2)])
def test_other_bounds(least, times):
    rng = random.Random(least)
    for _ in range(60):
        words = random_words(rng)
        assert periodic_runs.find_runs([words], least, times) == [brute_runs(words, least, times)]


@pytest.mark.parametrize("words,want", [
    ([b"w"] * 30_000, [(0, 30_000, 1)]), ([b"v", b"w"] * 15_000 + [b"x"], [(0, 30_000, 2)]),
    ([str(i).encode() for i in range(3000)] * 9 + [b"0", b"1"], [(0, 27_002, 3000)])])
def test_long_texts(words, want):
    assert periodic_runs.find_runs([words]) == [want]


def test_long_random_text():
    rng = random.Random(3)
    words = [str(rng.randrange(6)).encode() for _ in range(4000)]
    assert periodic_runs.find_runs([words, words[:10]])[0] == brute_runs(words)


def test_rows(documents):
    rows = [(1, "a b c " * 4 + "d"), (2, None), (3, ""), (4, " \n"), (None, "x x x x x x"), (5, "x x x x x"), (5, "x x x x x x x"),
            (6, "é é é " * 8)]
    got = periodic_runs.periodic_runs(documents(rows)).collect()
    told = {(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in got}
    assert len(got) == len(rows) and told == {
        (1, 13, ((0, 12, 3),), "a b c d"), (2, 0, (), ""), (3, 0, (), ""), (4, 0, (), ""), (None, 6, ((0, 6, 1),), "x"),
        (5, 5, (), "x x x x x"), (5, 7, ((0, 7, 1),), "x"), (6, 16, ((0, 16, 2),), "é é é")}
    assert periodic_runs.periodic_runs(documents([])).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs, r = brute_runs(words), got[doc_id]
        planted += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest()
    assert planted > 5
