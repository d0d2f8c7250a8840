"""Exact and line duplicates against brute force."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from creditmill.llm import exact_dedup, line_dedup
from creditmill.llm.common import small_slices, with_least
from creditmill.llm.jaccard_join import WordHash
from pyspark.sql import functions as F


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_duplicates(spark, documents):
    rng = random.Random(1)
    texts = ["a b", "a  b", "a\tb", "a\u00a0b", "", None, " ", "a b ", "x" * 5000] + [f"t{i}" for i in range(8)]
    rows = [(i, rng.choice(texts)) for i in range(400)] + [(None, "a b"), (None, "alone"), (7, "seven"), (7, "seven"), (-5, "a b")]
    got = exact_dedup.exact_duplicates(documents(rows, 7)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append(i)
    assert len(got) == len(rows)
    for r in got:
        group = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(group)
        assert r.keep_id == min((i for i in group if i is not None), default=None)
    kept = {}
    for r in got:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}  # of repeated rows just one


@pytest.mark.parametrize("fan_in", [2, 3])
def test_hot_text_in_every_run(documents, fan_in):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(600)]
    got = exact_dedup.exact_duplicates(documents(rows, 11), fan_in=fan_in).filter("group_size > 1").collect()
    assert len(got) == 400 and {r.keep_id for r in got} == {1} and {r.group_size for r in got} == {400}


def test_exact_empty(documents):
    assert exact_dedup.exact_duplicates(documents([])).collect() == []


def brute_lines(rows, near_words=8):
    """Rows in document order, by comparing each line with all earlier ones whose number of words allows an edit."""
    texts, by_size, out = set(), {}, {}
    for i, text in rows:
        kept, exact, near = [], 0, 0
        for line in text.split("\n"):
            words = line.encode().split()
            if words and line in texts:
                exact += 1
                continue
            n = len(words)
            close = n >= near_words and any(within_one(words, w) for m in (n - 1, n, n + 1) if m >= near_words for w in by_size.get(m, []))
            if words:
                texts.add(line)
                by_size.setdefault(n, []).append(words)
            if close:
                near += 1
            else:
                kept.append(line)
        out[i] = "\n".join(kept), exact, near
    return out


def within_one(a, b):
    """Edit distance of at most one, from what is left between equal starts and equal ends."""
    start = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    end = next((k for k, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    return distance(a[:len(a) - end], b[:len(b) - end]) <= 1 if max(len(a), len(b)) - end <= 1 else False


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_brute_force_within_one_is_the_distance():
    rng = random.Random(9)
    for _ in range(4000):
        a = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        b = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        assert within_one(a, b) == (distance(a, b) <= 1)


def edited(rng, words):
    words = list(words)
    for _ in range(rng.choice([0, 1, 1, 1, 2])):
        k = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[k:k + 1] = [[], [rng.choice("xyz")], [words[k], rng.choice("xyz")]][kind]
    return words


def test_lines_against_brute_force(documents):
    rng = random.Random(5)
    base = [[rng.choice("abcdef") for _ in range(rng.randint(6, 12))] for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [rng.choice([" ", "  ", "\t"]).join(edited(rng, rng.choice(base))) for _ in range(rng.randint(0, 6))]
        rows.append((i, "\n".join(lines + rng.choice([[], [""], ["short"], ["  "]]))))
    got = {r.doc_id: (r.text, r.n_exact, r.n_near) for r in line_dedup.dedup_lines(documents(rows)).collect()}
    assert got == brute_lines(rows)


def test_near_is_one_word():
    rng = random.Random(2)
    for _ in range(3000):
        a = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        b = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        assert line_dedup.near(a, b) == (distance(a, b) <= 1)


def test_near_is_k_words():
    rng = random.Random(3)
    for _ in range(4000):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        b = [rng.choice("abc") for _ in range(rng.randint(0, 9))] if rng.random() < 0.5 else edited(rng, a + ["a", "b"])
        k = rng.randint(0, 4)
        assert line_dedup.near(a, b, k) == (distance(a, b) <= k)


def test_near_lines_share_a_piece():
    rng, hashes, powers, held = random.Random(4), WordHash(), line_dedup.Powers(), {}
    edits = ((0, 1), (8, 2), (14, 3))
    for _ in range(2000):
        a = [rng.choice("abcd").encode() for _ in range(rng.randint(8, 24))]
        b = list(a)
        for _ in range(rng.randint(1, 3)):
            k = rng.randrange(len(b))
            b[k:k + 1] = rng.choice([[], [b"x"], [b[k], b"x"], [b"x", b[k]]])
        short, long = sorted((a, b), key=len)
        k = line_dedup.bound(len(short), edits)
        if k > 1 and distance(a, b) <= k:
            mine, own = line_dedup.piece_keys(short, edits, hashes, powers, held)
            assert {x for x, o in zip(mine, own) if o} & set(line_dedup.piece_keys(long, edits, hashes, powers, held)[0])


def test_long_lines_within_two_and_three_edits(documents):
    rng, edits = random.Random(6), ((0, 1), (12, 2), (20, 3))
    base = [[rng.choice("abcdefgh") for _ in range(n)] for n in (9, 11, 12, 13, 19, 20, 21, 26)]
    rows, seen, want = [], [], {}
    for i in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(words))
            words[k:k + 1] = rng.choice([[], ["x"], [words[k], "y"], ["z", words[k]]])
        line = " ".join(words)
        rows.append((i, line))
        exact = words in seen
        close = not exact and any(distance(words, w) <= line_dedup.bound(min(len(words), len(w)), edits)
                                  for w in seen if min(len(words), len(w)) >= 8) and len(words) >= 8
        want[i] = int(exact), int(close)
        seen.append(words)
    got = {r.doc_id: (r.n_exact, r.n_near) for r in line_dedup.dedup_lines(documents(rows), edits=edits).collect()}
    assert got == want
    one = sum(r.n_near for r in line_dedup.dedup_lines(documents(rows)).collect())
    assert sum(n for _, n in want.values()) > one  # one edit alone misses some


def test_hot_variant_needs_no_pairs(documents):
    rows = [(i, f"this line is the same but for number {i} in it") for i in range(500)]
    got = line_dedup.dedup_lines(documents(rows)).collect()
    assert sum(r.n_near for r in got) == 499 and next(r.n_near for r in got if r.doc_id == 0) == 0


def test_line_edges(documents):
    rows = [(3, None), (4, ""), (5, "\n\n"), (6, "one"), (7, "one"), (None, "one\ntwo"), (8, "w " * 30_000), (9, "w " * 30_000 + "v"),
            (1, "again"), (1, "again")]
    got = line_dedup.dedup_lines(documents(rows))
    told = {(r.doc_id, r.text) for r in got.collect()}
    assert told == {(3, None), (4, ""), (5, "\n\n"), (6, "one"), (7, ""), (None, "two"), (8, "w " * 30_000), (9, ""), (1, "again")}
    assert [c for c in got.columns][:9] == documents([]).columns and got.count() == len(rows)
    assert line_dedup.dedup_lines(documents([])).collect() == []


def test_with_least_of_a_hot_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("k"), "id")
    got = with_least(rows, ["k"], "id", least=F.col("id")).collect()
    assert len(got) == 1000 and all(r.least == (0 if r.k == 1 else r.k) for r in got)


def test_slices_hold_every_row_once():
    rng = random.Random(4)
    for _ in range(50):
        texts = [rng.choice([None, "", "é" * rng.randint(1, 400)]) for _ in range(rng.randint(0, 40))]
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "text"])
        parts = list(small_slices(batch, 1, rows=7, size=1000))
        assert [r for p in parts for r in p.to_pylist()] == batch.to_pylist()
        for p in parts:
            held = sum(len((t or "").encode()) for t in p.column(1).to_pylist())
            assert 1 <= p.num_rows <= 7 and (held <= 1000 or p.num_rows == 1)


def test_lines_of_a_long_text_and_of_rows_that_repeat(documents):
    long = "\n".join(["one two three four five six seven eight nine"] * 3000 + ["last line"])
    rows = [(1, long), (1, long), (2, "last line\nown"), (3, None), (4, "")]
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_exact) for r in line_dedup.dedup_lines(documents(rows)).collect() if r.text)
    kept = "one two three four five six seven eight nine\nlast line"
    assert got == [(1, kept, 3001, 2999), (1, kept, 3001, 2999), (2, "own", 2, 1)]
