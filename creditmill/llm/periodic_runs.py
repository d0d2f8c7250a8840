"""Periodic runs of words by maximal pairs.

A run is a stretch of words that repeats with some period and can't be lengthened. Two places as far apart as the period
then start the same words up to the end of the run, with unlike words before them and after: a maximal pair. The other way
round, a maximal pair whose places are no further apart than a third of what they share is a run, whole as it is.

The words of many texts are ranked at once by prefix doubling, which gives the sorted suffixes and what neighbours among
them share. These are the leaves and intervals of a tree that is worked through from the bottom; every interval keeps its
places by the word to their left, and where two intervals join, places of different lists and within reach of each other
are the maximal pairs. Places whose next five words are nowhere else in their text never enter the tree.
"""

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH, TIMES = 6, 4  # a run has at least so many words, and at least so many periods
WORDS = 1 << 17  # words that are ranked together; a longer text is ranked alone


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    """For each place of a sorted array where its group of equals starts."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(sorted_keys)), 0))


def _shared(starts: np.ndarray) -> np.ndarray:
    """Which members of a sorted array have an equal."""
    size = np.bincount(starts, minlength=len(starts))
    return size[starts] > 1


def repeated_suffixes(ids: np.ndarray, doc: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that share `least` words or more with another place of their text, in the order of their suffixes, and how many
    words each shares with the one before it in this order (0 for the first of a text).

    `ids` are word numbers of all texts in a row, `doc` says which text a word is in and `end` where that text ends.
    """
    n = len(ids)
    none = np.array([], np.int64), np.array([], np.int64)
    if not n:
        return none
    key = doc * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    starts = _starts(key[order])
    rank = np.empty(n, np.int64)
    rank[order] = starts
    active = order[_shared(starts)]

    def paired(places: np.ndarray, step: int, of: np.ndarray) -> np.ndarray:
        """Rank of a place and of the one `step` words on, as one number; a text's end comes before all words."""
        on = places + step
        return rank[places] * (n + 1) + np.where(on < end[places], of[np.minimum(on, n - 1)] + 1, 0)

    levels, h, leaves = [(1, rank.astype(np.int32))], 1, None
    while len(active):
        if h * 2 > least and leaves is None:  # h is the largest power of two up to `least`
            leaves = active
            if least > h:
                key = paired(active, least - h, rank)
                order = np.argsort(key, kind="stable")
                leaves = active[order][_shared(_starts(key[order]))]
            if not len(leaves):
                return none
            wanted = np.zeros(int(doc[-1]) + 1, bool)
            wanted[doc[leaves]] = True
            active = active[wanted[doc[active]]]
        key = paired(active, h, rank)
        order = np.argsort(key, kind="stable")
        active = active[order]
        starts, old = _starts(key[order]), _starts(rank[active])
        rank[active] += starts - old
        active = active[_shared(starts)]
        h *= 2
        levels.append((h, rank.astype(np.int32)))
    if leaves is None:
        return none
    leaves = leaves[np.argsort(rank[leaves], kind="stable")]
    a, b = leaves[:-1], leaves[1:]
    same = np.zeros(len(a), np.int64)
    one_text = doc[a] == doc[b]
    for h, of in reversed(levels):
        x, y = a + same, b + same
        fits = one_text & (x < end[a]) & (y < end[b])
        same[fits] += np.where(of[x[fits]] == of[y[fits]], h, 0)
    return leaves, np.concatenate([[0], same])


def _spread(ids: np.ndarray, start_of: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """The word before each leaf, -1 at the start of a text."""
    return np.where(leaves > start_of, ids[np.maximum(leaves - 1, 0)], -1)


def maximal_pairs(leaves: list[int], shared: list[int], left: list[int], least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(place, distance, words shared) of all maximal pairs with distance * (times - 1) <= words shared >= least."""
    # an interval: its places, sorted, and the same by the word to their left; and what it shares with the one below it
    stack: list[tuple[list[int], dict[int, list[int]], int]] = []

    def join(length: int) -> Iterator[tuple[int, int, int]]:
        b, b_by, _ = stack.pop()
        a, a_by, below = stack.pop()
        if len(a) < len(b):
            a, a_by, b, b_by = b, b_by, a, a_by
        reach = length // (times - 1)
        for c, places in b_by.items():
            if len(a_by) > 1 or c not in a_by:
                for p in places:
                    s, e = bisect_left(a, p - reach), bisect_right(a, p + reach)
                    if s == e:
                        continue
                    for other, their in a_by.items():
                        if other != c:
                            for k in range(bisect_left(their, p - reach), len(their)):
                                q = their[k]
                                if q > p + reach:
                                    break
                                yield min(p, q), abs(p - q), length
        for c, places in b_by.items():
            mine = a_by.setdefault(c, [])
            for p in places:
                insort(a, p)
                insort(mine, p)
        stack.append((a, a_by, below))

    for p, own, c in zip(leaves, shared, left):
        while len(stack) > 1 and stack[-1][2] > own and stack[-1][2] >= least:
            yield from join(stack[-1][2])
        if own < least:
            stack.clear()
        stack.append(([p], {c: [p]}, own))
    while len(stack) > 1:
        yield from join(stack[-1][2])


def find_runs(words: list[list[bytes]], least_length: int = LEAST_LENGTH, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, smallest period) of each list of words, by start, then period."""
    size = np.array([len(w) for w in words], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    total = int(size.sum())
    if not total:
        return out
    number = _Ids()
    ids = np.fromiter((i for w in words for i in map(number.__getitem__, w)), np.int64, total)
    doc, ends = np.repeat(np.arange(len(words)), size), np.cumsum(size)
    # a run shares its length less its period, which is at least this much
    least = min(max(least_length - q, (times - 1) * q) for q in range(1, least_length + 1))
    leaves, shared = repeated_suffixes(ids, doc, ends[doc], least)
    left = _spread(ids, (ends - size)[doc[leaves]], leaves)
    found: dict[tuple[int, int], int] = {}
    for p, q, same in maximal_pairs(leaves.tolist(), shared.tolist(), left.tolist(), least, times):
        if same + q >= least_length:
            key = p, same + q  # multiples of the period give the same stretch
            found[key] = min(found.get(key, q), q)
    for (p, length), q in found.items():
        k = int(doc[p])
        out[k].append((p - int(ends[k] - size[k]), length, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _together(texts: Iterator[tuple], most: int) -> Iterator[list[tuple]]:
    """Rows (key, words) in lists of about so many words."""
    held, size = [], 0
    for key, text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if held and size + len(words) > most or len(held) >= 4096:
            yield held
            held, size = [], 0
        held.append((key, words))
        size += len(words)
    if held:
        yield held


def periodic_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, times: int = TIMES, text: str = "text",
                  key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    A run has `least_length` words and `times` periods or more; its period is the smallest. `collapsed` joins by one space the
    words that no run holds after its first period. Words are parted by the six ASCII spaces. Null or empty text has no words
    and no runs, and collapses to empty text. Rows that repeat a key, or have none, are texts of their own. An empty table
    gives no rows; other columns are not read. A text is worked on whole, in memory of about 150 bytes a word.
    """
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for at in range(0, batch.num_rows, 512)
                for r in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns)))
        for held in _together(rows, WORDS):
            told = find_runs([w for _, w in held], least_length, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in held], pa.int64()), pa.array([len(w) for _, w in held], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in told], spans),
                 pa.array([b" ".join(collapse(w, runs)) for (_, w), runs in zip(held, told)], pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    return (docs.select(F.col(key).cast("bigint"), F.col(text).cast("string"))
            .mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"))
