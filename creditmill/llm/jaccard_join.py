"""Near-duplicate documents by a size-aware heavy-light join on word n-grams.

A document is the set of its distinct 5-word shingles; two are linked when their Jaccard similarity is at least 0.75.
Shingles have one global order, known frequent ones last, so linked sets share a shingle among the first
n - ceil(0.75 n) + 1 of each (two, when one more is taken). From this:

* small (light) sets enumerate all 2-subsets of that prefix; sharing a subset makes two of them candidates,
* large (heavy) sets are put on the inverted list of each prefix shingle, and the lists are scanned,
* the boundary between small and large minimises a cost: shuffled rows against scanned list entries. Small sets close
  enough to the boundary to match a large one are on the lists too, so no pair is lost.

Components need not compare all pairs of a list, which would be the square of a group of copies. Equal sets are one class.
On each list all classes meet three leaders, by which a list of up to four is done; what verification links is joined into
components; then, on longer lists, each class meets the nearest class of another component; last, all pairs on such a list
that lie in different components still are compared. Pairs inside one component can't change it and are never formed. Pairs are dropped before verification only
where sizes, or the parity bits of a hashed bitmap, prove that the sets differ in too many shingles. Shingles are 64-bit
hashes; verification intersects the whole sets.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill.llm.common import release, shard_join, shards_for
from creditmill.llm.components import components
from creditmill.session import settle, shuffle_width

SHINGLE = 5
PERCENT = 75  # similarity from which sets are linked
BITMAP = 512, 1 << 16  # least and most bits of a bitmap; in between it has twice the set's size, rounded up to a power of two
CODES_HELD = 2_000_000  # shingles counted at a time in a task (some 60 MB while they are sorted)
FREQUENT = 8  # counted documents from which a shingle comes last in the order
SAMPLED = 64  # one set in so many tells all its shingles, so that one which occurs once a task is known as frequent too
SAMPLE_FREQUENT = 4  # sampled sets from which a shingle counts as frequent, with SAMPLED documents each
FREQUENT_LIST = 1 << 20  # frequent shingles told to all tasks (16 MB); any others only cost time
LEADERS = 3  # classes of a list that all others meet; of one more class than that, so all pairs are met
PART = 1024  # classes of a list that are worked on together; longer lists are cut
PAIR_COST = 32  # comparing a pair costs about as much as so many shuffled rows
BOUNDARIES = (0, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)
BROADCAST_IDS = 1_000_000  # documents to fetch, up to which their ids (8 bytes each) are broadcast
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)  # odd multipliers


class WordHash:
    """64-bit hash of a word, by `of`. Hashing a word anew costs less than looking it up among very many, and holds nothing."""

    def __init__(self):
        import xxhash

        self.of: Callable[[bytes], int] = xxhash.xxh3_64_intdigest


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, hashes: WordHash, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingle codes of a whole text, ascending. A to Z lower-cased; words are parted by the six ASCII spaces."""
    words = text.encode().lower().split()  # on bytes both work on ASCII alone
    n = len(words)
    if not n:
        return np.array([], np.uint64)
    h = np.fromiter(map(hashes.of, words), np.uint64, n)
    k = min(size, n)
    code = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        code = code * _ODD + h[i:n - k + 1 + i]
    code = np.sort(_scrambled(code))
    return code[_starts([code])]


def bitmap(codes: np.ndarray) -> bytes:
    """Bit i: whether an odd number of codes hash to i. Two sets differ in at least as many codes as their bitmaps in bits."""
    width = min(max(BITMAP[0], 1 << (2 * len(codes) - 1).bit_length()), BITMAP[1])
    odd = np.bincount((codes >> np.uint64(40)).astype(np.int64) % width, minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap that the set would have with `size` bytes, a power of two and at most its own size."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 8), axis=0)


def bits_apart(i: np.ndarray, j: np.ndarray, bits: list[bytes]) -> np.ndarray:
    """In how many bits the bitmaps of each pair differ, at the smaller of the two sizes."""
    size = np.array([len(b) for b in bits])
    common, out = np.minimum(size[i], size[j]), np.zeros(len(i), np.int64)
    for s in np.unique(common):
        at = np.flatnonzero(common == s)
        used, where = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        rows = np.stack([folded(bits[k], int(s)) for k in used])
        left, right = where[:len(at)], where[len(at):]
        for k in range(0, len(at), 4096):
            out[at[k:k + 4096]] = np.bitwise_count(rows[left[k:k + 4096]] ^ rows[right[k:k + 4096]]).sum(axis=1)
    return out


def may_link(apart: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Overlap of t or more of the union means that sets differ in at most (1 - t) / (1 + t) of their total size."""
    return apart * (100 + percent) <= total * (100 - percent)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    return -(-n * percent // 100)


def _per_document(make: Callable, out: pa.Schema, flush: Callable | None = None) -> Callable:
    """Arrow function over (id, text) rows that runs make()(id, codes) for each and yields what it returns."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, row = WordHash(), make()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [r for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                        if (r := row(i, shingle_set(t or "", hashes))) is not None]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), out.types)], schema=out)
                if flush:  # after each slice: a whole batch of long texts may hold many times what is counted at a time
                    yield from flush(row, False)
        if flush:
            yield from flush(row, True)
        batch = part = rows = row = None
        release()

    return run


def _digest(codes: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(codes.tobytes())


def _surveyed(docs: DataFrame) -> DataFrame:
    """In one pass: size, digest and bitmap of every document; the shingles that several documents of a task share, with how
    many; and every shingle of one set in SAMPLED, chosen by digest, with the set's digest."""
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()), ("bits", pa.binary()),
                     ("code", pa.int64()), ("found", pa.int64())])

    class Row:
        def __init__(self):
            self.seen, self.held, self.size, self.sampled = set(), [], 0, []

        def __call__(self, doc_id, codes):
            if not len(codes):
                return doc_id, 0, None, None, None, None
            key = _digest(codes)
            if key not in self.seen:  # copies are one class
                self.seen.add(key)
                self.held.append(codes)
                self.size += len(codes)
                if int.from_bytes(key[:4], "little") % SAMPLED == 0:
                    self.sampled.append((key, codes))
            return doc_id, len(codes), key, bitmap(codes), None, None

    def flush(row: Row, last: bool) -> Iterator[pa.RecordBatch]:
        if row.held and (last or row.size >= CODES_HELD):
            held, sampled = np.concatenate(row.held), row.sampled
            row.held, row.size, row.sampled = [], 0, []
            held.sort()
            held = held[_repeated(held)]  # few: what comes next takes little memory
            starts = _starts([held])
            codes, found = held[starts].view(np.int64), np.diff(starts, append=len(held))
            del held, starts
            release()
            for at in range(0, len(codes), 1 << 16):
                c = codes[at:at + (1 << 16)]
                empty = [pa.nulls(len(c), t) for t in out.types[:4]]
                yield pa.RecordBatch.from_arrays([*empty, pa.array(c), pa.array(found[at:at + (1 << 16)])], schema=out)
            for key, codes in sampled:
                no = [pa.nulls(len(codes), t) for t in out.types]
                yield pa.RecordBatch.from_arrays([*no[:2], pa.array([key] * len(codes), pa.binary()), no[3], pa.array(codes.view(np.int64)),
                                                  no[5]], schema=out)

    return docs.mapInArrow(_per_document(Row, out, flush),
                           "doc_id bigint, n bigint, set_key binary, bits binary, code bigint, found bigint")


def choose_boundary(rows: DataFrame, repeats: float, percent: int = PERCENT) -> int:
    """Largest size of a small set, by cost summed over all sets in one row of aggregates.

    On lists a set costs a row for each prefix shingle and `repeats` comparisons for each; as a small set, a row for each
    2-subset. `repeats` is how many other sets an average list entry meets.
    """
    n = F.col("n")
    need = F.ceil(n * F.lit(percent) / 100)
    lists = (n - need + 1) * (1 + repeats * PAIR_COST)
    subsets = (n - need + 2) * (n - need + 1) / 2
    costs = [F.sum(F.when(n > b, lists).otherwise(subsets + F.when(n >= least_overlap(b + 1, percent), lists).otherwise(0)))
             .alias(str(b)) for b in BOUNDARIES]
    told = rows.filter("n > 1").agg(*costs).first()
    return min(BOUNDARIES, key=lambda b: (told[str(b)] or 0, b))


def list_keys(codes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], boundary: int, percent: int = PERCENT,
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys under which a set is listed, into how many parts each key's list is cut, and how many of the set's shingles come
    before: were the key the first one that two sets share, none of those would be in the other set."""
    n = len(codes)
    if n < 2:  # a set of one shingle is linked with equal sets only
        return np.array([], np.uint64), np.array([], np.int32), np.array([], np.int32)
    listed, counts = frequent
    parts = np.zeros(n, np.int32)
    if len(listed):
        at = np.minimum(np.searchsorted(listed, codes), len(listed) - 1)
        parts = np.where(listed[at] == codes, counts[at] // PART + 1, 0).astype(np.int32)
    first = n - least_overlap(n, percent) + 1
    order = np.argsort(parts > 0, kind="stable")[:first + 1]
    codes, parts = codes[order], np.maximum(parts[order], 1)
    keys, cut, before = [], [], []
    if n > boundary or n >= least_overlap(boundary + 1, percent):
        keys.append(codes[:first])
        cut.append(parts[:first])
        before.append(np.arange(first, dtype=np.int32))
    if n <= boundary:
        i, j = np.triu_indices(first + 1, 1)
        low, high = np.minimum(codes[i], codes[j]), np.maximum(codes[i], codes[j])
        keys.append(_scrambled(low * _ODD + high))
        cut.append(np.minimum(parts[i], parts[j]))
        before.append((j - 1).astype(np.int32))  # all before the second but the first
    return np.concatenate(keys), np.concatenate(cut), np.concatenate(before)


def _listed(docs: DataFrame, frequent, boundary: int, percent: int) -> DataFrame:
    out = pa.schema([("set_key", pa.binary()), ("n", pa.int32()), ("keys", pa.list_(pa.int64())), ("parts", pa.list_(pa.int32())),
                     ("before", pa.list_(pa.int32()))])

    def make():
        told, seen = frequent.value, set()

        def row(_, codes):
            if len(codes) < 2 or (key := _digest(codes)) in seen:
                return None
            seen.add(key)
            keys, parts, before = list_keys(codes, told, boundary, percent)
            return key, len(codes), keys.view(np.int64), parts, before

        return row

    return docs.mapInArrow(_per_document(make, out), "set_key binary, n int, keys array<bigint>, parts array<int>, before array<int>")


def _groups(batches: Iterable[pa.RecordBatch], by: int) -> Iterator[list[np.ndarray]]:
    """Sorted batches as arrays, cut so that rows equal in the first `by` columns stay together."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(cols[0]):
            continue
        held = cols if held is None else [np.concatenate(p) for p in zip(held, cols)]
        same = np.ones(len(held[0]), bool)
        for c in held[:by]:
            same &= c == c[-1]
        cut = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield [c[:cut] for c in held]
            held = [c[cut:] for c in held]
    if held is not None:
        yield held


def _starts(cols: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(cols[0]), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _repeated(codes: np.ndarray) -> np.ndarray:
    """Which of some sorted codes occur more than once."""
    out = np.zeros(len(codes), bool)
    np.equal(codes[1:], codes[:-1], out=out[1:])
    out[:-1] |= out[1:]
    return out


def _shared(percent: int) -> Callable:
    """Keep the lists' classes that may be linked with another one there; columns key, part, cls, parts, n, before, sorted by
    the first three. Added are whether the pairs with `leads` are all of the list, and `leads`: the leaders that the class may
    be linked with and that come before it. Leaders are the first of the list, as class numbers are random.

    A linked pair need only be found under the first key it shares, where what comes before is in one set alone: too much
    before it, or too unlike sizes, and the two are no pair of this list.
    """
    def possible(n, m, before, before_m):
        total = n.astype(np.int64) + m
        return (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & may_link(before.astype(np.int64) + before_m, total, percent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _groups(batches, 2):
            once = _starts(cols[:3])  # copies of a class in several tasks
            cols = [c[once] for c in cols]
            starts = _starts(cols[:2])
            size = np.diff(np.append(starts, len(cols[0])))
            n, before, keep = cols[4], cols[5], cols[3] > 1  # of a list that is cut into parts only some is seen here
            two = starts[(size == 2) & ~keep[starts]]
            keep[two] = keep[two + 1] = possible(n[two], n[two + 1], before[two], before[two + 1])
            for s, k in zip(starts, size):
                if k > 2 and not keep[s]:
                    e = s + k
                    for at in range(s, e, 256):
                        a = slice(at, min(at + 256, e))
                        met = possible(n[a, None], n[None, s:e], before[a, None], before[None, s:e])
                        met[np.arange(len(met)), np.arange(at - s, at - s + len(met))] = False
                        keep[a] = met.any(axis=1)
            if keep.any():
                cols = [c[keep] for c in cols]
                starts = _starts(cols[:2])
                size = np.diff(starts, append=len(cols[0]))
                start, size = np.repeat(starts, size), np.repeat(size, size)
                done = (size <= LEADERS + 1) & (cols[3] == 1)
                n, before, place = cols[4], cols[5], np.arange(len(start)) - start
                met = np.zeros((len(start), LEADERS), bool)
                for k in range(LEADERS):
                    lead = np.minimum(start + k, len(start) - 1)
                    alike = np.minimum(n, n[lead]) * 100 >= np.maximum(n, n[lead]) * percent
                    met[:, k] = (place > k) & np.where(done, possible(n, n[lead], before, before[lead]), alike)
                leads = cols[2][(start[:, None] + np.arange(LEADERS))[met]]
                ends = np.concatenate([[0], np.cumsum(met.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols[:5]), pa.array(done), pa.ListArray.from_arrays(ends, leads)],
                                                 ["key", "part", "cls", "parts", "n", "done", "leads"])
        cols = None
        release()

    return run


def _similar_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _across(nearest: bool, percent: int) -> Callable:
    """Pairs in different components on a list that sizes and bitmaps can't rule out: for each class its nearest, or all.

    Columns key, low, high, part, cls, n, label, bits, sorted by the first three. Where low <> high the group joins two parts
    of a long list and only pairs across the parts count.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _groups(batches, 3):
            _, low, high, part, cls, n, label, bits = cols
            starts = _starts(cols[:3])
            left, right = [], []
            for s, e in zip(starts, np.append(starts[1:], len(cls))):
                if (label[s:e] == label[s]).all():
                    continue
                for at in range(s, e, 256):
                    a = np.arange(at, min(at + 256, e))
                    size = n[a][:, None], n[None, s:e]
                    ok = (label[a][:, None] != label[None, s:e]) & (np.minimum(*size) * 100 >= np.maximum(*size) * percent)
                    if low[s] != high[s]:
                        ok &= part[a][:, None] != part[None, s:e]
                    if not nearest:
                        ok &= cls[a][:, None] < cls[None, s:e]
                    i, j = np.nonzero(ok)
                    if not len(i):
                        continue
                    i, j = a[i], s + j
                    apart = bits_apart(i - s, j - s, bits[s:e].tolist())
                    fine = may_link(apart, n[i].astype(np.int64) + n[j], percent)
                    i, j, apart = i[fine], j[fine], apart[fine]
                    if nearest and len(i):
                        order = np.lexsort((cls[j], apart, i))
                        first = _starts([i[order]])
                        i, j = i[order][first], j[order][first]
                    left.append(np.minimum(cls[i], cls[j]))
                    right.append(np.maximum(cls[i], cls[j]))
            if left:
                pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])
        release()

    return run


def _possible(percent: int) -> Callable:
    """Pairs that the bitmaps don't rule out; columns a, b, n_a, n_b, bits_a, bits_b."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_rows
            apart = bits_apart(np.arange(k), np.arange(k, 2 * k), batch.column(4).to_pylist() + batch.column(5).to_pylist())
            keep = may_link(apart, batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))
        release()

    return run


def _linked(percent: int) -> Callable:
    """Pairs whose whole sets are similar enough; columns a, b, codes_a, codes_b."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    return run


class Join:
    """The steps of one join over one table of documents."""

    def __init__(self, docs: DataFrame, text: str, key: str, percent: int):
        self.percent, self.spark = percent, docs.sparkSession
        self.docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
        survey = settle(_surveyed(self.docs).withColumn("run", F.spark_partition_id()))
        self.rows = survey.filter("n is not null").drop("code", "found")
        self.codes = survey.filter("found is not null").select("code", "found")
        self.sampled = survey.filter("code is not null and found is null").select("code", "set_key")
        self.seed = self._seed()
        self.cls = F.xxhash64("set_key", F.lit(self.seed))
        # one row a class: any document that has it; many steps read it
        self.classes = settle(self.rows.filter("n > 1").withColumn("cls", self.cls).groupBy("cls")
                              .agg(F.min("doc_id").alias("doc_id"), F.first("n").cast("int").alias("n"), F.first("bits").alias("bits")))

    def _seed(self) -> int:
        """A seed under which no two different sets get the same 64-bit class number."""
        for seed in range(100):
            told = self.rows.filter("n > 0").select("set_key", F.xxhash64("set_key", F.lit(seed)).alias("cls"))
            if not told.groupBy("cls").agg((F.min("set_key") != F.max("set_key")).alias("x")).filter("x").limit(1).count():
                return seed
        raise RuntimeError("no seed without collisions")

    def often(self, counts: DataFrame) -> DataFrame:
        """(code, n) of frequent shingles: by what tasks counted, or by the sampled sets that have them if that is more.

        A shingle in k sets that no task saw twice is missed where fewer than SAMPLE_FREQUENT of them are sampled, which has a
        probability below 0.0005 from k = 16 * SAMPLED on: how long a list may be without being told does not depend on the
        number of tasks. What is told changes the order of shingles and into how many parts lists are cut, never the links.
        """
        drawn = self.sampled.distinct().groupBy("code").agg(F.count("*").alias("k")).filter(F.col("k") >= SAMPLE_FREQUENT)
        return (counts.filter(F.col("n") >= FREQUENT).union(drawn.select("code", F.col("k") * SAMPLED))
                .groupBy("code").agg(F.max("n").alias("n")))

    def lists(self) -> DataFrame:
        """Lists with several classes: key, part, cls, parts, n, done, leads."""
        counts = self.codes.groupBy("code").agg(F.sum("found").alias("n"))
        often = self.often(counts).orderBy(F.desc("n"), "code").limit(FREQUENT_LIST).toPandas()
        listed = often["code"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(listed)
        frequent = self.spark.sparkContext.broadcast((listed[order], often["n"].to_numpy(np.int64)[order]))
        rare = counts.filter(F.col("n") < FREQUENT).agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or 0
        total = self.rows.agg(F.sum("n")).first()[0] or 1
        boundary = choose_boundary(self.rows, float(rare) / float(total), self.percent)
        entries = (_listed(self.docs, frequent, boundary, self.percent)
                   .select(self.cls.alias("cls"), "n", F.explode(F.arrays_zip("keys", "parts", "before")).alias("e"))
                   .select(F.col("e.keys").alias("key"), F.pmod(F.col("cls"), F.col("e.parts")).cast("int").alias("part"), "cls",
                           F.col("e.parts").alias("parts"), "n", F.col("e.before").alias("before")))
        return settle(entries.repartition(shuffle_width(self.spark), "key", "part").sortWithinPartitions("key", "part", "cls")
                      .mapInArrow(_shared(self.percent), "key bigint, part int, cls bigint, parts int, n int, done boolean, leads array<bigint>"))

    def leaders(self, lists: DataFrame) -> DataFrame:
        """Pairs of each class with the leaders of its lists (parts)."""
        met = lists.select("cls", F.explode("leads").alias("lead"))
        pairs = settle(met.select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b")).distinct())
        a, b = (self.classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
        both = self._attach(pairs, {"a": a, "b": b}).select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        return both.mapInArrow(_possible(self.percent), "a bigint, b bigint")

    def _attach(self, pairs: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        """Join a table of classes to each side of the pairs; a class in more than PART pairs is cut into shards."""
        out = pairs
        for side, table in tables.items():
            hot = (pairs.groupBy(side).agg(F.count("*").alias("_n")).filter(F.col("_n") > PART)
                   .select(side, shards_for("_n", PART).alias("shards")))
            cut, told = (x.join(F.broadcast(hot), side, "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
                         for x in (out, table))  # at most one class in PART pairs is hot
            out = shard_join(cut, told, [side], F.struct("a", "b"), "shards").drop("shards")
        return out

    def across(self, lists: DataFrame, labels: DataFrame, nearest: bool) -> DataFrame:
        """Candidate pairs between components that meet on a list of which not all pairs were met."""
        told = (lists.filter("not done").drop("done", "leads").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                .withColumn("label", F.coalesce("component", "cls")).drop("component"))
        mixed = told.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("key")
        rows = settle(told.join(mixed, "key")).join(self.classes.select("cls", "bits"), "cls")
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        paired = rows.withColumn("_o", other).select(
            "key", F.least("part", "_o").alias("low"), F.greatest("part", "_o").alias("high"), "part", "cls", "n", "label", "bits")
        return (paired.repartition(shuffle_width(self.spark), "key", "low", "high").sortWithinPartitions("key", "low", "high")
                .mapInArrow(_across(nearest, self.percent), "a bigint, b bigint").distinct())

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are links, by their whole sets, which are made again from the texts of just these documents."""
        pairs = settle(pairs)
        if not pairs.limit(1).count():
            return pairs
        wanted = settle(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
                        .join(self.classes.select("cls", "doc_id"), "cls"))
        ids = wanted.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id")).distinct()
        if wanted.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        texts = (self.docs.join(ids, F.coalesce(F.col("doc_id").cast("string"), F.lit("")) == F.col("_id"), "left_semi"))
        out = pa.schema([("set_key", pa.binary()), ("codes", pa.binary())])
        # an id that several rows share may bring sets that no pair asks for, or one twice: neither changes the links
        sets = settle(texts.mapInArrow(_per_document(lambda: lambda _, c: (_digest(c), c.tobytes()) if len(c) else None, out),
                                       "set_key binary, codes binary").select(self.cls.alias("cls"), "codes"))
        a, b = (sets.select(F.col("cls").alias(s), F.col("codes").alias(f"codes_{s}")) for s in "ab")
        both = self._attach(pairs, {"a": a, "b": b}).select("a", "b", "codes_a", "codes_b")
        return settle(both.mapInArrow(_linked(self.percent), "a bigint, b bigint"))

    def run(self) -> DataFrame:
        """(cls, component) of every class that is linked with another."""
        lists = self.lists()
        links = self.verified(self.leaders(lists))
        labels = settle(components(links))
        for nearest in (True, False):
            more = self.verified(self.across(lists, labels, nearest))
            if more.limit(1).count():
                # a component is a star, so its labels stand for all links so far
                links = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
                labels = settle(components(links))
        return labels.select(F.col("node").alias("cls"), "component")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (the smallest doc_id reachable over links).

    Linked means 100 * intersection >= `percent` * union of the distinct 5-word shingles; shorter texts are one shingle. Null
    text, or text without words, has no shingles and is linked with nothing: its component is itself. Rows that repeat a
    doc_id are documents of their own; null ids never are a component's smallest unless it has no other. An empty table gives
    no rows; other columns are not read.
    """
    join = Join(docs, text, key, percent)
    rows = join.rows.withColumn("cls", F.when(F.col("n") > 0, join.cls))
    # per class first within each scan partition, then over all, and back: a class of very many copies stays split
    by_run = settle(rows.filter("n > 0").groupBy("run", "cls").agg(F.min("doc_id").alias("low")))
    whole = (by_run.groupBy("cls").agg(F.min("low").alias("low"))
             .join(join.run(), "cls", "left").withColumn("component", F.coalesce("component", "cls")))
    ids = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    told = by_run.select("run", "cls").join(whole.join(ids, "component").select("cls", "component_id"), "cls")
    return (rows.join(told, ["run", "cls"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
