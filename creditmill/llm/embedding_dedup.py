"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

Vectors are normalised, so that a cosine is a distance. A table hashes a vector by several Gaussian projections, each
shifted at random and cut into steps; vectors of one group with equal steps share a bucket. Near vectors differ by a small
normal number in each projection, so the chance to share a bucket is known, and with it how many tables leave a pair at
the threshold apart in all of them with probability `miss`. How many projections a table takes follows from the size of
the largest group, so that buckets stay small as data grow.

Equal vectors are one class. Buckets first see only a class number and the signs of 128 more projections, which put aside
vectors that resemble nothing in the bucket. What is left meets as whole vectors, in blocks of a bounded
size, and the cosine of every pair is computed in double precision. Blocks hand on sums and a few edges, never pairs.
"""

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.common import meet, with_least
from creditmill.llm.components import components
from creditmill.session import settle, shuffle_width

THRESHOLD = 0.93
MISS = 1e-5
STEP = 6.0  # width of a step, in distances at the threshold
FAR = 1.37  # distance of two unrelated unit vectors (cosine about 0.06); matters for cost only
OCCUPANCY = 16  # unrelated vectors that a bucket should hold
PART = 1024  # vectors of a bucket that are worked on together; larger buckets are cut
SIGNS = 128
BROADCAST_BUCKETS = 200_000  # large buckets (16 bytes each) that are broadcast
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _normal_below(x: float) -> float:
    from math import erf, sqrt

    return (1 + erf(x / sqrt(2))) / 2


def collision(distance: float, step: float) -> float:
    """Chance that one projection puts two vectors at this distance into one step."""
    t = step / distance
    return 1 - 2 * _normal_below(-t) - 2 / (np.sqrt(2 * np.pi) * t) * (1 - np.exp(-t * t / 2))


def sign_limit(threshold: float, signs: int = SIGNS, miss: float = 1e-7) -> int:
    """In how many signs a pair at the threshold differs at most, but for a chance of `miss`."""
    from math import acos, comb, pi

    p, tail = acos(threshold) / pi, 1.0
    for k in range(signs + 1):
        tail -= comb(signs, k) * p**k * (1 - p)**(signs - k)
        if tail < miss:
            return k
    return signs


@dataclass(frozen=True)
class Tables:
    """Settings of all tables: projections a table, number of tables, width of a step."""

    projections: int
    tables: int
    step: float
    seed: int

    @classmethod
    def for_size(cls, n: int, threshold: float = THRESHOLD, miss: float = MISS, seed: int = 7) -> "Tables":
        near = float(np.sqrt(2 - 2 * threshold))
        step = STEP * near
        k = max(1, int(np.ceil(np.log(max(n, OCCUPANCY) / OCCUPANCY) / -np.log(collision(FAR, step)))))
        hit = collision(near, step)**k
        return cls(k, max(1, int(np.ceil(np.log(miss) / np.log1p(-hit)))), step, seed)

    def hashes(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit bucket number for every vector and table."""
        rng = np.random.default_rng((self.seed, unit.shape[1]))
        directions = rng.standard_normal((unit.shape[1], self.projections * self.tables))
        shift = rng.random(self.projections * self.tables)
        steps = np.floor(unit @ directions / self.step + shift).astype(np.int64).view(np.uint64)
        code = np.tile(np.arange(self.tables, dtype=np.uint64), (len(unit), 1))
        for k in range(self.projections):
            code = _mixed(code * _ODD + steps[:, k::self.projections])
        return code

    def signs(self, unit: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng((self.seed, unit.shape[1], 1))
        bits = unit @ rng.standard_normal((unit.shape[1], SIGNS)) > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def normalised(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for what can't be compared: null, empty, zero, not finite."""
    out = []
    for v in column.to_pylist():
        unit = None
        if v and None not in v:
            x = np.array(v, float)
            largest = np.abs(x).max()
            if np.isfinite(largest) and largest > 0:
                x = x / largest  # so that squares neither overflow nor vanish
                unit = x / np.sqrt((x * x).sum())
        out.append(unit)
    return out


def _surveyed(rows: DataFrame) -> DataFrame:
    """run, vec_id, grp, and a digest and the vector where it can be compared."""
    schema = "run int, vec_id bigint, grp string, digest binary, vec array<double>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                units = normalised(part.column(3))
                vec = [v if u is not None and g is not None else None
                       for u, g, v in zip(units, part.column(2).to_pylist(), part.column(3).to_pylist())]
                # adding zero makes both zeros one
                digest = [None if v is None else hashlib.sha256((np.array(v, float) + 0.0).tobytes()).digest() for v in vec]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(digest, pa.binary()), pa.array(vec, pa.list_(pa.float64()))],
                                                 ["run", "vec_id", "grp", "digest", "vec"])

    return rows.mapInArrow(run, schema)


def _hashed(classes: DataFrame, tables: Tables) -> DataFrame:
    """Per class its kind (a number for group and length), signs and buckets."""
    schema = "cls bigint, kind bigint, sign0 bigint, sign1 bigint, buckets array<bigint>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                units = normalised(part.column(2))
                for width in sorted({len(u) for u in units}):
                    rows = np.array([i for i, u in enumerate(units) if len(u) == width])
                    unit = np.stack([units[i] for i in rows])
                    kind = np.array([_number(f"{width} {g}") for g in part.column(1).take(pa.array(rows)).to_pylist()], np.uint64)
                    buckets = _mixed(tables.hashes(unit) * _ODD + kind[:, None]).view(np.int64)
                    signs = tables.signs(unit).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows)), pa.array(kind.view(np.int64)), pa.array(signs[:, 0]), pa.array(signs[:, 1]),
                         pa.array(list(buckets), pa.list_(pa.int64()))], ["cls", "kind", "sign0", "sign1", "buckets"])

    return classes.select("cls", "grp", "vec").mapInArrow(run, schema)


def _number(text: str) -> int:
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "little")


def _groups(batches: Iterable[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Sorted batches cut so that rows equal in the first `by` columns stay together."""
    held = None
    for batch in batches:
        here = pa.Table.from_batches([batch])
        held = here if held is None else pa.concat_tables([held, here])
        if not held.num_rows:
            continue
        cols = [held.column(i).to_numpy() for i in range(by)]
        same = np.ones(held.num_rows, bool)
        for c in cols:
            same &= c == c[-1]
        if not same.all():
            cut = len(same) - int(same[::-1].argmin())
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _bounds(cols: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(cols[0]) + 1, bool)
    new[1:-1] = False
    for c in cols:
        new[1:-1] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _alive(limit: int):
    """Members of a bucket that another one resembles in signs; columns bucket, cls, sign0, sign1, tab, sorted by the first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 1):
            bucket = table.column(0).to_numpy()
            x, y = (table.column(c).to_numpy().view(np.uint64) for c in ("sign0", "sign1"))
            ends, keep = _bounds([bucket]), np.zeros(len(bucket), bool)
            size = np.diff(ends)
            two = ends[:-1][size == 2]
            keep[two] = np.bitwise_count(x[two] ^ x[two + 1]).astype(int) + np.bitwise_count(y[two] ^ y[two + 1]) <= limit
            keep[two + 1] = keep[two]
            for s, e in zip(ends[:-1][size > 2], ends[1:][size > 2]):
                for at in range(s, e, 256):
                    a = np.arange(at, min(at + 256, e))
                    apart = np.bitwise_count(x[a, None] ^ x[None, s:e]) + np.bitwise_count(y[a, None] ^ y[None, s:e])
                    near = apart <= limit
                    near[np.arange(len(a)), a - s] = False
                    keep[a] = near.any(axis=1)
            if keep.any():
                yield from table.filter(pa.array(keep)).select(["bucket", "cls", "tab"]).to_batches()

    return run


def _local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component, by spreading minima along the links."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _compared(threshold: float):
    """Sums and edges of a block; columns bucket, kind, low, high, part, cls, n, tab, vec, buckets, sorted by the first four.

    A pair counts in the first table alone whose bucket both share. Where low <> high a block joins two parts of a bucket
    and only pairs across count.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 4):
            ends = _bounds([table.column(i).to_numpy() for i in range(4)])
            for s, e in zip(ends[:-1], ends[1:]):
                if e - s > 1:
                    yield from block(table.slice(s, e - s).combine_chunks())

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        m, tab = rows.num_rows, int(rows.column("tab")[0].as_py())
        cls, times, part = (rows.column(c).to_numpy() for c in ("cls", "n", "part"))
        across = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
        met = rows.column("buckets").combine_chunks().flatten().to_numpy().reshape(m, -1)[:, :tab]
        if tab and (met == met[0]).all(axis=0).any():
            return  # all of them met in an earlier table
        unit = np.stack(normalised(rows.column("vec").combine_chunks()))
        more, left, right = np.zeros(m, np.int64), [], []
        for at in range(0, m, 256):
            near = unit[at:at + 256] @ unit.T >= threshold
            i, j = np.nonzero(near)
            i += at
            fine = (i < j) & (part[i] != part[j]) if across else i < j
            i, j = i[fine], j[fine]
            left.append(i)
            right.append(j)
            for k in range(0, len(i), 1 << 16):
                a, b = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                first = ~(met[a] == met[b]).any(axis=1)
                np.add.at(more, a[first], times[b[first]])
                np.add.at(more, b[first], times[a[first]])
        i, j = np.concatenate(left), np.concatenate(right)
        if len(i):
            label = _local_components(m, i, j)
            told = np.flatnonzero((label != np.arange(m)) | (more > 0))
            yield pa.RecordBatch.from_arrays([pa.array(cls[told]), pa.array(more[told]), pa.array(cls[label[told]])], ["cls", "more", "other"])

    return run


def _pairs(classes: DataFrame, hashed: DataFrame, limit: int, threshold: float) -> DataFrame:
    """(cls, more, other): links of each class found in one block, and a class of its component there."""
    spark = classes.sparkSession
    width = shuffle_width(spark)
    entries = hashed.select("cls", "sign0", "sign1", F.posexplode("buckets").alias("tab", "bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("size"))
    large = settle(sizes.filter(F.col("size") > PART).withColumn("parts", F.ceil(F.col("size") / PART).cast("int")).drop("size"))
    n_large = large.count()
    small = entries
    if n_large:
        small = entries.join(F.broadcast(large) if n_large <= BROADCAST_BUCKETS else large, "bucket", "left_anti")
    alive = (small.select("bucket", "cls", "sign0", "sign1", "tab").repartition(width, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_alive(limit), "bucket bigint, cls bigint, tab int").withColumn("parts", F.lit(1)))
    if n_large:  # no member of a large bucket is put aside
        alive = alive.unionByName(meet(entries.select("bucket", "cls", "tab"), large, ["bucket"], BROADCAST_BUCKETS))
    alive = settle(alive)
    # a class once, with all its buckets, meets its own entries
    whole = classes.select("cls", "n", "vec").join(hashed.select("cls", "kind", "buckets"), "cls")
    rows = alive.join(whole, "cls").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    paired = rows.withColumn("_o", other).select(
        "bucket", "kind", F.least("part", "_o").alias("low"), F.greatest("part", "_o").alias("high"), "part", "cls", "n", "tab", "vec",
        "buckets")
    return (paired.repartition(width, "bucket", "kind", "low", "high").sortWithinPartitions("bucket", "kind", "low", "high")
            .mapInArrow(_compared(threshold), "cls bigint, more bigint, other bigint"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, vector: str = "embedding",
                    key: str = "vec_id", group: str = "label", seed: int = 7) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors of one group and one length are linked when their cosine is at least `threshold`; no pair below is ever linked,
    and a pair at the threshold is overlooked with probability `miss`, nearer ones far less often. Vectors that are null,
    empty, zero or hold null or non-finite entries, and those whose group is null, are linked with nothing. Equal vectors
    are linked with each other and counted each. The component is the smallest key reachable over links; null keys come
    last. `kept` says whether the row's key is its component's. Rows that repeat a key are vectors of their own. An empty
    table gives no rows; other columns are not read.
    """
    source = vectors.select(F.spark_partition_id().alias("run"), F.col(key).cast("bigint").alias("vec_id"),
                            F.col(group).cast("string").alias("grp"), F.col(vector).cast("array<double>").alias("vec"))
    survey = settle(_surveyed(source))
    rows = survey.drop("vec")
    valid = survey.filter("digest is not null")
    # copies are counted within each scan partition first, then over all: no class needs its rows in one place
    by_run = settle(valid.groupBy("run", "grp", "digest").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"),
                                                              F.first("vec").alias("vec")))
    classes = settle(by_run.groupBy("grp", "digest").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.first("vec").alias("vec"))
                     .withColumn("cls", F.monotonically_increasing_id()))
    most = classes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    hashed = settle(_hashed(classes, Tables.for_size(most, threshold, miss, seed)))
    found = settle(_pairs(classes, hashed, sign_limit(threshold), threshold))
    labels = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")).distinct()).withColumnRenamed("node", "cls")
    links = found.groupBy("cls").agg(F.sum("more").alias("more"))
    told = (classes.drop("vec").join(links, "cls", "left").join(labels, "cls", "left")
            .withColumn("component", F.coalesce("component", "cls")))
    told = (with_least(told, ["component"], "cls", component_id=F.col("low"))
            .select("grp", "digest", "component_id", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")))
    by_run = by_run.select("run", "grp", "digest").join(told, ["grp", "digest"])
    full = rows.join(by_run, ["run", "grp", "digest"], "left")
    component = F.when(F.col("digest").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return full.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                       F.col("vec_id").eqNullSafe(component).alias("kept"))
