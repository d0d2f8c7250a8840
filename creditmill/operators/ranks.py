"""Exact ranks, prefix sums and quantiles without a one-partition window.

Values are first grouped (hot values collapse into one row before the shuffle), then cut into
about as many ranges as there are shuffle partitions. Range totals are prefix-summed on a frame
of (keys x ranges) rows and joined back, and the running window stays inside one range.
"""

import random
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate
from math import ceil, floor, gcd, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill.functions.columns import any_of, ordered_hash
from creditmill.session import settle, shuffle_width

SPLIT_SAMPLE = 16
DIRECT_WIDTH = 32


def _range_of(grouped: DataFrame, value: str, width: int) -> DataFrame:
    """Replace `_splits` by `_range`, the number of splits <= value; 0 where there are no splits."""
    def at_most(part):
        return F.size(F.filter(part, lambda s: s <= F.col(value)))
    if width <= DIRECT_WIDTH:
        found = grouped.withColumn("_range", F.greatest(at_most(F.col("_splits")), F.lit(0)))
        return found.drop("_splits")
    step = ceil(sqrt(width))  # two steps of about sqrt(width) comparisons each
    marks = F.sequence(F.lit(step), F.greatest(F.size("_splits"), F.lit(step)), F.lit(step))
    coarse = F.size(F.filter(marks, lambda i: F.try_element_at(F.col("_splits"), i) <= F.col(value)))
    found = grouped.withColumn("_start", F.greatest(coarse, F.lit(0)) * step)
    fine = at_most(F.slice("_splits", F.col("_start") + 1, F.lit(step)))
    return (found.withColumn("_range", F.col("_start") + F.greatest(fine, F.lit(0))).drop("_splits", "_start"))


def with_ranges(grouped: DataFrame, value: str, keys: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """Add `_range`: an integer that never falls as the value rises, per key.

    The splits come from a sketch of every sixteenth distinct value. They only balance the work:
    any splits give the same sums, and a key too small to be sampled stays in one range.
    """
    width = width or shuffle_width(grouped.sparkSession)
    probs = [i / width for i in range(1, width)]
    sample = grouped.filter(F.pmod(F.xxhash64(value), F.lit(SPLIT_SAMPLE)) == 0)
    splits = F.percentile_approx(value, probs, 20 * width).alias("_splits")
    if keys:
        # one row per key, and keys are column or model names, so the broadcast side stays small
        marked = grouped.join(F.broadcast(sample.groupBy(*keys).agg(splits)), list(keys), "left")
    else:
        marked = grouped.withColumn("_splits", sample.agg(splits).scalar())
    return _range_of(marked, value, width)


def cumulate(grouped: DataFrame, value: str, sums: Sequence[str], keys: Sequence[str] = (),
             descending: bool = False, with_next: bool = False, width: int | None = None) -> DataFrame:
    """Add `upto_<s>` (inclusive running sum) and `total_<s>` for a frame of distinct (keys, value).

    `with_next` adds `next_value`, the following value in the same order (NULL at the end).
    """
    keys = list(keys)
    # splits, totals and rows all read it: one row per distinct value is stored, whatever lies before it runs once
    marked = with_ranges(settle(grouped), value, keys, width)
    in_order = F.col("_range").desc() if descending else F.col("_range").asc()
    edge = F.max(value) if descending else F.min(value)
    totals = marked.groupBy(*keys, "_range").agg(*[F.sum(s).alias(s) for s in sums], edge.alias("_edge"))
    across = W.partitionBy(*keys).orderBy(in_order)
    whole = W.partitionBy(*keys)
    offsets = totals.select(
        *keys, "_range",
        *[F.coalesce(F.sum(s).over(across.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(f"_off_{s}")
          for s in sums],
        *[F.sum(s).over(whole).alias(f"total_{s}") for s in sums],
        F.lead("_edge").over(across).alias("_next_edge"))
    by_value = F.col(value).desc() if descending else F.col(value).asc()
    inside = W.partitionBy(*keys, "_range").orderBy(by_value)
    out = marked.join(F.broadcast(offsets), [*keys, "_range"], "left")  # (keys x ranges) rows
    new = {f"upto_{s}": F.sum(s).over(inside.rowsBetween(W.unboundedPreceding, 0)) + F.col(f"_off_{s}")
           for s in sums}
    if with_next:
        new["next_value"] = F.coalesce(F.lead(value).over(inside), F.col("_next_edge"))
    return out.withColumns(new).drop("_range", "_next_edge", *[f"_off_{s}" for s in sums])


def long_values(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, column, value) with NULLs dropped; values as doubles."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), "column", "value").filter(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return long_values(df, columns, by).groupBy(*by, "column", "value").agg(F.count("*").alias("n"))


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], keys: Sequence[str],
                        blurred: str | None = None) -> DataFrame:
    """One row per key: q0, q1, … with linear interpolation, plus n.

    `blurred` names a flag of rows that stand for several values; `blurred` in the result says
    whether such a row was hit.
    """
    ranked = cumulate(counts, "value", ["n"], keys)
    aggs = [F.max("total_n").alias("n")]
    hits = F.lit(False)
    for i, p in enumerate(probs):
        at = (F.col("total_n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("upto_n") - F.col("n") <= rank) & (rank < F.col("upto_n"))
            aggs.append(F.max(F.when(holds, F.col("value"))).alias(f"_{side}{i}"))
            hits = hits | holds
    if blurred:
        aggs.append(F.max(hits & F.col(blurred)).alias(blurred))
    picked = ranked.groupBy(*keys).agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        at = (F.col("n") - 1) * F.lit(float(p))
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (at - F.floor(at))).alias(f"q{i}"))
    return picked.select(*keys, "n", *out, *([blurred] if blurred else []))


SKETCH = 2000
LOCAL_COUNTS = 200_000


def _quantiles_of_rows(rows, probs: Sequence[float]) -> dict:
    """(group, column) -> (quantiles, blurred) from collected (_g, column, value, n, blurred) rows."""
    parts: dict = {}
    for r in sorted(rows, key=lambda r: (r["value"] != r["value"], r["value"])):  # NaN is the largest
        parts.setdefault((r["_g"], r["column"]), []).append(r)
    out = {}
    for key, held in parts.items():
        upto = list(accumulate(r["n"] for r in held))
        quants, blurred = [], False
        for p in probs:
            at = (upto[-1] - 1) * p
            low, high = (held[bisect_right(upto, rank)] for rank in (floor(at), ceil(at)))
            blurred = blurred or low["blurred"] or high["blurred"]
            quants.append(low["value"] + (high["value"] - low["value"]) * (at - floor(at)))
        out[key] = (quants, blurred)
    return out


def _sketch(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None, accuracy: int) -> dict:
    """(group, column) -> approximate quantiles, in one pass; all-NULL columns are absent."""
    wide = df.groupBy(*([by] if by else [])).agg(*[
        F.percentile_approx(F.col(c).cast("double"), [float(p) for p in probs], accuracy).alias(f"_{i}")
        for i, c in enumerate(columns)])
    return {(r[by] if by else None, c): r[f"_{i}"] for r in wide.collect()
            for i, c in enumerate(columns) if r[f"_{i}"] is not None}


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int | None = None,
                 by: str | None = None) -> dict:
    """Quantiles per column, or per (group, column) if `by` names a class column; all-NULL columns are absent.

    Exact by default: a sketch brackets every quantile, a second pass counts the values outside the
    brackets in bulk and groups only those inside, a thousandth or so of the rows, and the ranks are
    read from these counts: here if at most LOCAL_COUNTS are left, else on the cluster. Should a rank fall outside its bracket, that column is counted in full.
    `accuracy` returns the sketch itself.
    """
    columns = list(columns)
    if not columns:
        return {}
    if accuracy is not None:
        found = _sketch(df, columns, probs, by, accuracy)
        return found if by else {c: q for (_, c), q in found.items()}
    reach = 2.0 / SKETCH
    edges = [(max(0.0, p - reach), min(1.0, p + reach)) for p in probs]
    rough = _sketch(df, columns, [x for pair in edges for x in pair], by, SKETCH)
    if not rough:
        return {}
    spans: dict = {}
    for (group, c), q in rough.items():
        bounds: list[float] = []
        for i, (low, high) in sorted(enumerate(edges), key=lambda e: e[1]):
            start = float("-inf") if low == 0.0 else q[2 * i]
            end = float("inf") if high == 1.0 else q[2 * i + 1]
            if bounds and start <= bounds[-1]:
                bounds[-1] = max(bounds[-1], end)
            else:
                bounds += [start, end]
        spans[group, c] = np.array(bounds)
    group_type = df.schema[by].dataType.simpleString() if by else "int"
    group = F.col(by) if by else F.lit(0)
    wide = df.select(group.alias("_g"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])

    def to_parts(batches):
        """Counts of a batch by part: even parts lie between the brackets, odd ones are brackets and are told by value."""
        for batch in batches:
            names = batch.column("_g").dictionary_encode()
            codes = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            out: list[list] = [[], [], [], [], [], []]
            for g, name in enumerate(names.dictionary.to_pylist()):
                rows = batch.filter(pa.array(codes == g))
                for i, c in enumerate(columns):
                    bounds = spans.get((name if by else None, c))
                    v = rows.column(f"_{i}").drop_null().to_numpy(zero_copy_only=False)
                    if bounds is None or not len(v):
                        continue
                    at = np.searchsorted(bounds[::2], v, "right") + np.searchsorted(bounds[1::2], v, "left")
                    inside = at % 2 == 1
                    values, counts = np.unique(v[inside], return_counts=True)
                    places = np.searchsorted(bounds[::2], values, "right") + np.searchsorted(bounds[1::2], values, "left")
                    for p in np.unique(at[~inside]):
                        held = v[at == p]
                        out[2].append(int(p)), out[3].append(None), out[4].append(float(held.max())), out[5].append(len(held))
                    out[2] += places.tolist()
                    out[3] += values.tolist()
                    out[4] += values.tolist()
                    out[5] += counts.tolist()
                    out[0] += [g] * (len(out[2]) - len(out[0]))
                    out[1] += [c] * (len(out[2]) - len(out[1]))
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(out[0], pa.int32())), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.float64()), pa.array(out[4], pa.float64()), pa.array(out[5], pa.int64())],
                ["_g", "column", "_at", "_v", "value", "n"])

    keys = ["_g", "column"]
    reduced = (wide.mapInArrow(to_parts, f"_g {group_type}, column string, _at int, _v double, value double, n bigint")
               .groupBy(*keys, "_at", "_v").agg(F.sum("n").alias("n"), F.max("value").alias("value"))
               .select(*keys, "value", "n", F.col("_v").isNull().alias("blurred")))
    expected = df.count() * len(columns) * len(probs) * 2 * reach
    rows = reduced.limit(LOCAL_COUNTS + 1).collect() if expected <= LOCAL_COUNTS / 4 else None
    if rows is not None and len(rows) <= LOCAL_COUNTS:
        found = _quantiles_of_rows(rows, probs)
    else:
        rows = quantiles_of_counts(reduced, probs, keys, "blurred").collect()  # one row per group and column
        found = {(r["_g"], r["column"]): ([r[f"q{i}"] for i in range(len(probs))], r["blurred"]) for r in rows}
    out = {key: q for key, (q, blurred) in found.items() if not blurred}
    missed = sorted({c for (_, c), (_, blurred) in found.items() if blurred})
    if missed:
        full = quantiles_of_counts(value_counts(df.withColumn("_g", group), missed, ["_g"]), probs, keys).collect()
        out.update({(r["_g"], r["column"]): [r[f"q{i}"] for i in range(len(probs))] for r in full})
    return out if by else {c: q for (_, c), q in out.items()}


def with_average_ranks(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add `rank` to stored (…, keys, value) rows: the mean 1-based position of the value within its key.

    A value that is one of its key's splits has its rank from counts alone. Every value with somewhat more than 1/width of
    the rows is a split, so hot values stay where they are. All others lie between two splits and are ranked there, which is
    the one shuffle of rows. Equal values are never parted by a split.
    """
    keys = list(keys)
    width = shuffle_width(long.sparkSession)
    probs = [i / width for i in range(1, width)]
    splits = settle(long.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("value", probs, 20 * width)).alias("_splits")))
    marked = long.join(F.broadcast(splits.withColumn("_edges", F.col("_splits"))), keys)  # one row per key
    below = F.col("_range")  # splits up to the value
    at_split = (below > 0) & F.coalesce(F.try_element_at("_edges", F.greatest(below, F.lit(1))) == F.col("value"), F.lit(False))
    marked = _range_of(marked, "value", width).withColumn("_slot", 2 * below - at_split.cast("int")).drop("_range", "_edges")
    before = F.sum("_n").over(W.partitionBy(*keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1))
    offsets = settle(marked.groupBy(*keys, "_slot").agg(F.count("*").alias("_n"))
                     .withColumn("_before", F.coalesce(before, F.lit(0))))
    placed = marked.join(F.broadcast(offsets), [*keys, "_slot"])  # at most two rows per key and split
    split = F.col("_slot") % 2 == 1
    inside = W.partitionBy(*keys, "_slot").orderBy("value")
    upto = (F.rank().over(inside) + F.count("*").over(inside)) / 2  # the first and the last place of its ties
    alike = placed.filter(split).withColumn("rank", F.col("_before") + (F.col("_n") + 1) / 2)
    between = placed.filter(~split).withColumn("rank", F.col("_before") + upto)
    return alike.unionByName(between).drop("_slot", "_n", "_before")


HASH_RANGES = 4096


def seeded_positions(df: DataFrame, key: str, seed, by: Sequence[str] = (), name: str = "position",
                     ranges: int = HASH_RANGES) -> DataFrame:
    """0-based position of each row in seeded hash order, per `by` group.

    Hash prefixes are uniform, so even a group with a third of all rows spreads over `ranges` windows.
    """
    by = list(by)
    bits = 60 - (ranges - 1).bit_length()
    marked = (df.withColumn("_hash", ordered_hash(key, seed))
              .withColumn("_range", F.shiftright("_hash", bits)))
    totals = marked.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = W.partitionBy(*by, "_range").orderBy("_hash", key)
    return (marked.join(F.broadcast(offsets), [*by, "_range"])  # at most classes x ranges rows
            .withColumn(name, F.row_number().over(inside) - 1 + F.col("_off"))
            .drop("_hash", "_range", "_off"))


def numbered(df: DataFrame, name: str = "position") -> tuple[DataFrame, int]:
    """(rows with positions 0 to n - 1, n): rows keep the order they are stored in, and none is shuffled.

    Stored once with their place in their partition; what precedes a partition comes from one count per partition.
    """
    rows = settle(df.withColumn("_at", F.monotonically_increasing_id()))
    sizes = {r["_part"]: r["_n"] for r in rows.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n")).collect()}
    starts = dict(zip(sorted(sizes), accumulate([0] + [sizes[p] for p in sorted(sizes)])))  # one row per partition
    before = df.sparkSession.createDataFrame(list(starts.items()) or [(0, 0)], "_part bigint, _before bigint")
    told = rows.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(before), "_part")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")
    return told.withColumn(name, place).drop("_at", "_part", "_before"), sum(sizes.values())


def bijection(position: Column, n: int, seed) -> Column:
    """A seeded permutation of the positions 0 to n - 1, as a function of the position alone."""
    draw = random.Random(str(seed))
    most = max(1, min(n - 1, (1 << 62) // max(n, 1) - 1))  # products stay within a long
    factor = next(a for a in iter(lambda: draw.randint(1, most), 0) if gcd(a, n) == 1 or most == 1)
    return F.pmod(position * F.lit(factor) + F.lit(draw.randrange(max(n, 1))), F.lit(max(n, 1)))


def hash_cuts(df: DataFrame, key: str, seed, by: str, sizes: dict, place: Column | None = None) -> dict:
    """(group, size) -> the bound below which exactly `size` rows of the group have their seeded hash.

    `sizes` has several per group, and all are found at once: radix selection over hash prefixes needs counts alone, so rows
    are never shuffled or sorted. Each pass counts 4096 cells around every cut that is still open. A group with fewer rows
    than wanted gets a bound above all hashes. `place` is the hash where a frame holds it already.
    """
    hashed = df.select(F.col(by).alias("_g"), (ordered_hash(key, seed) if place is None else place).alias("_hash"))
    cuts = {(g, n): 0 for g, wanted in sizes.items() for n in wanted}
    still = {(g, n): (0, n) for g, n in cuts if n > 0}  # prefix floor, rows wanted above it
    for shift in (48, 36, 24, 12, 0):
        if not still:
            break
        span = shift + 12
        alive = any_of([(F.col("_g") == F.lit(g)) & (F.shiftright("_hash", span) == (floor >> span))
                        for g, floor in {(g, floor) for (g, _), (floor, _) in still.items()}])
        cells = (hashed.filter(alive).groupBy("_g", F.shiftright("_hash", span).alias("_prefix"), F.shiftright("_hash", shift).alias("_cell"))
                 .agg(F.count("*").alias("_n")))
        upto = W.partitionBy("_g", "_prefix").orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)  # at most 4096 cells
        edge = any_of([(F.col("_g") == F.lit(g)) & (F.col("_prefix") == (floor >> span)) & (F.col("_upto") >= need)
                       & (F.col("_upto") - F.col("_n") < need) for (g, _), (floor, need) in still.items()])
        rows = cells.withColumn("_upto", F.sum("_n").over(upto)).filter(edge).collect()  # at most one per cut
        for (g, n), (floor, need) in list(still.items()):
            row = next((r for r in rows if r["_g"] == g and r["_prefix"] == floor >> span and r["_upto"] - r["_n"] < need <= r["_upto"]), None)
            if row is None or row["_upto"] == need or shift == 0:
                cuts[g, n] = 1 << 60 if row is None else (row["_cell"] + 1) << shift
                del still[g, n]
            else:
                still[g, n] = (row["_cell"] << shift, need - (row["_upto"] - row["_n"]))
    return cuts


def hash_cut(df: DataFrame, key: str, seed, by: str, sizes: dict, place: Column | None = None) -> Column:
    """Condition that holds for exactly `sizes[g]` rows of each group g: the smallest seeded hashes."""
    cuts = hash_cuts(df, key, seed, by, {g: [n] for g, n in sizes.items() if n > 0}, place)
    place = ordered_hash(key, seed) if place is None else place
    return any_of([(F.col(by) == F.lit(g)) & (place < F.lit(limit)) for (g, _), limit in cuts.items()])
