"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Targets rise with the weights until a source reaches its cap (a number of epochs); what it can't take is shared anew
among the others until no target is above its cap. A source then gives each document its whole epochs, and a further
copy to those with the smallest seeded hashes, up to the word count that the fraction of an epoch asks for.
"""

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill.functions.columns import ordered_hash
from creditmill.llm.common import WORD
from creditmill.session import settle, shuffle_width

STEP = 12  # bits of the seeded hash that one round of the search fixes
BITS = 60
BROADCAST_ROWS = 100_000  # sources up to which their table is broadcast; beyond, the join is salted


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def _of_source(df: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """Attach one row per source; null is a source of its own."""
    same = F.col("_source").eqNullSafe(F.col("_s"))
    right = sources.withColumnRenamed("_source", "_s")
    if n_sources <= BROADCAST_ROWS:
        return df.join(F.broadcast(right), same).drop("_s")
    salts = shuffle_width(df.sparkSession)
    left = df.withColumn("_salt", F.pmod(F.col("_hash"), F.lit(salts)))
    right = right.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, same & (F.col("_salt") == F.col("_r"))).drop("_s", "_salt", "_r")


def _weighted(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sources in code point order, null last, with repeating weights. The order is a range sort, not one task."""
    spark = sizes.sparkSession
    placed = settle(sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"))
                    .repartitionByRange(shuffle_width(spark), F.col("_source").asc_nulls_last())
                    .sortWithinPartitions(F.col("_source").asc_nulls_last())
                    .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    # one row per partition
    before = (placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).drop("_n"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    return settle(placed.withColumn("_part", part).join(F.broadcast(before), "_part")
                  .select("_source", "source_size", pick.alias("_weight")))


def water_level(sources: DataFrame, budget: float, epochs: float) -> float | None:
    """The level at which targets min(cap, weight * level) use up the budget; the driver sees a few sums a round."""
    cap = F.col("source_size") * F.lit(float(epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, -1
    while True:
        over = F.lit(False) if level is None else cap <= F.col("_weight") * F.lit(level)
        got = sources.agg(F.sum(F.when(over, F.col("source_size")).otherwise(F.lit(0))).alias("capped"),
                          F.sum(F.when(over, 0.0).otherwise(F.col("_weight"))).alias("open"),
                          F.sum(over.cast("int")).alias("n")).first()
        if not got["open"] or got["n"] == full:
            return level
        full = got["n"]
        level = (budget * total - epochs * got["capped"]) / got["open"]


def _cuts(sizes: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """For each source the largest hash that still gets a further copy, by radix search over sums of sizes.

    A cell is a hash prefix; each round looks into the cell where the sum crosses what is wanted. Cells are at most
    2^STEP a source and sums are made before the shuffle, so a hot source is no larger than another. The last round
    orders the few hashes of one cell.
    """
    want = sources.select("_source", (F.col("target") - F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
                                      * F.col("source_size")).alias("_want"),
                          F.lit(0).cast("bigint").alias("_floor"))
    upto = W.partitionBy("_source").orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
    for shift in range(BITS - STEP, BITS - 4 * STEP, -STEP):
        span = F.lit(1 << (shift + STEP))
        inside = (_of_source(sizes, want, n_sources)
                  .filter((F.col("_hash") >= F.col("_floor")) & (F.col("_hash") < F.col("_floor") + span)))
        cells = (inside.groupBy("_source", "_want", F.shiftright("_hash", shift).alias("_cell"))
                 .agg(F.sum("_size").alias("_n")).withColumn("_upto", F.sum("_n").over(upto)))
        edge = (cells.filter(F.col("_upto") >= F.col("_want")).groupBy("_source")
                .agg(F.min(F.struct("_cell", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_want"))).alias("e")))
        want = settle(edge.select("_source", F.col("e._want").alias("_want"),
                                  F.shiftleft(F.col("e._cell"), shift).alias("_floor")))
    last = (_of_source(sizes, want, n_sources)
            .filter((F.col("_hash") >= F.col("_floor")) & (F.col("_hash") < F.col("_floor") + span))
            .groupBy("_source", "_want", "_floor", F.col("_hash").alias("_cell")).agg(F.sum("_size").alias("_n"))
            .withColumn("_upto", F.sum("_n").over(upto)))
    taken = F.col("_upto") - F.col("_n") / 2 < F.col("_want")
    return settle(last.groupBy("_source", "_floor").agg(F.max(F.when(taken, F.col("_cell"))).alias("_top"))
                  .select("_source", F.coalesce("_top", F.col("_floor") - 1).alias("_cut")))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, epochs: float = 2.0,
        text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 7) -> DataFrame:
    """`docs` with added columns size, source_size, target and copies (0 up to the number of epochs, rounded up).

    `size` counts the words `[^\\x20\\x09-\\x0D]+` of the whole text, null text has none. The sources in code point
    order, null last, weigh `weights`, repeated, and share `budget` times all words; a target stops at `epochs` times
    its source. Copies depend on the seed and the key alone, so reruns agree and rows that repeat a key get the same;
    null keys count as one. Sources of size 0 have target 0 and give nothing. Columns of `docs` that are
    named like an added column are replaced. An empty table gives an empty result. The words that a source gives
    differ from its target by at most half the size of one key's rows.
    """
    seeded = F.when(F.col(key).isNull(), F.lit("")).otherwise(F.col(key).cast("string"))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    # the columns of `docs` travel in a struct, so that none can clash with a name used here
    marked = docs.select(F.struct(*own).alias("_doc"), ordered_hash(seeded, seed).alias("_hash"), F.col(source).alias("_source"),
                         word_count(text).alias("_size"))
    sizes = settle(marked.select("_hash", "_source", "_size"))
    sources = _weighted(sizes, weights)
    level = water_level(sources, budget, epochs)
    cap = F.col("source_size") * F.lit(float(epochs))
    target = F.lit(0.0) if level is None else F.least(cap, F.col("_weight") * F.lit(level))
    sources = sources.withColumn("target", target.cast("double")).drop("_weight")
    n_sources = sources.count()
    plan = _of_source(sources.withColumn("_hash", F.lit(0).cast("bigint")), _cuts(sizes, sources, n_sources), n_sources)
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    more = (F.col("_hash") <= F.col("_cut")).cast("bigint")
    return (_of_source(marked, settle(plan.drop("_hash")), n_sources)
            .select("_doc.*", F.col("_size").alias("size"), "source_size", "target",
                    F.least(whole + more, F.lit(ceil(epochs))).cast("bigint").alias("copies")))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows themselves: every row of `docs` as often as the mix takes it, with the columns of `docs`."""
    names = {n: options.get(n, d) for n, d in (("text", "text"), ("source", "source"), ("key", "doc_id"))}
    packed = docs.select(F.struct("*").alias("_doc"), *[F.col(c).alias(n) for n, c in names.items()])
    mixed = mix(packed, **(options | {"text": "text", "source": "source", "key": "key"})).filter("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("_doc.*")
