"""Shared pieces: white space, document keys, and joins that survive a hot key."""

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.session import shuffle_width

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def per_worker(key: tuple, make: Callable):
    """What `make` builds, kept as long as this Python worker lives: for tables of a fixed size that are slow to build. Task
    functions travel by value, so what they hold in globals of their own would be built anew in each task."""
    held = sys.modules.setdefault("creditmill_held", types.ModuleType("creditmill_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def release() -> None:
    """Give memory that a task has freed back to the system, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def small_slices(batch: pa.RecordBatch, column: int, rows: int = 256, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most so many rows, and so many bytes of the given text column unless one row has more."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, length in enumerate(lengths):
        if i > start and (held + length > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += length
    if lengths:
        yield batch.slice(start)


def rows_to_arrow(df: DataFrame, columns: str, make: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """Map every row in Arrow batches: `make()` runs once per task and returns the row function.

    The row function takes the columns of `df` in order (text as str) and returns one output tuple. What it remembers goes
    with the task; if it has a `close`, that is called then.
    """
    schema = df.sparkSession.createDataFrame([], columns).schema
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, row = to_arrow_schema(schema), make()
        try:
            for batch in batches:
                # slices keep what a task holds small when texts are long
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    out = [row(*r) for r in zip(*(c.to_pylist() for c in part.columns))]
                    if out:
                        cols = [pa.array(c, kinds.field(i).type) for i, c in enumerate(zip(*out))]
                        yield pa.RecordBatch.from_arrays(cols, names)
        finally:
            getattr(row, "close", lambda: None)()
            batch = part = out = cols = row = None  # else the last batch would be held still
            release()

    return df.mapInArrow(run, schema)


def with_least(rows: DataFrame, keys: list[str], spread: str, **values: Column) -> DataFrame:
    """`rows` with the smallest of each value over all rows of their key.

    Rows of a key are cut into parts by the hash of `spread`: the smallest is found in each part first, then over all, and
    told to the parts again, so a hot key needs no single task.
    """
    parts = shuffle_width(rows.sparkSession)
    cut = rows.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    by_part = cut.groupBy(*keys, "_part").agg(*[F.min(v).alias(f"_{n}") for n, v in values.items()])
    whole = by_part.groupBy(*keys).agg(*[F.min(f"_{n}").alias(n) for n in values])
    told = by_part.select(*keys, "_part").join(whole, keys)
    return cut.join(told, [*keys, "_part"]).drop("_part")


def meet(many: DataFrame, few: DataFrame, on: list[str], bound: int) -> DataFrame:
    """Inner join of rows that may share a hot key with a table of unique keys.

    Up to `bound` rows the table is broadcast. Beyond that each key is told first to the parts its rows are cut into, once
    each, and the rows meet it there.
    """
    if few.count() <= bound:
        return many.join(F.broadcast(few), on)
    parts = shuffle_width(many.sparkSession)
    cut = many.withColumn("_part", F.pmod(F.xxhash64(*many.columns), F.lit(parts)).cast("int"))
    told = cut.select(*on, "_part").distinct().join(few, on)
    return cut.join(told, [*on, "_part"]).drop("_part")


def shards_for(copies: str | Column, per: int) -> Column:
    """Into how many shards a key with so many rows is cut."""
    return F.greatest(F.lit(1), F.ceil((F.col(copies) if isinstance(copies, str) else copies) / F.lit(per))).cast("int")


def shard_join(many: DataFrame, few: DataFrame, on: list[str], spread: Column, shards: str,
               how: str = "inner") -> DataFrame:
    """Join rows that may share a hot key with a table of unique keys.

    Both sides carry `shards`, how many parts the key is cut into. A row goes to the part that `spread` hashes to
    and the unique side is copied to every part of its key only, so a hot key costs copies for itself alone.
    """
    left = many.withColumn("_shard", F.pmod(F.xxhash64(spread), F.col(shards)).cast("int"))
    right = few.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.col(shards) - 1))).drop(shards)
    return left.join(right, [*on, "_shard"], how).drop("_shard")
