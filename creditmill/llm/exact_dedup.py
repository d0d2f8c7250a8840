"""Exact duplicates by a tree-merge of sorted digest runs.

Every scan partition makes one run: its digests sorted, one row per digest with the smallest document and the number
of rows. The runs then move through binomial rounds. A partition's number is read as digits; in round r it exchanges
rows only with the partners that differ from it in digit r, and keeps those whose digest belongs to its own digit.
What arrives is merged at once, so a run never holds a digest twice: a text that a third of all rows share is one row
a run in every round. After the last round each partition holds its share of the digests, merged over all rows.
"""

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill.llm.common import rows_to_arrow
from creditmill.session import settle, shuffle_width

RUN = "at int, run int, digest binary, n_bytes bigint, keep_id bigint, keep_row bigint, group_size bigint"
_ARROW = pa.schema([("at", pa.int32()), ("run", pa.int32()), ("digest", pa.binary()), ("n_bytes", pa.int64()),
                    ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])


def _digests():
    """Rows (key, text) to key, digest and length of the text with each run of white space made one space."""
    spaces = re.compile(rb"[\x20\x09-\x0D]+")

    def row(doc_id, text):
        plain = spaces.sub(b" ", (text or "").encode())
        return doc_id, hashlib.sha256(plain).digest(), len(plain)

    return row


def _order() -> list[Column]:
    return [F.col("digest"), F.col("n_bytes"), F.col("keep_id").asc_nulls_last(), F.col("keep_row")]


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge neighbours of a sorted stream whose full digest and byte length agree; the first of each is the smallest."""
    held = None
    for batch in batches:
        here = pa.Table.from_arrays(batch.columns, schema=_ARROW)
        if held is not None:
            here = pa.concat_tables([held, here]).combine_chunks()
        if not here.num_rows:
            continue
        full = np.frombuffer(b"".join(here.column("digest").to_pylist()), np.uint64).reshape(-1, 4)
        size = here.column("n_bytes").to_numpy()
        run = here.column("run").to_numpy()
        new = np.ones(here.num_rows, bool)
        new[1:] = (full[1:] != full[:-1]).any(axis=1) | (size[1:] != size[:-1]) | (run[1:] != run[:-1])
        starts = np.flatnonzero(new)
        total = np.add.reduceat(here.column("group_size").to_numpy(), starts)
        out = here.take(pa.array(starts))
        out = out.set_column(out.schema.get_field_index("group_size"), "group_size", pa.array(total, pa.int64()))
        held = out.slice(out.num_rows - 1)
        yield from out.slice(0, out.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def _digits(width: int, fan_in: int) -> int:
    n = 1
    while fan_in**n < width:
        n += 1
    return n


def merge_runs(runs: DataFrame, fan_in: int = 4) -> DataFrame:
    """All runs merged into one row per digest; `fan_in` runs meet in a partition in each round."""
    rounds = _digits(shuffle_width(runs.sparkSession), fan_in)
    width = fan_in**rounds
    home = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint"), F.lit(width))
    state = runs.withColumn("at", F.pmod("run", F.lit(width)).cast("int")).withColumn("run", F.lit(0))
    for r in range(rounds):
        unit = fan_in**r

        def digit(x: Column, unit=unit) -> Column:
            return F.pmod(F.floor(x / F.lit(unit)), F.lit(fan_in))

        to = F.col("at") + (digit(home) - digit(F.col("at"))) * F.lit(unit)
        state = (state.withColumn("at", to.cast("int")).repartitionById(width, F.col("at"))
                 .sortWithinPartitions(*_order()).mapInArrow(_merged, RUN))
    return state


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", fan_in: int = 4) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical once each run of `[\\x20\\x09-\\x0D]` is one space; null is empty text.
    Of equal texts the smallest key stays, null keys coming last; of rows that share that key, the first read. Equality
    is verified on all 256 bits of the digest and the byte length. An empty table gives no rows; other columns of
    `docs`, whatever their names, are neither read nor returned. Texts are never shuffled, only digests.
    """
    told = rows_to_arrow(docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")),
                         "doc_id bigint, digest binary, n_bytes bigint", _digests)
    rows = settle(told.select("doc_id", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("run"), "digest",
                              "n_bytes"))
    first = rows.select(F.lit(0).alias("at"), "run", "digest", "n_bytes", F.col("doc_id").alias("keep_id"),
                        F.col("row").alias("keep_row"), F.lit(1).cast("bigint").alias("group_size"))
    runs = settle(first.sortWithinPartitions("run", *_order()).mapInArrow(_merged, RUN))
    groups = merge_runs(runs, fan_in).filter("group_size > 1")
    # Down again: a digest is once in each run, and a run's rows meet it by (run, digest).
    told = (runs.select("run", "digest", "n_bytes")
            .join(groups.drop("at", "run"), ["digest", "n_bytes"]))
    return (rows.join(told, ["run", "digest", "n_bytes"], "left")
            .select("doc_id", F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
                    (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
