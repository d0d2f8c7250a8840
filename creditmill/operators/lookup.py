"""Level tables: fit small, attach by a join whose broadcast is size-checked."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.session import settle

BROADCAST_ROWS = 100_000
HOT_ROWS = 100_000  # rows of one key that one task joins
SALTS = 16  # parts of the rows without a key


def attach(df: DataFrame, table: DataFrame, on: str | list[str], spread: str = "loan_id",
           max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join of a table with unique `on` keys, keeping NULL keys as NULL.

    Up to `max_rows` rows the table is broadcast. Beyond that both sides shuffle, whatever size the planner expects. Only the
    keys that more than HOT_ROWS rows of `df` share are cut, by a salt from `spread`, and only their rows of the table are copied.
    """
    if table.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(table), on, "left")
    keys = [on] if isinstance(on, str) else list(on)
    parts = F.ceil(F.col("_n") / HOT_ROWS).cast("int").alias("_parts")
    hot = settle(df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_ROWS).select(*keys, parts))
    if not hot.limit(1).count():
        return df.join(table.hint("merge"), keys, "left")
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    few = F.broadcast(hot)  # one row per HOT_ROWS rows of df at most
    salt = F.pmod(F.xxhash64(spread), F.when(unknown, SALTS).otherwise(F.coalesce("_parts", F.lit(1)))).cast("int")
    copies = (table.join(few, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
              .drop("_parts"))
    salted = df.join(few, keys, "left").withColumn("_salt", salt).drop("_parts")
    return salted.join(copies.hint("merge"), [*keys, "_salt"], "left").drop("_salt")
