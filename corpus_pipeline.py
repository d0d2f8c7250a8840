"""From documents to token ids: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again for the next. All but the last
return the columns of `documents`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.llm import bpe, jaccard_join, language_id, line_dedup, mixing
from creditmill.llm.common import WORD, table
from creditmill.llm.queries import TOKENIZER
from creditmill.session import scratch_path, settle

MIN_SCORE = 0.3  # language score below which a text is in none of the learned languages; clean text has 0.45 or more
BROADCAST_IDS = 1_000_000  # ids (8 bytes each) that are broadcast; more are joined by shuffling
# Rows and bytes that an executor hands to Python at a time. Spark's own 10,000 rows of text take tens of MB a task, outside
# the heap and again in Python, and an executor does not give all of that back between the stages.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2048", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def in_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages. Text without letters, or unlike every profile, goes."""
    profiles = language_id.fit_profiles(docs.filter(~language_id.held_out()))
    return language_id.in_known_language(docs, profiles, MIN_SCORE)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came before; n_chars follows. A document that loses all its words this way goes."""
    told = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_exact") + F.col("n_near") > 0) & ~F.col("text").rlike(WORD)
    return told.filter(~F.coalesce(emptied, F.lit(False))).select(
        *[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest id, nulls last, then the smallest row number."""
    rows = settle(docs.withColumn("_place", F.monotonically_increasing_id()))
    told = settle(jaccard_join.near_duplicates(rows, key="_place").filter("n_shingles > 0")
                  .select(F.col("doc_id").alias("_place"), "component_id"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_place")
    first = (told.join(rows.select("_place", "doc_id"), "_place").groupBy("component_id").agg(F.min(order).alias("first"))
             .select("first._place"))
    gone = settle(told.join(first, "_place", "left_anti").select(F.col("_place").alias("_gone")))
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return rows.join(gone, rows["_place"] == F.col("_gone"), "left_anti").drop("_place")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixture(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of what they decode to."""
    return bpe.encode_decode(docs, TOKENIZER, with_ids=True)


STAGES = [("language", in_language), ("lines", without_repeated_lines), ("near copies", without_near_copies),
          ("mix", mixed), ("tokens", encoded)]
ORACLE_SQL = None  # profiles, and the tokenizer, are beyond SQL: tests hold the result against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = {k: spark.conf.get(k, None) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    try:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        return docs
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
