"""Ingestion as one job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill import schema as S
from creditmill.operators import cleaning
from creditmill.sources import files


def ingest(spark: SparkSession, csv_path: str, root: str, nrows: int | None = None,
           name: str = files.CLEAN_NAME) -> DataFrame:
    """CSV to clean Parquet: filter, label, drop leaky columns, parse texts; returns the stored frame.

    The source `id` lives on as `loan_id`, the key every later operator carries.
    """
    raw = files.read_loans_csv(spark, csv_path, nrows=nrows).withColumn(S.KEY, F.col("id"))
    files.write_clean(raw.transform(cleaning.clean).transform(cleaning.drop_leaky_columns), root, name)
    return files.read_clean(spark, root, name)
