"""Files and tables: raw loans in, clean loans, feature sets, predictions and run logs out."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as S

CLEAN_NAME = "loans_cleaned"
FEATURES_NAME = "engineered_features"
JDBC_BATCH = 10_000
RUNS = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("sampling_method", T.StringType()),
    T.StructField("n_features", T.IntegerType()), T.StructField("train_size", T.LongType()),
    T.StructField("test_size", T.LongType()), T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
])


def _at(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_loans_csv(spark: SparkSession, path: str, schema: T.StructType = S.RAW_FILE,
                   nrows: int | None = None) -> DataFrame:
    """Loans with a header line and a declared schema; `nrows` keeps that many rows from the head."""
    df = spark.read.csv(path, schema=schema, header=True)
    return df if nrows is None else df.limit(nrows)


def write_clean(df: DataFrame, root: str, name: str = CLEAN_NAME) -> str:
    path = _at(root, name)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def read_clean(spark: SparkSession, root: str, name: str = CLEAN_NAME) -> DataFrame:
    return spark.read.parquet(_at(root, name))


def save_features(df: DataFrame, root: str, name: str = FEATURES_NAME,
                  partition_by: Sequence[str] = ()) -> str:
    path = _at(root, name)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def load_features(spark: SparkSession, root: str, name: str = FEATURES_NAME) -> DataFrame:
    return spark.read.parquet(_at(root, name))


def feature_set_metadata(spark: SparkSession, root: str, names: Sequence[str] = (FEATURES_NAME,)) -> DataFrame:
    """(name, num_rows, num_columns, file_size_mb, columns) per stored set.

    Only file metadata columns are read, so no data column is decoded.
    """
    rows = []
    for name in names:
        df = load_features(spark, root, name)
        files = (df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
                 .groupBy("f", "s").agg(F.count("*").alias("n")))
        rows.append(files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
                              (F.coalesce(F.sum("s"), F.lit(0)) / (1024 * 1024)).alias("file_size_mb"))
                    .select(F.lit(name).alias("name"), "num_rows", F.lit(len(df.columns)).alias("num_columns"),
                            "file_size_mb", F.array(*[F.lit(c) for c in df.columns]).alias("columns")))
    return reduce(DataFrame.unionByName, rows)


def warehouse_projection(df: DataFrame) -> DataFrame:
    """The warehouse columns that exist, in the order of the frame."""
    return df.select(*[c for c in df.columns if c in S.WAREHOUSE])


def load_warehouse(df: DataFrame, table: str = "raw_loans", mode: str = "replace",
                   dependents: Sequence[str] = ("predictions", "feature_store"), path: str | None = None) -> None:
    """Write the projection to a catalog table, kept under `path` if given. Replacing it drops the tables that refer to it."""
    spark = df.sparkSession
    if mode == "replace":
        for name in dependents:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = warehouse_projection(df).write.mode("overwrite" if mode == "replace" else "append")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def load_jdbc(df: DataFrame, url: str, table: str = "raw_loans", mode: str = "replace", **options) -> None:
    """The same projection to a database, in batches of 10,000 rows per insert."""
    (warehouse_projection(df).write.mode("overwrite" if mode == "replace" else "append")
     .jdbc(url, table, properties={"batchsize": str(JDBC_BATCH), **options}))


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """Any SQL text; `{name}` stands for a frame and `:name` for an argument."""
    return spark.sql(text, args=dict(args) if args else None, **frames)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Cast and order columns to a contract; absent ones are NULL, an absent timestamp is now."""
    out = []
    for field in contract:
        if field.name in df.columns:
            value = F.col(field.name)
        elif isinstance(field.dataType, T.TimestampType):
            value = F.current_timestamp()
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def create_tables(spark: SparkSession, root: str | None = None, prefix: str = "") -> dict[str, str]:
    """Create the contract tables that do not exist yet; returns contract -> table name."""
    names = {}
    for contract, fields in S.CONTRACTS.items():
        names[contract] = f"{prefix}{contract}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        place = f" LOCATION '{_at(root, contract)}'" if root else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names[contract]} ({columns}) USING parquet{place}")
    return names


def predictions(scored: DataFrame, version: str = S.MODEL_VERSION, pd_col: str = "predicted_pd") -> DataFrame:
    """Scored loans as prediction rows, stamped now."""
    rows = scored.select(
        S.KEY, F.lit(version).alias("model_version"), F.col(pd_col).alias("probability_of_default"),
        "risk_tier", "expected_loss", F.col("credit_score").alias("risk_score"))
    return conform(rows, S.PREDICTIONS)


def append_predictions(scored: DataFrame, path: str, version: str = S.MODEL_VERSION,
                       pd_col: str = "predicted_pd", run: str | None = None) -> None:
    """Append to the predictions table, one folder per tier so that a tier filter prunes files.

    With `run`, the rows lie in a folder of that key, which writing the same run again replaces: a retried job leaves no
    row twice. A table takes either rows with a key or rows without.
    """
    rows = predictions(scored, version, pd_col)
    if run is None:
        rows.write.mode("append").partitionBy("risk_tier").parquet(path)
    else:
        _replace_run(rows, path, run, ["risk_tier"])


def _replace_run(rows: DataFrame, path: str, run: str, more: Sequence[str] = ()) -> None:
    """Write the folder of one run anew: its earlier tiers go as well, other runs' folders are not touched."""
    rows.write.mode("overwrite").partitionBy(*more).parquet(f"{path.rstrip('/')}/run={run}")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PREDICTIONS).parquet(path).select(*S.PREDICTIONS.names)


def log_run(spark: SparkSession, path: str, runs: Sequence[Mapping], run: str | None = None) -> None:
    """Append training runs (parameters and metrics) to the runs table; with `run`, logging it again replaces its rows."""
    rows = [tuple(r.get(f.name) for f in RUNS) for r in runs]
    told = spark.createDataFrame(rows, RUNS).withColumn("logged_at", F.current_timestamp()).coalesce(1)
    if run is None:
        told.write.mode("append").parquet(path)
    else:
        _replace_run(told, path, run)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def join_features_to_loans(loans: DataFrame, features: DataFrame, key: str = S.KEY) -> DataFrame:
    """Loans with their stored features, where there are any."""
    shared = [c for c in features.columns if c in loans.columns and c != key]
    return loans.join(features.drop(*shared), key, "left")
