"""Readers and writers of the base tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowgauge.operators.cleaning import fill_defaults
from flowgauge.operators.quality import duplicate_keys, keep_first, null_violations
from flowgauge.session import settle
from flowgauge.sources import schemas


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet table; a missing path is a ``FileNotFoundError``."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no data at {path}; write it first") from e
        raise


def exists(spark: SparkSession, path: str) -> bool:
    try:
        read_table(spark, path)
    except FileNotFoundError:
        return False
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return False
        raise
    return True


def jdbc_options(
    url: str,
    query: str,
    *,
    partition_column: str | None = None,
    lower=None,
    upper=None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    user: str | None = None,
    password: str | None = None,
    driver: str = "org.postgresql.Driver",
) -> dict[str, str]:
    """Options of a JDBC read, split into ranges of ``partition_column``."""
    options = {
        "url": url,
        "dbtable": f"({query}) AS q",
        "driver": driver,
        "fetchsize": str(fetch_size),
    }
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of a base table, cast to its types, with its defaults."""
    schema = StructType.fromDDL(schemas.TABLES[table])
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return fill_defaults(df.select(*columns), schemas.DEFAULTS.get(table, {}))


def table_violations(df: DataFrame, table: str) -> DataFrame:
    """(check_name, n_violations) of a base table's required columns and unique keys."""
    found = null_violations(df, schemas.REQUIRED[table])
    found = found.select(F.concat("check_name", F.lit(" is required")).alias("check_name"), "n_violations")
    for name in schemas.UNIQUE.get(table, []):
        repeated = duplicate_keys(df, [name]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_violations"))
        found = found.unionByName(repeated.select(F.lit(f"{name} is unique").alias("check_name"), "n_violations"))
    return found


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_sets(tagged: DataFrame, path: str) -> None:
    """Train and test rows of ``tag_sets``, each in its own folder, in one pass."""
    tagged.write.mode("overwrite").partitionBy("set").parquet(path)


def read_sets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) as written by ``write_sets``."""
    stored = read_table(spark, path)
    train, test = (stored.filter(F.col("set") == name).drop("set") for name in ("TRAIN", "TEST"))
    return train, test


def append_facts(df: DataFrame, path: str, ts: str = "recorded_at", date: str = "date") -> None:
    """Append readings below one folder per date.

    ``rebalance`` gathers each date into files of the advisory size and splits
    a date that is too large for one task.
    """
    dated = df.withColumn(date, F.col(ts).cast("date"))
    dated.hint("rebalance", F.col(date)).write.mode("append").partitionBy(date).parquet(path)


def absent_rows(new: DataFrame, existing: DataFrame, key: Sequence[str], tie: str) -> DataFrame:
    """One new row per key value that ``existing`` does not have yet.

    Both sides are reduced to one row per key before they meet. A key with a
    NULL is equal to none, so such rows all count; only one that ``existing``
    has with the same values in all the columns they share is left out.
    """
    whole, rest = _by_whole_key(new, key)
    known = existing.select(*key).distinct()
    fresh = keep_first(whole, key, tie).join(known, list(key), "left_anti").select(*new.columns)
    same = F.lit(True)
    for name in (c for c in new.columns if c in existing.columns):
        same = same & F.col(f"_new.`{name}`").eqNullSafe(F.col(f"_old.`{name}`"))
    loaded = _by_whole_key(existing, key)[1]
    return fresh.unionByName(rest.alias("_new").join(loaded.alias("_old"), same, "left_anti"))


def _by_whole_key(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key has no NULL, the others)."""
    whole = F.lit(True)
    for name in key:
        whole = whole & F.col(name).isNotNull()
    return df.filter(whole), df.filter(~whole)


def insert_if_absent(new: DataFrame, path: str, key: Sequence[str], tie: str) -> None:
    """Append the rows whose key is not in the table; loading twice adds nothing.

    Of new rows with one key the one with the smallest ``tie`` is taken.
    """
    spark = new.sparkSession
    if exists(spark, path):
        rows = absent_rows(new, spark.read.parquet(path), key, tie)
    else:
        whole, rest = _by_whole_key(new, key)
        rows = keep_first(whole, key, tie).unionByName(rest)
    rows.write.mode("append").parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    """Special events, once per name and start."""
    insert_if_absent(events, path, ["event_name", "start_time"], "end_time")


def write_metrics(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METRICS).json(path)


def read_requests(spark: SparkSession, path: str, schema: str = schemas.REQUESTS) -> DataFrame:
    """JSON scoring requests; an unreadable line lands in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schema}, _corrupt_record string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


#: What makes a prediction the same one on another load.
PREDICTION_KEY = [
    "segment_id", "target_datetime", "predicted_at", "model_version", "input_features",
    "predicted_level", "confidence_score",
]


def append_predictions(rows: DataFrame, path: str) -> None:
    """Append predictions below one folder per target date, as a log.

    A row that is there already with the same values is not added, so a load
    that runs again adds nothing; predictions that differ in any value, such as
    a later one for the same target, are all kept. Rows are compared by their
    values, and only the target dates of the new rows are read. Each row gets
    an ``id`` (a hash of its values) and its time of writing as ``created_at``.
    """
    spark = rows.sparkSession
    dated = rows.withColumn("date", F.col("target_datetime").cast("date"))
    fresh = settle(dated.dropDuplicates(PREDICTION_KEY))  # the values must not change between the two jobs
    if exists(spark, path):
        dates = [r["date"] for r in fresh.select("date").distinct().collect()]
        stored = spark.read.parquet(path).filter(F.col("date").isin(dates)).select("date", *PREDICTION_KEY)
        same = F.col("_new.date") == F.col("_old.date")
        for name in PREDICTION_KEY:
            same = same & F.col(f"_new.{name}").eqNullSafe(F.col(f"_old.{name}"))
        fresh = fresh.alias("_new").join(stored.alias("_old"), same, "left_anti")
    stamped = fresh.withColumns({"id": F.xxhash64(*PREDICTION_KEY), "created_at": F.current_timestamp()})
    stamped.write.mode("append").partitionBy("date").parquet(path)


def counts_while_writing(df: DataFrame, path: str, name: str = "load") -> Mapping[str, int]:
    """Write a table and count its rows in the same pass."""
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(path)
    return seen.get
