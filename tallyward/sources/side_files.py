"""Small artefacts: manifest, rates, user statistics, metrics."""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import schemas as S
from tallyward.operators import rates
from tallyward.operators.columns import public_entries
from tallyward.operators.skew import small_rows
from tallyward.session import new_folder


def write_small(df: DataFrame, path: str) -> None:
    """One JSON file; for metric rows, not for data."""
    df.coalesce(1).write.mode("overwrite").json(path)


def manifest_row(spark: SparkSession, manifest: dict[str, list[str]]) -> DataFrame:
    return spark.createDataFrame([tuple(manifest[f.name] for f in S.MANIFEST.fields)], S.MANIFEST)


def read_manifest(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The manifest, or empty lists when there is none to read."""
    empty = {f.name: [] for f in S.MANIFEST.fields}
    try:
        row = spark.read.schema(S.MANIFEST).option("multiLine", True).json(path).first()
    except AnalysisException:
        return empty
    return empty if row is None else {name: row[name] or [] for name in empty}


def model_width(manifest: dict[str, list[str]]) -> int:
    return len(manifest["feature_names"]) or S.MODEL_WIDTH


_OVERALL = "_overall"


def write_rates(fitted: rates.Rates, path: str) -> None:
    spark = fitted.table.sparkSession
    overall = spark.createDataFrame([(_OVERALL, "", fitted.overall)], S.CATEGORY_RATE)
    fitted.table.unionByName(overall).write.mode("overwrite").json(path)


def read_rates(spark: SparkSession, path: str) -> rates.Rates:
    """Fitted rates, or the built-in ones when there are none to read."""
    try:
        table = spark.read.schema(S.CATEGORY_RATE).json(path)
    except AnalysisException:
        return rates.defaults(spark)
    overall = next((r.rate for r in table.filter(F.col("category") == _OVERALL).limit(1).collect()), None)
    table = table.filter(F.col("category") != _OVERALL)
    rows = small_rows(table)
    return rates.Rates(table, overall, False, {}) if rows is None else rates.of_rows(spark, rows, overall)


FOLDER_USERS = 4_000


def bucket(folders: int, user: str = "user_id") -> Column:
    """The folder of a user's row, out of so many."""
    return F.pmod(F.xxhash64(user), F.lit(folders)).cast("int")


def _write_by_user(df: DataFrame, path: str) -> None:
    """A folder for every ``FOLDER_USERS`` users or so; their number doubles as the table grows, and is kept beside it."""
    spark = df.sparkSession
    df.write.parquet(staged := new_folder(spark, "by-user"))
    rows = spark.read.schema(df.schema).parquet(staged)
    folders = 1 << max(0, (rows.count() - 1) // FOLDER_USERS).bit_length()
    placed = rows.withColumn("bucket", bucket(folders))
    placed.repartition("bucket").sortWithinPartitions("bucket", "user_id").write.mode("overwrite").partitionBy("bucket").parquet(path)
    write_small(spark.range(1).select(F.lit(folders).alias("folders")), f"{path}_layout")


def _read_by_user(spark: SparkSession, path: str, schema: T.StructType, users: DataFrame | None) -> DataFrame:
    """The rows, or those of some users (a column ``user_id``): then only their folders are listed and read.

    The folders of a micro-batch, at most as many as its users, go to the driver.
    """
    full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    if users is None:
        return spark.read.schema(full).parquet(path).drop("bucket")
    folders = spark.read.schema("folders int").json(f"{path}_layout").first().folders
    asked = users.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    found = [0] if folders == 1 else [r.b for r in asked.select(bucket(folders).alias("b")).distinct().collect()]
    if not found:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/bucket={b}" for b in found]).drop("bucket")
    return rows.join(asked, "user_id", "left_semi")


def write_user_stats(stats: DataFrame, path: str) -> None:
    """Statistics in folders by user hash, sorted by user: a lookup reads the folders of its users only."""
    _write_by_user(stats, path)


def read_user_stats(spark: SparkSession, path: str, users: DataFrame | None = None) -> DataFrame:
    return _read_by_user(spark, path, S.USER_STATS, users)


def write_user_partials(partials: DataFrame, path: str) -> None:
    """The sums behind the statistics, laid out alike: what is learned later can be added to them."""
    _write_by_user(partials, path)


def read_user_partials(spark: SparkSession, path: str, users: DataFrame | None = None) -> DataFrame:
    """The sums, or none when there are none to read."""
    try:
        return _read_by_user(spark, path, S.USER_PARTIALS, users)
    except AnalysisException:
        return spark.createDataFrame([], S.USER_PARTIALS)


METADATA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("training_job", T.StringType()),
    T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("creation_time", T.DoubleType()),
    T.StructField("feature_info", S.MANIFEST),
])


def metadata_row(
    spark: SparkSession, name: str, job: str, parameters: dict[str, object], manifest: dict[str, list[str]],
    created: float,
) -> DataFrame:
    """Model metadata with the public parameters only (no key that starts with ``_``)."""
    rows = [(name, job, {k: json.dumps(v) for k, v in parameters.items()}, created,
             tuple(manifest[f.name] for f in S.MANIFEST.fields))]
    df = spark.createDataFrame(rows, METADATA)
    return df.withColumn("hyperparameters", public_entries(F.col("hyperparameters")))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).json(path)
