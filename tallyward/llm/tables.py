"""Small shared helpers of the operators."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.session import new_folder, shared_folder  # noqa: F401


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns that an operator is about to add (its own names win)."""
    wanted = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in wanted])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ddl(df: DataFrame) -> str:
    """The frame's columns as a schema text."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
