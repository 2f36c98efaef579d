"""Labelled history: read, profile, write."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions import amounts, clock, codec
from tallyward.operators import columns
from tallyward.session import new_folder
from tallyward.sources import documents


def read_text(spark: SparkSession, path: str, array_document: bool | None = None) -> DataFrame:
    """One JSON text per record in ``value``, with ``problem`` where it is none: lines, or the elements of array documents.

    ``None`` looks at each file: one that begins with ``[`` is a document, the others are lines.
    """
    if array_document is None:
        found, lines = documents.by_form(spark, path)
    else:
        found, lines = ([path], []) if array_document else ([], [path])
    texts = spark.read.text(lines) if lines else spark.createDataFrame([], "value string")
    texts = texts.filter(F.trim("value") != "").select("value", F.lit(None).cast("string").alias("problem"))
    return texts.unionByName(documents.records(spark, found)) if found else texts


def parse(lines: DataFrame) -> DataFrame:
    """Records with the declared fields, ``ts``, and ``reason``: null, or why the record can't be used.

    ``bad_json`` is text that is no JSON of the declared types, ``extra_data`` text with more than one record,
    ``cut_off`` the rest of a document without an end, ``no_label`` a record without its label, ``bad_time``
    one whose time can't be read, ``bad_amount`` one whose amount is not finite or out of range. ``raw`` is the text.
    """
    problem = F.col("problem") if "problem" in lines.columns else F.lit(None).cast("string")
    texts = lines.select(F.col("value").alias("raw"), problem.alias("problem"))
    read = codec.with_record(texts, F.when(F.col("problem").isNull(), F.col("raw")), S.HISTORY, "r")
    named = read.select("raw", "problem", F.col("r").isNull().alias("_broken"), *[F.col(f"r.{f.name}").alias(f.name) for f in S.HISTORY.fields])
    timed = named.withColumn("ts", clock.parse_or_null(F.col("timestamp")))
    return timed.withColumn("reason", (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("_broken"), codec.unread(F.col("raw"), S.HISTORY))
        .when(F.col(S.LABEL).isNull(), "no_label")
        .when(F.col("timestamp").isNotNull() & F.col("ts").isNull(), "bad_time")
        .when(~amounts.in_range(F.col("amount")), "bad_amount")
    )).drop("_broken", "problem")


def read_json(spark: SparkSession, path: str, array_document: bool | None = False) -> DataFrame:
    """History with the declared schema and a parsed time column ``ts``; fails on a record that can't be used.

    ``ingest`` sets such records aside instead, and lands the rest.
    """
    parsed = parse(read_text(spark, path, array_document))
    text = F.concat(F.lit("unusable record ("), F.col("reason"), F.lit("): "), F.substring("raw", 1, 200))
    return parsed.filter(F.when(F.col("reason").isNull(), True).otherwise(F.raise_error(text).cast("boolean"))).drop("reason", "raw")


def ingest(spark: SparkSession, path: str, out: str, array_document: bool | None = None, unreadable: str = "reject") -> DataFrame:
    """History landed once as Parquet below ``out/history``; what can't be used goes to ``out/rejects``, text and reason.

    ``array_document=None`` looks at each file, a folder may hold both forms. With ``unreadable="fail"`` a reject is an
    error, with ``"reject"`` only when no record is left, as in a history without labels.
    """
    if unreadable not in ("reject", "fail"):
        raise ValueError(f"unknown unreadable: {unreadable}")
    parsed = parse(read_text(spark, path, array_document))
    parsed.write.parquet(staged := new_folder(spark, "history"))
    parsed = spark.read.schema(parsed.schema).parquet(staged)
    bad = parsed.filter(F.col("reason").isNotNull()).select("raw", "reason")
    bad.write.mode("overwrite").json(f"{out}/rejects")
    counts = {r.reason: r["count"] for r in parsed.groupBy("reason").count().collect()}
    rejected = {k: n for k, n in counts.items() if k is not None}
    if rejected and (unreadable == "fail" or not counts.get(None)):
        raise ValueError(f"unusable records, see {out}/rejects: {rejected}")
    land(parsed.filter(F.col("reason").isNull()).drop("reason", "raw"), f"{out}/history", "overwrite")
    return spark.read.parquet(f"{out}/history").drop("day")


def with_time(df: DataFrame) -> DataFrame:
    columns.require(df, [S.LABEL, "timestamp"])
    return df.withColumn("ts", clock.parse(F.col("timestamp")))


def wire_form(df: DataFrame) -> DataFrame:
    """Rows as they travel: the time as ISO text."""
    return df.withColumn("timestamp", clock.to_text(F.col("ts"))).select(
        *[f.name for f in S.HISTORY.fields if f.name in {*df.columns, "timestamp"}]
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, many files: splittable, unlike one array document."""
    wire_form(df).write.mode(mode).json(path)


def land(df: DataFrame, path: str, mode: str = "ignore") -> None:
    """Parquet copy partitioned by day; by default nothing is done when it exists."""
    df.withColumn("day", F.to_date("ts")).repartitionByRange("day", "transaction_id").write.mode(
        mode
    ).partitionBy("day").parquet(path)


def profile(df: DataFrame) -> DataFrame:
    """Row count and fraud percentage."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), (F.avg(F.col(S.LABEL).cast("int")) * 100).alias("fraud_percent")
    )


def head(df: DataFrame, n: int = 5, order: str = "transaction_id") -> DataFrame:
    """First rows by an order that does not depend on the layout."""
    return df.orderBy(order).limit(n)


def timeline(df: DataFrame) -> DataFrame:
    return df.orderBy("ts", "transaction_id")


def write_matrix(df: DataFrame, names: list[str], path: str, label: str = S.LABEL) -> None:
    """LIBSVM text of the feature columns (indices from 1, nulls as 0)."""
    filled = df.select(
        F.col(label).cast("double").alias("label"),
        *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in names],
    )
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(filled)
    vectors.select("label", "features").write.format("libsvm").save(path)


def read_matrix(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """LIBSVM back to one column per feature."""
    rows = spark.read.format("libsvm").option("numFeatures", len(names)).load(path)
    values = vector_to_array("features")
    return rows.select(F.col("label").cast("int").alias("label"), *[values[i].alias(n) for i, n in enumerate(names)])
