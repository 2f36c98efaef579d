"""Session builder and the shared work folder."""

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build(app: str = "tallyward", cpus: str = "*", **conf) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own settings."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TALLYWARD_DRIVER_MEMORY", "8g"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then works below its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is ever written twice to one path."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable, in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def parallelism(spark: SparkSession) -> int:
    """How many slices a range-sliced job is cut into: follows the cluster's setting."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def local_table(spark: SparkSession, rows, schema: pa.Schema) -> DataFrame:
    """A few rows as part of the plan itself: no job, and a size the optimizer knows."""
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    ))
