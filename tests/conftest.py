import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyward import schemas as S  # noqa: E402
from tallyward import session  # noqa: E402
from tallyward.plans import queries as q  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "tests", cpus="8", **{
            "spark.sql.shuffle.partitions": "4",
            # small frames, many plans: compiling each plan would take longer than running it
            "spark.sql.codegen.wholeStage": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def tx(spark):
    return q.tx(spark, DATA).persist()


@pytest.fixture
def record(spark):
    """Transactions from partial dictionaries; what is not given is null."""

    def make(*rows, schema=S.HISTORY):
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    return make


def rows_of(df):
    """Rows as sorted tuples, for comparison whatever the order."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
