import pandas as pd
import pytest
from pyspark.sql import functions as F

from waybill.schemas import CHUNK, ROW_ORDER
from waybill.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        driver_memory="4g",
        **{
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def make_chunk(spark):
    """A typed chunk frame from dicts; missing columns are null, rows keep their order."""

    def make(rows, files=None):
        full = [
            {f.name: row.get(f.name) for f in CHUNK}
            | {ROW_ORDER[0]: files[i] if files else "chunk_1", ROW_ORDER[1]: i}
            for i, row in enumerate(rows)
        ]
        schema = CHUNK.simpleString()[len("struct<"):-1]
        schema += f",{ROW_ORDER[0]}:string,{ROW_ORDER[1]}:bigint"
        columns = CHUNK.names + list(ROW_ORDER)
        return spark.createDataFrame([[r[c] for c in columns] for r in full], schema)

    return make


@pytest.fixture
def rows_of():
    """Rows as a sorted list of tuples, nulls last."""

    def rows(df):
        key = lambda row: tuple((v is None, v) if v is not None else (True,) for v in row)
        return sorted((tuple(r) for r in df.collect()), key=lambda r: repr(key(r)))

    return rows


@pytest.fixture
def plan_of():
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return plan
