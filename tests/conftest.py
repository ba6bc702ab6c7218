from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimforge.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(warehouse),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample(spark):
    """Claims at the edges of the rules; A-1 is sent twice, the second time with a stay below zero."""
    lines = [
        "A-1 P10 N7 12000 10000 APPROVED medical 2023-03-30 2023-04-02",
        "A-2 P11 N8 12000 10000.01 APPROVED medical 2023-03-31 2023-03-31",
        "A-3 P12 -- 0 0 DENIED vision 2023-04-01 --",
        "A-4 -- N7 75.5 10 PENDING dental 2023-04-01 --",
        "A-5 P10 N9 -- 5 APPROVED pharmacy 2023-04-02 --",
        "A-6 P13 N7 nan 5 APPROVED pharmacy 2023-04-02 --",
        "A-7 P13 N7 20 -0.5 ADJUSTED medical 2023-04-03 --",
        "A-1 P10 N7 640 160 DENIED medical 2023-05-09 2023-05-07",
    ]
    names = [
        "claim_id", "member_id", "provider_npi", "billed_amount", "paid_amount", "claim_status",
        "claim_type", "service_date", "discharge_date",
    ]
    rows = [tuple(None if x == "--" else x for x in line.split()) for line in lines]
    df = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names))
    for name in ("billed_amount", "paid_amount"):
        df = df.withColumn(name, F.col(name).cast("double"))
    for name in ("service_date", "discharge_date"):
        df = df.withColumn(name, F.col(name).cast("date"))
    return df
