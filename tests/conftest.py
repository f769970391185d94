import sys
from pathlib import Path

import pytest

for _p in (Path(__file__).resolve().parents[1], Path(__file__).resolve().parent):
    sys.path.insert(0, str(_p))


@pytest.fixture(scope="session")
def spark():
    from claimworks.session import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": "/tmp/claimworks-warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "no_ansi"])
def either_ansi(spark, request):
    """Every cleaning rule must hold in both modes."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)
