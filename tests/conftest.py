import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)  # for Python workers


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    made = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    return made


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    c = duckdb.connect()
    for f in Path(sf).iterdir():
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c
