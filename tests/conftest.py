from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TEST_DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TEST_DATA}/{t}.parquet')")
    return con


def cell(x):
    import pandas as pd

    if isinstance(x, (list, tuple)):
        return repr(x)
    return "NULL" if x is None or pd.isna(x) else repr(float(x)) if isinstance(x, float) else repr(x)


def same(spark_df, duck_rel) -> bool:
    a, b = spark_df.toPandas(), duck_rel.df()
    assert sorted(a.columns) == sorted(b.columns)
    rows = [sorted(tuple(map(cell, r)) for r in x[sorted(x.columns)].astype(object).itertuples(index=False)) for x in (a, b)]
    return rows[0] == rows[1]
