import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    db = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return db


def same_rows(frame, relation):
    """Equal as bags of rows, by column name; doubles to six places."""
    from collections import Counter

    def norm(v):
        return round(v, 6) if isinstance(v, float) else v

    names = sorted(frame.columns)
    assert names == sorted(relation.columns)
    got = Counter(tuple(norm(r[n]) for n in names) for r in frame.collect())
    want = Counter(tuple(map(norm, r)) for r in relation.select(*[f'"{n}"' for n in names]).fetchall())
    assert got == want
