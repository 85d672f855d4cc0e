import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("textloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values():
    """Rows of a one-column frame of texts, after a column function."""
    from pyspark.sql import functions as F

    def run(spark, texts, function):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r[1] for r in sorted(df.select("i", function(F.col("t")).alias("x")).collect())]

    return run


def plain(v):
    """Value in a form that Spark's and DuckDB's results share."""
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


@pytest.fixture(scope="session")
def against_sql(spark):
    """Compare a query with its SQL on a folder of tables."""
    import duckdb

    def run(query, sql, folder):
        con = duckdb.connect()
        for path in Path(folder).iterdir():
            con.sql(f"CREATE VIEW {path.name.split('.')[0]} AS SELECT * FROM '{path}'")
        rel = con.sql(sql)
        df = query(spark, str(folder))
        names = sorted(df.columns)
        assert names == sorted(rel.columns)
        mine = sorted(([plain(r[c]) for c in names] for r in df.collect()), key=repr)
        place = [rel.columns.index(c) for c in names]
        theirs = sorted(([plain(r[i]) for i in place] for r in rel.fetchall()), key=repr)
        assert mine == theirs
        return mine

    return run
