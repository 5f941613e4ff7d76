import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def canonical(rows, columns):
    """Rows as sorted tuples of comparable values."""
    value = lambda v: round(v, 6) if isinstance(v, float) else None if v is None else str(v)
    return sorted((tuple(value(r[c]) for c in columns) for r in rows), key=str)


@pytest.fixture(scope="session")
def same_as_sql(spark):
    """Check a registered query against its SQL in DuckDB."""
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")

    def check(query, sql):
        df = query(spark, SF)
        columns = sorted(df.columns)
        result = con.sql(sql)
        names = [d[0] for d in result.description]
        rows = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
        assert set(names) <= set(columns)
        assert canonical([r.asDict() for r in df.collect()], sorted(names)) == canonical(rows, sorted(names))

    return check
