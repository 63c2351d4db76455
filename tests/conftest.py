from __future__ import annotations

import glob
import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from klipgrid.session import build_session, ship

    s = build_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        # tiny tables: compiling a plan would take longer than running it
        "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.adaptive.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def production(spark):
    """A session that plans as in production: adaptive, with generated code."""
    s = spark.newSession()
    for k, v in {"spark.sql.adaptive.enabled": "true", "spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}.items():
        s.conf.set(k, v)
    return s


def plain(v):
    """A value as both engines would print it."""
    if v is None or isinstance(v, (str, bool)):
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return "nan" if math.isnan(v) else f"{float(v):.9g}" if v else "0"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def compare(spark, query, sql: str, folder: str = DATA) -> None:
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    df = query(spark, folder)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want
