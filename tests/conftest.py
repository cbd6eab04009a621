import json
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent.parent))

from cairn.runtime import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _plain(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, list | tuple):
        return [_plain(x) for x in v]
    if hasattr(v, "asDict"):
        return _plain(v.asDict())
    return None if v is None else str(v)


def same_as_sql(spark, query, sql, folder=SF):
    """Runs a query and its SQL over the same folder; fails with the rows that only one of them has."""
    import duckdb

    con = duckdb.connect()
    for p in Path(folder).iterdir():
        con.sql(f"create view {p.stem} as select * from read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    df = query(spark, str(folder))
    cols = sorted(df.columns)
    got = sorted(json.dumps([_plain(r[c]) for c in cols]) for r in df.collect())
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted(json.dumps([_plain(r[i]) for i in at]) for r in rel.fetchall())
    assert got == want, (list(set(got) - set(want))[:3], list(set(want) - set(got))[:3])


@pytest.fixture(scope="session")
def check_sql(spark):
    return lambda query, sql, folder=SF: same_as_sql(spark, query, sql, folder)
