"""Every query against its SQL in DuckDB, on the smallest tables."""

import math
from datetime import datetime, timedelta

import duckdb
import pytest

from framelake.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, list | tuple):
        return repr([plain(x) for x in v])
    return repr(int(v)) if isinstance(v, int) else repr(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    found = duck.sql(SQL[name])
    assert sorted(found.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(tuple(plain(v) for v in row) for row in duck.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall())
    assert ours == theirs


#: A series with values of two turns and more, and under 0.
FAR = [3.0, 725.5, 12.25, 360.0, 359.99, 720.0, 1000.5, 5.0, -20.0, 170.0, 719.99, 0.0, 1085.0, 40.0]


@pytest.mark.parametrize("name", ["angle_difference", "angle_filter", "angle_filter_fixpoint", "apply_flips", "unwrap_angles", "velocity", "velocity_by_chunk"])
def test_angles_out_of_range(spark, tmp_path, name):
    c = duckdb.connect()
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=i), 7, "error" if i % 5 == 4 else "view", v, f'{{"k": {i}}}') for i, v in enumerate(FAR)]
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    c.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    columns = sorted(df.columns)
    theirs = c.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(tuple(plain(v) for v in row) for row in df.select(*columns).collect()) == sorted(tuple(plain(v) for v in row) for row in theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    df = QUERIES[name](spark, DATA)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0
