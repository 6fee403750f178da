"""Every query of the catalog against its SQL, run by DuckDB over the same tables."""

from pathlib import Path

import duckdb
import pytest

from skein.operators.changes import apply_changes
from skein.plans import catalog


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, sf, db, name):
    got = catalog.queries()[name](spark, sf)
    cols = sorted(got.columns)
    want = db.execute(catalog.oracle_sql()[name])
    at = [[c[0] for c in want.description].index(c) for c in cols]
    assert sorted(c[0] for c in want.description) == cols
    rows = sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == rows


def test_crc16(spark):
    from skein.functions.encodings import crc16

    df = spark.sql("SELECT * FROM VALUES (cast('123456789' AS binary)), (cast('' AS binary)), (null) AS t(x)")
    assert [r[0] for r in df.select(crc16("x")).collect()] == [0x31C3, 0, None]


def test_changes_in_conflict_are_left_out(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(k, v)")
    changed = spark.sql("SELECT * FROM VALUES (1, 'INSERT', 'x'), (2, 'UPDATE', 'y'), (3, 'DELETE', 'z'), (4, 'UPDATE', 'z'), (5, 'INSERT', 'n') AS t(k, op, v)")
    assert sorted(map(tuple, apply_changes(target, changed, "k").collect())) == [(1, "a"), (2, "y"), (5, "n")]
