"""Every query of the engine against its SQL, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from cairn.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages labels".split():
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, DIR)
    cur = db.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(map(str, r)) for r in df.select(*names).collect()) == Counter(tuple(map(str, r)) for r in cur.fetchall())


def test_plans_hold_every_routed_partition(spark):
    """Every entity and partition that a file is routed to is planned by some query, with the last version of each of its files."""
    last = {}
    for r in QUERIES["manifest_supersede"](spark, DIR).where("not superseded").collect():
        last[r.file_path] = r.version
    want = {}
    for r in QUERIES["route_files"](spark, DIR).collect():
        want.setdefault((r.entity, r.partition_key), set()).add(last[r.file_path])
    plans = [q for n, q in QUERIES.items() if n.startswith("plan_")]
    got = {(r.entity, r.partition_key): set(map(int, r.versions.split(","))) for q in plans for r in q(spark, DIR).collect()}
    assert {e for e, _ in want} == {"first", "second"} and got == want
