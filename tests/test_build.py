"""Snapshots to marts, with a revision, an insert and a delete between two snapshots."""

import pytest

from cairn.plans import control as C
from cairn.plans import publish as P
from cairn.plans.build import Warehouse, snapshot

COLUMNS = [("Year", "year", "int"), ("Asylum", "asylum", "string"), ("Origin", "origin", "string"), ("Refugees", "refugees", "bigint")]
ROUTES = {"routes": [{"route_id": "r", "pattern": "*/bronze/*/*.parquet", "entity": "flows", "grain": "year"}]}
SILVER = {
    "entity": "flows", "grain": "year",
    "contract": {"primary_key": ["o", "d", "year"], "partitions": ["year"], "lineage": ["_ingest_run_id"], "columns": [
        {"name": "o_id", "type": "INT", "nullable": False}, {"name": "o", "type": "STRING", "nullable": False, "source": ["origin"]}, {"name": "d", "type": "STRING", "nullable": False, "source": ["asylum"]},
        {"name": "refugees", "type": "BIGINT", "nullable": False, "dq": ">= 0", "source": ["refugees"]}, {"name": "year", "type": "INT", "source": ["year"]}]},
    "canonicalizer": {"input": {"normalize": {"o": ["strip", "upper"], "d": ["strip", "upper"]}}, "dims": [{"name": "countries", "on_keys": {"left": "o", "right": "iso"}, "select": ["id"], "alias": "o_", "required": True}],
        "rules": [{"name": "years", "when": "year >= 1990 and year <= 2035", "action": "keep", "reject_reason": "year"}], "dedup": {"key": ["o", "d", "year"], "tiebreak": [{"column": "_ingest_run_id", "order": "desc"}]}, "row_hash": {"columns": ["o", "d", "year", "refugees"]}},
}
GOLD = {
    "entity": "flows_yearly", "grain": "year", "contract": {"primary_key": ["o_id", "d", "year"], "partitions": ["year"], "foreign_keys": [{"column": "o_id", "references": "dims.country(id)"}]},
    "columns": [{"name": "o_id", "type": "INT", "nullable": False}, {"name": "d", "type": "STRING"}, {"name": "refugees", "type": "BIGINT"}, {"name": "twice", "type": "BIGINT"}, {"name": "year", "type": "INT"}],
    "transform": {"source": "silver.flows", "select_map": {"o_id": "o_id", "d": "d", "refugees": "refugees", "year": "year"}, "derivations": {"twice": "refugees*2"}, "types": {"twice": "BIGINT"}, "order": ["o_id", "d", "refugees", "twice", "year"]},
}


def _raw(path, rows):
    path.write_text("Year,Asylum,Origin,Refugees\n" + "\n".join(",".join(map(str, r)) for r in rows) + "\n")
    return str(path)


def test_end_to_end(spark, tmp_path):
    dim = spark.createDataFrame([("SYR", 1), ("AFG", 2), ("IRN", 3)], "iso string, id int")
    bronze, w = str(tmp_path / "bronze" / "src"), Warehouse(spark, str(tmp_path / "lake"))
    first = [(2020, "TUR", " syr", 10), (2020, "IRN", "AFG", 7), (2020, "TUR", "XXX", 5), (2021, "TUR", "IRN", 1), ("abc", "TUR", "IRN", 1), (1989, "TUR", "IRN", 1)]
    s = snapshot(spark, _raw(tmp_path / "a.csv", first), bronze, COLUMNS, 2020, 2021, "1")
    assert s["records"] == 4 and s["severity"] == "MINOR"
    assert snapshot(spark, str(tmp_path / "a.csv"), bronze, COLUMNS, 2020, 2021, "1")["note"] == "exists"
    w.discover(bronze, ROUTES, "run1")
    assert {r.status for r in w.manifest.read().collect()} <= {"pending", "failed"}
    assert sorted(r.partition_key for r in w.dirty.read().collect()) == ["2020", "2021"]
    w.discover(bronze, ROUTES, "run1")  # the same bytes: nothing is new
    assert w.dirty.read().count() == 2 and w.links.read().count() == 2
    built = {b["partition_key"]: b for b in w.build_silver(SILVER, {"countries": dim}, "run1")}
    assert (built["2020"]["inserts"], built["2020"]["rejected"], built["2020"]["rows"]) == (2, 1, 2)
    assert {r.status for r in w.dirty.read().collect()} == {"clean"}
    before = {b.partition_key: b.partition_hash for b in w.commits.read().collect()}

    gold = w.build_gold(GOLD, "2020", "run1", {"dims.country": dim})
    assert gold["rows"] == 2 and sorted((r.d, r.twice) for r in w.read("flows_yearly").collect()) == [("IRN", 14), ("TUR", 20)]
    with pytest.raises(Exception, match="not promoted"):
        w.build_gold(GOLD, "2030", "run1", {})

    second = [(2020, "TUR", "SYR", 11), (2020, "TUR", "IRN", 3), (2021, "TUR", "IRN", 1)]
    snapshot(spark, _raw(tmp_path / "b.csv", second), bronze, COLUMNS, 2020, 2021, "1", overwrite=True)
    w.discover(bronze, ROUTES, "run2")
    assert "superseded" in {r.status for r in w.manifest.read().collect()}
    built = {b["partition_key"]: b for b in w.build_silver(SILVER, {"countries": dim}, "run2")}
    assert [built["2020"][k] for k in ("inserts", "updates", "deletes")] == [1, 1, 1]
    assert [built["2021"][k] for k in ("inserts", "updates", "deletes")] == [0, 0, 0]
    after = {b.partition_key: b.partition_hash for b in w.commits.read().where("run_id = 'run2'").collect()}
    assert after["2021"] == before["2021"] and after["2020"] != before["2020"]
    kinds = [r.event_type for r in w.lineage.events.read().collect()]
    assert (kinds.count("partition_published"), kinds.count("transform_run"), kinds.count("discover")) == (5, 5, 2)
    w.replay("flows")
    assert w.read("flows") is None and {r.status for r in w.dirty.read().collect()} == {"dirty"}


def test_control_tables(spark, tmp_path):
    table = P.ControlTable(spark, str(tmp_path), "t", "a int")
    assert table.read().count() == 0
    table.append(spark.createDataFrame([(1,)], "a int"))
    table.append(spark.createDataFrame([(2,)], "a int"))
    assert sorted(r.a for r in table.read().collect()) == [1, 2] and table.version() == 2
    old, new = spark.createDataFrame([("e", "p", "r", 1)], "entity string, partition_key string, run_id string, v int"), spark.createDataFrame([("e", "p", "r", 2), ("e", "q", "r", 3)], "entity string, partition_key string, run_id string, v int")
    assert sorted(r.v for r in P.insert_commits(old, new).collect()) == [1, 3]
    assert sorted(r.v for r in P.insert_commits(old, new, "replace").collect()) == [2, 3]
    with pytest.raises(ValueError):
        P.insert_commits(old, new, "merge")


def test_an_empty_plan_and_empty_roots(spark):
    empty = lambda s: spark.createDataFrame([], s)
    dirty = spark.createDataFrame([("e", "2020", "x", None, None, "dirty")], C.DIRTY)
    plan = C.plan(dirty, empty(C.LINKS), empty(C.MANIFEST)).collect()
    assert len(plan) == 1 and plan[0].inputs == []


def test_swap_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "v int, year int")
    P.swap_partition(rows((1, 2020)), path, "year", "year", "2020")
    P.swap_partition(rows((2, 2021)), path, "year", "year", "2021")
    P.swap_partition(rows((3, 2020)), path, "year", "year", "2020")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 3]
    P.swap_partition(rows((3, 2021)).limit(0), path, "year", "year", "2020")
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
    with pytest.raises(ValueError):
        P.partition_predicate("year", "week", "1")


def test_stream_of_files(spark, tmp_path):
    from cairn.streaming.files import available_now

    spark.range(5).write.parquet(str(tmp_path / "in"))
    got = []
    for _ in range(2):
        available_now(spark, str(tmp_path / "in"), "id long", str(tmp_path / "cp"), lambda df, n: got.append(df.count()))
    assert sum(got) == 5
