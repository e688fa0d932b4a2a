"""Crashes between steps, paths that need escapes, both sides of size switches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.functions.text import row_hash
from cairn.functions.types import canonical
from cairn.operators import relational as R
from cairn.plans import control as C
from cairn.plans import publish as P
from cairn.plans.contracts import metric, rollup, validate_metric
from cairn.sources import readers


def _table(spark, tmp_path):
    return P.ControlTable(spark, str(tmp_path), "t", "a int"), lambda *x: spark.createDataFrame([(i,) for i in x], "a int")


def _rows(table):
    return sorted(r.a for r in table.read().collect())


def test_a_crash_between_steps_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table, rows = _table(spark, tmp_path)
    table.append(rows(1))
    table.append(rows(2))
    assert _rows(table) == [1, 2]
    # cut off while a new whole version is written: files, but no mark
    rows(9).write.parquet(f"{table.base}/v=000000003.whole")
    P.delete(spark, f"{table.base}/v=000000003.whole/_SUCCESS")
    assert _rows(table) == [1, 2] and table.version() == 2
    table.replace(rows(3))  # the number that was cut off is not used again
    assert _rows(table) == [3] and table.version() == 4
    table.append(rows(4))
    # cut off after compaction wrote and before it deleted
    monkeypatch.setattr(P, "delete", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        table.compact()
    assert _rows(table) == [3, 4]


def test_append_writes_the_new_rows_alone(spark, tmp_path):
    table, rows = _table(spark, tmp_path)
    for i in range(4):
        table.append(rows(i))
    sizes = [spark.read.parquet(f"{table.base}/v={n:09d}.{kind}").count() for n, kind, _ in table.versions()]
    assert sizes == [1, 1, 1, 1] and _rows(table) == [0, 1, 2, 3]
    table.compact(keep=0)
    assert _rows(table) == [0, 1, 2, 3] and len(table.versions()) == 1


def test_text_is_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    P.put_text(spark, path, "one")
    P.put_text(spark, path, "two é")
    assert P.get_text(spark, path) == "two é" and [p.name for p in (tmp_path / "a").iterdir() if not p.name.endswith(".crc")] == ["x.json"]


def test_provenance_of_paths_that_begin_alike_or_need_escapes(spark, tmp_path):
    paths = {"/x/a/f.parquet": 1, "/x/ab/f.parquet": 2, "/x/a b%20+é/f.parquet": 3}
    inputs = []
    for p, v in paths.items():
        P.write_file(spark.createDataFrame([(v,)], "v int"), f"{tmp_path}{p}")
        inputs.append({"file_path": f"file:{tmp_path}{p}", "content_hash": f"h{v}"})
    got = readers.parquet_inputs(spark, inputs, "r").collect()
    assert sorted((r.v, r._content_hash) for r in got) == [(1, "h1"), (2, "h2"), (3, "h3")]
    folder = readers.parquet_inputs(spark, [{"file_path": str(tmp_path / "x" / "a"), "content_hash": "h"}], "r").collect()
    assert [(r.v, r._content_hash) for r in folder] == [(1, "h")]
    facts = {r.file_path: (r.content_hash, r.error) for r in readers.file_facts(spark, str(tmp_path)).collect()}
    pieces = {r.file_path: (r.content_hash, r.error) for r in readers.file_facts(spark, str(tmp_path), large_file=0).collect()}
    assert facts == pieces and len(facts) == 3 and all(len(h) == 64 for h, _ in facts.values())


def test_row_hash_of_times_and_nested_values(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    df = spark.createDataFrame([(1, t, {"b": 1, "a": 2}), (2, t.replace(microsecond=100_000), {"a": 2, "b": 1}), (3, t, {"a": 2, "b": 1})], "i int, t timestamp_ntz, m map<string,int>")
    h = {r.i: r.h for r in df.select("i", row_hash(df.schema, ["t", "m"]).alias("h")).collect()}
    assert h[1] == h[3] != h[2]
    plain = df.where("i = 1").select(F.sha2(F.lit('2024-01-02T03:04:05|{"a":2,"b":1}'), 256)).first()[0]
    assert h[1] == plain


def test_both_sides_of_the_dimension_switch(spark, monkeypatch):
    df, dim = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    out = []
    for limit in (R.SMALL_BYTES, 0):
        monkeypatch.setattr(R, "SMALL_BYTES", limit)
        got, lost = R.join_dimension(df, dim, {"left": "k", "right": "id"}, ["name"], required=True)
        out.append((sorted(map(tuple, got.collect())), [tuple(r) for r in lost.collect()]))
    assert out[0] == out[1] == ([(1, "a"), (2, "b")], [(3, "dimension_not_found")])
    with pytest.raises(KeyError):
        R.join_dimension(df, dim, {"left": "k", "right": "id"}, ["name"], rename={"gone": "x"})
    assert R.ensure(df.withColumnRenamed("k", "a`b.c"), ["a`b.c"]).columns == ["a`b.c"]


def test_routes_of_a_source_alone(spark):
    files = spark.createDataFrame([("s", "/b/s/x.parquet"), (None, "/b/n/y.parquet")], "source_id string, file_path string")
    spec = {"routes": [{"route_id": "a", "source_id": "s", "pattern": "*.csv", "entity": "e", "grain": "year"}, {"route_id": "b", "pattern": "*/y.parquet", "entity": "f", "grain": "month"}, {"route_id": "c", "source_id": "s", "entity": "g", "grain": "year", "enabled": False}]}
    router = C.routes(spark, spec)
    assert sorted((r.file_path, r.route_id, r.route_grain) for r in C.route(files, router).collect()) == [("/b/n/y.parquet", "b", "month")]
    assert [(r.file_path, r.route_id) for r in C.route(files, router, source_only=True).collect()] == [("/b/s/x.parquet", "a")]
    assert C.route(files, router.limit(0)).count() == 0


def test_metrics_and_rollups(spark):
    df = spark.createDataFrame([("x", 1, 2), ("x", -1, 3)], "k string, v int, w int")
    spec = {"name": "m", "formula": "v", "allowed_dimensions": ["k"], "validations": ["non_negative", {"equals_components": {"expression": "v == w - 1"}}]}
    assert validate_metric(df, spec) == {"non_negative": 1, "equals_components": 1}
    with pytest.raises(ValueError, match="non_negative"):
        metric(df, spec, ["k"], strict=True)
    assert metric(df, spec, ["k"]).first().m == 0
    with pytest.raises(ValueError):
        validate_metric(df, {**spec, "validations": ["other"]})
    with pytest.raises(ValueError):
        rollup(df, [{"name": "k"}, {"name": "v", "agg": "sum"}], ["w"])
    assert [canonical(x) for x in ("character varying", "FLOAT4", "float8", "timestamp without time zone")] == ["VARCHAR", "DOUBLE", "DOUBLE", "TIMESTAMP"]


def test_a_dimension_with_bad_or_repeated_codes(spark, tmp_path):
    from cairn.plans.build import Warehouse

    w = Warehouse(spark, str(tmp_path / "lake"))
    raw = tmp_path / "dim.csv"
    names = {"ISO3": "iso_country", "Name": "name"}
    raw.write_text('ISO3;Name\n syr ;"A; B"\nAFG;C\n', encoding="utf-8")
    got = w.build_dimension(str(raw), "countries", names, ["iso_country", "name"]).orderBy("country_id").collect()
    assert [tuple(r) for r in got] == [(1, "AFG", "C"), (2, "SYR", "A; B")]
    for bad in ("SY;x", "SYR;x\nsyr;y"):
        raw.write_text(f"ISO3;Name\n{bad}\n", encoding="utf-8")
        with pytest.raises(ValueError):
            w.build_dimension(str(raw), "countries", names, ["iso_country", "name"])
