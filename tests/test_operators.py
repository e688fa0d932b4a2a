import hashlib

import pytest
from pyspark.sql import functions as F

from cairn.functions import text as X
from cairn.functions.types import read_as
from cairn.operators import quality
from cairn.operators import relational as R
from cairn.plans.contracts import metric, transform

A = "be2c0dfd15cb5ef11ae3f8286b46dca47a14cd897068dda0e866fdbebe8905bf"
B = "db52f5425309d94aa60131d6a6b6669ab02ab16dac03e31619881022c4f460b8"
N = "18ffd7cabc391a07c4aa3ab648e329c9d0a8ba2ef89d0443644d4014e6f4f3b9"
COLS = ["o", "d", "year", "r", "a", "i", "s", "h", "x"]


def _rows(spark):
    return spark.createDataFrame([("SYR", "TUR", 2020, 10, 2, 0, 1, 5, 0), ("AFG", "IRN", 2020, 7, 3, 4, 0, 0, 6), ("SYR", "TUR", 2020, None, 2, 0, 1, 5, 0)], "o string, d string, year int, r long, a long, i long, s long, h long, x long")


def test_hashes_are_the_golden_ones(spark):
    got = [r.row_hash for r in R.with_row_hash(_rows(spark), COLS).collect()]
    assert got == [A, B, N]
    two = R.with_row_hash(_rows(spark).where("r is not null"), COLS)
    want = "475c8e9a721179704f934109bd1bcf8f89e17aa920e4a0dc2f0e0e0ec58bb33c"
    assert R.partition_hash(two, ["year"]).first().partition_hash == want
    assert R.partition_hash(two, ["year"], rows_in_memory=1).first().partition_hash == want
    assert R.partition_hash(two.limit(0), ["year"]).count() == 0
    assert hashlib.sha256("|".join(sorted([A, B])).encode()).hexdigest() == want


@pytest.mark.parametrize(
    "name,want",
    [
        ("2020-2021-part-000.parquet", ("2020", "2021", "year", None)),
        ("2020-part-000.parquet", ("2020", "2020", "year", None)),
        ("2020-05-part-000.parquet", ("2020-05", "2020-05", "month", None)),
        ("2020-05-2020-07-part-000.parquet", ("2020-05", "2020-07", "month", None)),
        ("2021-2020-part-000.parquet", ("2021", "2020", "year", "year_range_invalid")),
        ("2020-07-2020-05-part-000.parquet", ("2020-07", "2020-05", "month", "month_range_invalid")),
        ("2020-13-part-000.parquet", ("2020-13", "2020-13", "month", None)),
        ("part-000.parquet", (None, None, None, "unrecognized:part-000.parquet")),
    ],
)
def test_coverage(spark, name, want):
    r = spark.createDataFrame([(f"/x/bronze/unhcr/date=1/{name}",)], "p string").select(X.coverage(F.col("p")).alias("c"), X.source_id(F.col("p")).alias("s")).first()
    assert (tuple(r.c), r.s) == (want, "unhcr")


def test_text_steps(spark):
    df = spark.createDataFrame([("\t o'neil-SMITH \n",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(X.normalize(F.col("t"), ["strip", "title"])).collect()]
    assert got == ["O'Neil-Smith", None, ""]
    with pytest.raises(ValueError):
        X.normalize(F.col("t"), ["reverse"])
    assert X.glob_regex("*/a/*.parquet") == r"^.*/a/.*\.parquet$"


def test_casts_read_or_give_null(spark):
    df = spark.createDataFrame([("5",), ("5.0",), ("5.5",), ("n/a",), (None,), ("9007199254740993",)], "t string")
    assert [r[0] for r in df.select(read_as(F.col("t"), "BIGINT")).collect()] == [5, 5, None, None, None, 9007199254740993]
    flags = spark.createDataFrame([("True",), ("0",), ("x",)], "t string")
    assert [r[0] for r in flags.select(read_as(F.col("t"), "BOOLEAN")).collect()] == [True, False, None]


def test_dimension_lookup(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", "A"), (None, "none")], "code string, name string")
    got, lost = R.join_dimension(df, dim, {"left": "k", "right": "code"}, ["name"], alias="d_", required=True, reason="lost")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", "A"), (2, None, "none")]
    assert [tuple(r) for r in lost.collect()] == [(3, "z", "lost")]
    with pytest.raises(ValueError, match="repeated"):
        R.join_dimension(df, dim.union(dim), {"left": "k", "right": "code"}, ["name"])
    loose, _ = R.join_dimension(df, dim.union(dim), {"left": "k", "right": "code"}, ["name"], one_to_one=False)
    assert loose.count() == 3
    with pytest.raises(KeyError):
        R.join_dimension(df, dim, "nokey", ["name"])
    with pytest.raises(ValueError):
        R.join_dimension(df, dim, {"left": "k", "right": "code"}, ["name"], alias="x", rename={"name": "y"})


def test_rules_partition_the_rows(spark):
    df = spark.createDataFrame([(1990,), (1989,), (None,), (2036,)], "year int")
    for action in ("keep", "reject"):
        kept, lost = R.filter_rows(df, 'year >= 1990 and year <= 2035 and "a" == "a"', action, "bounds")
        assert kept.count() + lost.count() == 4
    assert R.filter_rows(df, "year >= 1990 and year <= 2035", "keep")[0].count() == 1
    assert R.filter_rows(df, "year in [1989]", "reject")[0].count() == 3
    with pytest.raises(ValueError):
        R.filter_rows(df, "true", "drop")


def test_diff(spark):
    make = lambda rows: spark.createDataFrame(rows, "k string, row_hash string")
    old, new = make([("A", "1"), ("B", "1"), ("C", "1"), (None, "n")]), make([("A", "1"), ("B", "2"), ("D", "1"), (None, "n")])
    assert tuple(R.diff_counts(old, new, ["k"]).first()) == (1, 1, 1)
    assert tuple(R.diff_counts(new, new, ["k"]).first()) == (0, 0, 0)
    with pytest.raises(RuntimeError):
        R.diff_counts(old.drop("row_hash"), new, ["k"])


def test_expansion(spark):
    rows = [("2020", "2021", "month"), ("2020-11", "2021-02", "year"), ("2021", "2020", "year"), ("2020", "2022", "year")]
    got = R.expand_partitions(spark.createDataFrame(rows, "start string, end string, route_grain string"))
    by = {}
    for r in got.collect():
        by.setdefault((r.start, r.route_grain), []).append(r.partition_key)
    assert len(by["2020", "month"]) == 24 and by["2020-11", "year"] == ["2020", "2021"] and by["2020", "year"] == ["2020", "2021", "2022"] and ("2021", "year") not in by


def test_checks_fail_alone(spark):
    cols = [{"name": "k", "type": "BIGINT", "nullable": False}, {"name": "v", "type": "INT", "dq": ">= 0"}, {"name": "year", "type": "INT"}]
    make = lambda rows: spark.createDataFrame(rows, "k long, v int, year int")
    tests = [{"reconcile": {"name": "small", "expression": "v < 100"}}]
    failed = lambda rows, ref=((1,), (2,)): {r.name for r in quality.run(make(rows), cols, ["k"], ("year", "year", "2020"), tests, [("k", spark.createDataFrame(list(ref), "id long"), "id")]).results if not r.passed}
    assert failed([(1, 1, 2020), (2, None, 2020)]) == set()
    assert failed([(1, 1, 2020), (1, 1, 2020)]) == {"pk_unique"}
    assert failed([(1, -1, 2020)]) == {"non_negative"}
    assert failed([(1, 100, 2020)]) == {"reconcile:small"}
    assert failed([(1, 1, 2021)]) == {"partition_matches_key"}
    assert failed([(1, 1, 2020), (2, 1, 2021)]) == {"partition_single_value"}
    assert failed([(3, 1, 2020)]) == {"ri:k->id"}
    assert failed([(None, 1, 2020)]) == {"pk_not_null", "not_null", "ri:k->id"}
    assert "non_empty" in failed([])
    assert {r.name for r in quality.run(make([]).drop("v"), cols).results if not r.passed} >= {"schema"}
    with pytest.raises(quality.GateError):
        quality.run(make([]), cols).gate()
    assert quality.bronze_policy(2021, 2020, 0, None, "")[0] == "CRITICAL" and quality.bronze_policy(2020, 2020, 1, 1, "x") == ("MINOR", [])


def test_transform_and_metric(spark):
    df = spark.createDataFrame([(1, None, 2020), (2, 3, 2021)], "a long, b long, year int")
    plan = {"select_map": {"x": "a", "y": "b"}, "defaults": {"z": 0}, "derivations": {"t": "COALESCE(x,0)+COALESCE(y,0)"}, "types": {"x": "INT", "t": "BIGINT"}, "order": ["t", "x", "z"]}
    out = transform(df, plan, F.col("year") == 2020)
    assert out.columns == ["t", "x", "z"] and [tuple(r) for r in out.collect()] == [(1, 1, 0)] and dict(out.dtypes)["x"] == "int"
    spec = {"name": "m", "formula": "a", "allowed_dimensions": ["year"], "record_set": {"filters": [{"expression": "a <> 1"}]}}
    assert [tuple(r) for r in metric(df, spec, ["year"]).collect()] == [(2021, 2)]
    with pytest.raises(ValueError):
        metric(df, spec, ["b"])


def test_optional_checks(spark):
    from cairn.operators import quality

    df = spark.createDataFrame([("SYR", "2024-01-02"), ("AFG", None), ("x1", None), (None, "2023-05-01")], "iso string, seen string")
    columns = [{"name": "iso", "type": "STRING"}, {"name": "seen", "type": "STRING"}]

    def found(*tests, rows=df):
        return {r.name: r.violations for r in quality.run(rows, columns, tests=list(tests)).results if ":" in r.name}

    iso = lambda least: {"coverage": {"column": "iso", "pattern": "^[A-Z]{3}$", "least": least}}
    assert found({"null_share": {"column": "seen", "most": 0.5}}, iso(0.5), {"freshness": {"column": "seen", "not_before": "2024-01-01"}}) == {"null_share:seen": 0, "coverage:iso": 0, "freshness:seen": 0}
    assert found({"null_share": {"column": "seen", "most": 0.4}}, iso(0.6), {"freshness": {"column": "seen", "not_before": "2024-02-01"}}) == {"null_share:seen": 2, "coverage:iso": 2, "freshness:seen": 1}
    assert found({"null_share": {"column": "gone", "most": 0}}) == {}
    assert found({"freshness": {"column": "seen", "not_before": "2024-01-01"}}, iso(1), rows=df.limit(0)) == {"freshness:seen": 1, "coverage:iso": 0}
