"""The engine's own operators over the driver's tables, each with the SQL its result must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import coverage, normalize
from cairn.functions.types import read_as
from cairn.operators import quality
from cairn.operators import relational as R
from cairn.plans import control
from cairn.plans.contracts import metric, transform

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return keep


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


ORDER_HASH = ["o_orderkey", "o_orderstatus", "day"]


def _orders(spark, d) -> DataFrame:
    o = t(spark, d, "orders")
    return o.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")).withColumn("year", F.year("o_orderdate"))


@query("""SELECT o_orderkey, sha256(o_orderkey || '|' || coalesce(o_orderstatus, '') || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS row_hash FROM orders""")
def row_hash(spark, d):
    return R.with_row_hash(_orders(spark, d), ORDER_HASH).select("o_orderkey", "row_hash")


@query("""WITH h AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, sha256(o_orderkey || '|' || o_orderstatus || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS h FROM orders)
SELECT year, sha256(string_agg(h, '|' ORDER BY h)) AS partition_hash FROM h GROUP BY year""")
def partition_hash(spark, d):
    return R.partition_hash(R.with_row_hash(_orders(spark, d), ORDER_HASH), ["year"])


@query("""WITH b AS (SELECT user_id, date_trunc('month', min(ts)) AS a, date_trunc('month', max(ts)) AS z FROM events GROUP BY user_id)
SELECT b.user_id, strftime(CAST(r.m AS TIMESTAMP), '%Y-%m') AS partition_key FROM b, LATERAL (SELECT unnest(range(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS m) r""")
def expand_months(spark, d):
    e = t(spark, d, "events").groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM").alias("start"), F.date_format(F.max("ts"), "yyyy-MM").alias("end"))
    return R.expand_partitions(e.withColumn("route_grain", F.lit("month"))).select("user_id", "partition_key")


@query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, d):
    return R.latest(t(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id"]).select("user_id", "event_type", "event_id")


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey AS h FROM orders WHERE o_orderstatus <> 'P'),
n AS (SELECT o_orderkey AS k, CASE WHEN year(o_orderdate) = 1995 THEN o_custkey + 1 ELSE o_custkey END AS h FROM orders WHERE o_orderstatus = 'P' OR year(o_orderdate) <> 1993)
SELECT count(*) FILTER (o.k IS NULL) AS inserts, count(*) FILTER (o.k IS NOT NULL AND n.k IS NOT NULL AND o.h <> n.h) AS updates, count(*) FILTER (n.k IS NULL) AS deletes FROM o FULL JOIN n ON o.k = n.k""")
def diff_iud(spark, d):
    """All orders, each in the old version, the new one or both: partial ones came, those of 1993 went, those of 1995 changed."""
    o = _orders(spark, d).withColumn("v", F.col("o_custkey"))
    old = R.with_row_hash(o.where("o_orderstatus <> 'P'"), ["o_orderkey", "v"])
    new = o.where("o_orderstatus = 'P' or year <> 1993").withColumn("v", F.when(F.col("year") == 1995, F.col("v") + 1).otherwise(F.col("v")))
    new = R.with_row_hash(new, ["o_orderkey", "v"])
    return R.diff_counts(old, new, ["o_orderkey"])


GOLD = {
    "select_map": {"nation": "n_name", "year": "year", "open_orders": "n_open", "filled": "n_filled", "partial": "n_partial"},
    "defaults": {"returned": 0},
    "derivations": {"active": "COALESCE(open_orders,0)+COALESCE(partial,0)", "total": "COALESCE(open_orders,0)+COALESCE(partial,0)+COALESCE(filled,0)"},
    "types": {"open_orders": "BIGINT", "filled": "BIGINT", "partial": "BIGINT", "returned": "BIGINT", "active": "BIGINT", "total": "BIGINT", "year": "INT"},
    "order": ["nation", "year", "open_orders", "filled", "partial", "returned", "active", "total"],
}


@query("""WITH s AS (SELECT n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'P') AS p
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE year(o_orderdate) = 1997 GROUP BY ALL)
SELECT nation, year, o AS open_orders, f AS filled, p AS partial, CAST(0 AS BIGINT) AS returned, o + p AS active, o + p + f AS total FROM s""")
def gold_stack(spark, d):
    o = _orders(spark, d).join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    status = lambda s: F.count_if(F.col("o_orderstatus") == s)
    counts = o.groupBy("n_name", "year").agg(status("O").alias("n_open"), status("F").alias("n_filled"), status("P").alias("n_partial"))
    return transform(counts, GOLD, F.col("year") == 1997)


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS unmatched FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) GROUP BY ALL""")
def anti_join_fk(spark, d):
    return quality.unmatched(_orders(spark, d), "o_custkey", t(spark, d, "customer").where("c_acctbal > 0"), "c_custkey").groupBy("year").agg(F.count("*").alias("unmatched"))


@query("""SELECT n_nationkey, '20' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS "start", '20' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS "end", 'year' AS grain FROM nation""")
def parse_tokens(spark, d):
    path = F.concat(F.lit("/x/bronze/s/20"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("-part-000.parquet"))
    return t(spark, d, "nation").select("n_nationkey", coverage(path).alias("c")).select("n_nationkey", "c.start", "c.end", "c.grain")


@query("""SELECT n_nationkey, TRY_CAST(CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS VARCHAR) ELSE n_name END AS BIGINT) AS n FROM nation""")
def try_cast_coerce(spark, d):
    text = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey").cast("string")).otherwise(F.col("n_name"))
    return t(spark, d, "nation").select("n_nationkey", read_as(text, "BIGINT").alias("n"))


@query("""SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998""")
def snapshot_project(spark, d):
    from cairn.sources.readers import typed_snapshot

    raw = _orders(spark, d).select(F.col("o_orderkey").cast("string").alias("Key"), F.col("o_custkey").cast("string").alias("Customer"), F.substring("day", 1, 4).alias("Year"))
    return typed_snapshot(raw, [("Key", "o_orderkey", "bigint"), ("Customer", "o_custkey", "bigint"), ("Year", "year", "int")], "year", 1996, 1998)


CUSTOMER = [{"name": "id", "type": "BIGINT", "source": ["cust_id", "c_custkey"]}, {"name": "segment", "type": "STRING", "source": ["c_mktsegment"]}, {"name": "nation", "type": "INT", "source": ["c_nationkey"]}, {"name": "phone", "type": "STRING", "source": ["c_phone_number"]}]


@query("""SELECT c_custkey AS id, c_mktsegment AS segment, c_nationkey AS nation, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS _run FROM customer""")
def harmonize(spark, d):
    return R.harmonize(t(spark, d, "customer"), CUSTOMER, ["_run"])


@query("""SELECT cn.n_name AS cust_n_name, sn.n_name AS supp_n_name, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY ALL""")
def dim_join_roles(spark, d):
    pairs = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"))
    nation = t(spark, d, "nation")
    one, _ = R.join_dimension(pairs, nation, {"left": "c_nationkey", "right": "n_nationkey"}, ["n_name"], alias="cust_")
    both, _ = R.join_dimension(one, nation, {"left": "s_nationkey", "right": "n_nationkey"}, ["n_name"], alias="supp_")
    return both.groupBy("cust_n_name", "supp_n_name").agg(F.sum("n").alias("n"))


@query("""SELECT c_custkey, 'nation_not_found' AS reject_reasons FROM customer WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey <= 2)""")
def dim_required_rejects(spark, d):
    _, lost = R.join_dimension(t(spark, d, "customer"), t(spark, d, "nation").where("n_regionkey <= 2"), {"left": "c_nationkey", "right": "n_nationkey"}, ["n_name"], required=True, reason="nation_not_found")
    return lost.select("c_custkey", "reject_reasons")


@query("""SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 1996 AND year(o_orderdate) <= 1998""")
def rule_keep(spark, d):
    return R.filter_rows(_orders(spark, d), "year >= 1996 and year <= 1998", "keep", "year_out_of_bounds")[0].select("o_orderkey")


@query("""SELECT c_custkey FROM customer WHERE NOT (c_acctbal < 0)""")
def rule_reject(spark, d):
    return R.filter_rows(t(spark, d, "customer"), "c_acctbal < 0", "reject", "negative")[0].select("c_custkey")


@query("""SELECT c_custkey, 'negative' AS reject_reasons FROM customer WHERE c_acctbal < 0""")
def rule_rejected_rows(spark, d):
    return R.filter_rows(t(spark, d, "customer"), "c_acctbal < 0", "reject", "negative")[1].select("c_custkey", "reject_reasons")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_tiebreak(spark, d):
    order = [{"column": "l_shipdate", "order": "desc"}, *({"column": c} for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))]
    return R.dedup(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _said(spark, report: quality.Report, names) -> DataFrame:
    rows = [(r.name, "passed" if r.passed else "failed", int(r.violations)) for r in report.results if r.name in names]
    return spark.createDataFrame(rows, "name string, status string, violations long")


_ROW = "SELECT '{0}' AS name, CASE WHEN v = 0 THEN 'passed' ELSE 'failed' END AS status, CAST(v AS BIGINT) AS violations FROM ({1}) q(v)"


@query(_ROW.format("pk_not_null", "SELECT count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) FROM lineitem") + " UNION ALL " + _ROW.format("pk_unique", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"))
def dq_pk(spark, d):
    return _said(spark, quality.run(t(spark, d, "lineitem"), [], ["l_orderkey", "l_linenumber"]), {"pk_not_null", "pk_unique"})


@query(_ROW.format("not_null", "SELECT count(*) FILTER (c_name IS NULL) + count(*) FILTER (c_nationkey IS NULL) FROM customer"))
def dq_not_null(spark, d):
    return _said(spark, quality.run(t(spark, d, "customer"), [], tests=[{"not_null": ["c_name", "c_nationkey"]}]), {"not_null"})


@query(_ROW.format("non_negative", "SELECT count(*) FILTER (c_acctbal < 0) FROM customer"))
def dq_non_negative(spark, d):
    return _said(spark, quality.run(t(spark, d, "customer"), [], tests=[{"non_negative": ["c_acctbal"]}]), {"non_negative"})


@query(_ROW.format("reconcile:price", "SELECT count(*) FILTER (NOT (l_extendedprice >= l_quantity)) FROM lineitem"))
def dq_reconcile(spark, d):
    return _said(spark, quality.run(t(spark, d, "lineitem"), [], tests=[{"reconcile": {"name": "price", "expression": "l_extendedprice >= l_quantity"}}]), {"reconcile:price"})


@query(_ROW.format("partition_single_value", "SELECT CAST(min(year(o_orderdate)) <> max(year(o_orderdate)) AS INTEGER) FROM orders") + " UNION ALL " + _ROW.format("partition_matches_key", "SELECT CAST(min(year(o_orderdate)) = max(year(o_orderdate)) AND min(year(o_orderdate)) <> 1997 AS INTEGER) FROM orders"))
def dq_partition(spark, d):
    return _said(spark, quality.run(_orders(spark, d), [], partition=("year", "year", "1997")), {"partition_single_value", "partition_matches_key"})


@query(_ROW.format("ri:o_custkey->c_custkey", "SELECT count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)"))
def dq_foreign_key(spark, d):
    return _said(spark, quality.run(t(spark, d, "orders"), [], foreign_keys=[("o_custkey", t(spark, d, "customer"), "c_custkey")]), {"ri:o_custkey->c_custkey"})


@query("""SELECT p_partkey, upper(trim(p_name)) AS up, lower(trim(p_name)) AS low FROM part""")
def normalize_ops(spark, d):
    return t(spark, d, "part").select("p_partkey", normalize(F.col("p_name"), ["strip", "upper"]).alias("up"), normalize(F.col("p_name"), ["strip", "lower"]).alias("low"))


def _files(spark, d) -> DataFrame:
    """A manifest made of documents: a source is a path's source, every fourth document is the next version of a path."""
    path = F.concat(F.lit("/bronze/"), F.col("source"), F.lit("/"), F.floor(F.col("doc_id") / 4).cast("string"), F.lit(".parquet"))
    year = (2000 + F.floor(F.col("doc_id") / 4) % 20).cast("string")
    return t(spark, d, "documents").select(F.col("source").alias("source_id"), path.alias("file_path"), F.col("doc_id").cast("string").alias("content_hash"), F.col("doc_id").alias("version"), year.alias("start"), year.alias("end"), F.timestamp_seconds("doc_id").alias("discovered_at"))


ROUTES = {"routes": [{"route_id": "one", "source_id": "src1", "pattern": "*/src1/*.parquet", "entity": "first", "grain": "year"}, {"route_id": "any", "pattern": "/bronze/*0.parquet", "entity": "second", "grain": "month"}, {"route_id": "off", "source_id": "src2", "entity": "third", "grain": "year", "enabled": False}]}
_FILES_SQL = """WITH f AS (SELECT source AS source_id, '/bronze/' || source || '/' || CAST(doc_id // 4 AS VARCHAR) || '.parquet' AS file_path, doc_id AS version, CAST(2000 + (doc_id // 4) % 20 AS VARCHAR) AS y FROM documents)"""


@query(_FILES_SQL + """ SELECT file_path, version, 'one' AS route_id, 'first' AS entity, y AS partition_key FROM f WHERE source_id = 'src1'
UNION ALL SELECT file_path, version, 'any', 'second', y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') FROM f, range(1, 13) r(m) WHERE file_path LIKE '%0.parquet'""")
def route_files(spark, d):
    return R.expand_partitions(control.route(_files(spark, d), control.routes(spark, ROUTES))).select("file_path", "version", "route_id", "entity", "partition_key")


@query(_FILES_SQL + """, l AS (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY version DESC) AS rn FROM f),
k AS (SELECT 'first' AS entity, y AS partition_key, version FROM l WHERE rn = 1 AND source_id = 'src1'
UNION ALL SELECT 'second', y || '-' || lpad(CAST(m AS VARCHAR), 2, '0'), version FROM l, range(1, 13) r(m) WHERE rn = 1 AND file_path LIKE '%0.parquet')
SELECT entity, partition_key, count(*) AS n_inputs, string_agg(CAST(version AS VARCHAR), ',' ORDER BY version) AS versions FROM k GROUP BY entity, partition_key""")
def plan_items(spark, d):
    """Every source, route and entity."""
    files = _files(spark, d)
    links = R.expand_partitions(control.route(files, control.routes(spark, ROUTES)))
    dirty = control.mark_dirty(spark.createDataFrame([], control.DIRTY), links, "2024-01-01")
    manifest = files.select("file_path", "content_hash", "discovered_at", F.col("start").alias("coverage_start"), F.col("end").alias("coverage_end"), F.lit("pending").alias("status"))
    plan = control.plan(dirty, links, manifest)
    return plan.select("entity", "partition_key", F.size("inputs").cast("long").alias("n_inputs"), F.array_join(F.transform("inputs", lambda i: i["content_hash"]), ",").alias("versions"))


@query(_FILES_SQL + """ SELECT file_path, version, version < max(version) OVER (PARTITION BY file_path) AS superseded FROM f""")
def manifest_supersede(spark, d):
    return control.supersede(_files(spark, d), "file_path", "version").select("file_path", "version", "superseded")


@query("""SELECT 'year' AS grain, strftime(o_orderdate, '%Y') AS partition_key, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'month', strftime(o_orderdate, '%Y-%m'), count(*) FROM orders GROUP BY ALL""")
def union_all_grains(spark, d):
    o = t(spark, d, "orders")
    of = lambda grain, form: o.groupBy(F.date_format("o_orderdate", form).alias("partition_key")).agg(F.count("*").alias("n")).withColumn("grain", F.lit(grain))
    return R.union_all([of("year", "yyyy"), of("month", "yyyy-MM")]).select("grain", "partition_key", "n")


METRIC = {"name": "customers", "formula": "one", "allowed_dimensions": ["r_name", "n_name"], "default_aggregation": "sum", "record_set": {"filters": [{"expression": "c_mktsegment <> 'BUILDING'"}]}}


@query("""SELECT r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment <> 'BUILDING' GROUP BY r_name""")
def metric_rollup(spark, d):
    rows = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return metric(rows.withColumn("one", F.lit(1).cast("long")), METRIC, ["r_name"])


def _more() -> None:
    from cairn import stage_queries

    QUERIES.update(stage_queries.QUERIES)
    SQL.update(stage_queries.SQL)


_more()
