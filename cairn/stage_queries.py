"""Queries over whole stages, control tables, sources and sinks, each with the SQL its result must equal.

They write what they read back to a scratch folder of their own.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import coverage, normalize, source_id
from cairn.functions.types import read_as
from cairn.operators import quality
from cairn.operators import relational as R
from cairn.plans import control, publish
from cairn.plans.build import Warehouse, snapshot
from cairn.plans.contracts import Contract, canonicalize, exposed, metric, rollup, validate_metric
from cairn.session import scratch
from cairn.sources import readers

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return keep


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- sources and sinks


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def csv_scan(spark, d):
    """Text with semicolons and quotes, all columns as text."""
    path = f"{scratch(spark)}/csv"
    t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey").write.csv(path, sep=";", header=True, quoteAll=True)
    return readers.csv(spark, path, sep=";").select("c_custkey", "c_name", "c_nationkey")


def _by_region(spark, d) -> str:
    """Nations in a file a region, in folders whose names hold a space, a percent sign, and begin alike."""
    root = f"{scratch(spark)}/bronze"
    for r in range(5):
        folder = f"{root}/src{r}/a b%20" + "x" * r
        publish.write_file(t(spark, d, "nation").where(F.col("n_regionkey") == r), f"{folder}/{2000 + r}-{2001 + r}-part-000.parquet")
    return root


@query("SELECT n_nationkey, '/' || (2000 + n_regionkey) || '-' || (2001 + n_regionkey) || '-part-000.parquet' AS file, TRUE AS hashed, 'run' AS run FROM nation")
def provenance_scan(spark, d):
    """Every row with its own file and that file's hash, whatever the path holds."""
    facts = readers.file_facts(spark, _by_region(spark, d)).collect()  # one row a file
    rows = readers.parquet_inputs(spark, [f.asDict() for f in facts], "run")
    known = spark.createDataFrame([(f.content_hash, f.coverage_start) for f in facts], "h string, start string")
    name = F.regexp_extract("_bronze_file", "(/[^/]*)$", 1)
    joined = rows.join(known, F.col("_content_hash") == F.col("h"), "left")
    return joined.select("n_nationkey", name.alias("file"), F.startswith(name, F.concat(F.lit("/"), F.col("start"))).alias("hashed"), F.col("_ingest_run_id").alias("run"))


@query("""SELECT 'src' || r_regionkey AS source_id, CAST(2000 + r_regionkey AS VARCHAR) AS coverage_start, CAST(2001 + r_regionkey AS VARCHAR) AS coverage_end, 'year' AS grain, TRUE AS same_hash, 64 AS hash_length, TRUE AS has_bytes FROM region""")
def file_discovery(spark, d):
    """Facts about files; hashed whole and hashed in pieces alike."""
    root = _by_region(spark, d)
    whole, pieces = readers.file_facts(spark, root), readers.file_facts(spark, root, large_file=0)
    both = whole.join(pieces.select("file_path", F.col("content_hash").alias("other")), "file_path")
    return both.select("source_id", "coverage_start", "coverage_end", "grain", (F.col("content_hash") == F.col("other")).alias("same_hash"), F.length("content_hash").alias("hash_length"), (F.col("file_size") > 0).alias("has_bytes"))


ISO = "chr(65 + CAST(n_nationkey // 5 AS INTEGER)) || chr(65 + CAST(n_nationkey % 5 AS INTEGER)) || 'X'"


@query(f"SELECT CAST(row_number() OVER (ORDER BY {ISO}) AS INTEGER) AS country_id, {ISO} AS iso_country, n_name AS country_unsd, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def dimension_load(spark, d):
    """Raw text to a dimension table: names mapped, cells stripped, codes checked, keys numbered, written and read back."""
    root = scratch(spark)
    code = F.concat(F.char(65 + F.floor(F.col("n_nationkey") / 5)), F.char(65 + F.col("n_nationkey") % 5), F.lit("x"))
    raw = t(spark, d, "nation").select(F.concat(F.lit(" "), code, F.lit("\t")).alias("ISO3 Code"), F.concat(F.col("n_name"), F.lit("  ")).alias("UNSD Name"), F.col("n_regionkey").alias("Region"))
    raw.write.csv(f"{root}/raw", sep=";", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    names = {"ISO3 Code": "iso_country", "UNSD Name": "country_unsd"}
    return Warehouse(spark, root).build_dimension(f"{root}/raw", "countries", names, ["iso_country", "country_unsd", "region"])


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (year(o_orderdate) <> 1995 OR o_orderstatus = 'F') AS n FROM orders WHERE year(o_orderdate) NOT IN (1996, 1998) GROUP BY ALL""")
def partition_swap(spark, d):
    """One partition replaced, one emptied, the others as they were."""
    path = f"{scratch(spark)}/orders"
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")).where("year <> 1998")
    o.write.partitionBy("year").parquet(path)
    publish.swap_partition(o.where("o_orderstatus = 'F'"), path, "year", "year", "1995")
    publish.swap_partition(o.limit(0), path, "year", "year", "1996")
    return spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n"))


# --- control tables


def _commits(spark, d):
    rows = t(spark, d, "nation").select(F.col("n_name").alias("entity"), F.col("n_regionkey").cast("string").alias("partition_key"), F.lit("r").alias("run_id"), F.col("n_nationkey").alias("v"))
    return rows.where("v < 15"), rows.where("v >= 10").withColumn("v", F.col("v") + 100)


@query("SELECT n_name AS entity, CASE WHEN n_nationkey < 15 THEN n_nationkey ELSE n_nationkey + 100 END AS v FROM nation")
def commits_ignore(spark, d):
    return publish.insert_commits(*_commits(spark, d)).select("entity", "v")


@query("SELECT n_name AS entity, CASE WHEN n_nationkey < 10 THEN n_nationkey ELSE n_nationkey + 100 END AS v FROM nation")
def commits_replace(spark, d):
    return publish.insert_commits(*_commits(spark, d), "replace").select("entity", "v")


@query("SELECT n_name AS entity, CASE WHEN n_nationkey < 10 THEN n_nationkey ELSE n_nationkey + 100 END AS v FROM nation")
def router_upsert(spark, d):
    return control.upsert(*_commits(spark, d), ["entity"]).select("entity", "v")


@query("SELECT n_nationkey AS v FROM nation WHERE n_nationkey >= 5 UNION ALL SELECT n_nationkey FROM nation WHERE n_nationkey >= 20")
def control_versions(spark, d):
    """A table replaced, added to, and compacted; a write that was cut off does not count."""
    rows = t(spark, d, "nation").select(F.col("n_nationkey").alias("v"))
    table = publish.ControlTable(spark, scratch(spark), "t", "v bigint")
    table.append(rows)
    table.replace(rows.where("v >= 5"))
    rows.write.parquet(f"{table.base}/v=000000099.whole")
    publish.delete(spark, f"{table.base}/v=000000099.whole/_SUCCESS")
    table.append(rows.where("v >= 20"))
    table.compact()
    return table.read()


@query("SELECT 'partition_published' AS event_type, r_name AS dataset, r_regionkey AS n, 'x' || r_regionkey AS file_path, '{\"k\": ' || r_regionkey || '}' AS stats FROM region")
def lineage_events(spark, d):
    emitter = publish.TableEmitter(spark, scratch(spark))
    regions = t(spark, d, "region").collect()  # five rows
    made = [publish.Event("partition_published", "run", "1", "gold", r.r_name, rows=r.r_regionkey, stats={"k": r.r_regionkey}, inputs=(publish.Input("silver", r.r_name, f"x{r.r_regionkey}"),)) for r in regions]
    publish.emit(made[0], [emitter])
    publish.emit_all(made[1:], [emitter])
    inputs = emitter.inputs.read().select("event_id", "file_path")
    return emitter.events.read().join(inputs, "event_id").select("event_type", "dataset", F.col("rows").alias("n"), "file_path", "stats")


def _versions(spark, d) -> DataFrame:
    """Two sightings of files made of documents: the second changes every third and cannot read names that end in 7."""
    doc = t(spark, d, "documents")
    path = F.concat(F.lit("/bronze/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".parquet"))
    bad = F.when(F.col("doc_id") % 10 == 7, F.lit("unrecognized"))
    year = F.lit("2001")
    return doc.select(F.col("source").alias("source_id"), path.alias("file_path"), F.concat(F.lit("h"), F.col("doc_id").cast("string")).alias("content_hash"), F.lit(1).cast("bigint").alias("file_size"), year.alias("coverage_start"), year.alias("coverage_end"), F.lit("year").alias("grain"), bad.alias("error"), "doc_id")


@query("""WITH f AS (SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN 'failed' ELSE 'pending' END AS s FROM documents)
SELECT doc_id, 'h' || doc_id AS content_hash, CASE WHEN doc_id % 3 = 0 AND s = 'pending' THEN 'superseded' ELSE s END AS status FROM f UNION ALL SELECT doc_id, 'new' || doc_id, s FROM f WHERE doc_id % 3 = 0""")
def manifest_register(spark, d):
    """New versions are pending or failed and supersede their path's older ones; what is known already is not taken up again."""
    files = _versions(spark, d)
    first = control.register(spark.createDataFrame([], control.MANIFEST), files, "2024-01-01", "a")
    again = files.withColumn("content_hash", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("new"), F.col("doc_id").cast("string"))).otherwise(F.col("content_hash")))
    second = control.register(first, again, "2024-01-02", "b")
    return second.select(F.regexp_extract("file_path", r"/(\d+)\.parquet$", 1).cast("bigint").alias("doc_id"), "content_hash", "status")


ROUTES = {"routes": [{"route_id": "any", "entity": "all", "grain": "month"}, {"route_id": "one", "source_id": "src1", "entity": "one", "grain": "year"}]}


@query("""SELECT 'all' AS entity, '2001-' || lpad(CAST(m AS VARCHAR), 2, '0') AS partition_key, count(*) AS files FROM documents, range(1, 13) r(m) WHERE doc_id % 10 <> 7 AND doc_id % 2 = 0 GROUP BY ALL
UNION ALL SELECT 'one', '2001', count(*) FROM documents WHERE doc_id % 10 <> 7 AND doc_id % 2 = 0 AND source = 'src1' HAVING count(*) > 0""")
def new_links(spark, d):
    """Links of pending files that are not linked yet: the odd ones are."""
    manifest = control.register(spark.createDataFrame([], control.MANIFEST), _versions(spark, d), "2024-01-01", "a")
    router = control.routes(spark, ROUTES)
    every = control.link(manifest, router, spark.createDataFrame([], control.LINKS), "2024-01-01")
    odd = every.where(F.regexp_extract("file_path", r"/(\d+)\.parquet$", 1).cast("bigint") % 2 == 1)
    return control.link(manifest, router, odd, "2024-01-02").groupBy("entity", "partition_key").agg(F.count("*").alias("files"))


@query("""SELECT 'e' AS entity, CAST(r_regionkey AS VARCHAR) AS partition_key, CASE WHEN r_regionkey IN (0, 1) THEN 'late' ELSE 'new_file' END AS reason, r_regionkey <> 1 AS seen_again FROM region WHERE r_regionkey <> 4""")
def mark_dirty(spark, d):
    """Partitions hit once more are seen again; clean ones are taken up anew."""
    dirty = spark.createDataFrame([("e", "0", "late", None, None, "dirty"), ("e", "1", "late", None, None, "dirty"), ("e", "2", "late", None, None, "clean")], control.DIRTY)
    hit = t(spark, d, "region").where("r_regionkey not in (1, 4)").select(F.lit("e").alias("entity"), F.col("r_regionkey").cast("string").alias("partition_key"))
    out = control.mark_dirty(dirty, hit, "2024-01-01")
    return out.select("entity", "partition_key", "reason", F.col("last_seen_at").isNotNull().alias("seen_again"))


@query("SELECT row_number() OVER (ORDER BY n_regionkey, n_name DESC) AS place, n_name AS partition_key FROM nation")
def dirty_order(spark, d):
    """The order in which dirty partitions are built: by when they were last seen, then entity and key."""
    at = F.timestamp_seconds(F.col("n_regionkey"))
    entity = F.lpad((100 - F.rank().over(_all().orderBy("n_name"))).cast("string"), 3, "0")
    dirty = t(spark, d, "nation").select(entity.alias("entity"), F.col("n_name").alias("partition_key"), F.lit("x").alias("reason"), at.alias("first_seen_at"), at.alias("last_seen_at"), F.lit("dirty").alias("status"))
    plan = control.plan(dirty, spark.createDataFrame([], control.LINKS), spark.createDataFrame([], control.MANIFEST)).collect()  # a row a partition
    return spark.createDataFrame([(i + 1, r.partition_key) for i, r in enumerate(plan)], "place bigint, partition_key string")


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))  # 25 nations


@query("""SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN 'failed' WHEN doc_id < 5 THEN 'processed' ELSE 'pending' END AS status, doc_id < 5 AS stamped FROM documents""")
def finish_partition(spark, d):
    """After a commit its inputs are processed and nothing else changes."""
    files = _versions(spark, d)
    manifest = control.register(spark.createDataFrame([], control.MANIFEST), files, "2024-01-01", "a")
    used = [r.asDict() for r in files.where("doc_id < 5").select("file_path", "content_hash").collect()]  # five rows
    m, _ = control.finish(manifest, spark.createDataFrame([], control.DIRTY), "e", "2001", used, "2024-01-02")
    return m.select(F.regexp_extract("file_path", r"/(\d+)\.parquet$", 1).cast("bigint").alias("doc_id"), "status", F.col("processed_at").isNotNull().alias("stamped"))


# --- contracts

SILVER = {
    "entity": "order_states", "grain": "year",
    "contract": {"primary_key": ["id"], "partitions": ["year"], "lineage": ["_ingest_run_id"], "columns": [
        {"name": "cust_n_name", "type": "STRING"}, {"name": "id", "type": "BIGINT", "nullable": False, "source": ["key", "o_orderkey"]}, {"name": "nation", "type": "INT", "source": ["c_nationkey"]},
        {"name": "status", "type": "STRING", "source": ["o_orderstatus"]}, {"name": "year", "type": "INT", "source": ["year"]}]},
    "canonicalizer": {"input": {"normalize": {"status": ["strip", "lower"]}}, "dims": [{"name": "nations", "on_keys": {"l": "nation", "r": "n_nationkey"}, "select": ["n_name"], "alias": "cust_", "required": True}],
        "rules": [{"when": "year >= 1993", "action": "keep", "reject_reason": "year"}, {"when": 'status == "p"', "action": "reject", "reject_reason": "partial"}],
        "dedup": {"key": ["id"], "tiebreak": [{"column": "nation", "order": "desc"}]}, "row_hash": {"columns": ["id", "status"]}},
}
_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


def _silver(spark, d):
    o = t(spark, d, "orders").withColumn("year", F.year("o_orderdate")).join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.withColumn("o_orderstatus", F.concat(F.lit(" "), F.col("o_orderstatus")))
    return canonicalize(o, Contract.of(SILVER), {"nations": t(spark, d, "nation").where("n_regionkey <= 2")})


@query(f"""SELECT n_name AS cust_n_name, o_orderkey AS id, CAST(c_nationkey AS INTEGER) AS nation, lower(o_orderstatus) AS status, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(NULL AS VARCHAR) AS _ingest_run_id,
sha256(o_orderkey || '|' || lower(o_orderstatus)) AS row_hash FROM {_ORDERS} WHERE n_regionkey <= 2 AND year(o_orderdate) >= 1993 AND o_orderstatus <> 'P'""")
def silver_rows(spark, d):
    return _silver(spark, d)[0]


@query(f"""SELECT o_orderkey AS id, CASE WHEN n_regionkey > 2 THEN 'nations_not_found' WHEN year(o_orderdate) < 1993 THEN 'year' ELSE 'partial' END AS reject_reasons FROM {_ORDERS}
WHERE n_regionkey > 2 OR year(o_orderdate) < 1993 OR o_orderstatus = 'P'""")
def silver_rejects(spark, d):
    return _silver(spark, d)[1].select("id", "reject_reasons")


@query(f"""SELECT n_name AS cust_n_name, o_orderkey AS id, CAST(c_nationkey AS INTEGER) AS nation, lower(o_orderstatus) AS status, CAST(year(o_orderdate) AS INTEGER) AS year FROM {_ORDERS} WHERE n_regionkey <= 2 AND year(o_orderdate) >= 1993 AND o_orderstatus <> 'P'""")
def exposure_view(spark, d):
    return exposed(_silver(spark, d)[0], Contract.of(SILVER))


@query("SELECT n_name AS \"a b\", CAST(NULL AS BIGINT) AS gone, n_nationkey AS \"x-y\" FROM nation")
def ensure_columns(spark, d):
    """Columns whose names must be quoted, one of them missing."""
    df = t(spark, d, "nation").select(F.col("n_nationkey").alias("x-y"), F.col("n_name").alias("a b"), "n_regionkey")
    return R.ensure(df, ["a b", "gone", "x-y"], {"gone": "BIGINT"})


@query("""SELECT count(*) AS rows_in, count(*) FILTER (n_regionkey <= 2) AS rows_out, count(*) FILTER (n_regionkey > 2) AS rejected, count(*) FILTER (n_regionkey > 2) AS unmatched, count(*) FILTER (n_regionkey <= 2) AS matched
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def dim_join_metrics(spark, d):
    c, n = t(spark, d, "customer"), t(spark, d, "nation").where("n_regionkey <= 2")
    got, lost = R.join_dimension(c, n, {"left": "c_nationkey", "right": "n_nationkey"}, ["n_name"], required=True)
    m = R.join_metrics(c, got, lost, True, ["n_name"])
    return spark.createDataFrame([tuple(m.values())], ", ".join(f"{k} bigint" for k in m))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return quality.duplicated_keys(t(spark, d, "lineitem"), ["l_orderkey"]).withColumnRenamed("count", "n")


@query("""SELECT r_name, CAST(sum(n_nationkey) AS BIGINT) AS total, max(n_name) AS last FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def rollup_hints(spark, d):
    """Columns added up as the contract's hints say."""
    rows = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", F.col("n_nationkey").alias("total"), F.col("n_name").alias("last"))
    return rollup(rows, [{"name": "r_name"}, {"name": "total", "agg": "sum"}, {"name": "last", "agg": "max"}], ["r_name"])


METRIC = {"name": "balance", "formula": "c_acctbal", "allowed_dimensions": ["c_nationkey"], "record_set": {"filters": [{"expression": "c_mktsegment <> 'BUILDING'"}]}, "validations": ["non_negative", {"equals_components": {"expression": "c_acctbal == whole + rest"}}]}


@query("""SELECT count(*) FILTER (c_acctbal < 0) AS non_negative, count(*) FILTER (c_custkey % 2 = 0) AS equals_components FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def metric_validations(spark, d):
    c = t(spark, d, "customer").withColumns({"whole": F.col("c_acctbal"), "rest": (F.col("c_custkey") % 2 == 0).cast("double")})
    found = validate_metric(c, METRIC)
    return spark.createDataFrame([(found["non_negative"], found["equals_components"])], "non_negative bigint, equals_components bigint")


@query("SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey")
def metric_strict(spark, d):
    """A metric whose validations hold."""
    spec = {"name": "customers", "formula": "one", "allowed_dimensions": ["c_nationkey"], "validations": ["non_negative", {"equals_components": {"expression": "one = 1"}}]}
    return metric(t(spark, d, "customer").withColumn("one", F.lit(1).cast("bigint")), spec, ["c_nationkey"], strict=True)


# --- scalars


@query("""SELECT event_id, sha256(event_id || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(event_id % 999983 + 1 AS VARCHAR), 6, '0') || '|' || '{"a":' || user_id || ',"b":"' || event_type || '"}') AS row_hash FROM events""")
def row_hash_fractions(spark, d):
    """Fractions of a second count, and a nested value's keys are in order."""
    e = t(spark, d, "events")
    at = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 999983 + 1).cast("decimal(18,6)") / 1000000)
    df = e.select("event_id", at.alias("moment"), F.struct(F.col("event_type").alias("b"), F.col("user_id").alias("a")).alias("nested"))
    return R.with_row_hash(df, ["event_id", "moment", "nested"]).select("event_id", "row_hash")


@query("""SELECT n_nationkey, upper(n_name[1:1]) || lower(n_name[2:]) || '''' || upper(n_name[1:1]) || lower(n_name[2:]) AS titled, 's' || n_regionkey AS source FROM nation WHERE n_name NOT LIKE '% %' UNION ALL SELECT n_nationkey, NULL, 's' || n_regionkey FROM nation WHERE n_name LIKE '% %'""")
def title_and_source(spark, d):
    n = t(spark, d, "nation")
    titled = normalize(F.concat(F.lit("\t"), F.lower("n_name"), F.lit("'"), F.col("n_name"), F.lit(" \n")), ["strip", "title"])
    path = F.concat(F.lit("/x/bronze/s"), F.col("n_regionkey").cast("string"), F.lit("/f.parquet"))
    return n.select("n_nationkey", F.when(~F.col("n_name").contains(" "), titled).alias("titled"), source_id(path).alias("source"))


@query("""SELECT n_nationkey, n_nationkey % 2 = 1 AS flag, CAST(n_nationkey AS DOUBLE) / 2 AS half, DATE '2020-01-01' + CAST(n_nationkey AS INTEGER) AS day, CAST(CASE WHEN n_nationkey < 20 THEN n_nationkey END AS INTEGER) AS small FROM nation""")
def cast_set(spark, d):
    """Every contract type read from text; what cannot be read is null."""
    k = F.col("n_nationkey")
    day = F.date_add(F.lit("2020-01-01").cast("date"), k.cast("int")).cast("string")
    flag = F.when(k % 4 == 1, "TRUE").when(k % 4 == 3, "1").when(k % 4 == 2, "0").otherwise("false")
    small = F.when(k < 20, k.cast("string")).otherwise("n/a")
    return t(spark, d, "nation").select("n_nationkey", read_as(flag, "BOOL").alias("flag"), read_as((k / 2).cast("string"), "FLOAT8").alias("half"), read_as(day, "DATE").alias("day"), read_as(small, "INT4").alias("small"))


_COVER = """VALUES ('2020-2021', '2020', '2021', 'year', NULL), ('2020', '2020', '2020', 'year', NULL), ('2020-05', '2020-05', '2020-05', 'month', NULL), ('2020-05-2020-07', '2020-05', '2020-07', 'month', NULL),
('2021-2020', '2021', '2020', 'year', 'year_range_invalid'), ('2020-07-2020-05', '2020-07', '2020-05', 'month', 'month_range_invalid'), ('2020-13', '2020-13', '2020-13', 'month', NULL), ('20x', NULL, NULL, NULL, 'unrecognized:20x-part-0.parquet')"""


@query(f'SELECT token, "start", "end", grain, error, r_regionkey FROM region, ({_COVER}) v(token, "start", "end", grain, error)')
def coverage_forms(spark, d):
    """Every form that a file name tells its coverage in."""
    tokens = F.explode(F.array(*map(F.lit, ("2020-2021", "2020", "2020-05", "2020-05-2020-07", "2021-2020", "2020-07-2020-05", "2020-13", "20x"))))
    rows = t(spark, d, "region").select("r_regionkey", tokens.alias("token"))
    return rows.withColumn("c", coverage(F.concat(F.lit("/b/"), F.col("token"), F.lit("-part-0.parquet")))).select("token", "c.start", "c.end", "c.grain", "c.error", "r_regionkey")


# --- the gate


def _status(spark, report: quality.Report) -> DataFrame:
    return spark.createDataFrame([(r.name, "passed" if r.passed else "failed", int(r.violations)) for r in report.results], "name string, status string, violations long")


@query("""SELECT * FROM (VALUES ('schema', 'failed', 1), ('types_match', 'failed', 1), ('pk_not_null', 'passed', 0), ('non_empty', 'passed', 0), ('pk_unique', 'passed', 0)) v(name, status, violations)
UNION ALL SELECT 'not_null', 'failed', count(*) FROM customer
UNION ALL SELECT 'row_hash_length', 'failed', count(*) FILTER (c_custkey % 2 = 0) FROM customer
UNION ALL SELECT 'unique:c_nationkey', 'failed', count(*) FROM (SELECT 1 FROM customer GROUP BY c_nationkey HAVING count(*) > 1)""")
def dq_contract(spark, d):
    """Columns that are missing, of another type, without a stamp, and a hash of the wrong length."""
    c = t(spark, d, "customer").withColumns({"row_hash": F.sha2(F.col("c_name"), 256), "_run": F.lit(None).cast("string")})
    c = c.withColumn("row_hash", F.when(F.col("c_custkey") % 2 == 0, F.substring("row_hash", 1, 9)).otherwise(F.col("row_hash")))
    columns = [{"name": "c_custkey", "type": "INT8"}, {"name": "c_name", "type": "CHARACTER VARYING"}, {"name": "c_nationkey", "type": "DATE"}, {"name": "c_fax", "type": "TEXT"}]
    return _status(spark, quality.run(c, columns, ["c_custkey"], tests=[{"unique": ["c_nationkey"]}], more=["row_hash"], stamped=["_run"]))


@query("""SELECT 'partition_single_value' AS name, CASE WHEN count(DISTINCT strftime(o_orderdate, '%Y-%m')) <= 1 THEN 'passed' ELSE 'failed' END AS status, CAST(count(DISTINCT strftime(o_orderdate, '%Y-%m')) > 1 AS BIGINT) AS violations FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) = 3
UNION ALL SELECT 'partition_matches_key', CASE WHEN count(*) = 0 THEN 'passed' ELSE 'failed' END, CAST(count(*) > 0 AS BIGINT) FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) = 3""")
def dq_month(spark, d):
    """A month's rows against the key of another month."""
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")).where("year(day) = 1995 and month(day) = 3")
    out = _status(spark, quality.run(o, [], partition=("day", "month", "1995-04")))
    return out.where("name like 'partition%'")


@query("""SELECT 'null_share:c_name' AS name, 0 AS violations UNION ALL SELECT 'coverage:c_mktsegment', count(*) FILTER (NOT regexp_matches(c_mktsegment, '^[A-H]')) FROM customer UNION ALL SELECT 'freshness:day', 1""")
def dq_optional(spark, d):
    c = t(spark, d, "customer").withColumn("day", F.lit("2020-01-01"))
    tests = [{"null_share": {"column": "c_name", "most": 0.1}}, {"coverage": {"column": "c_mktsegment", "pattern": "^[A-H]", "least": 1}}, {"freshness": {"column": "day", "not_before": "2021-01-01"}}]
    return _status(spark, quality.run(c, [], tests=tests)).where("name like '%:%'").select("name", "violations")


@query("SELECT r_regionkey, CASE WHEN r_regionkey = 0 THEN 'MINOR' ELSE 'CRITICAL' END AS severity, CASE r_regionkey WHEN 0 THEN '' WHEN 1 THEN 'bad_year_range' WHEN 2 THEN 'zero_records' WHEN 3 THEN 'zero_bytes' ELSE 'no_hash' END AS notes FROM region")
def bronze_policy(spark, d):
    rows = []
    for r in t(spark, d, "region").collect():  # five rows
        k = r.r_regionkey
        severity, notes = quality.bronze_policy(2021 if k == 1 else 2020, 2020, 0 if k == 2 else 1, 0 if k == 3 else 1, "" if k == 4 else "x")
        rows.append((k, severity, ",".join(notes)))
    return spark.createDataFrame(rows, "r_regionkey bigint, severity string, notes string")


# --- the stages, from text to a mart

STATES = {
    "entity": "states", "grain": "year",
    "contract": {"primary_key": ["nation", "year"], "partitions": ["year"], "lineage": ["_ingest_run_id"], "columns": [{"name": "nation", "type": "BIGINT", "nullable": False, "source": ["nation"]}, {"name": "orders", "type": "BIGINT", "dq": ">= 0", "source": ["orders"]}, {"name": "year", "type": "INT", "source": ["year"]}]},
    "canonicalizer": {"rules": [{"when": "nation < 20", "action": "keep", "reject_reason": "far"}], "row_hash": {"columns": ["nation", "year", "orders"]}},
}
MART = {
    "entity": "mart", "grain": "year", "contract": {"primary_key": ["nation", "year"], "partitions": ["year"], "lineage_columns": [{"name": "_ingest_run_id"}, {"name": "_built_at"}], "tests": [{"non_negative": ["twice"]}, {"reconcile": {"name": "double", "expression": "twice = orders * 2"}}]},
    "columns": [{"name": "nation", "type": "BIGINT", "nullable": False}, {"name": "orders", "type": "BIGINT"}, {"name": "twice", "type": "BIGINT"}, {"name": "year", "type": "INT"}],
    "transform": {"source": "silver.states", "select_map": {"nation": "nation", "orders": "orders", "year": "year"}, "derivations": {"twice": "orders*2"}, "types": {"twice": "BIGINT"}, "order": ["nation", "orders", "twice", "year"]},
}


@query("""WITH c AS (SELECT c_nationkey AS nation, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) IN (1996, 1997) GROUP BY ALL),
k AS (SELECT y, count(*) AS rows_in, count(*) FILTER (nation < 20) AS rows_out FROM c GROUP BY y),
all_rows AS (SELECT sum(rows_in) AS n FROM k)
SELECT 'states' AS entity, CAST(y AS VARCHAR) AS partition_key, 'silver' AS layer, CAST(all_rows.n AS BIGINT) AS rows_in, rows_out, CAST(rows_in - rows_out AS BIGINT) AS rows_rejected, rows_out AS inserts, 'passed' AS dq_status, TRUE AS promoted FROM k, all_rows
UNION ALL SELECT 'mart', '1996', 'gold', rows_out, rows_out, CAST(0 AS BIGINT), rows_out, 'passed', TRUE FROM k WHERE y = 1996""")
def stages_commits(spark, d):
    """Snapshot, discovery, silver, gold: the commit log of two partitions and a mart."""
    root = scratch(spark)
    counts = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.year("o_orderdate").alias("Year"), F.col("c_nationkey").alias("Nation")).agg(F.count("*").alias("Orders"))
    counts.coalesce(1).write.csv(f"{root}/raw", header=True)
    columns = [("Year", "year", "int"), ("Nation", "nation", "bigint"), ("Orders", "orders", "bigint")]
    made = [snapshot(spark, f"{root}/raw", f"{root}/bronze/src", columns, 1996, 1997, "1") for _ in range(2)]
    if made[0]["severity"] != "MINOR" or made[1].get("note") != "exists":
        raise RuntimeError(f"the snapshot is not as it should be: {made}")
    summary = json.loads(publish.get_text(spark, f"{root}/bronze/src/date=1/_dq_summary.json"))
    w = Warehouse(spark, f"{root}/lake")
    routes = {"routes": [{"route_id": "r", "pattern": "*/bronze/*.parquet", "entity": "states", "grain": "year"}]}
    w.discover(f"{root}/bronze", routes, "run", datetime(2024, 1, 1, tzinfo=UTC))
    w.build_silver(STATES, {}, "run")
    w.build_gold(MART, "1996", "run", {})
    if summary["records"] != made[0]["records"]:
        raise RuntimeError("the summary beside the snapshot tells another number of records")
    return w.commits.read().select("entity", "partition_key", "layer", "rows_in", "rows_out", "rows_rejected", "inserts", "dq_status", "promoted")
