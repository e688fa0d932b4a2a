"""Control plane: file versions, routes, dirty partitions, plans - as DataFrame transformations of control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import glob_regex
from cairn.operators.relational import expand_partitions

MANIFEST = "source_id string, file_path string, content_hash string, file_size bigint, coverage_start string, coverage_end string, grain string, discovered_at timestamp, processed_at timestamp, status string, run_id string, notes string"
ROUTER = "route_id string, source_id string, path_regex string, entity string, grain string, enabled boolean"
LINKS = "file_path string, content_hash string, entity string, partition_key string, route_id string, linked_at timestamp"
DIRTY = "entity string, partition_key string, reason string, first_seen_at timestamp, last_seen_at timestamp, status string"


def routes(spark, spec: dict) -> DataFrame:
    rows = [(r["route_id"], r.get("source_id"), glob_regex(r["pattern"]) if r.get("pattern") else None, r["entity"], r["grain"], r.get("enabled", True)) for r in spec.get("routes", [])]
    return spark.createDataFrame(rows, ROUTER)


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows replace old rows of the same key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def register(manifest: DataFrame, files: DataFrame, at: str, run_id: str) -> DataFrame:
    """The next manifest.  A path's new content is pending (failed if its name tells no coverage) and supersedes its
    older versions; content that comes back after a change is taken up again."""
    now = F.lit(at).cast("timestamp")
    seen = manifest.where("status in ('pending', 'processed', 'failed')").select("file_path", "content_hash")
    new = files.join(seen, ["file_path", "content_hash"], "left_anti")
    none = F.lit(None)
    fresh = new.select("source_id", "file_path", "content_hash", "file_size", "coverage_start", "coverage_end", "grain", now.alias("discovered_at"), none.cast("timestamp").alias("processed_at"), F.when(F.col("error").isNull(), "pending").otherwise("failed").alias("status"), F.lit(run_id).alias("run_id"), F.col("error").alias("notes"))
    back = fresh.select("file_path", "content_hash")
    changed = fresh.select("file_path").distinct().withColumn("changed", F.lit(True))
    old = manifest.join(back, ["file_path", "content_hash"], "left_anti").join(changed, "file_path", "left")
    old = old.withColumn("status", F.when(F.col("changed") & F.col("status").isin("pending", "processed"), F.lit("superseded")).otherwise(F.col("status"))).select(*manifest.columns)
    return old.unionByName(fresh)


def supersede(rows: DataFrame, path: str, at: str) -> DataFrame:
    """Flags every version of a path but its latest (ties are all latest)."""
    return rows.withColumn("superseded", F.col(at) < F.max(at).over(Window.partitionBy(path)))


def route(files: DataFrame, router: DataFrame, source_only: bool = False) -> DataFrame:
    """Files with every enabled route that fits: the same source, or a route for any, and a path that its pattern fits
    (``source_only``: routes of a source alone, whatever their patterns).

    Routes are a configuration that the driver read from one file, so they travel as literals: each file tries each of them
    where it lies, and nothing is joined or dealt out."""
    rows = [r.asDict() for r in router.where("enabled").collect()]  # as many as the file has
    rows = [r for r in rows if r["source_id"] is not None] if source_only else rows
    kind = "array<struct<route_id:string,entity:string,route_grain:string>>"
    if not rows:
        return files.withColumn("_r", F.explode(F.array().cast(kind))).select(*files.columns, "_r.*")
    tried = []
    for r in rows:
        fits = F.lit(True) if r["source_id"] is None else F.col("source_id") == r["source_id"]
        if r["path_regex"] is not None and not source_only:
            fits &= F.rlike("file_path", F.lit(r["path_regex"]))
        tried.append(F.when(fits, F.struct(F.lit(r["route_id"]).alias("route_id"), F.lit(r["entity"]).alias("entity"), F.lit(r["grain"]).alias("route_grain"))))
    return files.withColumn("_r", F.explode(F.filter(F.array(*tried), lambda x: x.isNotNull()))).select(*files.columns, "_r.*")


def link(manifest: DataFrame, router: DataFrame, links: DataFrame, at: str) -> DataFrame:
    """New links from the latest pending version of each path to its partitions."""
    w = Window.partitionBy("file_path")
    pending = manifest.where("status = 'pending'").withColumn("_last", F.max("discovered_at").over(w)).where("discovered_at = _last").drop("_last")
    keyed = expand_partitions(route(pending.withColumnsRenamed({"coverage_start": "start", "coverage_end": "end"}), router))
    rows = keyed.select("file_path", "content_hash", "entity", "partition_key", "route_id", F.lit(at).cast("timestamp").alias("linked_at")).dropDuplicates(["file_path", "content_hash", "entity", "partition_key"])
    return rows.join(links, ["file_path", "content_hash", "entity", "partition_key"], "left_anti").select(*rows.columns)


def mark_dirty(dirty: DataFrame, new_links: DataFrame, at: str) -> DataFrame:
    """The next dirty table: one row a partition; one that is dirty already is only seen again."""
    now = F.lit(at).cast("timestamp")
    hit = new_links.select("entity", "partition_key").distinct()
    again = dirty.join(hit.withColumn("_hit", F.lit(True)), ["entity", "partition_key"], "left")
    kept = again.withColumn("last_seen_at", F.when(F.col("_hit") & (F.col("status") == "dirty"), now).otherwise(F.col("last_seen_at"))).select(*dirty.columns)
    fresh = hit.join(dirty.where("status = 'dirty'"), ["entity", "partition_key"], "left_anti").select("entity", "partition_key", F.lit("new_file").alias("reason"), now.alias("first_seen_at"), now.alias("last_seen_at"), F.lit("dirty").alias("status"))
    return kept.join(fresh.select("entity", "partition_key"), ["entity", "partition_key"], "left_anti").unionByName(fresh)


def plan(dirty: DataFrame, links: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row a dirty partition, oldest first: entity, partition_key, inputs (latest version of each path, in the order
    of discovery; empty if there are none).  One query for all partitions."""
    d = dirty.where("status = 'dirty'").select("entity", "partition_key", "last_seen_at")
    m = manifest.where("status in ('pending', 'processed')").select("file_path", "content_hash", "discovered_at", "coverage_start", "coverage_end")
    pairs = links.select("entity", "partition_key", "file_path", "content_hash").join(m, ["file_path", "content_hash"])
    order = Window.partitionBy("entity", "partition_key", "file_path").orderBy(F.desc("discovered_at"), "content_hash")
    last = pairs.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")
    inputs = last.groupBy("entity", "partition_key").agg(F.array_sort(F.collect_list(F.struct("discovered_at", "file_path", "content_hash"))).alias("inputs"))
    empty = F.array().cast("array<struct<discovered_at:timestamp,file_path:string,content_hash:string>>")
    return d.join(inputs, ["entity", "partition_key"], "left").withColumn("inputs", F.coalesce("inputs", empty)).orderBy("last_seen_at", "entity", "partition_key")


def finish(manifest: DataFrame, dirty: DataFrame, entity: str, partition_key: str, inputs: list[dict], at: str) -> tuple[DataFrame, DataFrame]:
    """After a commit: the inputs are processed, the partition is clean."""
    used = manifest.sparkSession.createDataFrame([(i["file_path"], i["content_hash"], True) for i in inputs], "file_path string, content_hash string, _used boolean")
    m = manifest.join(F.broadcast(used), ["file_path", "content_hash"], "left")
    done = F.coalesce(F.col("_used") & (F.col("status") == "pending"), F.lit(False))
    m = m.withColumn("processed_at", F.when(done, F.lit(at).cast("timestamp")).otherwise(F.col("processed_at"))).withColumn("status", F.when(done, F.lit("processed")).otherwise(F.col("status"))).select(*manifest.columns)
    own = (F.col("entity") == entity) & (F.col("partition_key") == partition_key)
    return m, dirty.withColumn("status", F.when(own, F.lit("clean")).otherwise(F.col("status")))
