"""The stages: snapshot, discover, silver, gold.  Everything is lazy up to the gate; nothing is written before it."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import quality
from cairn.operators.relational import diff_counts, partition_hash, with_row_hash
from cairn.plans import control as C
from cairn.plans import publish as P
from cairn.plans.contracts import Contract, canonicalize, exposed, transform
from cairn.sources import readers


def snapshot(spark: SparkSession, raw: str, out: str, columns: list[tuple[str, str, str]], start: int, cutoff: int, version: str, overwrite: bool = False) -> dict:
    """CSV to one immutable Parquet file, date=<version>/<start>-<cutoff>-part-000.parquet, and a summary beside it."""
    base = f"{out.rstrip('/')}/date={version}"
    path = f"{base}/{start}-{cutoff}-part-000.parquet"
    if P.exists(spark, path) and not overwrite:
        return {"path": path, "note": "exists"}
    with P.StageTimer() as t:
        df = readers.typed_snapshot(readers.csv(spark, raw), columns, "year", start, cutoff)
        P.write_file(df, path)
    facts = readers.file_facts(spark, path).agg(F.sum("file_size"), F.max("content_hash")).first()
    records = spark.read.parquet(path).count()
    severity, notes = quality.bronze_policy(start, cutoff, records, facts[0], facts[1])
    summary = {"path": path, "records": records, "bytes": facts[0], "content_hash": facts[1], "severity": severity, "notes": notes}
    P.put_text(spark, f"{base}/_dq_summary.json", P.to_json(summary))
    return summary | {"duration_sec": t.duration_sec}


class Warehouse:
    """Data and control tables below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        table = lambda n, s: P.ControlTable(spark, f"{self.root}/control", n, s)
        self.manifest, self.router, self.links, self.dirty, self.commits = table("manifest", C.MANIFEST), table("router", C.ROUTER), table("links", C.LINKS), table("dirty", C.DIRTY), table("commits", P.COMMITS)
        self.lineage = P.TableEmitter(spark, f"{self.root}/control")

    def read(self, entity: str) -> DataFrame | None:
        path = f"{self.root}/{entity}"
        return self.spark.read.parquet(path) if P.exists(self.spark, path) else None

    def discover(self, bronze: str, routes: dict, run_id: str, at: datetime | None = None) -> None:
        now = (at or datetime.now(UTC)).strftime("%Y-%m-%d %H:%M:%S.%f")
        self.router.replace(C.upsert(self.router.read(), C.routes(self.spark, routes), ["route_id"]))
        self.manifest.replace(C.register(self.manifest.read(), readers.file_facts(self.spark, bronze), now, run_id))
        fresh = C.link(self.manifest.read(), self.router.read(), self.links.read(), now)
        self.links.append(fresh)
        stamped = self.links.read().where(F.col("linked_at") == F.lit(now).cast("timestamp"))
        self.dirty.replace(C.mark_dirty(self.dirty.read(), stamped, now))
        seen = self.manifest.read().where(F.col("discovered_at") == F.lit(now).cast("timestamp")).groupBy("source_id").agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"), F.count_if(F.col("status") == "failed").alias("failed"))
        events = [P.Event("discover", run_id, "1", "bronze", r.source_id, rows=r.files, stats={"bytes": r.bytes, "failed": r.failed}) for r in seen.collect()]  # one row a source
        P.emit_all(events, [self.lineage])

    def publish(self, df: DataFrame, contract: Contract, key: str, layer: str, run_id: str, rows_in: int, rejected: int, report: quality.Report, inputs: list[P.Input]) -> dict:
        column, path = contract.partitions[0], f"{self.root}/{contract.entity}"
        before = self.read(contract.entity)
        old = before.where(P.partition_predicate(column, contract.grain, key)) if before is not None else df.limit(0)
        counts = diff_counts(old, df, contract.key).first().asDict()
        digest = partition_hash(df, [column]).first()
        rows = df.count()
        P.swap_partition(df, path, column, contract.grain, key)
        row = (contract.entity, key, run_id, layer, rows_in, rows, rejected, counts["inserts"], counts["updates"], counts["deletes"], digest["partition_hash"] if digest else None, report.status, report.status == "passed", datetime.now(UTC))
        self.commits.append(P.new_commits(self.commits.read(), self.spark.createDataFrame([row], P.COMMITS)))
        P.emit(P.Event("partition_published", run_id, "1", layer, contract.entity, key, rows, row[10], report.status, counts, tuple(inputs)), [self.lineage])
        return counts | {"rows": rows, "partition_hash": row[10], "rejected": rejected}

    def build_silver(self, spec: dict, dims: dict[str, DataFrame], run_id: str) -> list[dict]:
        contract, done = Contract.of(spec), []
        for item in C.plan(self.dirty.read(), self.links.read(), self.manifest.read()).where(F.col("entity") == contract.entity).collect():  # one row a partition
            inputs = [i.asDict() for i in item.inputs]
            raw = readers.parquet_inputs(self.spark, inputs, run_id)
            if raw is None:
                continue
            rows, lost = canonicalize(raw, contract, dims, item.partition_key)
            stamp = {"_build_at": F.lit(datetime.now(UTC).isoformat()), "_ingest_run_id": F.lit(run_id), "_transform_version": F.lit("1")}
            rows = rows.withColumns({k: v for k, v in stamp.items() if k in rows.columns}).persist()
            try:
                more = [*contract.body.get("canonicalizer", {}).get("output", {}).get("extra", []), *contract.lineage, "row_hash"]
                report = quality.run(rows, contract.columns, contract.key, (contract.partitions[0], contract.grain, item.partition_key), more=more)
                P.emit(P.Event("transform_run", run_id, "1", "silver", contract.entity, item.partition_key, dq_status=report.status, stats=report.summary, inputs=tuple(P.Input("bronze", i["file_path"].rsplit("/", 1)[0], i["file_path"], i["content_hash"]) for i in inputs)), [self.lineage])
                report.gate()
                lost.select(F.lit(contract.entity).alias("entity"), F.lit(item.partition_key).alias("partition_key"), F.lit(run_id).alias("run_id"), "reject_reasons", F.to_json(F.struct("*")).alias("payload")).write.mode("append").parquet(f"{self.root}/rejects")
                out = self.publish(rows, contract, item.partition_key, "silver", run_id, raw.count(), lost.count(), report, [P.Input("bronze", i["file_path"].rsplit("/", 1)[0], i["file_path"], i["content_hash"]) for i in inputs])
            finally:
                rows.unpersist()
            m, d = C.finish(self.manifest.read(), self.dirty.read(), contract.entity, item.partition_key, inputs, datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f"))
            self.manifest.replace(m)
            self.dirty.replace(d)
            done.append({"partition_key": item.partition_key} | out)
        return done

    def build_gold(self, spec: dict, key: str, run_id: str, refs: dict[str, DataFrame]) -> dict:
        """One partition from promoted silver."""
        contract, plan = Contract.of(spec), spec["transform"]
        entity = plan["source"].split(".")[-1]
        promoted = self.commits.read().where((F.col("entity") == entity) & (F.col("partition_key") == key) & F.col("promoted"))
        if promoted.isEmpty():
            raise quality.GateError(f"{entity} {key} is not promoted")
        source = self.read(entity)
        df = transform(source, plan, P.partition_predicate(contract.partitions[0], contract.grain, key))
        df = df.withColumns({"_ingest_run_id": F.lit(run_id), "_transform_version": F.lit(1).cast("bigint"), "_built_at": F.lit(datetime.now(UTC))})
        df = with_row_hash(df, [c["name"] for c in contract.columns if not c["name"].startswith("_")]).persist()
        try:
            keys = [(f["column"], refs[t], k) for f in contract.foreign_keys for t, k in [quality.reference(f["references"])] if t in refs]
            report = quality.run(df, contract.columns, contract.key, (contract.partitions[0], contract.grain, key), contract.tests, keys, stamped=contract.lineage)
            P.emit(P.Event("transform_run", run_id, "1", "gold", contract.entity, key, dq_status=report.status, stats=report.summary, inputs=(P.Input("silver", entity),)), [self.lineage])
            report.gate()
            return self.publish(df, contract, key, "gold", run_id, df.count(), 0, report, [P.Input("silver", entity)])
        finally:
            df.unpersist()

    def build_dimension(self, raw: str, name: str, names: dict[str, str], keep: list[str]) -> DataFrame:
        """The country dimension: semicolon-separated text to one Parquet table, written whole and read back."""
        dim = readers.country_dimension(readers.csv(self.spark, raw, sep=";"), names).select("country_id", *keep)
        twice = quality.duplicated_keys(dim, ["iso_country"]).limit(5).collect()
        if twice:
            raise ValueError(f"codes that repeat: {[r.iso_country for r in twice]}")
        path = f"{self.root}/dims/{name}"
        dim.coalesce(1).write.mode("overwrite").parquet(path)  # some 250 rows
        return self.spark.read.parquet(path)

    def expose(self, spec: dict, name: str | None = None) -> DataFrame:
        """A temporary view of an entity without lineage and row hash; returns it."""
        contract = Contract.of(spec)
        rows = self.read(contract.entity)
        if rows is None:
            raise ValueError(f"{contract.entity} is not built")
        view = exposed(rows, contract)
        view.createOrReplaceTempView(name or f"{contract.entity}_exposed")
        return view

    def replay(self, *entities: str) -> None:
        """Drops what was built and marks every partition dirty again; snapshots and manifest stay."""
        for e in entities:
            P.delete(self.spark, f"{self.root}/{e}")
        self.dirty.replace(self.dirty.read().withColumn("status", F.when(F.col("entity").isin(*entities), F.lit("dirty")).otherwise(F.col("status"))))
        self.manifest.replace(self.manifest.read().withColumn("status", F.when(F.col("status") == "processed", F.lit("pending")).otherwise(F.col("status"))))
