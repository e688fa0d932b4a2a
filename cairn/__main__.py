"""python -m cairn snapshot | dimension | discover | silver | gold | replay: one stage a call, its result as one JSON line."""

from __future__ import annotations

import argparse
import sys
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.logs import configure_logging
from cairn.plans.build import Warehouse, snapshot
from cairn.plans.contracts import Contract, load
from cairn.plans.publish import StageTimer, to_json
from cairn.session import session


def _pair(text: str) -> tuple[str, str]:
    name, _, path = text.partition("=")
    if not name or not path:
        raise argparse.ArgumentTypeError(f"not NAME=PATH: {text}")
    return name, path


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cairn")
    top.add_argument("--plain-logs", action="store_true", help="text instead of JSON lines")
    stages = top.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, *, built: bool = True) -> argparse.ArgumentParser:
        p = stages.add_parser(name, help=text)
        p.add_argument("--run-id", default=None, help="default: a new one")
        if built:
            p.add_argument("--root", required=True, help="folder of data and control tables")
        return p

    p = stage("snapshot", "CSV to one immutable Parquet file", built=False)
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--columns", required=True, help="YAML: a list of {raw, name, type} under `columns`")
    p.add_argument("--start", type=int, required=True)
    p.add_argument("--cutoff", type=int, required=True)
    p.add_argument("--version", required=True)
    p.add_argument("--overwrite", action="store_true")
    p = stage("discover", "register new files, route them, mark partitions dirty")
    p.add_argument("--bronze", required=True)
    p.add_argument("--routes", required=True, help="YAML with `routes`")
    p = stage("silver", "build the dirty partitions of a contract's entity")
    p.add_argument("--spec", required=True)
    p.add_argument("--dim", type=_pair, action="append", default=[], metavar="NAME=PARQUET")
    p = stage("gold", "build partitions from promoted silver")
    p.add_argument("--spec", required=True)
    p.add_argument("--key", action="append", default=[], help="a partition; default: every promoted one")
    p.add_argument("--ref", type=_pair, action="append", default=[], metavar="NAME=PARQUET")
    p = stage("dimension", "the country dimension, from semicolon-separated text")
    p.add_argument("--raw", required=True)
    p.add_argument("--names", required=True, help="YAML: `name`, `names` (raw column: column) and `keep` (columns)")
    p = stage("replay", "drop what was built of entities and mark their partitions dirty")
    p.add_argument("entities", nargs="+")
    return top


def promoted(w: Warehouse, spec: dict) -> list[str]:
    """Partitions of the spec's source that silver has promoted (one row each)."""
    entity = spec["transform"]["source"].split(".")[-1]
    return sorted(r[0] for r in w.commits.read().where((F.col("entity") == entity) & F.col("promoted")).select("partition_key").distinct().collect())


def run(spark: SparkSession, a: argparse.Namespace) -> object:
    def tables(pairs: list[tuple[str, str]]) -> dict[str, DataFrame]:
        return {name: spark.read.parquet(path) for name, path in pairs}

    run_id = a.run_id or uuid4().hex
    if a.stage == "snapshot":
        columns = [(c["raw"], c["name"], c["type"]) for c in load(a.columns)["columns"]]
        return snapshot(spark, a.raw, a.out, columns, a.start, a.cutoff, a.version, a.overwrite)
    w = Warehouse(spark, a.root)
    if a.stage == "dimension":
        spec = load(a.names)
        return {"rows": w.build_dimension(a.raw, spec["name"], spec["names"], spec["keep"]).count()}
    if a.stage == "discover":
        w.discover(a.bronze, load(a.routes), run_id)
        return {"dirty": w.dirty.read().where("status = 'dirty'").count()}
    if a.stage == "silver":
        return w.build_silver(load(a.spec), tables(a.dim), run_id)
    if a.stage == "gold":
        spec, refs = load(a.spec), tables(a.ref)
        entity = Contract.of(spec).entity
        return [{"entity": entity, "partition_key": k} | w.build_gold(spec, k, run_id, refs) for k in a.key or promoted(w, spec)]
    w.replay(*a.entities)
    return {"replayed": a.entities}


def main(argv: list[str] | None = None) -> int:
    """0, or 1 after a stage that failed (its error is logged)."""
    a = parser().parse_args(argv)
    log = configure_logging(not a.plain_logs)
    spark = session(f"cairn-{a.stage}")
    log.info("stage_started", extra={"stage": a.stage})
    try:
        with StageTimer() as t:
            result = run(spark, a)
    except Exception:
        log.exception("stage_failed", extra={"stage": a.stage})
        return 1
    print(to_json(result))
    log.info("stage_finished", extra={"stage": a.stage, "duration_sec": t.duration_sec})
    return 0


if __name__ == "__main__":
    sys.exit(main())
