"""YAML contracts as data, and their compilation to DataFrame plans."""

from __future__ import annotations

from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import normalize
from cairn.functions.types import spark_type
from cairn.operators import relational as R


def load(text_or_path: str) -> dict:
    if "\n" in text_or_path:
        return yaml.safe_load(text_or_path)
    with open(text_or_path, encoding="utf-8") as f:
        return yaml.safe_load(f)


@dataclass(frozen=True)
class Contract:
    """Either layer's contract in one form: columns with name, type, nullable, source, dq."""

    entity: str
    grain: str
    columns: list[dict]
    key: list[str]
    partitions: list[str]
    lineage: list[str]
    foreign_keys: list[dict] = field(default_factory=list)
    tests: list[dict] = field(default_factory=list)
    body: dict = field(default_factory=dict)

    @classmethod
    def of(cls, spec: dict) -> Contract:
        c = spec.get("contract", {})
        lineage = c.get("lineage") or [x["name"] for x in c.get("lineage_columns", [])]
        columns = c.get("columns") or spec.get("columns", [])
        missing = [k for k in c.get("primary_key", []) if k not in {x["name"] for x in columns}]
        if missing:
            raise ValueError(f"key columns that the contract does not have: {missing}")
        return cls(spec["entity"], spec.get("grain", "year"), columns, c.get("primary_key", []), c.get("partitions", []), lineage, c.get("foreign_keys", []), c.get("tests", []), spec)


def canonicalize(df: DataFrame, c: Contract, dims: dict[str, DataFrame], partition: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): normalize, cut to the partition, look up dimensions, apply rules one after another, dedup,
    fingerprint, project."""
    plan = c.body.get("canonicalizer", {})
    df = R.harmonize(df, c.columns, c.lineage)
    for name, steps in plan.get("input", {}).get("normalize", {}).items():
        df = df.withColumn(name, normalize(F.col(name), steps))
    if partition is not None:
        df = df.where(F.col(c.partitions[0]).cast("string") == str(partition))
    rejects = []
    for d in plan.get("dims", []):
        df, lost = R.join_dimension(df, dims[d["name"]], d["on_keys"], d["select"], d.get("alias", ""), d.get("select_rename"), d.get("required", False), f"{d['name']}_not_found")
        rejects.append(lost)
    for r in plan.get("rules", []):
        df, lost = R.filter_rows(df, r["when"], r["action"], r.get("reject_reason", "unspecified"))
        rejects.append(lost)
    if plan.get("dedup"):
        df = R.dedup(df, plan["dedup"]["key"], plan["dedup"].get("tiebreak", []))
    df = R.with_row_hash(df, plan.get("row_hash", {}).get("columns", c.key))
    out = plan.get("output", {})
    order = list(dict.fromkeys([*(x["name"] for x in c.columns), *out.get("extra", []), *out.get("lineage", c.lineage), "row_hash"]))
    types = {x["name"]: x["type"] for x in c.columns}
    lost = R.union_all(rejects) if rejects else df.limit(0).withColumn("reject_reasons", F.lit(""))
    return R.ensure(df, order, types), lost


def transform(source: DataFrame, plan: dict, where=None) -> DataFrame:
    """A mart: slice, then source columns under their new names and defaults, then derivations over these (not over
    each other), then casts in the order asked for."""
    df = source if where is None else source.where(where)
    have, base = set(df.columns), {}
    for target, name in plan.get("select_map", {}).items():
        if name in have:
            base[target] = F.col(f"`{name}`")
        elif target not in plan.get("defaults", {}):
            raise ValueError(f"the source has no column {name}")
    for target, value in plan.get("defaults", {}).items():
        if target not in base:
            base[target] = F.col(f"`{target}`") if target in have else F.lit(value)
    df = df.select(*(c.alias(n) for n, c in base.items()))
    derived = {n: F.expr(x) for n, x in plan.get("derivations", {}).items()}
    df = df.select(*(F.col(f"`{n}`") for n in base if n not in derived), *(x.alias(n) for n, x in derived.items()))
    order = plan.get("order") or [*base, *(n for n in derived if n not in base)]
    types = plan.get("types", {})
    return df.select(*(F.col(f"`{n}`").cast(spark_type(types[n])).alias(n) if n in types else F.col(f"`{n}`") for n in order))


AGGREGATIONS = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def rollup(df: DataFrame, columns: list[dict], by: list[str]) -> DataFrame:
    """All columns that a contract gives an ``agg`` to, over some of the others."""
    known = {c["name"] for c in columns}
    hints = {c["name"]: c["agg"] for c in columns if c.get("agg")}
    wrong = [n for n in by if n not in known or n in hints] + [n for n, how in hints.items() if how not in AGGREGATIONS]
    if wrong or not hints:
        raise ValueError(f"columns that cannot be rolled up by, or how: {wrong}" if wrong else "no column has an agg")
    return df.groupBy(*by).agg(*(AGGREGATIONS[how](f"`{n}`").alias(n) for n, how in hints.items()))


def exposed(df: DataFrame, c: Contract) -> DataFrame:
    """The exposure view: without lineage and the row hash, all else in its order."""
    hidden = {*c.lineage, "row_hash"}
    return df.select(*(F.col(f"`{n}`") for n in df.columns if n not in hidden and not n.startswith("_")))


def validate_metric(df: DataFrame, spec: dict) -> dict[str, int]:
    """Violations of each of a metric's ``validations``, counted over its record set before it is added up: non_negative,
    equals_components (an expression; null breaks nothing)."""
    checks = {}
    for v in spec.get("validations", []):
        name, body = (v, {}) if isinstance(v, str) else next(iter(v.items()))
        if name == "non_negative":
            bad = F.expr(spec["formula"]) < 0
        elif name == "equals_components":
            bad = ~F.expr(R.rule_sql(body["expression"]))
        else:
            raise ValueError(f"unknown validation: {name}")
        checks[name] = F.count_if(F.coalesce(bad, F.lit(False))).alias(name)
    return _records(df, spec).agg(*checks.values()).first().asDict() if checks else {}


def _records(df: DataFrame, spec: dict) -> DataFrame:
    for f in spec.get("record_set", {}).get("filters", []):
        df = df.where(R.rule_sql(f["expression"]))
    return df


def metric(df: DataFrame, spec: dict, by: list[str], strict: bool = False) -> DataFrame:
    """A declared metric over some of its declared dimensions; ``strict``: its validations must hold."""
    other = [d for d in by if d not in spec.get("allowed_dimensions", [])]
    if other:
        raise ValueError(f"dimensions that {spec['name']} does not allow: {other}")
    broken = {k: n for k, n in validate_metric(df, spec).items() if n} if strict else {}
    if broken:
        raise ValueError(f"{spec['name']}: {broken}")
    how = AGGREGATIONS[spec.get("default_aggregation", "sum")]
    return _records(df, spec).groupBy(*by).agg(how(F.expr(spec["formula"])).alias(spec["name"]))
