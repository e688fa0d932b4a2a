"""Data-quality checks as a promotion gate.  All row checks run in one aggregate, key uniqueness in one more, and
one anti-join a foreign key."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.types import canonical, of_spark
from cairn.operators.relational import rule_sql


class GateError(RuntimeError):
    """The first check that failed."""


@dataclass(frozen=True)
class Result:
    name: str
    passed: bool
    violations: int
    note: str = ""


@dataclass(frozen=True)
class Report:
    results: list[Result]

    @property
    def status(self) -> str:
        return "passed" if all(r.passed for r in self.results) else "failed"

    @property
    def summary(self) -> dict:
        bad = sum(not r.passed for r in self.results)
        return {"total": len(self.results), "passed": len(self.results) - bad, "failed": bad}

    def gate(self) -> None:
        for r in self.results:
            if not r.passed:
                raise GateError(f"{r.name}: {r.violations} violations {r.note}".strip())


def _any(cols):
    return reduce(lambda a, b: a | b, cols)


def duplicated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key groups of more than one row; nulls are equal."""
    return df.groupBy(*key).count().where("count > 1")


def unmatched(df: DataFrame, column: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Rows whose foreign key finds nothing; null finds nothing."""
    return df.join(ref.select(F.col(ref_key).alias("_ref")).distinct(), F.col(f"`{column}`") == F.col("_ref"), "left_anti")


def _optional(test: dict, have: dict) -> dict:
    """Checks a contract may ask for: how many nulls a column may have, how many values must fit a pattern, and how old
    the newest value may be.  A column that is missing is the schema check's business."""
    out, rows = {}, F.count(F.lit(1))
    if (t := test.get("null_share")) and t["column"].lower() in have:
        nulls = F.count_if(F.col(t["column"]).isNull())
        out[f"null_share:{t['column']}"] = F.when(nulls > rows * float(t["most"]), nulls).otherwise(0)
    if (t := test.get("coverage")) and t["column"].lower() in have:
        lost = F.count_if(~F.coalesce(F.rlike(t["column"], F.lit(t["pattern"])), F.lit(False)))
        out[f"coverage:{t['column']}"] = F.when(lost > rows * (1 - float(t["least"])), lost).otherwise(0)
    if (t := test.get("freshness")) and t["column"].lower() in have:
        newest = F.max(F.col(t["column"]).cast("timestamp"))
        out[f"freshness:{t['column']}"] = F.when(newest >= F.lit(str(t["not_before"])).cast("timestamp"), 0).otherwise(1)
    return out


def run(df: DataFrame, columns: list[dict], key: list[str] = (), partition: tuple[str, str, str] | None = None, tests: list[dict] = (), foreign_keys: list[tuple[str, DataFrame, str]] = (), more: list[str] = (), stamped: list[str] = ()) -> Report:
    """``partition``: (column, grain, key); ``tests``: the contract's list, each a mapping of one name; ``more``: columns that
    must be there besides the contract's (lineage, extra, row_hash); ``stamped``: those of them without a null."""
    have = {c.lower(): c for c in df.columns}
    expected = list(dict.fromkeys([*(c["name"] for c in columns), *more, *stamped]))
    lost = [n for n in expected if n.lower() not in have]
    extra = sorted(set(have) - {n.lower() for n in expected})
    out = [Result("schema", not lost, len(lost), f"missing {lost}" if lost else f"extra {extra}" if extra else "")]
    types = dict(df.dtypes)
    wrong = [c["name"] for c in columns if (n := have.get(c["name"].lower())) and of_spark(types[n]) != canonical(c["type"])]
    out.append(Result("types_match", not wrong, len(wrong), str(wrong) if wrong else ""))
    there = lambda names: [n for n in names if n.lower() in have]
    filled = there(dict.fromkeys([*(c["name"] for c in columns if not c.get("nullable", True)), *(n for t in tests for n in t.get("not_null", [])), *stamped]))
    signed = there(dict.fromkeys([*(c["name"] for c in columns if str(c.get("dq", "")).replace(" ", "") == ">=0"), *(n for t in tests for n in t.get("non_negative", []))]))
    checks = {"rows": F.count(F.lit(1))}
    if key := there(key):
        checks["pk_not_null"] = F.count_if(_any([F.col(k).isNull() for k in key]))
    if filled:
        checks["not_null"] = reduce(lambda a, b: a + b, [F.count_if(F.col(n).isNull()) for n in filled])
    if signed:
        checks["non_negative"] = F.count_if(_any([F.coalesce(F.col(n) < 0, F.lit(False)) for n in signed]))
    for t in tests:
        if "reconcile" in t:
            checks[f"reconcile:{t['reconcile']['name']}"] = F.count_if(~F.expr(rule_sql(t["reconcile"]["expression"])))
        checks |= _optional(t, have)
    if "row_hash" in have and "row_hash" in more:
        checks["row_hash_length"] = F.count_if(F.coalesce(F.length(have["row_hash"]) != 64, F.lit(True)))
    if partition:
        text = F.date_format(partition[0], "yyyy-MM") if partition[1] == "month" and types.get(partition[0]) == "date" else F.col(partition[0]).cast("string")
        checks |= {"lo": F.min(text), "hi": F.max(text)}
    got = df.agg(*(c.alias(n) for n, c in checks.items())).first().asDict()
    for name, n in got.items():
        if name in ("rows", "lo", "hi"):
            continue
        out.append(Result(name, n == 0, n))
    out.append(Result("non_empty", got["rows"] > 0, int(got["rows"] == 0)))
    if partition:
        one = got["lo"] == got["hi"]
        out.append(Result("partition_single_value", one, int(not one)))
        same = not one or got["lo"] is None or got["lo"] == str(partition[2])
        out.append(Result("partition_matches_key", same, int(not same)))
    for names in [key, *(t["unique"] for t in tests if "unique" in t and list(t["unique"]) != list(key))]:
        if names:
            n = duplicated_keys(df, names).count()
            out.append(Result("pk_unique" if list(names) == list(key) else f"unique:{','.join(names)}", n == 0, n))
    for column, ref, ref_key in foreign_keys:
        n = unmatched(df, column, ref, ref_key).count()
        out.append(Result(f"ri:{column}->{ref_key}", n == 0, n))
    return Report(out)


def reference(text: str) -> tuple[str, str]:
    """schema.table(column) -> (schema.table, column)."""
    m = re.fullmatch(r"\s*([\w.]+)\s*\(\s*(\w+)\s*\)\s*", text)
    if not m:
        raise ValueError(f"not a reference: {text}")
    return m[1], m[2]


def bronze_policy(start: int, cutoff: int, records: int | None, size: int | None, digest: str | None) -> tuple[str, list[str]]:
    """(MINOR or CRITICAL, notes) for a snapshot; it never blocks the write."""
    bad = [n for n, failed in (("bad_year_range", start > cutoff), ("zero_records", not records), ("zero_bytes", not size), ("no_hash", not digest)) if failed]
    return ("CRITICAL" if bad else "MINOR"), bad
