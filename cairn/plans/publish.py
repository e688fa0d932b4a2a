"""Publishing without a table format: data by partition, control tables as numbered versions, commits, lineage.

A control table is a folder of versions: a whole one, or rows added to those before.  A version counts once its write is
done (its ``_SUCCESS`` is there); nothing is deleted or renamed to make it current, so a crash between any two steps leaves
the table as it was or as it was to be.  One writer at a time.  A partition's data are written first, its commit row
next, its state after that: a crash leaves the partition dirty, and a second run gives the same result.
"""

from __future__ import annotations

import json
import re
import time
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "entity string, partition_key string, run_id string, layer string, rows_in bigint, rows_out bigint, rows_rejected bigint, inserts bigint, updates bigint, deletes bigint, partition_hash string, dq_status string, promoted boolean, committed_at timestamp"
LINEAGE = "event_id string, event_type string, run_id string, code_version string, namespace string, dataset string, partition_key string, rows bigint, content_hash string, dq_status string, stats string, happened_at timestamp"
LINEAGE_INPUTS = "event_id string, namespace string, dataset string, file_path string, content_hash string"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    f, p, _ = _fs(spark, path)
    return f.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    f, p, _ = _fs(spark, path)
    f.delete(p, True)


def _rename_over(spark: SparkSession, source: str, target: str) -> None:
    """In one step: readers see the old file or the new one."""
    jvm = spark.sparkContext._jvm
    f, p, _ = _fs(spark, target)
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(f.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(jvm.org.apache.hadoop.fs.Path(source), p, options)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Whole or not at all: written beside, then renamed over."""
    f, _, jvm = _fs(spark, path)
    beside = f"{path}.{uuid4().hex}"
    s = f.create(jvm.org.apache.hadoop.fs.Path(beside), True)
    s.write(bytearray(text.encode("utf-8")))
    s.close()
    _rename_over(spark, beside, path)


def get_text(spark: SparkSession, path: str) -> str | None:
    f, p, jvm = _fs(spark, path)
    if not f.exists(p):
        return None
    s = f.open(p)
    try:
        return bytes(s.readAllBytes()).decode("utf-8")
    finally:
        s.close()


def write_file(df: DataFrame, path: str) -> None:
    """One Parquet file under exactly this name: written aside by one task, then renamed over it."""
    spark = df.sparkSession
    aside = f"{path.rsplit('/', 1)[0]}/_{uuid4().hex}"
    df.coalesce(1).write.option("compression", "zstd").parquet(aside)
    f, p, _ = _fs(spark, aside)
    part = next(x.getPath() for x in f.listStatus(p) if x.getPath().getName().startswith("part-"))
    _rename_over(spark, part.toString(), path)
    f.delete(p, True)


class ControlTable:
    """Versions ``v=<n>.whole`` and ``v=<n>.more``: the table is the last whole one and all that were added since."""

    def __init__(self, spark: SparkSession, root: str, name: str, schema: str):
        self.spark, self.base, self.schema = spark, f"{root.rstrip('/')}/{name}", schema

    def versions(self) -> list[tuple[int, str, bool]]:
        """(number, kind, whether its write was finished), in order."""
        f, p, jvm = _fs(self.spark, self.base)
        names = [x.getPath().getName() for x in f.listStatus(p)] if f.exists(p) else []
        found = [(int(m[1]), m[2]) for n in names if (m := re.fullmatch(r"v=(\d+)\.(whole|more)", n))]
        return [(n, kind, f.exists(jvm.org.apache.hadoop.fs.Path(f"{self._at(n, kind)}/_SUCCESS"))) for n, kind in sorted(found)]

    def _at(self, n: int, kind: str) -> str:
        return f"{self.base}/v={n:09d}.{kind}"

    def _current(self) -> list[tuple[int, str]]:
        done = [(n, kind) for n, kind, whole in self.versions() if whole]
        last = max((n for n, kind in done if kind == "whole"), default=0)
        return [(n, kind) for n, kind in done if n >= last]

    def version(self) -> int:
        return max((n for n, _ in self._current()), default=0)

    def read(self) -> DataFrame:
        paths = [self._at(*v) for v in self._current()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _write(self, df: DataFrame, kind: str) -> None:
        # an unfinished version keeps its number: nothing is written over what a reader might be reading
        n = max((n for n, _, _ in self.versions()), default=0) + 1
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(self._at(n, kind))

    def replace(self, df: DataFrame) -> None:
        self._write(df, "whole")

    def append(self, df: DataFrame) -> None:
        """Writes the new rows alone."""
        self._write(df, "more")

    def compact(self, keep: int = 1) -> None:
        """One whole version of what is there; all but the last ``keep`` whole versions before it, what was added to them, and
        unfinished writes go."""
        self.replace(self.read())
        whole = [n for n, kind, done in self.versions() if done and kind == "whole"]
        oldest = whole[max(0, len(whole) - 1 - keep)]
        for n, kind, done in self.versions():
            if n < oldest or not done:
                delete(self.spark, self._at(n, kind))


def partition_predicate(column: str, grain: str, key: str):
    if grain == "year":
        return F.col(column) == int(key)
    if grain == "month":
        return F.col(column) == F.to_date(F.lit(key), "yyyy-MM")
    raise ValueError(f"unknown grain: {grain}")


def swap_partition(df: DataFrame, path: str, column: str, grain: str, key: str) -> None:
    """Replaces one partition and no other; without rows, it is removed."""
    spark = df.sparkSession
    rows = df.where(partition_predicate(column, grain, key))
    at = f"{path}/{column}={key if grain == 'year' else key + '-01'}"
    if rows.isEmpty():
        delete(spark, at)
        return
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def new_commits(old: DataFrame, new: DataFrame) -> DataFrame:
    """The commits whose key (entity, partition, run) is not there yet."""
    return new.join(old, ["entity", "partition_key", "run_id"], "left_anti").select(*new.columns)


def insert_commits(old: DataFrame, new: DataFrame, on_conflict: str = "ignore") -> DataFrame:
    key = ["entity", "partition_key", "run_id"]
    if on_conflict == "ignore":
        return old.unionByName(new_commits(old, new))
    if on_conflict == "replace":
        return old.join(new, key, "left_anti").select(*old.columns).unionByName(new)
    raise ValueError(f"unknown on_conflict: {on_conflict}")


@dataclass(frozen=True)
class Input:
    namespace: str
    dataset: str
    file_path: str = ""
    content_hash: str = ""


@dataclass(frozen=True)
class Event:
    """discover, transform_run or partition_published."""

    event_type: str
    run_id: str
    code_version: str
    namespace: str
    dataset: str
    partition_key: str = ""
    rows: int | None = None
    content_hash: str | None = None
    dq_status: str | None = None
    stats: dict = field(default_factory=dict)
    inputs: tuple[Input, ...] = ()
    event_id: str = field(default_factory=lambda: str(uuid4()))
    happened_at: datetime = field(default_factory=lambda: datetime.now(UTC))


def to_json(x) -> str:
    def other(o):
        if hasattr(o, "isoformat"):
            return o.isoformat()
        if hasattr(o, "item"):
            return o.item()
        return float(o) if type(o).__name__ == "Decimal" else str(o)

    return json.dumps(x, default=other, ensure_ascii=False)


class StdoutEmitter:
    def emit(self, event: Event) -> None:
        print(to_json(asdict(event)))


class TableEmitter:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.events, self.inputs = ControlTable(spark, root, "lineage_events", LINEAGE), ControlTable(spark, root, "lineage_inputs", LINEAGE_INPUTS)

    def emit(self, event: Event) -> None:
        self.emit_many([event])

    def emit_many(self, events: list[Event]) -> None:
        """One version of each table for all of them."""
        names = [f.split()[0] for f in LINEAGE.split(", ")]
        rows = [tuple(to_json(e[n]) if n == "stats" else e[n] for n in names) for e in map(asdict, events)]
        inputs = [(e.event_id, i.namespace, i.dataset, i.file_path, i.content_hash) for e in events for i in e.inputs]
        if rows:
            self.events.append(self.spark.createDataFrame(rows, LINEAGE))
        if inputs:
            self.inputs.append(self.spark.createDataFrame(inputs, LINEAGE_INPUTS))


def emit(event: Event, emitters) -> None:
    for e in emitters:
        e.emit(event)


def emit_all(events: list[Event], emitters) -> None:
    for e in emitters:
        if hasattr(e, "emit_many"):
            e.emit_many(events)
        else:
            for event in events:
                e.emit(event)


class StageTimer:
    def __enter__(self):
        self._began = time.perf_counter()
        self.duration_sec = 0.0
        return self

    def __exit__(self, *_):
        self.duration_sec = round(time.perf_counter() - self._began, 3)
