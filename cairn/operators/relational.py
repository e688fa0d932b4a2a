"""Row operators of a contract build: harmonize, enrich, filter, dedup, fingerprint, compare, expand."""

from __future__ import annotations

import hashlib
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import row_hash
from cairn.functions.types import read_as, spark_type

#: A dimension is sent to all executors only up to this many bytes (measured first, in the same pass that checks its keys).
SMALL_BYTES = 32 << 20


def quoted(name: str) -> Column:
    """A column by its whole name, whatever that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def ensure(df: DataFrame, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Exactly these columns in this order; what is missing is null."""
    have = set(df.columns)
    return df.select(*(quoted(c) if c in have else F.lit(None).cast(spark_type((types or {}).get(c, "STRING"))).alias(c) for c in columns))


def harmonize(df: DataFrame, columns: list[dict], lineage: list[str] = ()) -> DataFrame:
    """Contract columns that name a source: the first alias present, cast to the contract's type (unreadable: null),
    in the contract's order, then lineage columns; all else goes."""
    have, out = set(df.columns), []
    for c in columns:
        if not c.get("source"):
            continue
        found = next((a for a in c["source"] if a in have), None)
        out.append((read_as(F.col(f"`{found}`"), c["type"]) if found else F.lit(None).cast(spark_type(c["type"]))).alias(c["name"]))
    out += [F.col(f"`{n}`") if n in have else F.lit(None).cast("string").alias(n) for n in lineage]
    return df.select(*out)


def keys_of(on, left: list[str], right: list[str]) -> tuple[list[str], list[str]]:
    """Join keys from a name, a list of names, or a mapping with left / l / left_on and right / r / right_on."""
    if isinstance(on, dict):
        pick = lambda names: next((on[n] for n in names if n in on), None)
        a, b = pick(("left", "l", "left_on")), pick(("right", "r", "right_on"))
    else:
        a = b = on
    a, b = ([x] if isinstance(x, str) else list(x or []) for x in (a, b))
    missing = [x for x in a if x not in left] + [x for x in b if x not in right]
    if missing or not a or len(a) != len(b):
        raise KeyError(f"join keys: {missing or on}")
    return a, b


def join_dimension(df: DataFrame, dim: DataFrame, on, select: list[str], alias: str = "", rename: dict[str, str] | None = None, required: bool = False, reason: str = "dimension_not_found", one_to_one: bool = True, how: str = "left") -> tuple[DataFrame, DataFrame]:
    """(matched rows, rejects).  A left lookup in which a null key finds a null key; with ``required``, rows that find
    nothing are rejects with a reason.  Keys repeated in the dimension raise with up to five examples, or, unless
    ``one_to_one``, the row with the least values stands for its key."""
    if how != "left":
        raise ValueError("only left lookups are supported")
    if alias and rename:
        raise ValueError("alias and rename exclude each other")
    left, right = keys_of(on, df.columns, dim.columns)
    gone = [c for c in rename or {} if c not in select]
    if gone:
        raise KeyError(f"renamed columns that are not selected: {gone}")
    names = {c: (rename or {}).get(c, f"{alias}{c}") for c in dict.fromkeys(select)}
    clash = [n for n in names.values() if n in df.columns]
    if clash or len(set(names.values())) < len(names):
        raise ValueError(f"columns already there: {clash or list(names.values())}")
    slim = dim.select(*dict.fromkeys([*right, *names]))
    if one_to_one:
        twice = slim.groupBy(*right).count().where("count > 1").limit(5).collect()
        if twice:
            raise ValueError(f"keys repeated in the dimension: {[tuple(r)[:-1] for r in twice]}")
    else:
        order = Window.partitionBy(*right).orderBy(*slim.columns)
        slim = slim.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
    look = slim.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(right)), *(F.col(c).alias(n) for c, n in names.items()), F.lit(True).alias("_hit"))
    size = F.sum(reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in look.columns]))
    if (look.agg(size).first()[0] or 0) <= SMALL_BYTES:
        look = F.broadcast(look)
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(left)]
    joined = df.join(look, cond, "left").drop(*(f"_k{i}" for i in range(len(right))))
    if not required:
        return joined.drop("_hit"), df.limit(0).withColumn("reject_reasons", F.lit(reason))
    lost = joined.where("_hit is null").select(*df.columns, F.lit(reason).alias("reject_reasons"))
    return joined.where("_hit").drop("_hit"), lost


def join_metrics(df: DataFrame, joined: DataFrame, rejects: DataFrame, required: bool, added: list[str]) -> dict:
    """What a lookup did: rows in, out and rejected, and rows that found nothing.  Asked for when wanted: it reads rows."""
    rows, out, lost = df.count(), joined.count(), rejects.count()
    unmatched = lost if required else joined.where(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in added])).count()
    return {"rows_in": rows, "rows_out": out, "rejected": lost, "unmatched": unmatched, "matched": rows - unmatched}


def rule_sql(text: str) -> str:
    """A rule's text as SQL: == is =, lists in brackets are lists in parentheses."""
    parts = re.split(r"('(?:[^']|'')*'|\"[^\"]*\")", text)
    fix = lambda s: s.replace("==", "=").replace("[", "(").replace("]", ")").replace("&", " and ").replace("|", " or ")
    return "".join(f"'{p[1:-1]}'" if p[:1] == '"' else p if p[:1] == "'" else fix(p) for p in parts)


def filter_rows(df: DataFrame, rule: str | Column, action: str, reason: str = "unspecified") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): keep holds on to rows that match, reject to those that do not; null is no match."""
    if action not in ("keep", "reject"):
        raise ValueError(f"unknown action: {action}")
    match = F.coalesce(F.expr(rule_sql(rule)) if isinstance(rule, str) else rule, F.lit(False))
    stay = match if action == "keep" else ~match
    return df.where(stay), df.where(~stay).withColumn("reject_reasons", F.lit(reason))


def union_all(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


def dedup(df: DataFrame, key: list[str], tiebreak: list[dict]) -> DataFrame:
    """One row a key: the first by the tiebreak columns; what they leave open, the other columns settle."""
    named = [t["column"] for t in tiebreak]
    order = [F.col(t["column"]).desc_nulls_last() if t.get("order", "asc") == "desc" else F.col(t["column"]).asc_nulls_last() for t in tiebreak]
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in named and f.name not in key and f.dataType.typeName() != "map"]
    w = Window.partitionBy(*key).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest(df: DataFrame, key: list[str], by: str, tail: list[str] = ()) -> DataFrame:
    return dedup(df, key, [{"column": by, "order": "desc"}, *({"column": t} for t in tail)])


def with_row_hash(df: DataFrame, columns: list[str], name: str = "row_hash") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns to hash are missing: {missing}")
    return df.withColumn(name, row_hash(df.schema, columns))


def partition_hash(df: DataFrame, partition: list[str], column: str = "row_hash", rows_in_memory: int = 1_000_000) -> DataFrame:
    """SHA-256 of each partition's sorted row hashes joined by |.  Where a partition has more rows than may be gathered
    in one, the hashes are sorted across tasks' memory and fed to one running digest: the same bytes, constant memory."""
    largest = df.groupBy(*partition).count().agg(F.max("count")).first()[0] or 0
    if largest <= rows_in_memory:
        joined = F.array_join(F.array_sort(F.collect_list(column)), "|")
        return df.groupBy(*partition).agg(F.sha2(joined, 256).alias("partition_hash"))
    names = list(partition)

    def digest(batches):
        import pandas as pd

        key, running = None, None
        for pdf in batches:
            for *k, h in pdf.itertuples(index=False):
                if k != key:
                    if key is not None:
                        yield pd.DataFrame([[*key, running.hexdigest()]], columns=[*names, "partition_hash"])
                    key, running = k, hashlib.sha256(h.encode())
                else:
                    running.update(b"|" + h.encode())
        if key is not None:
            yield pd.DataFrame([[*key, running.hexdigest()]], columns=[*names, "partition_hash"])

    out = df.select(*names, column).limit(0).drop(column).schema.add("partition_hash", "string")
    return df.select(*names, column).repartition(*names).sortWithinPartitions(*names, column).mapInPandas(digest, out)


def diff_counts(old: DataFrame, new: DataFrame, key: list[str], column: str = "row_hash") -> DataFrame:
    """One row: inserts, updates, deletes.  Null keys equal null keys."""
    for df in (old, new):
        missing = [c for c in (*key, column) if c not in df.columns]
        if missing:
            raise RuntimeError(f"columns to compare are missing: {missing}")
    a = old.select(*(F.col(k).alias(f"o_{k}") for k in key), F.col(column).alias("o_hash"), F.lit(True).alias("o"))
    b = new.select(*(F.col(k).alias(f"n_{k}") for k in key), F.col(column).alias("n_hash"), F.lit(True).alias("n"))
    both = a.join(b, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in key], "full_outer")
    return both.agg(
        F.count_if(F.col("o").isNull()).alias("inserts"),
        F.count_if(F.col("o").isNotNull() & F.col("n").isNotNull() & ~F.col("o_hash").eqNullSafe(F.col("n_hash"))).alias("updates"),
        F.count_if(F.col("n").isNull()).alias("deletes"),
    )


def expand_partitions(df: DataFrame, grain: str = "route_grain") -> DataFrame:
    """Adds partition_key for every year or month (by the column ``grain``) from start to end, given as YYYY or YYYY-MM."""
    first = F.to_date(F.when(F.length("start") == 4, F.concat("start", F.lit("-01"))).otherwise(F.col("start")), "yyyy-MM")
    last = F.to_date(F.when(F.length("end") == 4, F.concat("end", F.lit("-12"))).otherwise(F.col("end")), "yyyy-MM")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    years = F.when(first <= last, F.sequence(F.year(first), F.year(last)))
    keys = F.when(F.col(grain) == "year", F.transform(years, lambda y: y.cast("string"))).when(F.col(grain) == "month", F.transform(months, lambda m: F.date_format(m, "yyyy-MM")))
    return df.withColumn("partition_key", F.explode(keys))
