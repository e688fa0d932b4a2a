"""Text functions of contracts: normalization by named steps, snake case, row hashes, coverage of file names."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"[\s\x1c-\x1f\x85   -     　]"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end (trim drops spaces only)."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def title(c: Column) -> Column:
    """A capital after every non-letter: o'neil-smith -> O'Neil-Smith."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


STEPS = {"strip": strip, "upper": F.upper, "lower": F.lower, "title": title}


def normalize(c: Column, steps: list[str]) -> Column:
    for s in steps:
        if s not in STEPS:
            raise ValueError(f"unknown normalization: {s}")
        c = STEPS[s](c)
    return c


def snake(name: str, known: dict[str, str] | None = None) -> str:
    name = name.strip()
    return (known or {}).get(name) or re.sub(r"\s", "_", name.lower())


def _in_order(c: Column, t: T.DataType) -> Column:
    """A nested value with the keys of all its structs and maps in order."""
    if isinstance(t, T.StructType):
        fields = sorted(t.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*(_in_order(c.getField(f.name), f.dataType).alias(f.name) for f in fields)))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _in_order(x, t.elementType))
    if isinstance(t, T.MapType):
        entries = F.array_sort(F.map_entries(F.transform_values(c, lambda _, v: _in_order(v, t.valueType))), lambda x, y: F.when(x["key"] < y["key"], -1).otherwise(1))
        return F.map_from_entries(entries)
    return _time(c) if isinstance(t, (T.TimestampType, T.TimestampNTZType)) else c


def _time(c: Column) -> Column:
    """ISO to the second, with six digits of a fraction where there is one."""
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def cell(c: Column, t: T.DataType) -> Column:
    """A cell as hashed text: null is empty, times are ISO, nested values are JSON with their keys in order."""
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        c = _time(c)
    elif isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        c = F.to_json(_in_order(c, t), {"ignoreNullFields": "false"})
    return F.coalesce(c.cast("string"), F.lit(""))


def row_hash(schema: T.StructType, columns: list[str]) -> Column:
    """SHA-256 of the cells joined by |, in the order given."""
    return F.sha2(F.concat_ws("|", *(cell(F.col(f"`{n}`"), schema[n].dataType) for n in columns)), 256)


def glob_regex(pattern: str) -> str:
    """An anchored Java regex for a shell glob with * and ?."""
    return "^" + "".join({"*": ".*", "?": "."}.get(ch, re.escape(ch)) for ch in pattern) + "$"


def source_id(path: Column) -> Column:
    found = F.regexp_extract(path, r"(?:^|/)bronze/([^/]+)/", 1)
    return F.when(found == "", F.lit("unknown")).otherwise(found)


def coverage(path: Column) -> Column:
    """struct(start, end, grain, error) told by a file name: YYYY, YYYY-YYYY, YYYY-MM or YYYY-MM-YYYY-MM before ``-part-``."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    head = F.regexp_extract(name, r"^(.*?)-part-", 1)
    take = lambda rx, i: F.regexp_extract(head, rx, i)
    month2, month1, year2, year1 = r"^(\d{4}-\d{2})-(\d{4}-\d{2})$", r"^(\d{4}-\d{2})$", r"^(\d{4})-(\d{4})$", r"^(\d{4})$"

    def out(a, b, grain, bad):
        error = F.when(a > b, F.lit(bad)).otherwise(F.lit(None).cast("string"))
        return F.struct(a.alias("start"), b.alias("end"), F.lit(grain).alias("grain"), error.alias("error"))

    none = F.lit(None).cast("string")
    unknown = F.struct(none.alias("start"), none.alias("end"), none.alias("grain"), F.concat(F.lit("unrecognized:"), name).alias("error"))
    cases = [(month2, 2, "month"), (month1, 1, "month"), (year2, 2, "year"), (year1, 1, "year")]
    return reduce(lambda rest, k: F.when(F.rlike(head, F.lit(k[0])), out(take(k[0], 1), take(k[0], k[1]), k[2], f"{k[2]}_range_invalid")).otherwise(rest), reversed(cases), unknown)
