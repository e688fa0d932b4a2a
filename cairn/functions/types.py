"""Contract types: synonyms, Spark types, and casts that turn what cannot be read into null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Synonym -> canonical name.
SYNONYMS = {
    "STRING": "VARCHAR", "TEXT": "VARCHAR", "CHAR": "VARCHAR", "CHARACTER VARYING": "VARCHAR", "VARCHAR": "VARCHAR",
    "INT": "INTEGER", "INT4": "INTEGER", "SMALLINT": "INTEGER", "TINYINT": "INTEGER", "UINTEGER": "INTEGER", "INTEGER": "INTEGER",
    "INT8": "BIGINT", "LONG": "BIGINT", "UBIGINT": "BIGINT", "BIGINT": "BIGINT",
    "FLOAT": "DOUBLE", "REAL": "DOUBLE", "FLOAT4": "DOUBLE", "FLOAT8": "DOUBLE", "DOUBLE": "DOUBLE",
    "BOOL": "BOOLEAN", "BOOLEAN": "BOOLEAN",
    "DATETIME": "TIMESTAMP", "TIMESTAMP": "TIMESTAMP", "TIMESTAMP_NTZ": "TIMESTAMP", "TIMESTAMP WITHOUT TIME ZONE": "TIMESTAMP",
    "TIMESTAMPTZ": "TIMESTAMPTZ", "TIMESTAMP WITH TIME ZONE": "TIMESTAMPTZ", "TIMESTAMP_LTZ": "TIMESTAMPTZ",
    "DATE": "DATE", "JSON": "VARCHAR",
}
SPARK = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "TIMESTAMPTZ": "timestamp", "DATE": "date"}


def canonical(name: str) -> str:
    plain = name.strip().upper().split("(")[0].strip()
    return SYNONYMS.get(plain, plain)


def spark_type(name: str) -> str:
    try:
        return SPARK[canonical(name)]
    except KeyError:
        raise ValueError(f"unknown type: {name}") from None


def of_spark(simple: str) -> str:
    """The canonical name of a Spark type's simpleString."""
    return canonical({"timestamp": "timestamptz", "timestamp_ntz": "timestamp"}.get(simple, simple))


def read_as(c: Column, name: str) -> Column:
    """``c`` as a contract type; unreadable is null.  Whole numbers written with a point ('5.0') are read, fractions are not."""
    kind = canonical(name)
    if kind in ("BIGINT", "INTEGER"):
        t = SPARK[kind]
        wide = c.cast("string").try_cast("double")
        return F.coalesce(c.cast("string").try_cast(t), F.when(wide == F.floor(wide), wide.try_cast(t)))
    if kind == "BOOLEAN":
        low = F.lower(c.cast("string"))
        return F.when(low.isin("true", "1"), True).when(low.isin("false", "0"), False)
    return c.try_cast(spark_type(name))
