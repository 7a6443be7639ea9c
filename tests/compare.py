"""Run a query and its SQL side by side and compare the rows, whatever their order."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(item) for item in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(row[name]) for name in names) for row in df.select(*names).collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [column[0] for column in cursor.description]
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(columns), Counter(tuple(_plain(row[at]) for at in order) for row in cursor.fetchall())


# Spark's names for DuckDB's types.
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}


def type_difference(df, con, sql: str) -> str | None:
    wanted = {row[0]: _TYPES.get(row[1], row[1]) for row in con.execute(f"describe {sql}").fetchall()}
    found = dict(df.dtypes)
    return None if found == wanted else f"types {found} != {wanted}"


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names, found = rows_of_spark(df)
    wanted_names, wanted = rows_of_sql(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if found != wanted:
        extra, absent = list((found - wanted).items())[:2], list((wanted - found).items())[:2]
        return f"{sum(found.values())} rows, {sum(wanted.values())} wanted; only here {extra}; only there {absent}"
    if not wanted:
        return "no rows at all"
    return None
