"""Compare a Spark result with a DuckDB result, ignoring row order."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0  # exact, but 0 has no sign
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT",
}


def type_differences(frame, relation):
    theirs = dict(zip(relation.columns, (str(kind) for kind in relation.types)))
    found = []
    for name, kind in frame.dtypes:
        want = KINDS.get(kind, kind.upper())
        if theirs.get(name) != want:
            found.append((name, kind, theirs.get(name)))
    return found


def difference(frame, sql, db):
    """None when equal, otherwise a short account of what differs."""
    relation = db.sql(sql)
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} / {sorted(relation.columns)}"
    mine = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    theirs = rows_of(relation.columns, relation.fetchall())
    if mine == theirs:
        return None
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} / {sum(theirs.values())} rows; {sum(only_mine.values())} only here, e.g. "
        f"{sorted(only_mine, key=repr)[:2]}; {sum(only_theirs.values())} only there, e.g. "
        f"{sorted(only_theirs, key=repr)[:2]}"
    )
