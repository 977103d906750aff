"""Comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def plain(value):
    """A value in the form both engines agree on."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(df, con, text):
    """Problems found, as text; empty when schema and rows agree."""
    relation = con.sql(text)
    ours = dict(df.dtypes)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if set(ours) != set(theirs):
        return f"columns {sorted(ours)} / {sorted(theirs)}"
    types = {c: (ours[c], theirs[c]) for c in ours if SPARK_TYPES.get(ours[c], ours[c]) != theirs[c]}
    names = sorted(ours)
    left = sorted(tuple(plain(row[c]) for c in names) for row in df.select(*names).collect())
    order = [list(relation.columns).index(c) for c in names]
    right = sorted(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    if left != right:
        wrong = [(a, b) for a, b in zip(left, right) if a != b][:2]
        return f"rows {len(left)} / {len(right)}, first differences {names} {wrong}"
    return f"types {types}" if types else ""
