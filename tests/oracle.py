"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TYPE_NAMES = {
    "bigint": "bigint", "int": "int", "smallint": "smallint", "tinyint": "tinyint", "double": "double",
    "float": "float", "string": "string", "boolean": "boolean",
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint", "DOUBLE": "double",
    "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(row[i]) for i in order) for row in rows]
    out.sort(key=_key)
    return [names[i] for i in order], out


def compare(spark, sf_dir, run, sql) -> str | None:
    """None when rows, names and types agree, otherwise what differs."""
    df = run(spark, sf_dir)
    names, ours = _sorted(df.collect(), df.columns)
    types = [TYPE_NAMES.get(dict(df.dtypes)[n], dict(df.dtypes)[n]) for n in names]
    if sql is None:
        return None if ours else "no rows"
    rel = connect(sf_dir).sql(sql)
    kinds = dict(zip(rel.columns, rel.types))
    their_names, theirs = _sorted(rel.fetchall(), rel.columns)
    if names != their_names:
        return f"columns {set(names) ^ set(their_names)}"
    their_types = [TYPE_NAMES.get(str(kinds[n]), str(kinds[n])) for n in names]
    off = [(n, a, b) for n, a, b in zip(names, types, their_types) if a != b]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(bad)}/{len(ours)} rows differ, first: {cells[:4]} (types {off})"
    if off:
        return f"types {off}"
    return None if ours else "no rows"
