"""Runs a registered query beside its SQL and compares rows by column name."""

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(folder, table)}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if value.__class__.__name__ == "Decimal":
        return float(f"{float(value):.9g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, db, sql):
    """What differs, as text; empty where the results are the same."""
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    theirs = _rows(columns, result.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if ours == theirs:
        return ""
    only_ours = [r for r in ours if r not in set(theirs)][:4]
    only_theirs = [r for r in theirs if r not in set(ours)][:4]
    return f"{len(ours)} rows != {len(theirs)} rows; ours {only_ours}; theirs {only_theirs}"
