"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def spark_types(df) -> dict[str, str]:
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    return {n: names.get(t, t) for n, t in df.dtypes}


def difference(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None if rows, names, types and values agree."""
    df = fn(spark, sf_dir)
    rows = [tuple(plain(v) for v in r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = [tuple(plain(v) for v in r) for r in result.fetchall()]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    mine = spark_types(df)
    wrong = {n: (mine[n], types[n]) for n in names if mine[n] != types[n]}
    if wrong:
        return f"types {wrong}"
    order = sorted(names)
    a = sorted((tuple(r[df.columns.index(n)] for n in order) for r in rows), key=repr)
    b = sorted((tuple(r[names.index(n)] for n in order) for r in expected), key=repr)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, e.g. {bad[:2]} in {order}" if bad else None


if __name__ == "__main__":
    from rankloom.session import build_session
    import __spark_entry__ as entry

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, sf, fn, oracles[name])
            else:
                problem = None if fn(spark, sf).count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.2f}s {'' if name in oracles else '(no sql)'} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
