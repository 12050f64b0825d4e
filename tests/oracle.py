"""Side-by-side comparison of a registered query and its SQL twin."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return repr(value + 0.0 if value else 0.0)
    return None if value is None else f"{type(value).__name__}:{value}"


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=str)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree in names, types, row count and every value."""
    ours = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = normal(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    off = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(off)} of {len(ours)} rows differ, first {off[0]}" if off else None


if __name__ == "__main__":  # python -m tests.oracle FOLDER [name ...]
    from tillwright.registry import ORACLES, QUERIES
    from tillwright.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
                          **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, query in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = query(spark, folder)
            if name in ORACLES:
                message = difference(df, con, ORACLES[name])
                rows = ""
            else:
                message, rows = None, f"rows only: {len(df.collect())}"
        except Exception as exc:
            message = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += message is not None
        print(f"{'FAIL' if message else 'ok  '} {name} {time.time() - t0:.1f}s {message or rows}", flush=True)
    print("bad:", bad)
