"""Run registered queries next to their SQL and compare rows.

    python -m tests.compare [folder] [name ...]
"""

from __future__ import annotations

import collections
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, int):
        return value
    return float(value) if type(value).__name__ == "Decimal" else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    counted = collections.Counter(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], counted


def compare(spark, con, query, sql, folder):
    """None if equal, else what differs."""
    at = time.time()
    df = query(spark, folder)
    planned = time.time()
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    print(f"    built {planned - at:.2f}s, ran {time.time() - planned:.2f}s")
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    only_mine, only_theirs = mine[1] - theirs[1], theirs[1] - mine[1]
    if only_mine or only_theirs:
        return (
            f"{sum(mine[1].values())} rows != {sum(theirs[1].values())}; "
            f"{sum(only_mine.values())} only here, e.g. {str(next(iter(only_mine), None))[:600]}; "
            f"{sum(only_theirs.values())} only there, e.g. {str(next(iter(only_theirs), None))[:600]}"
        )
    return None


def main(folder="/root/testdata/sf0.01", *names):
    import __spark_entry__ as entry
    from pagemill.session import build_session

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        at = time.time()
        try:
            problem = compare(spark, con, query, oracles[name], folder) if name in oracles else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - at:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
