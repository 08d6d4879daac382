"""Side-by-side run of the named queries in Spark and DuckDB: ``python -m tests.compare``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    """Rows with columns in name order, sorted; numbers of one kind compare as equal."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 6) + 0.0
        return value

    out = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


# Spark and DuckDB names of the same type.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def type_gaps(df, con, sql):
    """Columns whose types differ between the two engines."""
    described = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {
        c: (t, described.get(c))
        for c, t in df.dtypes
        if SAME_TYPE.get(t, t) != described.get(c)
    }


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from briefloom.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = run(spark, SF_DIR)
            got = spark_rows(frame)
            middle = time.time()
            if name not in sqls:
                print(f"{name:24s} rows {len(got[1]):6d} {middle - start:6.2f}s", flush=True)
                continue
            want = duck_rows(con, sqls[name])
            gaps = type_gaps(frame, con, sqls[name])
            ok = got == want and not gaps
            print(
                f"{name:24s} {'OK ' if ok else 'BAD'} {len(got[1]):6d} spark {middle - start:6.2f}s "
                f"duck {time.time() - middle:6.2f}s {gaps or ''}",
                flush=True,
            )
            if got != want:
                differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
                print("   ", got[0], want[0], len(got[1]), len(want[1]), str(differing)[:600])
            bad += not ok
        except Exception as error:
            bad += 1
            print(f"{name:24s} ERROR {str(error)[:700]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
