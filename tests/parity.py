"""Run queries on Spark and their SQL on DuckDB, and compare columns, types and values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def compare(df, con, sql: str) -> str:
    """'' when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    types = dict(zip(names, [str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()]))
    order = sorted(names)
    if sorted(df.columns) != order:
        return f"columns {sorted(df.columns)} != {order}"
    problems = [
        f"type of {n}: {t} != {types[n]}" for n, t in df.dtypes if SPARK_TO_DUCK.get(t, t) != types[n]
    ]
    at = [names.index(n) for n in order]
    want = sorted((tuple(_plain(r[i]) for i in at) for r in want), key=_key)
    got = sorted((tuple(_plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in order]).collect()), key=_key)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    else:
        wrong = [(g, w) for g, w in zip(got, want) if g != w]
        if wrong:
            problems.append(f"{len(wrong)} of {len(got)} rows differ, first: {wrong[0]}")
    return "; ".join(problems)


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"({len(df.collect())} rows, no SQL)"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        ok = not problem or problem.startswith("(")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
