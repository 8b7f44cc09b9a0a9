"""Run a query and its SQL twin and compare the rows. Also a script:

    python tests/oracle.py [folder] [query ...]
"""

import os
import sys
import time
from glob import glob

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder):
    connection = duckdb.connect()
    for path in glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if isinstance(value, bool):
        return value
    if hasattr(value, "tolist"):
        return [normal(v) for v in value.tolist()]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, folder, query, sql):
    """(problem or None, rows, seconds of the query)"""
    start = time.time()
    frame = query(spark, folder)
    found = [tuple(row) for row in frame.collect()]
    seconds = time.time() - start
    if sql is None:
        return None, len(found), seconds
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}", len(found), seconds
    ours, theirs = rows_of(frame.columns, found), rows_of(names, expected)
    if ours != theirs:
        extra = [row for row in ours if row not in theirs][:3] if len(ours) < 20_000 else []
        lacking = [row for row in theirs if row not in ours][:3] if len(ours) < 20_000 else []
        return f"{len(ours)} rows, expected {len(theirs)}; extra {extra}; lacking {lacking}", len(found), seconds
    return None, len(found), seconds


def main():
    from __spark_entry__ import oracle_sql, queries
    from repoquarry.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cores=8, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles, failed = oracle_sql(), 0
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        try:
            problem, n, seconds = compare(spark, connection, folder, query, oracles.get(name))
        except Exception as error:  # report and go on
            problem, n, seconds = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        failed += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {kind:4s} {n:8d} rows {seconds:6.2f} s  {problem or ''}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
