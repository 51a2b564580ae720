"""Run the driver queries next to their SQL twins: python tests/oracle.py SF_DIR [name ...]."""

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN"}


def connect(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def _value(v):
    return float(v) if isinstance(v, decimal.Decimal) else v.isoformat() if isinstance(
        v, (dt.date, dt.datetime)) else v


def compare(spark, con, query, sql, sf):
    """Differences of names, types or rows; an empty list when both agree."""
    df = query(spark, sf)
    rows = df.collect()
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    expected = cursor.fetchall()
    problems = []
    names = sorted(df.columns)
    if names != sorted(n for n, _ in described):
        return [f"columns {df.columns} != {[n for n, _ in described]}"]
    types = dict(df.dtypes)
    for name, dtype in described:
        if SPARK_TYPES.get(types[name], types[name]) != dtype:
            problems.append(f"{name}: {types[name]} != {dtype}")
    order = [[n for n, _ in described].index(n) for n in names]
    got = sorted((tuple(_value(r[n]) for n in names) for r in rows), key=_key)
    want = sorted((tuple(_value(r[i]) for i in order) for r in expected), key=_key)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        problems.append(f"{len(wrong)} rows differ in {names}, first: {wrong[0]}")
    if not got:
        problems.append("no rows")
    return problems


def main():
    from pyspark.sql import SparkSession

    from hubcat.queries import oracle_sql, queries
    from hubcat.session import tune
    sf, names = sys.argv[1], sys.argv[2:]
    spark = (tune(SparkSession.builder.master("local[8]")).config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problems = compare(spark, con, query, sql[name], sf)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s", *problems, sep="\n     "
              if problems else " ", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
