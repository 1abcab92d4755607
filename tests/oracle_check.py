"""Compare every query with its SQL twin: ``python -m tests.oracle_check [sf] [name …]``."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, name, sf_dir):
    """Differences between both results, empty when equal."""
    df = queries()[name](spark, sf_dir)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    want = bag(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(columns)}"], sum(got.values())
    types = [
        f"type of {n}: {a} against {b}"
        for n, a, b in (
            (c[0], dict(df.dtypes)[c[0]], str(c[1])) for c in result.description
        )
        if kind(a) != kind(b)
    ]
    diff = [f"only Spark: {list((got - want).items())[:3]}"] if got - want else []
    diff += [f"only SQL: {list((want - got).items())[:3]}"] if want - got else []
    return diff + types, sum(got.values())


def kind(name):
    name = name.lower()
    for family, words in {
        "double": ("double", "float"), "decimal": ("decimal",), "bigint": ("bigint", "hugeint"),
        "int": ("int", "smallint"), "string": ("string", "varchar"),
    }.items():
        if name.startswith(words):
            return family if family != "bigint" else name
    return name


def main():
    from adtally.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            if name in oracle_sql():
                diff, rows = compare(spark, con, name, sf_dir)
            else:
                diff, rows = [], len(query(spark, sf_dir).collect())
        except Exception as error:  # noqa: BLE001
            diff, rows = [f"{type(error).__name__}: {str(error)[:1500]}"], 0
        failed += bool(diff)
        print(f"{'FAIL' if diff else 'ok':5}{name:32}{rows:8} rows {time.time() - started:6.2f}s", flush=True)
        for line in diff:
            print("     ", line, flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
