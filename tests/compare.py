"""Runs registered queries and their SQL side by side."""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return int(value)
    if isinstance(value, float) and math.isinf(value):
        return "inf"
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return value


def _sorted_rows(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, types and rows agree, in any order."""
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    names = sorted(types)
    expected = [tuple(dict(zip(types, row))[n] for n in names) for row in cursor.fetchall()]
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    found = []
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} != {types[name]}")
    left = _sorted_rows(df.select(*names).collect())
    right = _sorted_rows(expected)
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)}")
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        found.append(f"{len(different)} rows differ, first {different[0]}")
    return found


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as registered
    from filetide.session import local_session

    sf_dir = f"/root/testdata/sf{argv[0]}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), registered.oracle_sql(), 0
    for name, query in registered.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            found = differences(query(spark, sf_dir), con, sqls[name]) if name in sqls else [
                f"no SQL, {query(spark, sf_dir).count()} rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"\n{'BAD' if found else 'ok '} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
