"""Run registered queries against their SQL counterparts in DuckDB and compare every value.

    python -m tests.compare [--sf 0.01] [key ...]
"""

from __future__ import annotations

import argparse
import tempfile
import time
from datetime import date, datetime
from decimal import Decimal
from typing import NamedTuple

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("num", format(value.normalize(), "f"))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("num", str(value))
    if isinstance(value, float):
        return ("num", str(int(value))) if value.is_integer() else ("float", repr(value))
    if isinstance(value, datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(_plain(v) for v in value))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


class Result(NamedTuple):
    columns: list[str]
    values: list[tuple]


def spark_result(df) -> Result:
    return Result(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, text) -> Result:
    found = con.execute(text)
    return Result([d[0] for d in found.description], found.fetchall())


def differences(found: Result, con, text) -> list[str]:
    """Empty if columns, row count and all values agree."""
    expected = duck_result(con, text)
    if sorted(found.columns) != sorted(expected.columns):
        return [f"columns {sorted(found.columns)} / {sorted(expected.columns)}"]
    faults = []
    if len(found.values) != len(expected.values):
        faults.append(f"rows {len(found.values)} / {len(expected.values)}")
    left, right = rows_of(*found), rows_of(*expected)
    if left != right:
        only_left = sorted(set(left) - set(right), key=repr)[:3]
        only_right = sorted(set(right) - set(left), key=repr)[:3]
        faults.append(f"{sorted(found.columns)}\n  spark  {only_left}\n  duckdb {only_right}")
    return faults


SQL_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_differences(df, con, text) -> list[str]:
    """Columns of another type; decimals only have to agree in their scale."""
    expected = {name: kind for name, kind, *_ in con.execute(f"describe {text}").fetchall()}

    def agrees(kind: str, other: str) -> bool:
        if kind.startswith("decimal"):
            return other.startswith("DECIMAL") and kind.rstrip(")").split(",")[1] == other.rstrip(")").split(",")[1]
        return SQL_TYPES.get(kind) == other

    found = [(f.name, f.dataType.simpleString(), expected.get(f.name, "")) for f in df.schema.fields]
    return [f"{name}: {kind} / {other}" for name, kind, other in found if not agrees(kind, other)]


def main() -> None:
    import __spark_entry__ as entry
    from lakeloom.session import get_spark

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    shared = tempfile.mkdtemp(prefix="compare-")
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": shared}
    spark = get_spark("compare", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = connect(folder)
    bad = 0
    wanted = [k for k in queries if not args.keys or any(k.startswith(p) for p in args.keys)]
    for key in wanted:
        start = time.time()
        try:
            df = queries[key](spark, folder)
            if key in oracles:
                found = type_differences(df, con, oracles[key]) + differences(spark_result(df), con, oracles[key])
                verdict = "ok" if not found else "DIFFERENT"
            else:
                found, verdict = [], f"rows only ({len(df.collect())})"
        except Exception as error:  # keep going, report all
            found, verdict = [f"{type(error).__name__}: {str(error)[:1500]}"], "FAILED"
        bad += bool(found)
        print(f"{time.time() - start:6.1f}s {key}: {verdict}", *found, sep="\n   " if found else " ", flush=True)
    print(f"{len(wanted)} queries, {bad} bad, {sum(k in oracles for k in wanted)} with SQL")
    spark.stop()


if __name__ == "__main__":
    main()
