"""Compare every registered query with its SQL: row count, columns, order-insensitive values.

Usage: python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0 if value else 0.0)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, (date, Decimal)):
        return str(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """None if equal, else what differs."""
    frame = query(spark, sf_dir)
    ours = rows_of(frame.columns, frame.collect())
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        left, right = ours[1] - theirs[1], theirs[1] - ours[1]
        return (
            f"rows {ours[1].total()} vs {theirs[1].total()}; only here {left.total()}: {list(left)[:2]}; "
            f"only SQL {right.total()}: {list(right)[:2]}"
        )
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tripflow import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = get_spark("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    connection, wanted, sqls, bad = connect(sf), set(sys.argv[2:]), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.monotonic()
        try:
            if name in sqls:
                outcome = compare(session, connection, query, sqls[name], sf)
            else:
                outcome = f"(no SQL) {query(session, sf).count()} rows"
        except Exception as error:
            outcome = f"FAILED {type(error).__name__}: {str(error)[:300]}"
        bad += bool(outcome) and not str(outcome).startswith("(no SQL)")
        print(f"{time.monotonic() - started:6.1f}s {name:28s} {outcome or 'equal'}", flush=True)
    print("SQL without query:", sorted(set(sqls) - set(entry.queries())), "| differing:", bad)
