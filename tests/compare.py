"""Side-by-side run of the registered queries and their SQL twins."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) + 0.0
    return v


def rows_of(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_plain(v) for v in row) for row in zip(*columns, strict=True))


def compare(spark, con, sf_dir: str, build, sql: str | None) -> dict:
    start = time.time()
    got = build(spark, sf_dir).toArrow()
    out = {"rows": got.num_rows, "sec": round(time.time() - start, 2)}
    if sql is None:
        return out
    want = con.sql(sql).to_arrow_table()
    out["types"] = {
        n: (str(got.schema.field(n).type), str(want.schema.field(n).type))
        for n in set(got.column_names) & set(want.column_names)
        if str(got.schema.field(n).type).removeprefix("large_")
        != str(want.schema.field(n).type).removeprefix("large_")
    }
    out["columns"] = sorted(got.column_names) == sorted(want.column_names)
    if not out["columns"]:
        out["names"] = (got.column_names, want.column_names)
        out["equal"] = False
        return out
    a, b = rows_of(got), rows_of(want)
    out["equal"] = a == b
    if a != b:
        out["want_rows"] = want.num_rows
        out["extra"] = list((a - b).items())[:3]
        out["missing"] = list((b - a).items())[:3]
    return out


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from formline.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(queries())
    spark = local_session("compare", 8)
    con = oracle_connection(sf_dir)
    for key in wanted:
        try:
            print(key, compare(spark, con, sf_dir, queries()[key], oracle_sql().get(key)), flush=True)
        except Exception as e:  # noqa: BLE001
            print(key, "FAILED", str(e)[:1500], flush=True)
