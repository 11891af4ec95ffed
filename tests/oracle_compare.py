"""Compare a registered query with its oracle SQL run by DuckDB.

Row count, column names and an order-insensitive multiset of rows must
agree. A test tool: it collects whole results. Used by the test-suite and by
``python tests/oracle_compare.py SF_DIR [QUERY...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from dataclasses import dataclass

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass
class Outcome:
    name: str
    rows_spark: int
    rows_oracle: int
    columns_match: bool
    values_match: bool
    seconds: float
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.columns_match and self.values_match and self.rows_spark == self.rows_oracle


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _norm(value):
    if isinstance(value, dict):
        return tuple(sorted((k, _norm(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return _norm(value.asDict(recursive=True))
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9)
    if hasattr(value, "item"):
        return _norm(value.item())
    return value


def _rows(columns: list[str], records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(rec[i]) for i in order) for rec in records)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> Outcome:
    start = time.time()
    df = query(spark, sf_dir)
    spark_cols = df.columns
    spark_rows = _rows(spark_cols, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    rel = con.execute(sql)
    oracle_cols = [d[0] for d in rel.description]
    oracle_rows = _rows(oracle_cols, rel.fetchall())
    columns_match = sorted(spark_cols) == sorted(oracle_cols)
    values_match = spark_rows == oracle_rows
    detail = ""
    if not values_match:
        only_spark = list((spark_rows - oracle_rows).items())[:3]
        only_oracle = list((oracle_rows - spark_rows).items())[:3]
        detail = f"spark-only {only_spark} oracle-only {only_oracle}"
    if not columns_match:
        detail += f" columns spark={spark_cols} oracle={oracle_cols}"
    return Outcome(
        name, sum(spark_rows.values()), sum(oracle_rows.values()),
        columns_match, values_match, seconds, detail,
    )


def main(argv: list[str]) -> int:
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries

    from quiver.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb_connection(sf_dir)
    sqls = oracle_sql()
    failed = 0
    for name in names:
        if name not in sqls:
            print(f"{name:28s} no oracle")
            continue
        out = compare(spark, con, name, queries()[name], sqls[name], sf_dir)
        failed += not out.ok
        flag = "ok  " if out.ok else "FAIL"
        print(f"{flag} {name:26s} rows {out.rows_spark:>9d}/{out.rows_oracle:<9d} {out.seconds:6.2f}s {out.detail}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
