"""Compare registered queries with their SQL, the way the driver does."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    return value


def sorted_rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, sf_dir: str, sql: str) -> str | None:
    """None if both sides hold the same rows under the same column names."""
    columns, rows = oracle_rows(sf_dir, sql)
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    ours = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = sorted_rows(columns, rows)
    if ours == theirs:
        return None if rows else "empty result"
    more, less = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows, {sum(more.values())} only here "
        f"{list(more)[:3]}, {sum(less.values())} only there {list(less)[:3]}"
    )


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from __spark_entry__ import oracle_sql, queries
    from harvestline.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql = oracle_sql()
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = build(spark, sf)
            if name in sql:
                outcome = differences(frame, sf, sql[name]) or "ok"
            else:
                outcome = f"rows only: {len(frame.collect())}"
        except Exception as error:
            outcome = f"ERROR {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {outcome}", flush=True)
