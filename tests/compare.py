"""Spark results against DuckDB results: same columns, same types of values, same rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return db


def canonical(table) -> list[tuple]:
    """Rows of an Arrow table, columns by name, values as text, in a fixed order."""
    table = table.select(sorted(table.column_names))
    rows = zip(*[c.to_pylist() for c in table.columns], strict=True)
    return sorted(tuple(repr(v) for v in row) for row in rows)


def differences(spark_df, db, sql: str) -> str | None:
    mine, theirs = spark_df.toArrow(), db.sql(sql).to_arrow_table()
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(mine.column_names)} / {sorted(theirs.column_names)}"
    kinds = [
        f"{n}: {mine.schema.field(n).type} / {theirs.schema.field(n).type}"
        for n in sorted(mine.column_names)
        if str(mine.schema.field(n).type).removeprefix("large_").split("[")[0]
        != str(theirs.schema.field(n).type).removeprefix("large_").split("[")[0]
    ]
    if kinds:
        return f"types {kinds}"
    a, b = canonical(mine), canonical(theirs)
    if a != b:
        only = (sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2])
        return f"rows {len(a)} / {len(b)}; only here {only[0]}; only there {only[1]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from deskwise.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls, failed = connect(sf_dir), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            verdict = differences(result, db, sqls[name]) if name in sqls else None
            rows = result.count() if names else ""
        except Exception as error:  # noqa: BLE001
            verdict, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - start:.1f}s {rows} {verdict or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
