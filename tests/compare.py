"""Compare registered queries with their SQL in DuckDB: `python tests/compare.py SF_DIR [name ...]`."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str):
    try:
        import duckdb
    except ImportError:
        sys.path.append("/opt/oracle")
        import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(oracle_sql()[name])
    theirs = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns differ: {mine[0]} / {theirs[0]}", len(mine[1])
    if len(mine[1]) != len(theirs[1]):
        return f"rows differ: {len(mine[1])} / {len(theirs[1])}", len(mine[1])
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1], strict=True) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first: {wrong[0]}", len(mine[1])
    return "ok", len(mine[1])


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from stationfield.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        **{
            "spark.master": "local[8]", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_views(sf_dir)
    for name in wanted or queries():
        if name not in oracle_sql():
            print(f"{name:32} no SQL", flush=True)
            continue
        start = time.time()
        try:
            verdict, n = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            verdict, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        print(f"{name:32} {n:8} {time.time() - start:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
