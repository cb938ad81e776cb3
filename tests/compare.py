"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, missing values alike, sorted."""

    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return ("", None)
        if isinstance(value, float):
            return ("n", value + 0.0)
        if isinstance(value, (bool, int)) or type(value).__module__ == "numpy":
            return ("n", float(value) if type(value).__name__.startswith(("float", "int")) else value)
        if hasattr(value, "isoformat"):
            return ("d", pd.Timestamp(value).isoformat())
        return ("t", str(value))

    columns = sorted(frame.columns)
    rows = [tuple(cell(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} against {sorted(sql_frame.columns)}"
    left, right = normal(spark_frame), normal(sql_frame)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    unequal = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None


def main(sf_dir: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from homelake.session import build_session

    spark = build_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls = oracle(sf_dir), oracle_sql()
    failed = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            mine = run(spark, sf_dir).toPandas()
            spent = time.time() - start
            verdict = f"rows only {len(mine)}"
            if name in sqls:
                start = time.time()
                theirs = connection.execute(sqls[name]).df()
                found = difference(mine, theirs)
                verdict = f"{'DIFF ' + found[:600] if found else 'ok'} ({len(mine)} rows, sql {time.time() - start:.2f}s)"
                failed += bool(found)
        except Exception as problem:  # report and go on with the next query
            spent, verdict, failed = time.time() - start, f"ERROR {str(problem)[:900]}", failed + 1
        print(f"{name:28s} {spent:6.2f}s {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
