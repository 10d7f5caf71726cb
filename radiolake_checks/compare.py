"""Run registered queries next to their oracle SQL: python -m radiolake_checks.compare 0.01 [names]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TESTDATA = "/root/testdata"


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _bag(columns: list[str], rows: list) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark_result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' when columns and rows are equal, else what differs."""
    ours = _bag(spark_result.columns, [tuple(r) for r in spark_result.collect()])
    answer = connection.execute(sql)
    theirs = _bag([d[0] for d in answer.description], answer.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return ""
    extra, missing = list((ours[1] - theirs[1]))[:2], list((theirs[1] - ours[1]))[:2]
    counts = f"{sum(ours[1].values())} rows against {sum(theirs[1].values())}"
    return f"{counts}; only here {extra}; only there {missing}"


def main(argv: list[str]) -> int:
    from radiolake.session import local_session
    from radiolake_checks.oracle import all_sql
    from radiolake_checks.queries import all_queries

    sf_dir = f"{TESTDATA}/sf{argv[0]}"
    spark: SparkSession = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, failed = tables(sf_dir), all_sql(), 0
    for name, run in all_queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            found = difference(run(spark, sf_dir), connection, oracle[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name} {time.time() - start:.1f}s {found}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
