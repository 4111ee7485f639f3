"""Compare every registered query with its SQL counterpart on one table folder.

``python -m checks.compare [folder] [name ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("FATAL")
    return spark


def database(folder: str):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in data), key=repr
    )


def compare(spark, connection, folder: str, name: str) -> str:
    """Empty when both results are equal, else what differs."""
    frame = QUERIES[name](spark, folder)
    ours = rows(frame.columns, frame.collect())
    result = connection.execute(ORACLES[name])
    theirs = rows([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    differing = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b or list(map(type, a)) != list(map(type, b))]
    return f"{len(differing)} rows differ, first {differing[0]}" if differing else ""


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark, connection = session(), database(folder)
    failed = 0
    for name in arguments[1:] or QUERIES:
        if name not in ORACLES:
            print(f"{name:28} no SQL")
            continue
        started = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += bool(problem)
        print(f"{name:28} {time.time() - started:6.2f}s {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
