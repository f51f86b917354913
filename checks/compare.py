"""Run the queries next to their SQL twins: ``python -m checks.compare SF_DIR [query …]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, db, sf_dir: str, name: str) -> str:
    """Empty if both sides agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    theirs = canonical(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in result.description}
    wrong = {c: (t, types[c]) for c, t in df.dtypes if _TYPES[t] != types[c]}
    if wrong:
        return f"types {wrong}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sum(x != y for x, y in zip(ours, theirs))} rows differ, first {a} / {b}"
    return ""


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = database(sf_dir), 0
    for name in names or QUERIES:
        started = time.time()
        if name not in ORACLE:
            problem = "" if QUERIES[name](spark, sf_dir).count() else "no rows"
            kind = "rows"
        else:
            problem, kind = compare(spark, db, sf_dir, name), "sql"
        failed += bool(problem)
        print(f"{name}: {problem[:1500] or 'ok'} ({kind}, {time.time() - started:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
