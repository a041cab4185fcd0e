"""Runs named queries on Spark and their SQL on DuckDB and compares the rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _family(type_name: str) -> str:
    names = {
        "bigint": "bigint",
        "int": "integer",
        "integer": "integer",
        "double": "double",
        "string": "varchar",
        "varchar": "varchar",
        "boolean": "boolean",
        "date": "date",
        "timestamp_ntz": "timestamp",
        "timestamp": "timestamp",
    }
    return names.get(type_name.lower(), type_name.lower())


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Differences between the two results; empty when they are equal."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    spark_types = {n: _family(t) for n, t in df.dtypes}
    rows = Counter(tuple(r) for r in df.select(*columns).collect())
    rel = con.sql(sql)
    duck_types = {n: _family(str(t)) for n, t in zip(rel.columns, rel.types)}
    problems = []
    if spark_types != duck_types:
        diff = set(spark_types.items()) ^ set(duck_types.items())
        problems.append(f"types {sorted(diff)}")
        if set(spark_types) != set(duck_types):
            return problems
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(con.sql(f"SELECT {listed} FROM ({sql})").fetchall())
    if rows != expected:
        problems.append(
            f"rows {rows.total()} vs {expected.total()}; only Spark "
            f"{list((rows - expected).items())[:3]}; only SQL "
            f"{list((expected - rows).items())[:3]}"
        )
    return problems
