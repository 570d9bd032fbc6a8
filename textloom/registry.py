"""The registry of queries and of the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.operators import glossary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def nested(rules, x: str = "text") -> str:
    for a, b in rules:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def literal_count(rules) -> str:
    x, parts = "text", []
    for a, b in rules:
        parts.append(f"(length({x}) - length(replace({x}, '{a}', ''))) // {len(a)}")
        x = f"replace({x}, '{a}', '{b}')"
    return " + ".join(parts)


def classify_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({x}), '{'|'.join(h)}') THEN '{n}'" for n, h in glossary.HINTS) + " ELSE 'doctrinal' END"
