"""Registered queries: a Spark callable and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_pct(a: str, b: str, guard: bool = False) -> str:
    """SQL text of a two-digit, half-even percentage."""
    share = f"round_even(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) * 100 * 100, 0) / 100"
    rest = "0.0" if guard else "NULL"
    return f"CASE WHEN {b} {'>' if guard else '<>'} 0 THEN {share} ELSE {rest} END"


def sql_zfill(text: str, width: int) -> str:
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"
