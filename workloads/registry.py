"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from examloom.functions.text import WHITESPACE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The whitespace class and line breaks as the SQL engine spells them.
SQL_SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SQL_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_strip(expr: str) -> str:
    return f"trim({expr}, '{WHITESPACE}')"


def sql_lines(expr: str) -> str:
    return f"regexp_split_to_array({expr}, '{SQL_BREAK}')"


def sql_tokens(expr: str) -> str:
    return f"coalesce(len(regexp_extract_all({expr}, '[^{SQL_SPACE}]+')), 0)::BIGINT"


def sql_index(n: str, seed: int, purpose: str, *keys: str) -> str:
    key = "||'|'||".join([f"'{seed}|{purpose}'", *(f"({k})::VARCHAR" for k in keys)])
    return f"(('0x'||substr(md5({key}),1,8))::BIGINT % ({n}))"


def sql_hash(seed: int, purpose: str, *keys: str) -> str:
    key = "||'|'||".join([f"'{seed}|{purpose}'", *(f"({k})::VARCHAR" for k in keys)])
    return f"md5({key})"
