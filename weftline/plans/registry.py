"""Registry of named queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from weftline.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tuned(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tune(spark)
        return fn(spark, folder)

    return run


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is only checked by tests."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = tuned(fn)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# SQL for the lines and words of ``documents``, shared by several oracles.
LINES_SQL = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"
WORDS_SQL = f"""
SELECT doc_id, unnest(CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
                           ELSE string_split(rtrim(line, ' '), ' ') END) AS word
FROM ({LINES_SQL})"""
TRIMMED_WORDS_SQL = rf"""
SELECT doc_id, unnest(string_split(
    regexp_replace(line, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'), ' ')) AS word
FROM ({LINES_SQL})"""
