"""Registration of queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def registry():
    """``queries, oracles, query``: two tables and the decorator that fills them."""
    queries, oracles = {}, {}

    def query(sql: str | None = None):
        def register(function):
            queries[function.__name__] = function
            if sql is not None:
                oracles[function.__name__] = sql
            return function

        return register

    return queries, oracles, query


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})
