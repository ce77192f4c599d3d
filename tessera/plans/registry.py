"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the job is expressible in SQL, an equivalent DuckDB statement used as oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


ROUND_DECIMALS = 9


def register(name: str, sql: str | None = None, rounded: tuple[str, ...] = (),
             decimals: int = ROUND_DECIMALS) -> Callable[[QueryFn], QueryFn]:
    """Register a query.  ``rounded`` names double columns whose value depends on the
    summation order (sums, means, variances): both the Spark result and the oracle round
    them to ``decimals`` places so the engines compare equal."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            for c in rounded:
                df = df.withColumn(c, F.round(F.col(c), decimals))
            return df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run if rounded else fn
        if sql is not None:
            body = sql.strip()
            if rounded:
                repl = ", ".join(f"round({c}, {decimals}) AS {c}" for c in rounded)
                body = f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) AS q"
            ORACLE_SQL[name] = body
        return fn
    return deco
