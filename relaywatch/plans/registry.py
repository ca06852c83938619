"""Registry of named queries and their SQL twins.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the driver's
tables (or frames Spark derives from them). The SQL twin, when there is one,
is DuckDB SQL over the same tables; both alias every computed column to the
same name and round doubles to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FLAGSHIP = "a2_delivery_summary"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every DOUBLE column (results are compared across engines)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def sql_pct(n: str, d: str, if_zero: str = "0.0") -> str:
    return (f"round(CASE WHEN ({d}) > 0 THEN CAST({n} AS DOUBLE) * 100.0 / ({d}) "
            f"ELSE {if_zero} END, 6)")
