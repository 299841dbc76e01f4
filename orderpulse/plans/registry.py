"""All queries by name, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from orderpulse.plans import facts, monitoring, quality, serving, streams

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (facts, serving, quality, monitoring, streams)


def _without_zone(query: Query) -> Query:
    """Result times as the test tables hold them: UTC without a zone."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = query(spark, sf_dir)
        zoned = [f.name for f in result.schema if isinstance(f.dataType, TimestampType)]
        return result.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})

    return run


def queries() -> dict[str, Query]:
    return {name: _without_zone(query) for m in _MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
