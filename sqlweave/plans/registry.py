"""All registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from sqlweave.plans import lineage_queries
    out = dict(lineage_queries.QUERIES)
    for mod in ("sqlweave.plans.column_queries", "sqlweave.plans.workloads",
                "sqlweave.streaming.query_log"):
        m = __import__(mod, fromlist=["QUERIES"])
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    from sqlweave.plans import lineage_oracle
    out = dict(lineage_oracle.oracles())
    for mod in ("sqlweave.plans.column_oracle", "sqlweave.plans.workload_oracle"):
        m = __import__(mod, fromlist=["oracles"])
        out.update(m.oracles())
    return out
