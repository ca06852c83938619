"""Registered queries (``QUERIES``) and their DuckDB SQL twins (``ORACLE``)."""

from relaywatch.plans import (q_demand, q_diagnose, q_kpis, q_reliability,  # noqa: F401
                              q_search, q_streaming)
from relaywatch.plans.registry import FLAGSHIP, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "FLAGSHIP"]
